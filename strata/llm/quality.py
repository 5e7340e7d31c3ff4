"""Quality classifier (operator 7): random-indexing word vectors, a two-layer network.

Every token has a sparse ternary index vector made from its hash. A token's word
vector is the sum of the index vectors of its neighbours over the whole corpus:
integer sums, so task order does not matter. A document is the mean of its tokens'
scaled word and index vectors. A network with one hidden layer (numpy) is fitted on
them; a temperature, chosen on examples the fit did not see, calibrates its
probabilities.

Tokens are hashed into ``buckets`` together with their letter case, so that the
shape of a text is seen as well as its words; an immediate repetition is a token of
its own. The vector table has ``buckets * size`` numbers whatever the corpus.

Bound: at most ``max_examples`` labelled texts are learned from (chosen by hash of
their id). Corpus sums and scores cover all rows and whole texts.

Defined cases: null and empty texts have the zero vector and get its score; a null
``doc_id`` is scored and is never held out; repeated rows are scored alike;
conflicting labels of an id are averaged; without labels every score is 0.5; a long text is
pooled in blocks; an empty table gives an empty result; other columns of the input, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strata.llm.common import TOKEN, WordHashes, held_out, map_batches, map_rows, mix, pieces, word_hash


@dataclass(frozen=True)
class Settings:
    buckets: int = 4096
    size: int = 48
    window: int = 2
    max_examples: int = 6000
    hidden: int = 16
    steps: int = 300
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.mean) * self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


#: Buckets in front of the hashed ones: a token that repeats the one before it.
REPEAT, RESERVED = 0, 1


class Tokens(WordHashes):
    """Bucket of a token: its letters without case, and the kind of case."""

    def __init__(self, buckets: int):
        super().__init__()
        self.share = (buckets - RESERVED) // 4

    def __missing__(self, token: str) -> int:
        if not token[0].isalpha():
            kind = 0
        elif token.islower():
            kind = 1
        else:
            kind = 2 if len(token) == 1 or token[1:].islower() else 3
        if len(self) >= self.LIMIT:
            self.clear()
        bucket = self[token] = RESERVED + kind * self.share + word_hash(token.lower()) % self.share
        return bucket

    def ids(self, text: str | None) -> np.ndarray:
        tokens = TOKEN.findall(text or "")
        found = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if len(found) > 1:
            found[1:][found[1:] == found[:-1]] = REPEAT
        return found


def index_vectors(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket, four places and their signs."""
    codes = mix(np.arange(s.buckets, dtype=np.uint64)[:, None] * np.uint64(4) + np.arange(4, dtype=np.uint64) + np.uint64(s.seed << 32))
    return (codes % np.uint64(s.size)).astype(np.int64), (codes >> np.uint64(63)).astype(np.int64) * 2 - 1


def _dense_index(s: Settings) -> np.ndarray:
    places, signs = index_vectors(s)
    out = np.zeros((s.buckets, s.size))
    np.add.at(out, (np.arange(s.buckets)[:, None], places), signs)
    return out


def corpus_vectors(documents: DataFrame, s: Settings) -> np.ndarray:
    """Sums of the index vectors of all neighbours of each bucket, over all texts.

    Each task adds up its own table and sends the rows that are not zero; Spark
    adds these. The result has a fixed size.
    """
    places, signs = index_vectors(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, total = Tokens(s.buckets), np.zeros(s.buckets * s.size, np.int64)
        for batch in pieces(batches):
            rows = [tokens.ids(t) for t in batch.column(0).to_pylist()]
            apart = [x for r in rows for x in (r, np.full(s.window, -1))]  # texts are no neighbours
            ids = np.concatenate([*apart, np.empty(0, np.int64)])
            for offset in range(1, s.window + 1):
                a, b = ids[:-offset], ids[offset:]
                both = (a >= 0) & (b >= 0)
                a, b = a[both], b[both]
                for word, other in ((a, b), (b, a)):
                    for k in range(places.shape[1]):
                        flat = word * s.size + places[other, k]
                        total += np.bincount(flat, signs[other, k], len(total)).astype(np.int64)
        table = total.reshape(s.buckets, s.size)
        full = np.flatnonzero(table.any(axis=1))
        if len(full):
            yield pa.record_batch([pa.array(full), *(pa.array(c) for c in table[full].T)], ["bucket", *names])

    names = [f"v{i}" for i in range(s.size)]
    parts = map_batches(documents.select("text"), run, "bucket long, " + ", ".join(f"{n} long" for n in names))
    rows = parts.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    out = np.zeros((s.buckets, s.size))
    out[rows["bucket"].to_numpy()] = np.column_stack([rows[n].to_numpy() for n in names])
    return out


def word_table(sums: np.ndarray, s: Settings) -> np.ndarray:
    """Scaled word vectors next to the tokens' own index vectors."""
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.hstack([sums / np.maximum(length, 1), _dense_index(s)]).astype(np.float32)


def pooled(texts: list[str | None], words: np.ndarray, tokens: Tokens) -> np.ndarray:
    """Mean vector of each text, in blocks of bounded size."""
    out = np.zeros((len(texts), words.shape[1]))
    for i, text in enumerate(texts):
        ids = tokens.ids(text)
        for at in range(0, len(ids), 4096):
            out[i] += words[ids[at : at + 4096]].sum(axis=0, dtype=np.float64)
        out[i] /= max(1, len(ids))
    return out


def _learn(x: np.ndarray, y: np.ndarray, s: Settings) -> Network:
    rng = np.random.default_rng(s.seed)
    mean, scale = x.mean(axis=0), 1 / (x.std(axis=0) + 1e-6)
    z = (x - mean) * scale
    par = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], s.hidden)), np.zeros(s.hidden), rng.normal(0, s.hidden**-0.5, s.hidden), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    for step in range(1, s.steps + 1):
        h = np.tanh(z @ par[0] + par[1])
        off = (1 / (1 + np.exp(-np.clip(h @ par[2] + par[3], -40, 40))) - y) / len(y)
        back = np.outer(off, par[2]) * (1 - h**2)
        grads = [z.T @ back + s.decay * par[0], back.sum(axis=0), h.T @ off + s.decay * par[2], np.array([off.sum()])]
        for i, g in enumerate(grads):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g**2
            par[i] = par[i] - s.rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Network(mean, scale, par[0], par[1], par[2], float(par[3][0]), 1.0)


def train(x: np.ndarray, y: np.ndarray, s: Settings) -> Network:
    """Fit on four fifths of the examples; the rest choose the temperature."""
    size = 2 * s.size
    if not len(y):
        return Network(np.zeros(size), np.ones(size), np.zeros((size, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0)
    aside = np.arange(len(y)) % 5 == 4
    net = _learn(x[~aside], y[~aside], s)
    if not aside.any():
        return net
    z, target = net.logits(x[aside]), y[aside]
    heats = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [np.mean(np.logaddexp(0, z / t) - target * z / t) for t in heats]
    return Network(net.mean, net.scale, net.w1, net.b1, net.w2, net.b2, float(heats[int(np.argmin(loss))]))


@dataclass(frozen=True)
class Model:
    words: np.ndarray
    network: Network
    settings: Settings


def fit(documents: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Word vectors from all documents, the network from labels that are not held out."""
    words = word_table(corpus_vectors(documents, s), s)
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(s.max_examples)
    )
    shared = documents.sparkSession.sparkContext.broadcast(words)

    def vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = pooled(batch.column(1).to_pylist(), shared.value, Tokens(s.buckets))
        return pa.record_batch([batch.column(0), pa.array(list(x), pa.list_(pa.float64())), batch.column(2)], ["doc_id", "x", "y"])

    examples = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(F.col("doc_id").cast("long"), "text", "quality")
    rows = map_rows(examples, vectors, "doc_id long, x array<double>, y double").toArrow()
    ids, y = rows["doc_id"].to_numpy(), rows["y"].to_numpy()
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, words.shape[1])
    order = np.lexsort((*x.T[:4], ids, mix(ids)))  # the order of tasks must not matter
    return Model(words, train(x[order], y[order], s), s)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` and ``quality_score`` in a new last column."""
    shared = documents.sparkSession.sparkContext.broadcast(model.words)
    network, buckets = model.network, model.settings.buckets
    tokens = Tokens(buckets)
    at = documents.columns.index("text")
    name = "quality_score"
    while name in documents.columns:
        name = f"_{name}"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = network.probability(pooled(batch.column(at).to_pylist(), shared.value, tokens))
        return pa.record_batch([*batch.columns, pa.array(p)], [*batch.schema.names, name])

    return map_rows(documents, run, StructType([*documents.schema, StructField(name, DoubleType())]))


def quality(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, s: Settings = Settings()) -> DataFrame:
    """Fit, score and decide: ``doc_id, held_out, score, predicted``."""
    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(columns, fit(columns, labels, s))
    p = F.col(scored.columns[-1])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), p.alias("score"), (p >= threshold).cast("int").alias("predicted")
    )


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, s: Settings = Settings()) -> DataFrame:
    """The rows whose score reaches ``threshold``, with their own columns only."""
    scored = score(documents, fit(documents, labels, s))
    return scored.where(F.col(scored.columns[-1]) >= threshold).select(*(F.col(f"`{c}`") for c in documents.columns))
