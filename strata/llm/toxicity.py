"""Toxicity: non-negative positive-unlabelled learning (operator 3).

A sparse logistic model over the words (and beginnings of words) a text contains is trained from confirmed
toxic examples and unlabelled text only. The risk estimator is the
class-prior-corrected one that never lets the estimated negative risk fall below
zero; the prior is the share of toxic rows among the labelled ones. An L1 step
keeps few words, so that long texts do not add up the noise of thousands.

The scores of such a model are not probabilities. Their cut is chosen from positive and
unlabelled text too: of all cuts the one with the largest ``recall ** 2 / share called
toxic`` on texts that the model of the other folds has not seen; it is moved to
``threshold``.

Bounds: at most ``max_positive`` toxic and ``max_unlabelled`` unlabelled texts are
learned from (chosen by hash of their id). Both come from the labelled rows that are not
held out; as unlabelled text these count without their labels. Features are hashed to
``bits`` bits. Scoring reads every whole text, in one pass without a shuffle.

Defined cases: null and empty texts get the score of a text without words; a null
``doc_id`` is scored and is never held out; repeated rows are scored alike and learned from
once; of equal ids with different texts one text is learned from, the same one each time;
without a single toxic example every score is the prior (0 without labels); a long text
counts as the set of its words; an empty table gives an empty result; other columns of the
input, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import TOKEN, held_out, map_rows, word_hash


#: Lengths of the beginnings of a word that count besides the whole word.
BEGINNINGS = (4, 5, 6, 7, None)


@dataclass(frozen=True)
class Settings:
    max_positive: int = 1500
    max_unlabelled: int = 5000
    bits: int = 24
    steps: int = 120
    averaged: int = 30
    rate: float = 0.1
    sparsity: float = 7e-3  # over the root of the number of positive examples
    min_examples: int = 3
    folds: int = 3


@dataclass(frozen=True)
class Model:
    """Weights of the few features that have one, by ascending feature."""

    bias: float
    used: np.ndarray
    weights: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        columns = np.concatenate([*rows, np.empty(0, np.int32)])
        at = np.minimum(np.searchsorted(self.used, columns), max(0, len(self.used) - 1))
        hit = self.used[at] == columns if len(self.used) else np.zeros(len(columns), bool)
        return _sigmoid(np.bincount(owner[hit], self.weights[at[hit]], len(rows)) + self.bias)


class Beginnings(dict):
    """Row of a word in a table of buckets: the word's own and those of its beginnings."""

    LIMIT = 200_000

    def __init__(self, bits: int):
        super().__init__()
        self.shift, self.table = 64 - bits, np.empty((0, len(BEGINNINGS)), np.int32)

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.table):
            self.table = np.resize(self.table, (2 * row + 1024, len(BEGINNINGS)))
        self.table[row] = [word_hash(word[:n]) >> self.shift for n in BEGINNINGS]
        self[word] = row
        return row


def features(texts: list[str | None], known: Beginnings) -> list[np.ndarray]:
    """The hashed words and beginnings of words each text contains, each once."""
    out = []
    for text in texts:
        if len(known) > known.LIMIT:
            known.clear()
        words = set(TOKEN.findall((text or "").lower()))
        rows = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        out.append(np.unique(known.table[rows]))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class _Rows:
    """Sparse 0/1 rows over the kept features."""

    def __init__(self, rows: list[np.ndarray], kept: np.ndarray):
        self.n, self.size = len(rows), len(kept)
        columns = np.concatenate(rows)
        at = np.minimum(np.searchsorted(kept, columns), len(kept) - 1)
        known = kept[at] == columns
        self.columns, self.owner = at[known], np.repeat(np.arange(self.n), [len(r) for r in rows])[known]

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.columns], self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, values[self.owner], self.size)


def train(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, s: Settings
) -> Model:
    """Minimise ``prior * R+(P) + max(0, R-(U) - prior * R-(P))`` with the logistic loss."""
    share = min(max(prior, 1e-9), 1 - 1e-9)
    bias = float(np.log(share / (1 - share)))
    found, counts = np.unique(np.concatenate([*positive, *unlabelled, np.empty(0, np.int32)]), return_counts=True)
    kept = found[counts >= s.min_examples]
    if not positive or not unlabelled or not len(kept):
        return Model(bias, np.empty(0, np.int32), np.empty(0))
    p, u, size = _Rows(positive, kept), _Rows(unlabelled, kept), len(kept)
    w = np.zeros(size)
    mean_w, mean_bias = np.zeros(size), 0.0
    threshold = s.sparsity / np.sqrt(len(positive))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, s.steps + 1):
        at_p, at_u = _sigmoid(p.times(w) + bias), _sigmoid(u.times(w) + bias)
        # d/dz of softplus(-z) is a - 1, of softplus(z) is a.
        up, un, pn = prior * (at_p - 1) / p.n, at_u / u.n, prior * at_p / p.n
        loss = lambda a: float(np.mean(-np.log1p(-np.minimum(a, 1 - 1e-12))))
        negative = loss(at_u) - prior * loss(at_p)
        if negative >= 0:
            grad, grad_b = p.back(up - pn) + u.back(un), float(np.sum(up - pn) + np.sum(un))
        else:  # the estimated negative risk went below zero: undo its overfit
            grad, grad_b = p.back(pn) - u.back(un), float(np.sum(pn) - np.sum(un))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b**2
        fix, fix2 = 1 - 0.9**step, 1 - 0.999**step
        scale = s.rate / (np.sqrt(v / fix2) + 1e-5)
        w = w - scale * m / fix
        w = np.sign(w) * np.maximum(np.abs(w) - scale * threshold, 0)
        bias -= s.rate * (mb / fix) / (np.sqrt(vb / fix2) + 1e-5)
        if step > s.steps - s.averaged:
            mean_w, mean_bias = mean_w + w / s.averaged, mean_bias + bias / s.averaged
    used = np.flatnonzero(mean_w)
    return Model(mean_bias, kept[used], mean_w[used])


def _logit(p: float) -> float:
    p = min(max(p, 1e-9), 1 - 1e-9)
    return float(np.log(p / (1 - p)))


def best_cut(positive: np.ndarray, unlabelled: np.ndarray) -> float | None:
    """The score with the largest ``recall ** 2 / share of unlabelled texts above``."""
    best = (0.0, None)
    for cut in np.unique(positive):
        recall, share = float(np.mean(positive >= cut)), float(np.mean(unlabelled >= cut))
        value = recall**2 / max(share, 1 / len(unlabelled))
        if value > best[0]:
            best = (value, float(cut))
    return best[1]


def train_with_cut(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, threshold: float, s: Settings) -> Model:
    """A model of all examples, whose scores pass ``threshold`` at the best cut."""
    model = train(positive, unlabelled, prior, s)
    if len(positive) < 2 * s.folds or len(unlabelled) < 2 * s.folds or not len(model.used):
        return model
    at_p, at_u = np.zeros(len(positive)), np.zeros(len(unlabelled))
    for k in range(s.folds):
        seen = [[x for i, x in enumerate(rows) if i % s.folds != k] for rows in (positive, unlabelled)]
        other = train(*seen, prior, s)
        at_p[k :: s.folds], at_u[k :: s.folds] = other.scores(positive[k :: s.folds]), other.scores(unlabelled[k :: s.folds])
    cut = best_cut(at_p, at_u)
    return model if cut is None else Model(model.bias + _logit(threshold) - _logit(cut), model.used, model.weights)


def _chosen(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` ids, the same ones for the same data."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _examples(documents: DataFrame, ids: DataFrame, bits: int) -> list[np.ndarray]:
    """Features of the chosen documents; ``ids`` is bounded by the settings."""

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = features(batch.column(1).to_pylist(), Beginnings(bits))
        return pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "words"])

    texts = documents.join(F.broadcast(ids), "doc_id").select(F.col("doc_id").cast("long"), F.col("text").alias("text"))
    once = map_rows(texts, extract, "doc_id long, words array<int>").groupBy("doc_id").agg(F.min("words").alias("words"))
    found = once.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()["words"]  # the order of tasks must not matter
    return [np.asarray(x.as_py(), np.int32) for x in found]


def fit(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, s: Settings = Settings()) -> Model:
    """Learn from the rows of ``labels`` that are not held out."""
    docs = documents.select("doc_id", "text")
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg("toxic").alias("toxic"))
    )
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    positive = _examples(docs, _chosen(known.where("toxic >= 0.5").select("doc_id"), s.max_positive), s.bits)
    unlabelled = _examples(docs, _chosen(known.select("doc_id"), s.max_unlabelled), s.bits) if positive else []
    return train_with_cut(positive, unlabelled, min(max(prior, 1e-9), 0.5), threshold, s)


def score(documents: DataFrame, model: Model, s: Settings = Settings()) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher is more likely toxic) of every row."""
    known = Beginnings(s.bits)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = model.scores(features(batch.column(1).to_pylist(), known))
        return pa.record_batch([batch.column(0), pa.array(p)], ["doc_id", "score"])

    columns = documents.select(F.col("doc_id").cast("long"), "text")
    return map_rows(columns, run, "doc_id long, score double")


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, s: Settings = Settings()) -> DataFrame:
    """Fit, score and decide: ``doc_id, held_out, score, predicted``."""
    scored = score(documents, fit(documents, labels, threshold, s), s)
    decided: Column = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", decided.alias("predicted"))
