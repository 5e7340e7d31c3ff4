"""SentencePiece encoding and decoding (operator 2) by suffix-array matching.

A public SentencePiece BPE model (``model_path``; never trained here) is read by the
driver and travels with the job. In a task, the words of a batch (each with its
leading word mark, each once) are concatenated and indexed by a suffix array; every
piece of the vocabulary is binary-searched for its range of occurrences; the
resulting edges are sorted by position; relaxing them gives the segmentation: each
round every word takes its best edge over two neighbouring symbols (best score,
then leftmost) until none is left, which is this model's definition of a tokenised
word. Pieces never reach over the start of a word, so words are independent.

Characters without a piece become bytes. A word mark (U+2581) inside a text is
written as bytes too, so that every text decodes to itself; while words are matched, a
lone surrogate stands for it, which no UTF-8 text holds.

No shuffle. A batch holds ``BATCH`` bytes of text, or one longer text; the words a task
remembers are bounded (``Encoder.LIMIT``, two generations, so that frequent words stay).

Defined cases: a null text has null ids and decodes to null; an empty text has no ids; a
long text is a batch of its own; repeated rows are encoded alike; null ids of documents
stay null; an empty table gives an empty result; other columns are kept and not read. A new
column takes the place of one that has its name.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from strata.llm.common import map_rows

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: A word with its marks in front; a run of marks belongs to the word behind it.
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Words of more symbols than this are relaxed one at a time, with a heap.
LONG = 256
NONE = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Model:
    """Pieces with their ids and ranks (0 is the best score), and the ids of bytes."""

    ids: np.ndarray
    ranks: np.ndarray
    sizes: np.ndarray
    spelled: np.ndarray  # characters of each piece
    bytes_at: np.ndarray  # id of each byte
    outputs: list[bytes]  # what each id decodes to


def read_model(path: str = MODEL_PATH) -> Model:
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    size = p.get_piece_size()
    normal = [i for i in range(size) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
    scores = np.array([p.get_score(i) for i in normal])
    _, ranks = np.unique(-scores, return_inverse=True)
    bytes_at, outputs = np.zeros(256, np.int64), [b""] * size
    for i in range(size):
        text = p.id_to_piece(i)
        if p.is_byte(i):
            value = int(text[3:5], 16)
            bytes_at[value], outputs[i] = i, bytes([value])
        elif not p.is_control(i):
            outputs[i] = text.replace(MARK, " ").encode()
    texts = [p.id_to_piece(i) for i in normal]
    sizes = np.array([len(x) for x in texts])
    spelled = np.full((len(texts), sizes.max()), -2, np.int64)
    for i, text in enumerate(texts):
        spelled[i, : len(text)] = [ord(c) for c in text]
    return Model(np.array(normal), ranks.astype(np.int64), sizes, spelled, bytes_at, outputs)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their next ``depth`` codes, by doubling.

    The first round already sorts by as many codes as fit into one number.
    """
    found, small = np.unique(codes, return_inverse=True)
    bits = int(len(found)).bit_length()
    length = max(1, min(depth, 62 // bits))
    padded = np.concatenate([small.astype(np.int64) + 1, np.zeros(length, np.int64)])
    key = np.zeros(len(codes), np.int64)
    for k in range(length):
        key = (key << bits) | padded[k : k + len(codes)]
    order = np.argsort(key)
    while length < depth:
        rank = np.empty_like(key)
        rank[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-length] = rank[length:] + 1
        key = rank * (len(codes) + 2) + ahead
        order = np.argsort(key)
        length *= 2
    return order


class Edges:
    """All occurrences of all pieces in a concatenation of words, sorted by position."""

    def __init__(self, text: str, model: Model):
        self.model = model
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        longest, sizes, spelled = model.spelled.shape[1], model.sizes, model.spelled
        self.width = longest + 1
        order = suffix_array(codes, longest)
        lows, highs = np.zeros(len(sizes), np.int64), np.full(len(sizes), len(order), np.int64)
        padded = np.concatenate([codes, np.full(longest, -1)])
        for k in range(longest):  # narrow every piece's range by its next character
            live = np.flatnonzero((sizes > k) & (lows < highs))
            want = spelled[live, k]
            lows[live], highs[live] = (
                self._bound(padded, order, lows[live], highs[live], want + side, k) for side in (0, 1)
            )
        counts = np.maximum(highs - lows, 0)
        piece = np.repeat(np.arange(len(counts)), counts)
        at = order[np.repeat(lows - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
        keys = at * self.width + sizes[piece]
        by_place = np.argsort(keys)
        self.keys, self.piece = keys[by_place], piece[by_place]

    @staticmethod
    def _bound(text: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, want: np.ndarray, k: int) -> np.ndarray:
        """First place of each range whose character ``k`` is not below ``want``."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            below = open_ & (text[order[np.minimum(middle, len(order) - 1)] + k] < want)
            low = np.where(below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        return low

    def pieces(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The piece that spans each stretch, -1 if none."""
        sizes = ends - starts
        keys = starts * self.width + np.minimum(sizes, self.width - 1)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        if not len(self.keys):
            return np.full(len(keys), -1)
        return np.where((self.keys[at] == keys) & (sizes < self.width), self.piece[at], -1)

    def costs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rank of the edge over each stretch, ``NONE`` where there is none."""
        found = self.pieces(starts, ends)
        return np.where(found >= 0, self.model.ranks[found], NONE)


def _relax_long(edges: Edges, start: int, end: int) -> np.ndarray:
    """Symbol starts of one long word; its edges wait in a heap."""
    n = end - start
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    first = edges.costs(np.arange(start, end - 1), np.arange(start + 2, end + 1))
    heap = [(int(c), i, i + 2) for i, c in enumerate(first) if c != NONE]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or after[j] != stop:
            continue
        alive[j], after[i] = False, stop
        if stop < n:
            before[stop] = i
        for a, b in ((before[i], stop), (i, after[stop] if stop < n else n)):
            if a >= 0 and (a != i or stop < n):
                cost = int(edges.costs(np.array([start + a]), np.array([start + b]))[0])
                if cost != NONE:
                    heapq.heappush(heap, (cost, a, b))
    return start + np.flatnonzero(alive)


def relax(edges: Edges, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where symbols start in the concatenation, and to which word each belongs."""
    ends = np.cumsum(sizes)
    long = np.flatnonzero(sizes > LONG)
    apart = [(w, _relax_long(edges, int(ends[w] - sizes[w]), int(ends[w]))) for w in long]
    short = np.repeat(sizes <= LONG, sizes)
    starts = np.flatnonzero(short)
    word = np.repeat(np.arange(len(sizes)), sizes)[starts]
    done_starts, done_words = [s for _, s in apart], [np.full(len(s), w) for w, s in apart]
    stop = np.append(starts[1:], 0)
    last = np.append(word[1:] != word[:-1], True) if len(word) else np.empty(0, bool)
    stop = np.where(last, ends[word], stop)
    cost = np.full(len(starts), NONE)
    inner = np.flatnonzero(~last)
    cost[inner] = edges.costs(starts[inner], stop[inner + 1])
    while len(starts):
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best = np.minimum.reduceat(cost, heads)
        open_ = best != NONE
        lengths = np.diff(np.append(heads, len(word)))
        if not open_.all():  # words without an edge are done
            closed = np.repeat(~open_, lengths)
            done_starts.append(starts[closed])
            done_words.append(word[closed])
            starts, stop, word, cost = starts[~closed], stop[~closed], word[~closed], cost[~closed]
            best, lengths = best[open_], lengths[open_]
            if not len(starts):
                break
            heads = np.cumsum(lengths) - lengths
        hits = np.flatnonzero(cost == np.repeat(best, lengths))
        left = hits[np.concatenate([[True], word[hits][1:] != word[hits][:-1]])]  # leftmost of each word
        stop[left] = stop[left + 1]
        kept = np.ones(len(starts), bool)
        kept[left + 1] = False
        place = np.cumsum(kept) - 1
        starts, stop, word, cost = starts[kept], stop[kept], word[kept], cost[kept]
        merged = place[left]
        for at in (merged, merged[(merged > 0) & (word[merged - 1] == word[merged])] - 1):
            follows = np.append(word[1:] == word[:-1], False)[at]
            cost[at] = NONE
            at = at[follows]
            cost[at] = edges.costs(starts[at], stop[at + 1])
    starts, word = np.concatenate([*done_starts, np.empty(0, np.int64)]), np.concatenate([*done_words, np.empty(0, np.int64)])
    order = np.argsort(starts)
    return starts[order].astype(np.int64), word[order].astype(np.int64)


class Encoder:
    """Ids of words, remembered up to a bound; new ones are matched a batch at a time."""

    LIMIT = 80_000  # words of a generation; two are kept
    AT_ONCE = 30_000  # words in one suffix array

    def __init__(self, model: Model):
        self.model, self.known, self.older = model, {}, {}

    def learn(self, words: list[str]) -> None:
        text = "".join(words)
        sizes = np.array([len(w) for w in words])
        edges = Edges(text, self.model)
        starts, owner = relax(edges, sizes)
        stops = np.append(starts[1:], len(text))
        found = edges.pieces(starts, stops)
        ids = np.where(found >= 0, self.model.ids[found], -1).astype(np.int32)
        at = np.searchsorted(owner, np.arange(len(words) + 1))
        packed, cuts = ids.tobytes(), (at * 4).tolist()
        self.known.update(zip(words, map(packed.__getitem__, map(slice, cuts, cuts[1:])), strict=True))
        for i in np.unique(owner[found < 0]).tolist():  # words with characters that become bytes
            own = []
            for k in range(at[i], at[i + 1]):
                own += [ids[k]] if ids[k] >= 0 else self.model.bytes_at[list(_plain(text[starts[k] : stops[k]]))].tolist()
            self.known[words[i]] = np.array(own, np.int32).tobytes()

    def packed(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text as 32-bit numbers in a row."""
        if len(self.known) > self.LIMIT:
            self.known, self.older = {}, self.known
        # A mark of the text itself gets a stand-in that no piece contains.
        units = [None if t is None else UNIT.findall(MARK + t.replace(MARK, STAND_IN).replace(" ", MARK)) if t else [] for t in texts]
        known, older, new = self.known, self.older, []
        for word in set().union(*filter(None, units)).difference(known):
            if word in older:
                known[word] = older[word]
            else:
                new.append(word)
        for at in range(0, len(new), self.AT_ONCE):
            self.learn(new[at : at + self.AT_ONCE])
        return [None if row is None else b"".join(map(known.__getitem__, row)) for row in units]

    def encode(self, texts: list[str | None]) -> list[list[int] | None]:
        return [None if x is None else np.frombuffer(x, np.int32).tolist() for x in self.packed(texts)]

    def column(self, texts: list[str | None]) -> pa.Array:
        rows = self.packed(texts)
        sizes = np.array([len(x or b"") // 4 for x in rows], np.int32)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        values = pa.array(np.frombuffer(b"".join(x or b"" for x in rows), np.int32))
        return pa.ListArray.from_arrays(offsets, values, mask=pa.array([x is None for x in rows]))


#: Stands for a word mark of the text: a lone surrogate, which no text or piece has.
STAND_IN = "\ud800"
#: Bytes of text in a batch.
BATCH = 3 * 1024 * 1024


def _plain(text: str) -> bytes:
    return text.replace(STAND_IN, MARK).encode()


class Decoder:
    """Texts of ids; the bytes of all pieces are one array, and those of a batch are gathered from it."""

    def __init__(self, model: Model):
        self.sizes = np.array([len(x) for x in model.outputs], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(model.outputs), np.uint8)

    def column(self, ids: pa.ListArray) -> pa.Array:
        gone = pc.is_null(ids).to_numpy(zero_copy_only=False)
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = self.sizes[values]
        ends = np.cumsum(sizes)
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[values] - ends + sizes, sizes)
        text = self.bytes[source]
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        lead = cuts[:-1][full]
        lead = lead[text[lead] == 32]  # the blank in front of each text's first word
        kept = np.ones(len(text), bool)
        kept[lead] = False
        cuts = cuts - np.searchsorted(lead, cuts)
        buffers = [pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(text[kept].tobytes())]
        found = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, *buffers])
        try:
            found = found.cast(pa.string())
        except pa.ArrowInvalid:  # ids that no text gives
            found = pa.array([x.as_py().decode("utf-8", "replace") for x in found], pa.string())
        return pc.if_else(pa.array(gone), pa.scalar(None, pa.string()), found)


def decode(rows: list[list[int] | None], model: Model) -> list[str | None]:
    return Decoder(model).column(pa.array(rows, pa.list_(pa.int32()))).to_pylist()


def _with_columns(documents: DataFrame, new: list[StructField], function) -> DataFrame:
    """``documents`` with new last columns, which ``function`` makes of each batch; equal names go."""
    names = {f.name.lower() for f in new}
    rest = documents.select(*(F.col(f"`{c}`") for c in documents.columns if c.lower() not in names))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        added = function(batch)
        own = [i for i, c in enumerate(batch.schema.names) if c.lower() not in names]
        return pa.record_batch([*(batch.column(i) for i in own), *added], [*(batch.schema.names[i] for i in own), *(f.name for f in new)])

    return map_rows(documents, run, StructType([*rest.schema, *new]), rows=10_000, size=BATCH)


IDS, TEXT = ArrayType(IntegerType()), StringType()


def encode_column(documents: DataFrame, into: str = "ids", text: str = "text", model: Model | None = None) -> DataFrame:
    """All columns of ``documents`` and the ids of ``text`` in a new last column."""
    encoder, at = Encoder(model or read_model()), documents.columns.index(text)
    return _with_columns(documents, [StructField(into, IDS)], lambda batch: [encoder.column(batch.column(at).to_pylist())])


def decode_column(encoded: DataFrame, into: str = "decoded", ids: str = "ids", model: Model | None = None) -> DataFrame:
    """All columns of ``encoded`` and the text of ``ids`` in a new last column."""
    decoder, at = Decoder(model or read_model()), encoded.columns.index(ids)
    return _with_columns(encoded, [StructField(into, TEXT)], lambda batch: [decoder.column(batch.column(at))])


def encode_and_decode(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """All columns of ``documents``, then ``ids`` of its text and ``decoded``, in one pass."""
    model = model or read_model()
    encoder, decoder, at = Encoder(model), Decoder(model), documents.columns.index("text")

    def both(batch: pa.RecordBatch) -> list[pa.Array]:
        ids = encoder.column(batch.column(at).to_pylist())
        return [ids, decoder.column(ids)]

    return _with_columns(documents, [StructField("ids", IDS), StructField("decoded", TEXT)], both)


def round_trip(documents: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """``doc_id, n_tokens, ids, same``: the ids of each text, and whether they decode to it."""
    both = encode_and_decode(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), read_model(model_path))
    tokens: Column = F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long")
    return both.select("doc_id", tokens.alias("n_tokens"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("same"))
