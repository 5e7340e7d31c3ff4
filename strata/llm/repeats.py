"""Suffix-array dedup (operator 4): bytes covered by strings of an earlier document.

A byte of a document is removed if a string of ``length`` bytes around it also starts
in a document with a smaller id.

Every window of ``length`` bytes has a smallest hashed ``seed``-byte gram; a run of
windows with the same one is a stretch of text. Equal windows have equal grams. First the
stretches of each gram are counted (sums of each block of documents, then of all). Grams of
one document only are done: nothing in them repeats. The others' stretches go to the shard
of their gram, of stretches with equal bytes in a block only the smallest id's; later copies
in the block are wholly covered and need no comparison. A shard is a concatenation of
stretches. Hashes of its windows tell which cannot repeat; the stretches with others get a
suffix array by induced sorting (``suffixes.py``), and permuted common prefixes of
``length`` or more join equal windows. The smallest id of each group decides.

Grams with more than ``hot`` different stretches (the rim of a passage that a third of all
documents hold, each in its own context) would all meet in one shard. Their stretches are
cut into single windows, dealt by a hash of the whole window: equal windows still meet, and
one window's copies are one row for each block.

Which grams repeat, and which are hot, reaches the tasks as bit arrays of at most
``2 ** filter_bits`` bits. A gram that shares its bit with another is only sent or cut in
vain; a full bit array makes the job larger, not the result different.

Stretches travel compressed, a row for each shard of a block of documents. A shard has about
``shard_bytes`` of stretches; their number follows the input. What comes back are intervals,
merged by document. Copies of whole texts are left out: only their smallest id is indexed,
and for the others all is removed.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing; any byte may
occur, also zero; rows with one id do not remove from each other; a row without id loses
nothing and removes nothing; a long text is a block of its own; an empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, map_rows, mix, pieces, stored
from strata.llm.suffixes import permuted_matches, suffix_array, words_at


@dataclass(frozen=True)
class Settings:
    length: int = 50
    seed: int = 16
    shard_bytes: int = 12_000_000
    block_bytes: int = 4_000_000
    broadcast_bytes: int = 32 * 1024 * 1024
    hot: int = 20_000
    filter_bits: int = 28

    @property
    def spread(self) -> int:
        return self.length - self.seed + 1


# Odd factors of the hashes.
C1, C2, C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
CHUNK = 1 << 15  # positions at once, so that they stay in a core's cache


def window_minima(text: np.ndarray, s: Settings) -> np.ndarray:
    """Smallest gram hash of each window of a text (zeros behind its end are padding)."""
    words = words_at(np.concatenate([text, np.zeros(s.length + 16, np.uint8)]))
    out = np.empty(len(text), np.uint64)
    for low in range(0, len(text), CHUNK):
        high = min(len(text), low + CHUNK)
        size = high - low + s.spread
        grams = words[low : low + size] * C1
        grams ^= grams >> np.uint64(29)
        grams += words[low + s.seed - 8 : low + s.seed - 8 + size]
        grams *= C2
        grams ^= grams >> np.uint64(32)
        grams *= C3
        grams ^= grams >> np.uint64(31)
        span = 1
        while span < s.spread:  # minima over 1, 2, 4 ... grams
            step = min(span, s.spread - span)
            grams = np.minimum(grams[:-step], grams[step:])
            span += step
        out[low:high] = grams[: high - low]
    return out


def stretches(texts: list[bytes], s: Settings) -> tuple[np.ndarray, ...]:
    """Document number, start, number of windows (``length`` at most), gram hash of each stretch, and the joined text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum(sizes) - sizes
    has = np.flatnonzero(sizes >= s.length)
    if not len(has):
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64), text
    low = window_minima(text, s)
    new = np.concatenate([[True], low[1:] != low[:-1]])
    new[first[has]] = True
    behind = np.zeros(len(text) + 1, np.int8)  # 1 where windows begin, -1 where they end
    np.add.at(behind, first[has], 1)
    np.add.at(behind, first[has] + sizes[has] - s.length + 1, -1)
    new &= np.cumsum(behind[:-1], dtype=np.int8) > 0
    heads = np.flatnonzero(new)
    doc = has[np.searchsorted(first[has], heads, "right") - 1]
    runs = np.minimum(np.append(heads[1:], len(text)), first[doc] + sizes[doc] - s.length + 1) - heads
    parts = -(-runs // s.length)  # a repeated gram can make a run of any length
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        doc, heads, runs = np.repeat(doc, parts), np.repeat(heads, parts) + nth * s.length, np.minimum(np.repeat(runs, parts) - nth * s.length, s.length)
    return doc, heads, runs, low[heads], text


def window_hashes(words: np.ndarray, at: np.ndarray, s: Settings) -> np.ndarray:
    """Hash of the window at each place; ``words`` are those of the text (``words_at``)."""
    out = np.zeros(len(at), np.uint64)
    for k in [*range(0, s.length - 7, 8), s.length - 8]:
        out = (out ^ words[at + k]) * C1
        out ^= out >> np.uint64(32)
    return out


def padded_words(text: np.ndarray, s: Settings) -> np.ndarray:
    return words_at(np.concatenate([text, np.zeros(s.length + 16, np.uint8)]))


def different(words: np.ndarray, doc: np.ndarray, at: np.ndarray, runs: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts stretches of equal bytes together, by document; and where each kind begins in it.

    A stretch has less than two windows' bytes, so its length and the hashes of its first
    and last window tell its bytes.
    """
    head, tail = window_hashes(words, at, s), window_hashes(words, at + runs - 1, s)
    order = np.lexsort((at, doc, runs, head, tail))
    head, tail, runs = head[order], tail[order], runs[order]
    new = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]) | (runs[1:] != runs[:-1])
    return order, np.concatenate([[True], new])


def in_blocks(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, tags and texts of about ``block_bytes`` at a time, by id."""

    def block(ids: list[int], tags: list[int], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        order = np.argsort(np.array(ids), kind="stable")
        return np.array(ids, np.int64)[order], np.array(tags, np.int64)[order], [texts[i] for i in order]

    ids, tags, texts, size = [], [], [], 0
    for batch in pieces(batches):
        for i, g, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids.append(i)
            tags.append(g)
            texts.append(t)
            size += len(t)
            if size >= s.block_bytes:
                yield block(ids, tags, texts)
                ids, tags, texts, size = [], [], [], 0
    if ids:
        yield block(ids, tags, texts)


def bit_places(grams: np.ndarray, bits: int) -> np.ndarray:
    return (mix(grams) & np.uint64((1 << bits) - 1)).astype(np.int64)


def has_bit(filter_: np.ndarray, grams: np.ndarray) -> np.ndarray:
    at = bit_places(grams, (len(filter_) * 8).bit_length() - 1)
    return (filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bit_filter(grams: DataFrame, total: int, s: Settings) -> np.ndarray:
    """Bits of all ``grams`` (``total`` of them), 16 a gram up to the bound."""
    bits = min(s.filter_bits, max(15, (16 * total).bit_length()))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([pa.array(bit_places(batch.column(0).to_numpy().view(np.uint64), bits) + 1)], ["bit"])

    placed = map_rows(grams.select("gram"), place, "bit long", rows=100_000)
    groups = placed.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in groups.toLocalIterator():
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(out) - at]
    return out


def gram_filters(rows: DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bit arrays of the grams that two documents or more may share, and of the hot ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, _, texts in in_blocks(batches, s):
            doc, at, runs, low, text = stretches(texts, s)
            if not len(doc):
                continue
            order = np.argsort(low, kind="stable")
            grams, ids = low[order], own[doc[order]]
            heads = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            counts = np.diff(np.append(heads, len(grams)))
            several = np.minimum.reduceat(ids, heads) < np.maximum.reduceat(ids, heads)
            many = np.flatnonzero(np.repeat(counts > 1, counts))  # count equal bytes once
            if len(many):
                some = order[many]
                kinds, new = different(padded_words(text, s), doc[some], at[some], runs[some], s)
                first = np.zeros(len(order), bool)
                first[many[kinds]] = new
                kept = np.add.reduceat(first.astype(np.int64), heads)
                counts = np.where(counts > 1, kept, counts)
            yield pa.record_batch([pa.array(grams[heads].view(np.int64)), pa.array(counts), pa.array(several.astype(np.int64) + 1)], ["gram", "n", "documents"])

    found = map_batches(rows.select("id", "tag", "text"), run, "gram long, n long, documents long")
    shared = found.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")).where("documents > 1")
    shared = stored(rows.sparkSession, shared.select("gram", "n"), "grams")
    total, hot = shared.agg(F.count("*"), F.count_if(F.col("n") > s.hot)).first()
    return bit_filter(shared, total, s), bit_filter(shared.where(F.col("n") > s.hot), hot, s)


BLOCK = "shard long, payload binary"


def _pack(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray, runs: np.ndarray, blob: bytes) -> bytes:
    head = np.array([len(ids)], np.int64).tobytes()
    body = np.diff(ids, prepend=0).astype(np.int64).tobytes() + tags.tobytes() + starts.astype(np.int64).tobytes() + runs.astype(np.int32).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + body + blob)


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ids, tags, starts = (np.frombuffer(raw, np.int64, n, 8 + 8 * n * k) for k in range(3))
    return np.cumsum(ids), tags, starts, np.frombuffer(raw, np.int32, n, 8 + 24 * n).astype(np.int64), raw[8 + 28 * n :]


def shards(rows: DataFrame, count: int, shared: np.ndarray, hot: np.ndarray, s: Settings) -> DataFrame:
    """Rows ``shard, payload`` of the stretches of ``rows`` (id, tag, text) that may repeat.

    Shards from ``count`` on hold no text: their stretches are known to be covered.
    """

    def block(own: np.ndarray, tag: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        doc, at, runs, low, text = stretches(texts, s)
        kept = np.flatnonzero(has_bit(shared, low)) if len(doc) else np.empty(0, np.int64)
        if not len(kept):
            return
        doc, at, runs, low = doc[kept], at[kept], runs[kept], low[kept]
        words = padded_words(text, s)
        rim = has_bit(hot, low)
        shard = mix(low)
        if rim.any():
            size = np.where(rim, runs, 1)
            nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            alone = np.repeat(rim, size)
            doc, at, runs, shard = np.repeat(doc, size), np.repeat(at, size) + nth, np.where(alone, 1, np.repeat(runs, size)), np.repeat(shard, size)
            shard[alone] = mix(window_hashes(words, at[alone], s))
        order, new = different(words, doc, at, runs, s)
        least = own[doc[order]][np.flatnonzero(new)][np.cumsum(new) - 1]
        covered = np.zeros(len(order), bool)
        covered[order] = own[doc[order]] > least
        first = np.cumsum([0, *map(len, texts)])[:-1]
        done = np.flatnonzero(covered)
        if len(done):  # one run for neighbours
            done = done[np.argsort(at[done], kind="stable")]
            low_end, high_end = at[done], np.maximum.accumulate(at[done] + runs[done] + s.length - 1)
            heads = np.flatnonzero(np.concatenate([[True], (low_end[1:] > high_end[:-1]) | (doc[done][1:] != doc[done][:-1])]))
            high_end = high_end[np.append(heads[1:], len(done)) - 1]
            of = doc[done][heads]
            windows = high_end - low_end[heads] - s.length + 1
            yield count + int(mix(np.uint64(own[0] + len(texts)).reshape(1))[0] % np.uint64(count)), _pack(own[of], tag[of], low_end[heads] - first[of], windows, b"")
        rest = np.flatnonzero(~covered)
        shard = (shard[rest] % np.uint64(count)).astype(np.int64)
        by_shard = np.argsort(shard, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], np.diff(shard[by_shard]) != 0]))
        raw, stop = text.tobytes(), at + runs + s.length - 1
        for part in np.split(by_shard, heads[1:]):
            to, part = int(shard[part[0]]), rest[part]
            blob = b"".join(map(raw.__getitem__, map(slice, at[part].tolist(), stop[part].tolist())))
            yield to, _pack(own[doc[part]], tag[doc[part]], at[part] - first[doc[part]], runs[part], blob)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, tag, texts in in_blocks(batches, s):
            found = block(own, tag, texts)
            while some := list(islice(found, 64)):
                yield pa.record_batch([pa.array([k for k, _ in some], pa.int64()), pa.array([p for _, p in some], pa.binary())], ["shard", "payload"])

    return map_batches(rows.select("id", "tag", "text"), run, BLOCK)


def _possible(text: np.ndarray, at: np.ndarray, doc: np.ndarray, s: Settings) -> np.ndarray:
    """Windows whose hash also stands in another document; no other can repeat in one."""
    hashes = window_hashes(padded_words(text, s), at, s)
    order = np.argsort(hashes)
    hashes = hashes[order]
    heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    low, high = np.minimum.reduceat(doc[order], heads), np.maximum.reduceat(doc[order], heads)
    out = np.zeros(len(at), bool)
    out[order] = np.repeat(low < high, np.diff(np.append(heads, len(at))))
    return out


def later_windows(doc: np.ndarray, runs: np.ndarray, blob: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Windows that also start in a smaller document: their stretch, and their place in it.

    ``doc`` orders the documents; the stretches of ``blob`` have ``runs`` windows.
    """
    none = np.empty(0, np.int64)
    if len(doc) < 2:
        return none, none
    sizes = runs + s.length - 1
    first = np.cumsum(sizes) - sizes

    def windows(runs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(runs)), runs)
        return owner, np.arange(len(owner)) + np.repeat(first - np.cumsum(runs) + runs, runs)

    owner, at = windows(runs, first)
    wanted = np.unique(owner[_possible(blob, at, doc[owner], s)])
    if not len(wanted):
        return none, none
    # The stretches that may repeat, each with a separator (0; bytes are 1 to 256) behind it.
    runs, sizes = runs[wanted], sizes[wanted]
    base = np.cumsum(sizes + 1) - sizes - 1
    inside = np.arange(sizes.sum()) + np.repeat(base - np.cumsum(sizes) + sizes, sizes)
    source = np.arange(sizes.sum()) + np.repeat(first[wanted] - np.cumsum(sizes) + sizes, sizes)
    text = np.zeros(int((sizes + 1).sum()), np.uint8)
    text[inside] = blob[source]
    codes = np.zeros(len(text), np.int16)
    codes[inside] = text[inside].astype(np.int16) + 1
    owner, at = windows(runs, base)
    order = suffix_array(codes, s.length)
    whole = np.zeros(len(text), bool)
    whole[at] = True
    order = order[whole[order]]  # suffixes that are whole windows, without separators; equal ones stand together
    starts = ~permuted_matches(text, order, s.length)[order]
    starts[0] = True
    group = np.cumsum(starts) - 1
    ids = np.zeros(len(text), np.int64)
    ids[at] = doc[wanted][owner]
    least = np.minimum.reduceat(ids[order], np.flatnonzero(starts))
    hit = np.zeros(len(text), bool)
    hit[order] = ids[order] > least[group]
    found = hit[at]
    return wanted[owner[found]], (at - base[owner])[found]


def _merged(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as sorted ones that neither overlap nor touch."""
    order = np.argsort(lows, kind="stable")
    lows, reach = lows[order], np.maximum.accumulate(highs[order])
    new = np.concatenate([[True], lows[1:] > reach[:-1]])
    heads = np.flatnonzero(new)
    return lows[heads], reach[np.append(heads[1:], len(lows)) - 1]


INTERVALS = "id long, tag long, lows array<long>, highs array<long>"


def intervals(blocks: DataFrame, count: int, s: Settings) -> DataFrame:
    """``id, tag, lows, highs``: the merged intervals to remove, a row for each document."""

    def ends(*columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(columns[0]), 50_000):
            yield pa.record_batch([pa.array(c[k : k + 50_000]) for c in columns], ["id", "tag", "low", "high"])

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(p) for b in batches for p in b.column(1).to_pylist()]
        ids, tags, starts, runs = (np.concatenate([p[k] for p in parts]) for k in range(4))
        if key[0].as_py() >= count:
            yield from ends(ids, tags, starts, starts + runs + s.length - 1)
            return
        blob = np.frombuffer(b"".join(p[4] for p in parts), np.uint8)
        del parts
        stretch, offset = later_windows(ids, runs, blob, s)
        if not len(stretch):
            return
        at = starts[stretch] + offset
        new = np.flatnonzero(np.concatenate([[True], (stretch[1:] != stretch[:-1]) | (at[1:] != at[:-1] + 1)]))
        end = at[np.append(new[1:], len(at)) - 1] + s.length
        owner = stretch[new]
        yield from ends(ids[owner], tags[owner], at[new], end)

    found = blocks.groupBy("shard").applyInArrow(run, "id long, tag long, low long, high long")
    lists = found.groupBy("id", "tag").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))

    def merge(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [_merged(np.array(a), np.array(b)) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        ends = [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (0, 1)]
        return pa.record_batch([batch.column(0), batch.column(1), *ends], ["id", "tag", "lows", "highs"])

    return map_rows(lists, merge, INTERVALS)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the bytes kept, of every row."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    digest = F.xxhash64("text")
    seen = rows.agg(F.sum(F.length("text")), F.count("doc_id"), F.count_distinct("doc_id")).first()
    tag = F.lit(0).cast("long") if seen[1] == seen[2] else digest  # tells rows of one id apart
    count = max(1, round((seen[0] or 0) * 3.7 / s.shard_bytes))

    # Of equal texts only the smallest id is indexed; for the others that text is all gone.
    whole = rows.where(F.col("doc_id").isNotNull() & (F.length("text") >= s.length))
    name = whole.select("doc_id", F.md5("text").alias("name"))
    copies = stored(spark, name.groupBy("name").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    few = copies.count() * 48 <= s.broadcast_bytes
    marked = rows.withColumn("name", F.md5("text")).join(F.broadcast(copies) if few else copies, "name", "left")
    is_copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))

    indexed = marked.where(~is_copy & F.col("doc_id").isNotNull() & (F.length("text") >= s.length))
    indexed = indexed.select(F.col("doc_id").alias("id"), tag.alias("tag"), "text")
    blocks = shards(indexed, count, *gram_filters(indexed, s), s)
    found = stored(spark, intervals(blocks.repartition(count, "shard"), count, s), "intervals")
    size = found.agg(F.sum(F.size("lows") * 16 + 64)).first()[0] or 0
    side = F.broadcast(found) if size <= s.broadcast_bytes else found
    joined = marked.withColumns({"copy": is_copy, "tag": tag}).withColumnRenamed("doc_id", "id").join(side, ["id", "tag"], "left")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc_id, text, copy, lows, highs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lows, highs = ([0], [len(text)]) if copy else (lows or [], highs or [])
            kept = b"".join(text[a:b] for a, b in zip([0, *highs], [*lows, len(text)], strict=True))
            out.append((doc_id, len(text), len(text) - len(kept), len(lows), hashlib.sha256(kept).hexdigest(), kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        columns = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.record_batch(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return map_rows(joined.select("id", "text", "copy", "lows", "highs"), cut, RESULT)
