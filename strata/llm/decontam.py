"""Benchmark decontamination (operator 6): rare n-gram seeds, Smith-Waterman scores.

An alignment that reaches ``min_score`` can have so many edits and no more, so it must
keep a least number ``t`` of the item's n-grams (``needed``). The n-grams of all test
items are counted over the whole corpus; the seeds of an item are all of them but the
``t - 1`` most common, so that one seed at least stands in every such document. A
document with a seed and ``t`` n-grams of the item within the longest passage an
alignment can cover is aligned there with the item's words (local alignment, linear
gaps): the score is the alignment's share of what an exact copy would get. The hits are
those of aligning every item with every document.

An item's n-grams have the most words, ``n`` at most, that leave ``t`` at one or more: at
the default scores two words, and one in items of five words or fewer.

Two passes over the documents, no shuffle of texts. The test items are the query
set: they are taken in blocks of ``block_items`` items and ``block_bytes`` of text,
so that what a task holds is bounded; every block meets every document.

Words are lower-cased runs of letters and digits of any script; all else separates them, so
quotes, dashes or blanks of another kind hide nothing. Words that no item has are told apart
from the items' words only.

Defined cases: null and empty texts match nothing; an item without words matches nothing,
one of a single word is found where it stands; repeated items are items of their own unless
id and text agree; repeated documents are scored alike; null ids stay null; a long text is
looked up and aligned passage by passage; empty tables give empty results, or all documents
from the filter; other columns are not read by the scores and are kept by the filter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, map_rows, pieces, word_hash

TERM = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    n: int = 3
    min_score: float = 0.6
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    block_items: int = 20_000
    block_bytes: int = 16 * 1024 * 1024


#: Every ASCII character that is no letter or digit as a blank.
PLAIN = bytes(c if chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    if text.isascii():  # the same words, faster
        return text.encode().translate(PLAIN).decode().split()
    return TERM.findall(text)


class Vocabulary:
    """Hashes of the words of some items; any other word is 0, which no item has."""

    def __init__(self, words: list[str]):
        self.numbers = {w: i + 1 for i, w in enumerate(dict.fromkeys(words))}
        self.hashes = np.array([0, *map(word_hash, self.numbers)], np.uint64)

    def terms(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return self.hashes[np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))]


def grams(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams without unknown words, and their places; of all words if there are fewer."""
    if not len(words):
        return words, np.empty(0, np.int64)
    size = min(n, len(words))
    known = words != 0
    whole = known[: len(words) - size + 1].copy()
    for k in range(1, size):
        whole &= known[k : k + len(whole)]
    at = np.flatnonzero(whole)
    out = np.full(len(at), size, np.uint64)
    for k in range(size):
        out = (out ^ words[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out, at


def align(item: np.ndarray, passage: np.ndarray, s: Settings) -> tuple[int, int, int]:
    """Best local alignment: its score, and where it ends and roughly begins in the passage."""
    columns = np.arange(1, len(passage) + 1)
    before = np.zeros(len(passage) + 1, np.int64)
    start = np.arange(len(passage) + 1)  # where the alignment that ends here begins
    best = (0, 0, 0)
    for word in item:
        same = np.where(passage == word, s.match, s.mismatch)
        diagonal, up = before[:-1] + same, before[1:] + s.gap
        score, begin = np.where(diagonal >= up, diagonal, up), np.where(diagonal >= up, start[:-1], start[1:])
        begin = np.where(score > 0, begin, columns)
        score = np.maximum(score, 0)
        # A run of gaps along the row: the best of score[j] + gap * (i - j).
        level = score - s.gap * columns
        top = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == top, columns - 1, 0))
        now = top + s.gap * columns
        before = np.concatenate([[0], np.where(now > score, now, score)])
        start = np.concatenate([[0], np.where(now > score, begin[source], begin)])
        at = int(before.argmax())
        if before[at] > best[0]:
            best = (int(before[at]), int(start[at]), at)
    return best


def reach(size: int, s: Settings) -> int:
    """The most words that an alignment of ``min_score`` with an item of ``size`` words covers."""
    return size + int(size * s.match * (1 - s.min_score) / -max(s.mismatch, s.gap) + 1e-9)


def needed(size: int, n: int, s: Settings) -> int:
    """The least number of an item's n-grams that an alignment of ``min_score`` keeps.

    ``k`` matches and ``e`` edits leave at most ``e + 1`` runs of matches, and so at least
    ``k - (n - 1) * (e + 1)`` whole n-grams; the score bounds ``e`` by ``k``. This is linear
    in ``k``, so it is least at one of its ends.
    """
    cost, ends = -max(s.mismatch, s.gap), (size * s.min_score, size)
    kept = (k - (n - 1) * (s.match * (k - ends[0]) / cost + 1) for k in ends)
    return math.ceil(min(kept) - 1e-9)


@dataclass(frozen=True)
class Items:
    """A block of test items: ids, words, n-grams, and by n-gram the items it is a seed of."""

    ids: list[int | None]
    vocabulary: Vocabulary
    words: list[np.ndarray]
    sizes: list[int]  # words of the n-grams in use
    least: np.ndarray  # how many n-grams of each item a document must hold
    codes: np.ndarray  # distinct n-grams
    gram: np.ndarray  # for each item and n-gram of it: which of the codes
    ends: np.ndarray  # of each item's n-grams in gram
    first: np.ndarray  # of each code's items in owner
    owner: np.ndarray  # the items that have the code as a seed


def index_items(rows: list[tuple[int | None, str | None]], s: Settings) -> Items:
    """The items with all of their n-grams and no seeds yet."""
    vocabulary = Vocabulary([w for _, text in rows for w in words_of(text)])
    words = [vocabulary.terms(text) for _, text in rows]
    sizes = [next((n for n in range(s.n, 1, -1) if needed(len(w), n, s) > 0), 1) for w in words]
    least = np.array([max(1, needed(len(w), n, s)) for w, n in zip(words, sizes, strict=True)], np.int64)
    found = [grams(w, n)[0] for w, n in zip(words, sizes, strict=True)]
    codes, gram = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_inverse=True)
    ends = np.cumsum([0, *map(len, found)])
    none = np.empty(0, np.int64)
    return Items([i for i, _ in rows], vocabulary, words, sorted(set(sizes)), least, codes, gram.astype(np.int64), ends, none, none)


def all_grams(words: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of a text that the items may have, and their places."""
    found = [grams(words, n) for n in items.sizes]
    return np.concatenate([*(g for g, _ in found), np.empty(0, np.uint64)]), np.concatenate([*(at for _, at in found), np.empty(0, np.int64)])


def lookup(codes: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``found`` whose value is one of the sorted ``codes``, and which it is."""
    if not len(codes) or not len(found):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
    places = np.flatnonzero(codes[at] == found)
    return places, at[places]


def frequencies(documents: DataFrame, items: Items) -> np.ndarray:
    """In how many documents each of the items' n-grams stands."""
    codes = items.codes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(codes), np.int64)
        for batch in pieces(batches):
            for text in batch.column(0).to_pylist():
                counts[np.unique(lookup(codes, all_grams(items.vocabulary.terms(text), items)[0])[1])] += 1
        seen = np.flatnonzero(counts)
        if len(seen):
            yield pa.record_batch([pa.array(seen), pa.array(counts[seen])], ["gram", "n"])

    rows = map_batches(documents.select(F.col("text").cast("string")), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(codes), np.int64)
    out[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``starts, starts + 1 ...`` of all ranges, one range after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def seeds(items: Items, counts: np.ndarray) -> Items:
    """The same items with the seeds of each: all n-grams but the ``least - 1`` most common."""
    sizes = np.diff(items.ends)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((items.gram, counts[items.gram], owner))
    rank = ranges(np.zeros(len(sizes), np.int64), sizes)
    kept = order[rank < np.repeat(sizes - items.least + 1, sizes)]
    pairs = np.unique(np.stack([items.gram[kept], owner[kept]]), axis=1)
    return replace(items, first=np.searchsorted(pairs[0], np.arange(len(items.codes) + 1)), owner=pairs[1])


def candidates(codes: np.ndarray, items: Items) -> np.ndarray:
    """Items with a seed and with enough n-grams among the distinct ``codes``."""
    first = items.first[codes]
    found = np.unique(items.owner[ranges(first, items.first[codes + 1] - first)])
    if not len(found):
        return found
    present = np.zeros(len(items.codes), bool)
    present[codes] = True
    sizes = items.ends[found + 1] - items.ends[found]
    held = np.add.reduceat(present[items.gram[ranges(items.ends[found], sizes)]], np.cumsum(sizes) - sizes, dtype=np.int64)
    return found[held >= items.least[found]]


def matches(words: np.ndarray, items: Items, s: Settings) -> list[tuple[int, float, int, int]]:
    """Item, score, first and last word of the best alignment of each item found."""
    found, at = all_grams(words, items)
    where, codes = lookup(items.codes, found)
    if not len(where):
        return []
    places, out = at[where], []
    for item in candidates(np.unique(codes), items):
        size, least = len(items.words[item]), int(items.least[item])
        most, wide = s.match * size, reach(size, s)
        own = np.unique(places[np.isin(codes, items.gram[items.ends[item] : items.ends[item + 1]])])
        heads, tails = own[: max(0, len(own) - least + 1)], own[least - 1 :]
        close = np.flatnonzero(tails - heads < wide)  # enough n-grams in one passage
        if not len(close):
            continue
        heads, tails = heads[close], tails[close]
        best = (0, 0, 0)
        for group in np.split(np.arange(len(heads)), np.flatnonzero(np.diff(heads) > 2 * wide) + 1):
            low, high = max(0, int(tails[group[0]]) - wide), min(len(words), int(heads[group[-1]]) + wide)
            score, begin, end = align(items.words[item], words[low:high], s)
            if score > best[0]:
                best = (score, low + begin, low + end)
        if best[0] >= s.min_score * most:
            out.append((int(item), best[0] / most, best[1], best[2]))
    return out


def _blocks(benchmark: DataFrame, s: Settings) -> Iterator[list[tuple[int | None, str | None]]]:
    """The test items in blocks of bounded size, one block at a time on the driver."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").distinct().orderBy("item_id", "text")
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "")
        if len(block) >= s.block_items or size >= s.block_bytes:
            yield block
            block, size = [], 0
    yield block


HIT = "item_id long, score double, first_word long, last_word long"


def contaminated(documents: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` of every document that holds an item."""
    hits = with_hits(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, "hits", s)
    return hits.select("doc_id", F.inline("hits"))


def with_hits(documents: DataFrame, benchmark: DataFrame, into: str, s: Settings = Settings()) -> DataFrame:
    """``documents`` with an array of the items found in each; texts are aligned where they are read."""
    out, found = documents, []
    for number, rows in enumerate(_blocks(benchmark, s)):
        every = index_items(rows, s)
        items = seeds(every, frequencies(documents, every))
        name = f"_{into}{number}"
        at, fields = out.columns.index("text"), pa.struct(
            [("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
        )

        def run(batch: pa.RecordBatch, items=items, at=at, name=name, fields=fields) -> pa.RecordBatch:
            hits = []
            for text in batch.column(at).to_pylist():
                own = matches(items.vocabulary.terms(text), items, s)
                hits.append([{"item_id": items.ids[i], "score": p, "first_word": a, "last_word": b - 1} for i, p, a, b in own])
            return pa.record_batch([*batch.columns, pa.array(hits, pa.list_(fields))], [*batch.schema.names, name])

        out = map_rows(out, run, out.select("*", F.lit(None).cast(f"array<struct<{_typed(HIT)}>>").alias(name)).schema)
        found.append(F.col(name))
    names = [f"_{into}{i}" for i in range(len(found))]
    return out.withColumn(into, F.concat(*found)).drop(*names)


def _typed(columns: str) -> str:
    return ", ".join(c.replace(" ", ": ") for c in columns.split(", "))


def decontaminate(documents: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents that hold no test item, with their own columns."""
    name = "_hits"
    while name in documents.columns:
        name = f"_{name}"
    return with_hits(documents, benchmark, name, s).where(F.size(name) == 0).drop(name)
