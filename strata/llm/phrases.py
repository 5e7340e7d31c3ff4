"""Phrase collocation mining (operator 11): count streams in prefix and suffix order.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at
blanks and tabs into words. All runs of one to three words inside pieces are counted for
each language; what stands ``least`` times or more is a count stream. Sorted in prefix
order, an n-gram follows its own first words, so one pass over the sorted stream carries
the counts of the left parts down to it and the largest count of a right extension up
from it. Sorted in suffix order, the same pass gives right parts and left extensions.
Nothing is looked up by hash, and nothing is joined but the passes' carries.

The stream is dealt by ranges of the whole n-gram, so a word that starts a third of all
phrases spans as many tasks as it fills. A task's stream may begin inside a group: the
headers in force and the extensions that follow are carried over by one row for each
task (``_carried``).

Counting takes two scans. The first counts words and pairs: blocks of ``block_bytes`` of
text are counted in numpy, and only a block's sums are shuffled. The second counts triples,
of which only those of two frequent pairs can be frequent: a bit array of at most
``2 ** filter_bits`` bits, made of all frequent pairs, leaves out most others before the
shuffle. It has no false negatives, so counts stay exact at any size; beyond its size it
only saves less.

Scores are exact: a*a*1000000 and l*r are decimals of 38 digits, enough for counts below
10**15; the quotient is at most 1000000.

Defined cases: a null or empty text has no words; a null ``lang`` is ``und``; repeated rows
all count; ties are resolved as stated in ``collocations``; a long text is one block of its
own; an empty table, or one without phrases, gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_batches, mix, pieces, stored, word_hash

# Characters that end a piece, and those that separate words in it.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

#: A-Z to a-z, ends of pieces to a line feed, blanks to a space.
FOLD = bytes(10 if c in ENDS else 32 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Settings:
    least: int = 10
    inside_percent: int = 50
    top: int = 2000
    block_bytes: int = 4 * 1024 * 1024
    filter_bits: int = 28


class _Numbers(dict):
    """Numbers of words, in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


@dataclass(frozen=True)
class Block:
    """Words of some texts: their numbers, languages and pieces, and the words themselves."""

    ids: np.ndarray
    lang: np.ndarray
    piece: np.ndarray
    words: list[bytes]
    langs: list[str]


def read_block(langs: list[str], texts: list[bytes]) -> Block:
    raw = b"\n".join(texts).translate(FOLD)
    codes = np.frombuffer(raw, np.uint8)
    blank = (codes == 32) | (codes == 10)
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(codes) else np.empty(0, np.int64)
    piece = np.cumsum(codes == 10, dtype=np.int32)[starts]
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, raw.split()), np.int64, len(starts))
    names, which = np.unique(np.array(langs, object), return_inverse=True) if langs else (np.empty(0, object), np.empty(0, np.int64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return Block(ids, which[np.searchsorted(ends, starts, "right")], piece, list(numbers), list(names))


def distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of some columns of small numbers, sorted, and how often each stands."""
    if not len(columns[0]):
        return columns, np.empty(0, np.int64)
    bits = [int(c.max()).bit_length() for c in columns]
    if sum(bits) > 62:  # too wide for one number
        order = np.lexsort(columns[::-1])
        rows = [c[order] for c in columns]
        new = np.concatenate([[True], np.any([r[1:] != r[:-1] for r in rows], axis=0)])
        heads = np.flatnonzero(new)
        return [r[heads] for r in rows], np.diff(np.append(heads, len(order)))
    key = np.zeros(len(columns[0]), np.int64)
    for column, width in zip(columns, bits, strict=True):
        key = (key << width) | column
    key, counts = np.unique(key, return_counts=True)
    out = []
    for width in bits[::-1]:
        out.append(key & ((1 << width) - 1))
        key = key >> width
    return out[::-1], counts


#: Parts of a language that are ranked apart first.
SHARES = 8

#: A gram is named by its language, a line feed (no word holds one) and its words, space-joined.
SEPARATOR = "\n"


def _emit(block: Block, rows: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    words, langs = pa.array(block.words, pa.binary()).cast(pa.string()), pa.array(block.langs, pa.string())
    for at in range(0, len(counts), 200_000):
        lang, *grams = (pa.array(r[at : at + 200_000]) for r in rows)
        text = pc.binary_join_element_wise(*(words.take(g) for g in grams), " ") if grams else pa.array([""] * len(lang))
        key = pc.binary_join_element_wise(langs.take(lang), text, SEPARATOR)
        yield pa.record_batch([key, pa.array(counts[at : at + 200_000])], ["gram", "f"])


def pair_hashes(words: np.ndarray, langs: np.ndarray, lang: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of each pair of words, from hashes of words and languages."""
    return mix(mix(words[a] + langs[lang]) * np.uint64(0x9E3779B97F4A7C15) + words[b])


def _hashes(values: list) -> np.ndarray:
    return np.fromiter(map(word_hash, values), np.uint64, len(values))


def in_filter(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64(len(filter_) * 8 - 1)).astype(np.int64)
    return (filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _words_and_pairs(block: Block) -> Iterator[pa.RecordBatch]:
    yield from _emit(block, *distinct([block.lang]))
    yield from _emit(block, *distinct([block.lang, block.ids]))
    same = block.piece[1:] == block.piece[:-1]
    yield from _emit(block, *distinct([block.lang[1:][same], block.ids[:-1][same], block.ids[1:][same]]))


def _triples(block: Block, filter_: np.ndarray) -> Iterator[pa.RecordBatch]:
    ids, lang = block.ids, block.lang
    hashes = pair_hashes(_hashes(block.words), _hashes(block.langs), lang[1:], ids[:-1], ids[1:])
    pair = (block.piece[1:] == block.piece[:-1]) & in_filter(filter_, hashes)
    both = pair[1:] & pair[:-1]
    yield from _emit(block, *distinct([lang[2:][both], ids[:-2][both], ids[1:-1][both], ids[2:][both]]))


def _counted(documents: DataFrame, count, s: Settings) -> DataFrame:
    """``gram, f`` of the grams that ``count`` finds in blocks of texts, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, texts, size = [], [], 0
        for batch in pieces(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                langs.append(lang)
                texts.append(text)
                size += len(text)
                if size >= s.block_bytes:
                    yield from count(read_block(langs, texts))
                    langs, texts, size = [], [], 0
        if texts:
            yield from count(read_block(langs, texts))

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = documents.select(lang.alias("lang"), F.col("text").cast("binary").alias("text")).where(F.length("text") > 0)
    return map_batches(rows, run, "gram string, f long").groupBy("gram").agg(F.sum("f").alias("f"))


def _named(counts: DataFrame) -> DataFrame:
    """``lang, n, w1, w2, w3, a``; the total of a language has no words."""
    phrase = F.substring_index("gram", SEPARATOR, -1)
    lang = F.expr("left(gram, char_length(gram) - char_length(substring_index(gram, '\\n', -1)) - 1)")
    words = F.split(phrase, " ")
    n = F.when(phrase == "", 0).otherwise(F.size(words))
    each = [F.get(words, F.lit(k)).alias(f"w{k + 1}") for k in range(3)]
    return counts.select(lang.alias("lang"), n.alias("n"), *each, F.col("f").alias("a"))


def pair_filter(pairs: DataFrame, s: Settings) -> np.ndarray:
    """Bits of the hashes of all frequent pairs, up to ``2 ** filter_bits`` of them."""
    total = pairs.count()
    bits = min(s.filter_bits, max(15, (16 * total).bit_length()))
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, a, b = (_hashes(c.to_pylist()) for c in batch.columns)
            here = np.arange(len(lang))
            yield pa.record_batch([pa.array((pair_hashes(np.concatenate([a, b]), lang, here, here, here + len(a)) & mask).astype(np.int64) + 1)], ["bit"])

    bit = map_batches(pairs.select("lang", "w1", "w2"), run, "bit long")
    groups = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in groups.toLocalIterator():
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(out) - at]
    return out


def grams(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Counts ``a`` of all frequent runs of one to three words, and each language's total (``n`` = 0)."""
    spark = documents.sparkSession
    frequent = (F.col("f") >= s.least) | F.endswith("gram", F.lit(SEPARATOR))
    short = stored(spark, _named(_counted(documents, _words_and_pairs, s).where(frequent)), "short-grams")
    filter_ = pair_filter(short.where("n = 2"), s)
    triples = _counted(documents, lambda block: _triples(block, filter_), s).where(F.col("f") >= s.least)
    return short.unionByName(_named(triples))


def _carried(stream: DataFrame, order: list[str], names: tuple[str, str, str]) -> DataFrame:
    """Counts of the parts that each gram starts with in this order, and its largest extension.

    ``order`` is the language and the gram's words, first to last of the order; ``names``
    are the new columns: the first word's count, the first two words' count, the largest
    count of a triple that starts with this pair.
    """
    spark, key = stream.sparkSession, order[:3]
    one, two, longest = names
    placed = stream.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    placed = stored(spark, placed, "stream")

    def of(n: int) -> Column:
        return F.when(F.col("n") == n, F.col("a"))

    # One row for each part: the last headers in it.
    last_pair = F.max(F.when(F.col("n") == 2, F.struct(*key, "a")))
    ends = placed.groupBy("part").agg(F.max(F.when(F.col("n") == 1, F.struct(*order[:2], "a"))).alias("word"), last_pair.alias("pair"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.when(F.col("pair").isNotNull(), F.col("part"))
    carries = ends.select(
        "part",
        F.last("word.a", ignorenulls=True).over(earlier).alias("word_before"),
        F.last("pair.a", ignorenulls=True).over(earlier).alias("pair_before"),
        F.last(owner, ignorenulls=True).over(earlier).alias("owner"),
        F.col("pair").alias("last_pair"),
    )
    above = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = placed.withColumns(
        {
            one: F.last(of(1), ignorenulls=True).over(above),
            two: F.last(of(2), ignorenulls=True).over(above),
            longest: F.max(of(3)).over(Window.partitionBy("part", *key)),
        }
    )
    # Triples in front of a part's first header belong to a pair of an earlier part.
    first = placed.groupBy("part").agg(F.min(F.when(F.col("n") < 3, F.struct(*order))).alias("head"))
    loose = placed.where("n = 3").join(F.broadcast(first), "part").where(F.col("head").isNull() | (F.struct(*order) < F.col("head")))
    later = loose.groupBy("part").agg(F.max("a").alias("m")).join(F.broadcast(carries), "part")
    later = later.groupBy("owner").agg(F.max("m").alias("later")).withColumnRenamed("owner", "part")
    side = carries.drop("owner").join(later, "part", "left")
    joined = here.join(F.broadcast(side), "part", "left")
    at_end = (F.col("n") == 2) & (F.struct(*key, "a") == F.col("last_pair"))
    return joined.select(
        *stream.columns,
        F.coalesce(one, "word_before").alias(one),
        F.coalesce(two, "pair_before").alias(two),
        F.when(F.col("n") == 2, F.greatest(longest, F.when(at_end, F.col("later")))).alias(longest),
    )


def with_parts(counts: DataFrame) -> DataFrame:
    """Counts of words and phrases with those of their parts and of their largest extensions."""
    stream = _carried(counts.where("n > 0"), ["lang", "w1", "w2", "w3"], ("left_1", "left_2", "right_extension"))
    words = F.array("w1", "w2", "w3")
    turned = stream.withColumns({f"x{k}": F.get(words, F.col("n") - k) for k in (1, 2, 3)})
    return _carried(turned, ["lang", "x1", "x2", "x3"], ("right_1", "right_2", "left_extension")).drop("x1", "x2", "x3")


def _score(left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(15,0))) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def collocations(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` phrases.

    A phrase is scored by its lowest cut (the first of equal ones). Phrases that stand inside
    a longer one with ``inside_percent`` of their count are left out. Ranks go by score, then
    count (both descending), then phrase in byte order, so there are no ties.
    """
    counts = stored(documents.sparkSession, grams(documents, s), "grams")
    parts = with_parts(counts).where("n > 1")
    cut_1 = F.struct(_score("left_1", "if(n = 2, right_1, right_2)").alias("score"), F.lit(1).alias("k"))
    cut_2 = F.when(F.col("n") == 3, F.struct(_score("left_2", "right_1").alias("score"), F.lit(2).alias("k")))
    scored = parts.withColumn("cut", F.least(cut_1, cut_2))
    outer = F.coalesce(F.greatest("left_extension", "right_extension"), F.lit(0))
    scored = scored.where(100 * outer < s.inside_percent * F.col("a"))
    first = F.col("cut.k") == 1
    rows = scored.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(first, F.col("left_1")).otherwise(F.col("left_2")).alias("l"),
        F.when(first & (F.col("n") == 3), F.col("right_2")).otherwise(F.col("right_1")).alias("r"),
        F.col("cut.score").alias("score"),
    )
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # The first ones of every share of a language, then of these: a task sees bounded rows.
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    close = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).where(F.col("place") <= s.top)
    ranked = close.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= s.top)
    totals = counts.where("n = 0").select(F.col("lang"), F.col("a").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rule in SQL: result of the query op11_phrases.
ORACLE_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), grams AS (
  SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase, count(*) AS a
  FROM places, (VALUES (1), (2), (3)) AS t(n) WHERE i + n - 1 <= len(w) GROUP BY ALL
), totals AS (SELECT lang, sum(a)::BIGINT AS n FROM grams WHERE n = 1 GROUP BY lang),
candidates AS (
  SELECT lang, n, phrase, a, string_split(phrase, ' ') AS w FROM grams WHERE n > 1 AND a >= 10
), cuts AS (
  SELECT lang, phrase, a, n AS size, unnest(range(1, n)) AS k, w FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, l.a AS l, r.a AS r,
         (1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts c
  JOIN grams l ON l.lang = c.lang AND l.n = c.k AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN grams r ON r.lang = c.lang AND r.n = c.size - c.k AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE n = 3
), inside AS (SELECT lang, phrase, max(a) AS m FROM parts GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inside i ON s.size = 2 AND i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.m IS NULL OR 100 * i.m < 50 * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, t.n, score FROM ranked JOIN totals t USING (lang) WHERE rank <= 2000
"""
