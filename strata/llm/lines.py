"""Line dedup (operator 9) by winnowing over line hashes, with DataFrame functions only.

A run of lines with at least ``min_words`` words that equals an earlier run (earlier
document id, or earlier in the document) is deleted. Lines without a word are not
compared; inside a deleted run they go with it.

From each line two windows reach out: the fewest lines forwards, and backwards, that
hold ``min_words`` words. The line with the smallest hash in a window is its
fingerprint. A repeated run holds a whole window, and equal windows select equal
fingerprints, so fingerprints that stand at two places or more lead to every repeated
run (the guarantee of winnowing). Positions are joined on the fingerprint; the
windows around a shared one extend it both ways, and those whose lines all equal an
earlier window's are deleted. Forward windows cover a repeated run but for its last
``min_words`` words, backward windows all but its first: together the whole run.

Shuffles carry hashes and positions of lines, no text but for the last join with the
documents, which is a broadcast while the runs are measured to be small. Counts of a
hot line are combined before the shuffle; its join side is skewed and can be split.

Defined cases: a null text stays null; an empty text stays empty; a text may become
empty; rows with equal id and text are one document and get one result; a null id
comes before all others; a long text is as many rows as lines; an empty table gives an empty
result; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD_PATTERN, stored


@dataclass(frozen=True)
class Settings:
    min_words: int = 50
    broadcast_bytes: int = 32 * 1024 * 1024


KEY = ["_id", "_digest"]


def _lines(documents: DataFrame) -> DataFrame:
    """Lines with a word: document, position, two hashes, words, words before it."""
    text = documents.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_digest"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    words = F.regexp_count("line", F.lit(WORD_PATTERN))
    each = text.select(*KEY, "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"), words.alias("words")).where("words > 0")
    each = each.repartition(*KEY).distinct()  # repeated rows; keeps the partitioning
    ahead = Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return each.withColumn("end", F.sum("words").over(ahead)).withColumn("start", F.col("end") - F.col("words"))


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Both windows of every line: content, fingerprint with its place, first and last line."""
    forwards = Window.partitionBy(*KEY).orderBy("start").rangeBetween(0, min_words - 1)
    backwards = Window.partitionBy(*KEY).orderBy("end").rangeBetween(1 - min_words, 0)

    def window(side: int, over) -> dict:
        own = F.struct(
            F.lit(side).alias("side"),
            F.xxhash64(F.collect_list("h").over(over)).alias("k1"),
            F.xxhash64(F.collect_list("g").over(over)).alias("k2"),
            F.min(F.struct("h", "pos")).over(over).alias("f"),
            F.min("pos").over(over).alias("lo"),
            F.max("pos").over(over).alias("hi"),
        )
        return {f"w{side}": F.when(F.sum("words").over(over) >= min_words, own)}

    both = lines.withColumns(window(0, forwards)).withColumns(window(1, backwards))
    each = both.select(*KEY, "pos", F.explode(F.array("w0", "w1")).alias("w")).where("w is not null")
    return each.select(*KEY, "pos", "w.side", "w.k1", "w.k2", F.col("w.f.h").alias("f"), F.col("w.f.pos").alias("at"), "w.lo", "w.hi")


def repeated_runs(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``_id, _digest, runs``: the first and last line of each run to delete."""
    windows = stored(documents.sparkSession, _windows(_lines(documents), s.min_words), "windows")
    place = F.struct("_id", "_digest", "at")
    shared = windows.groupBy("f").agg(F.min(place).alias("a"), F.max(place).alias("z")).where("a < z").select("f")
    candidates = windows.join(shared, "f")
    here = F.struct("_id", "_digest", "pos")
    first = candidates.groupBy("side", "k1", "k2").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = candidates.join(first.drop("n"), ["side", "k1", "k2"]).where(here > F.col("first"))
    spans = later.select(*KEY, "lo", "hi").distinct()
    before = Window.partitionBy(*KEY).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    breaks = spans.withColumn("new", (F.coalesce(F.max("hi").over(before), F.lit(-1)) < F.col("lo") - 1).cast("int"))
    upto = Window.partitionBy(*KEY).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = breaks.withColumn("run", F.sum("new").over(upto)).groupBy(*KEY, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return runs.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs"))


def dedup_lines(documents: DataFrame, s: Settings = Settings(), removed: str | None = None) -> DataFrame:
    """``documents`` without repeated runs; ``removed`` names a column for the lines deleted."""
    runs = stored(documents.sparkSession, repeated_runs(documents, s), "runs")
    size = runs.agg(F.sum(F.size("runs") * 8 + 64)).first()[0] or 0
    side = F.broadcast(runs) if size <= s.broadcast_bytes else runs
    d, r = documents.alias("d"), side.alias("r")
    same = F.col("d.doc_id").eqNullSafe(F.col("r._id")) & (F.xxhash64("d.text") == F.col("r._digest"))
    lines = F.split("d.text", "\n")
    kept = F.filter(lines, lambda _, i: ~F.exists("r.runs", lambda run: i.between(run["lo"], run["hi"])))
    text = F.when(F.col("r.runs").isNull(), F.col("d.text")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in documents.columns]
    if removed:
        columns.append(F.when(F.col("r.runs").isNull(), 0).otherwise(F.size(lines) - F.size(kept)).cast("long").alias(removed))
    return d.join(r, same, "left").select(*columns)


#: The same rule in SQL, on the lines themselves: result of the query op9_lines.
ORACLE_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents
), counted AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM split
), lines AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS stop FROM counted WHERE words > 0
), spots AS (SELECT *, stop - words AS start FROM lines), windows AS (
  SELECT doc_id, pos, 0 AS side, list(line) OVER f AS content, sum(words) OVER f AS total, min(pos) OVER f AS lo, max(pos) OVER f AS hi
  FROM spots WINDOW f AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, pos, 1, list(line) OVER b, sum(words) OVER b, min(pos) OVER b, max(pos) OVER b
  FROM spots WINDOW b AS (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY side, content ORDER BY doc_id, pos) AS copy FROM windows WHERE total >= 50
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM ranked WHERE copy > 1
), kept AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.pos) AS text FROM split s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos GROUP BY s.doc_id
), removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(r.n, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)
"""
