"""MinHash near-dedup (operator 5): SuperMinHash, banding, verification, union-find.

Each document's set of word shingles gets a SuperMinHash signature: an element puts
one of its ranks ``r + j`` into each slot, in the order of a permutation of its own,
and the scan over ``j`` stops once no slot can change. Equal sets are one node from
here on. Bands of the signature make buckets. In each bucket the node that shares
buckets with most others is the centre, and all others are compared with it on the
full sets; links are grouped by union-find. Pairs of one bucket that are still in
different groups are compared as well, so that no link through other members is lost,
unless one of these excludes a link: the sizes, the measured distances to the bucket's
centre, a lower bound of the symmetric difference (a bit per element, added by xor),
or the signatures. The signatures exclude by an estimate: a pair at the threshold of 0.85
(0.8) is left out if fewer than 77 (71) of its 128 slots agree, with probability below
2e-12 (9e-11) for independent slots. Of two groups the closest such pair comes first; the rest of their
pairs follow only where that one did not link them.

With 32 bands of 4 slots a pair at similarity 0.85 shares no bucket with probability
6e-11 (at 0.8: 5e-8).

Buckets are only joined, never gathered: a hot one is a skewed join side, which Spark
splits. Full sets are made again for candidate documents only.

Defined cases: null or empty texts and those without words have an empty set, are in
no bucket and are their own component; rows of one ``doc_id`` are one document; a row
without ``doc_id`` is linked with nothing, has no component and is kept; a long text is a
large set, compared like any other; an empty table gives an empty result; other columns,
whatever their names, are kept by the filter and not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WordHashes, map_rows, mix, stored
from strata.llm.components import components


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 80
    slots: int = 128
    rows: int = 4  # at most 4, a band key has 64 bits
    broadcast_bytes: int = 32 * 1024 * 1024


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; of all words if there are fewer."""
    if not len(words):
        return words
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ words[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def shingles(text: bytes | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct shingles, sorted."""
    return np.unique(runs(hashes.of((text or b"").lower().split()), words))


def signature(elements: np.ndarray, slots: int, block: int = 32768) -> np.ndarray:
    """SuperMinHash of a set of 64-bit numbers."""
    out = np.full(slots, np.inf)
    for at in range(0, len(elements), block):
        part = elements[at : at + block]
        order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int64), (len(part), 1))
        row = np.arange(len(part))
        for j in range(slots):
            if out.max() < j:
                break
            x = mix(part + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
            k = j + (((x & np.uint64(0xFFFFFF)) * np.uint64(slots - j)) >> np.uint64(24)).astype(np.int64)
            slot = order[row, k].copy()
            order[row, k] = order[:, j]
            np.minimum.at(out, slot, j + (x >> np.uint64(24)).astype(np.float64) / 2**40)
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """16 bits of each slot; the slots of a band side by side are its key."""
    short = (mix(sig.view(np.uint64)) >> np.uint64(48)).astype("<u2").reshape(-1, rows)
    lanes = np.zeros((len(short), 4), "<u2")
    lanes[:, :rows] = short
    return lanes.view("<i8").ravel()


#: Bits of the xor of a set's elements, in longs.
LONGS = 16
BITS = [f"x{i}" for i in range(LONGS)]


def parity_bits(elements: np.ndarray) -> np.ndarray:
    """Which of the bits an odd number of elements falls on."""
    at = (mix(elements) >> np.uint64(64 - 10)).astype(np.int64)
    odd = (np.bincount(at, minlength=64 * LONGS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


SKETCH = "doc_id long, n long, h1 long, h2 long, bands array<long>, " + ", ".join(f"{x} long" for x in BITS)


def sketches(documents: DataFrame, s: Settings) -> DataFrame:
    """Set size, a 128-bit name of the set, band keys (with them a short signature) and bits of every row."""
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = shingles(text, s.words, hashes)
            if not len(found):
                rows.append((doc_id, 0, 0, 0, None, *[0] * LONGS))
                continue
            sig = signature(found, s.slots)
            name = [int(mix(found ^ np.uint64(k)).sum(dtype=np.uint64).view(np.int64)) for k in (1, 2)]
            rows.append((doc_id, len(found), *name, band_keys(sig, s.rows), *parity_bits(found).tolist()))
        kinds = (*[pa.int64()] * 4, pa.list_(pa.int64()), *[pa.int64()] * LONGS)
        columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.record_batch(columns, ["doc_id", "n", "h1", "h2", "bands", *BITS])

    return map_rows(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")), run, SKETCH)


def _sets(documents: DataFrame, ids: DataFrame, s: Settings) -> DataFrame:
    """``id, items``: full sets of the documents in ``ids``."""
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items = [shingles(t, s.words, hashes).view(np.int64) for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(items, pa.list_(pa.int64()))], ["id", "items"])

    few = ids.count() * 16 <= s.broadcast_bytes
    wanted = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    return map_rows(wanted.join(F.broadcast(ids) if few else ids, "id", "left_semi"), run, "id long, items array<long>")


def _similar(n_a: Column, n_b: Column, both: Column, percent: int) -> Column:
    return 100 * both >= percent * (n_a + n_b - both)


def _measured(pairs: DataFrame, documents: DataFrame, s: Settings) -> DataFrame:
    """``pairs`` (columns a, b) with the sizes of both full sets and of their intersection."""
    spark = pairs.sparkSession
    ids = stored(spark, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = stored(spark, _sets(documents, ids, s), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("right"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select(
        "a", "b", F.size("left").alias("n_a"), F.size("right").alias("n_b"), F.size(F.array_intersect("left", "right")).alias("both")
    )


def _agreeing(a: Column, b: Column, rows: int) -> Column:
    """How many slots of two short signatures agree."""

    def equal(x: Column, y: Column) -> Column:
        lanes = [F.when(x.bitwiseXOR(y).bitwiseAND(F.lit(0xFFFF << 16 * k if k < 3 else -(1 << 48))) == 0, 1).otherwise(0) for k in range(rows)]
        return sum(lanes[1:], lanes[0])

    return F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda total, n: total + n)


def _apart(p: str, q: str) -> Column:
    """At least so many elements are in one of two sets only."""
    each = [F.bit_count(F.col(f"{p}.{x}").bitwiseXOR(F.col(f"{q}.{x}"))) for x in BITS]
    return sum(each[1:], each[0])


def _relabelled(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """``pairs`` whose sides are still in different groups."""
    for side in ("a", "b"):
        named = groups.select(F.col("node").alias(f"low_{side}"), F.col("component").alias(f"new_{side}"))
        pairs = pairs.join(named, f"low_{side}", "left")
    return pairs.where(F.coalesce("new_a", "low_a") != F.coalesce("new_b", "low_b")).select("a", "b")


def near_duplicates(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``documents``."""
    spark = documents.sparkSession
    rows = stored(spark, sketches(documents, s), "sketches")
    full = rows.where(F.col("bands").isNotNull() & F.col("doc_id").isNotNull())
    nodes = full.groupBy("h1", "h2", "n").agg(F.min_by(F.struct("bands", *BITS), "doc_id").alias("s"), F.min("doc_id").alias("id"))
    nodes = stored(spark, nodes.select("id", "n", "h1", "h2", "s.*"), "nodes")
    slots = nodes.select("id", F.posexplode("bands").alias("band", "key"))
    shared = slots.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1")
    met = stored(spark, slots.join(shared, ["band", "key"]), "met")
    central = met.join(met.groupBy("id").agg(F.sum("members").alias("company")), "id")
    centres = central.groupBy("band", "key").agg(F.max_by("id", F.struct("company", -F.col("id"))).alias("a"))
    members = stored(spark, met.drop("members").join(centres, ["band", "key"]), "members")
    stars = members.where("id != a").select("a", F.col("id").alias("b")).distinct()
    measured = stored(spark, _measured(stars, documents, s), "measured")
    linked = measured.where(_similar(F.col("n_a"), F.col("n_b"), F.col("both"), s.percent)).select("a", "b")
    groups = components(linked)

    # What is left: pairs of a bucket in different groups that nothing known excludes.
    label = F.coalesce("component", "id")
    labelled = members.join(groups.withColumnRenamed("node", "id"), "id", "left").select("band", "key", "a", "id", label.alias("label"))
    spread = labelled.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = labelled.join(spread.where("low != high").select("band", "key"), ["band", "key"])
    away = 1 - F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both"))
    to_centre = measured.select("a", F.col("b").alias("id"), away.alias("away"))
    placed = open_.join(to_centre, ["a", "id"], "left").join(nodes.select("id", "n", "bands", *BITS), "id")
    placed = stored(spark, placed.select("band", "key", "id", "label", "n", "bands", *BITS, F.coalesce("away", F.lit(0.0)).alias("away")), "open")
    # Members of a bucket's largest group need no look at each other: the others are one side.
    shares = placed.groupBy("band", "key", "label").agg(F.count("*").alias("size"))
    largest = shares.groupBy("band", "key").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
    sided = placed.where("away > 0").join(largest, ["band", "key"])  # centres have been compared with all
    p, q = sided.where("label != main").alias("p"), sided.alias("q")
    reach = (100 - s.percent) / 100 + 1e-9
    first_equal = F.zip_with("p.bands", "q.bands", lambda x, y: x == y)
    possible = (
        (F.col("p.band") == F.col("q.band")) & (F.col("p.key") == F.col("q.key"))
        & (F.col("p.label") != F.col("q.label"))
        & (F.abs(F.col("p.away") - F.col("q.away")) <= reach)
        & (100 * F.least("p.n", "q.n") >= s.percent * F.greatest("p.n", "q.n"))
        & ((100 + s.percent) * _apart("p", "q") <= (100 - s.percent) * (F.col("p.n") + F.col("q.n")))
        & ((F.col("q.label") == F.col("q.main")) | (F.col("p.id") < F.col("q.id")))
        & (_agreeing(F.col("p.bands"), F.col("q.bands"), s.rows) * 100 >= s.slots * (s.percent - 25))
        & (F.array_position(first_equal, True) == F.col("p.band") + 1)  # each pair in one bucket
    )
    sides = F.col("p.id") < F.col("q.id")
    rest = p.join(q, possible).select(
        F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b"),
        F.when(sides, F.col("p.label")).otherwise(F.col("q.label")).alias("low_a"),
        F.when(sides, F.col("q.label")).otherwise(F.col("p.label")).alias("low_b"),
        (_apart("p", "q") / (F.col("p.n") + F.col("q.n"))).alias("apart"),
    )
    rest = stored(spark, rest.distinct(), "rest")
    if rest.limit(1).count():
        between = [F.least("low_a", "low_b").alias("g"), F.greatest("low_a", "low_b").alias("h")]
        closest = rest.groupBy(*between).agg(F.min_by(F.struct("a", "b"), F.struct("apart", "a", "b")).alias("pair")).select("pair.*")
        for pairs in (lambda: closest, lambda: stored(spark, _relabelled(rest, groups), "still")):
            more = _measured(pairs(), documents, s)
            late = more.where(_similar(F.col("n_a"), F.col("n_b"), F.col("both"), s.percent)).select("a", "b")
            linked = linked.union(stored(spark, late, "late"))
            groups = components(linked)

    named = nodes.join(groups.withColumnRenamed("node", "id"), "id", "left").select("h1", "h2", "n", label.alias("component"))
    found = rows.join(named, ["h1", "h2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents without those that have a near-duplicate with a smaller id in their group."""
    spark = documents.sparkSession
    gone = stored(spark, near_duplicates(documents, s).where(~F.col("kept")).select("doc_id").distinct(), "gone")
    few = gone.count() * 16 <= s.broadcast_bytes
    return documents.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in documents.columns))
