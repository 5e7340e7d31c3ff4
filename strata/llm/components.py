"""Connected components of links, over a cluster."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, pieces, stored


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces links, 100,000 at a time, by a link from each node to its group's smallest."""
    for batch in pieces(batches, 100_000):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        pairs = [(x, root(x)) for x in list(parent)]
        pairs = [(x, r) for x, r in pairs if x != r]
        if pairs:
            high, low = zip(*pairs, strict=True)
            yield pa.record_batch([pa.array(high, pa.int64()), pa.array(low, pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (two long columns) but the smallest of each.

    Union-find inside each task's batches, then large-star and small-star rounds until
    nothing changes. Each round is a table in the shared folder; the driver sees two
    numbers of it.
    """
    spark = links.sparkSession
    first, second = links.columns
    pairs = links.where(F.col(first) != F.col(second)).select(
        F.greatest(first, second).cast("long").alias("a"), F.least(first, second).cast("long").alias("b")
    )
    stars = stored(spark, map_batches(pairs, _union_find, "a long, b long").distinct(), "links")
    seen = None
    while True:
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = now
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.union(lowest.select("a", F.col("m").alias("b"))).distinct()
        stars = stored(spark, small, "links")
