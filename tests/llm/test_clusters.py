"""Integer k-means against brute force and SQL."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import clusters, registered
from verification import compare

TABLES = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, v string, cluster string, near string"


def brute(rows, s):
    """The contract's rules, one vector at a time."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == s.size and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [max(-clusters.LIMIT, min(clusters.LIMIT, math.floor(s.scale * float(np.float32(c))))) for c in x]))

    def name(vec_id):
        return hashlib.sha256(f"{s.seed}:{'' if vec_id is None else vec_id}".encode()).hexdigest()

    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[: s.clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(s.rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if groups[k] else c for k, c in enumerate(centroids)]
    found = [(vec_id, *near(v)) for vec_id, v in kept]
    totals = defaultdict(int)
    for _, distance, k in found:
        totals[k] += distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, k, d, totals[k], sum(totals.values()), digest[k]) for i, d, k in found]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def make(spark, rows):
    return spark.createDataFrame([(i, x, None, "x", "x", "x") for i, x in rows], VECTORS)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_ties_and_copies(spark, seed):
    rng = np.random.default_rng(seed)
    s = clusters.Settings(size=3, clusters=5, rounds=6, scale=4)
    rows = [(i, [float(c) for c in rng.integers(-3, 3, 3) / 2]) for i in range(80)]
    rows += [(3, rows[3][1])] * 40 + [(None, rows[5][1]), (None, [0.3, -0.1, 9.0])]
    assert rows_of(clusters.cluster(make(spark, rows), s)) == sorted(brute(rows, s), key=repr)


def test_left_out_and_clamped_rows(spark):
    s = clusters.Settings(size=2, clusters=3, rounds=2)
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [1e30, -3e38]), (9, [0.5, 0.25])]
    got = rows_of(clusters.cluster(make(spark, rows), s))
    assert got == sorted(brute(rows, s), key=repr) and [r[0] for r in got] == [1, 8, 9]


def test_fewer_vectors_than_clusters_and_none(spark):
    assert rows_of(clusters.cluster(make(spark, [(5, [1.0] * 64)]))) == brute([(5, [1.0] * 64)], clusters.Settings())
    empty = clusters.cluster(make(spark, [(2, None)]))
    assert empty.collect() == [] and empty.columns == clusters.cluster(make(spark, [(5, [1.0] * 64)])).columns
    assert clusters.cluster(make(spark, [(2, None)]).limit(0)).count() == 0


def test_query_equals_sql(spark):
    query = registered.op12_clusters(spark, TABLES)
    assert compare.differences(query, compare.connect(TABLES), clusters.oracle_sql()) == []


def test_only_built_in_expressions(spark):
    df = clusters.cluster(make(spark, [(i, [float(i)] * 64) for i in range(20)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "zip_with" in plan and "array_min" in plan
