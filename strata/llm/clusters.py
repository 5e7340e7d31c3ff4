"""Centroid clustering (operator 12): integer k-means in JVM-native expressions.

A vector's components become integers, ``floor(scale * x)``. Squared distances to the
centroids, which are literal arrays of the plan, are ``zip_with`` and ``aggregate`` over
the components; ``array_min`` of (distance, number) structs chooses the cluster, so ties go
to the smaller number. A round is one aggregate of column sums, with map-side combine: a
task sends one row for each cluster, however many vectors a cluster or copies a vector has.
What reaches the driver in a round are ``clusters`` rows of ``size`` sums. The next
centroids are their exact ``floor(sum / count)``.

The integers are written once to the shared scratch folder; every round scans that table
and nothing else, and no round's plan holds an earlier round.

Defined cases: a null vector, another number of components, null or non-finite components:
the row is left out. Fewer vectors than clusters: as many clusters as vectors, none for an
empty table (empty result). Repeated rows count each; rows of one id start in the order of
their components; a null id hashes as empty text and comes back null. Integers are clamped
to +-2**27, beyond which a squared distance would not fit 64 bits. Sums that pass 64 bits
are null (inertia only). Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

LIMIT = 2**27


@dataclass(frozen=True)
class Settings:
    size: int = 64
    scale: int = 1024
    clusters: int = 8
    rounds: int = 10
    seed: int = 3


def integers(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``vec_id, v``: usable vectors as integers."""
    inside = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        return F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.greatest(F.lit(-2.0 * LIMIT), F.least(F.lit(2.0 * LIMIT), x * s.scale))))).cast("long")

    kept = vectors.where((F.size("embedding") == s.size) & F.coalesce(usable, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(inside, whole).alias("v"))


def first_centroids(vectors: DataFrame, s: Settings) -> list[list[int]]:
    name = F.concat(F.lit(f"{s.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name.cast("binary"), 256).alias("hash"), "v").orderBy("hash", "v").limit(s.clusters)
    return [list(r["v"]) for r in rows.collect()]


def nearest(centroids: list[list[int]]) -> Column:
    """The nearest centroid of ``v``: its squared distance, and its number."""
    each = []
    for k, centroid in enumerate(centroids):
        literal = ", ".join(f"{c}L" for c in centroid)
        distance = f"aggregate(zip_with(v, array({literal}), (x, c) -> (x - c) * (x - c)), 0L, (a, b) -> a + b)"
        each.append(f"struct({distance} AS distance, {k} AS cluster)")
    return F.expr(f"array_min(array({', '.join(each)}))")


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    return vectors.withColumn("near", nearest(centroids)).select("*", "near.cluster", "near.distance").drop("near")


def next_centroids(vectors: DataFrame, centroids: list[list[int]], s: Settings) -> list[list[int]]:
    sums = [F.expr(f"sum(v[{k}]) AS s{k}") for k in range(s.size)]
    rows = assigned(vectors, centroids).groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()
    moved = {r["cluster"]: [r[f"s{k}"] // r["n"] for k in range(s.size)] for r in rows}
    return [moved.get(k, c) for k, c in enumerate(centroids)]


def cluster(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of usable vectors."""
    rows = stored(vectors.sparkSession, integers(vectors, s), "vectors")
    centroids = first_centroids(rows, s)
    if not centroids:
        return rows.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    for _ in range(s.rounds):
        centroids = next_centroids(rows, centroids, s)
    final = assigned(rows, centroids)
    wide = F.sum(F.col("distance").cast("decimal(20,0)"))
    parts = {r[0]: int(r[1]) for r in final.groupBy("cluster").agg(wide).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def per_cluster(values: list) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("cluster"))

    def fits(total: int) -> Column:
        return F.lit(total if total < 2**63 else None).cast("long")

    inertia = F.get(F.array(*(fits(parts.get(k, 0)) for k in range(len(centroids)))), F.col("cluster"))
    return final.select(
        "vec_id",
        "cluster",
        "distance",
        inertia.alias("cluster_inertia"),
        fits(sum(parts.values())).alias("inertia"),
        per_cluster(digests).alias("centroid_sha256"),
    )


def oracle_sql(s: Settings = Settings()) -> str:
    """The same rule in SQL, a pair of subqueries for each round: result of op12_clusters."""
    parts = [
        f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({s.scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {s.size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {s.size}
), c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS k, v AS c
  FROM (SELECT sha256('{s.seed}:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {s.clusters})
)"""
    ]
    for i in range(s.rounds + 1):
        parts.append(f"""d{i} AS MATERIALIZED (
  SELECT vec_id, v, k, list_sum(list_transform(range(1, {s.size + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS distance
  FROM kept, c{i}
), a{i} AS MATERIALIZED (
  SELECT * FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, k) = 1
)""")
        if i < s.rounds:
            parts.append(f"""s{i} AS (
  SELECT k, j, sum(v[j])::BIGINT AS total, count(*) AS n FROM a{i}, range(1, {s.size + 1}) AS t(j) GROUP BY k, j
), m{i} AS (
  SELECT k, list((total - ((total % n + n) % n)) // n ORDER BY j) AS c FROM s{i} GROUP BY k
), c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN m{i} m USING (k))""")
    last = s.rounds
    return f"""WITH {", ".join(parts)}
SELECT vec_id, k::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (k)"""
