"""Centroid clustering of integer vectors by JVM expressions alone.

A vector becomes whole numbers once. Every round computes the squared distance to each literal centroid array with
``zip_with`` and ``aggregate``, takes the ``array_min`` of (distance, number) structs, and sums each component per
cluster in one hash aggregation of plain columns; the new centroid is the exact floor of sum / count. All arithmetic
is on integers, so neither the order of rows nor the number of partitions changes any result.

The squared distance is |v|^2 + (|c|^2 - 2 v.c): the first term is stored with the vector, the second alone decides the nearest.

Plan: the whole numbers are written once; a round is one scan of them whose tasks send k partial rows of sums, so
what reaches the driver is k x d numbers whatever the input. A vector copied many times costs only its scans.

Defined cases: vectors that are null, or have another length, or hold a null, NaN or infinite component, are left
out; components beyond +-131072 count as that bound, so that no distance overflows; vec_id repeats are rows of their
own; with the same vec_id, hash ties at the start are settled by the vector; a null vec_id is clustered but never
chosen at the start (its hash is null); fewer vectors than k give as many centroids; none give an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import table
from openbell.session import materialize

K, ROUNDS, SIZE, SCALE, SEED = 8, 10, 64, 1024, "3"
BOUND = 131_072


def whole_vectors(vectors: DataFrame, key: str, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(key, v, norm): components as floor(scale x) and their squared length; unusable vectors are left out."""
    x = F.col(f"`{vector}`").cast("array<double>")
    bound = F.lit(float(BOUND))
    usable = (F.size(x) == size) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    number = lambda c: F.floor(F.greatest(F.least(c, bound), -bound) * scale).cast("long")
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(f"`{key}`").alias(key), F.transform(x, number).alias("v"))
    return rows.withColumn("norm", _dot(F.col("v"), F.col("v")))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, y: s + y)


def first_centroids(rows: DataFrame, key: str, k: int = K, seed: str = SEED) -> list[list[int]]:
    """The vectors whose key has the smallest SHA-256 behind the seed."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256)
    chosen = rows.where(F.col(key).isNotNull()).select(name.alias("h"), "v").orderBy("h", "v").limit(k)
    return [list(r.v) for r in chosen.collect()]


def nearest(centroids: list[list[int]]) -> Column:
    """The struct (d, cluster) of the nearest centroid; d lacks the vector's own squared length. Ties: smaller number."""
    v = F.col("v")

    def away(c: list[int]) -> Column:
        literal = F.lit(c).cast("array<bigint>")
        return F.lit(sum(x * x for x in c)).cast("long") - 2 * _dot(v, literal)

    return F.array_min(F.array(*[F.struct(away(c).alias("d"), F.lit(n).alias("cluster")) for n, c in enumerate(centroids)]))


def assign(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``rows`` with ``cluster`` and ``distance``."""
    found = rows.withColumn("_near", nearest(centroids))
    return found.withColumns({"cluster": F.col("_near.cluster"), "distance": F.col("norm") + F.col("_near.d")}).drop("_near")


def update(rows: DataFrame, centroids: list[list[int]], size: int = SIZE) -> list[list[int]]:
    """Every centroid as the floor of its vectors' mean; those without vectors stay."""
    sums = rows.select(nearest(centroids)["cluster"].alias("cluster"), "v").groupBy("cluster")
    moved = list(centroids)
    for r in sums.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(size)]).collect():
        moved[r.cluster] = [r[f"s{i}"] // r.n for i in range(size)]
    return moved


def cluster(rows: DataFrame, key: str, k: int = K, rounds: int = ROUNDS, size: int = SIZE, seed: str = SEED) -> tuple[DataFrame, list[list[int]]]:
    """Clustered rows and the final centroids, from ``whole_vectors``."""
    centroids = first_centroids(rows, key, k, seed)
    if not centroids:
        return rows.withColumns({"cluster": F.lit(None).cast("int"), "distance": F.lit(None).cast("long")}).where("false"), []
    for _ in range(rounds):
        moved = update(rows, centroids, size)
        if moved == centroids:  # further rounds would repeat this one
            break
        centroids = moved
    return assign(rows, centroids), centroids


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "whole-vectors")
    found, centroids = cluster(rows, "vec_id")
    found = materialize(found.select("vec_id", "cluster", "distance"), "clustered")
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    each = F.array(*[F.lit(inertia.get(n, 0)).cast("long") for n in range(len(centroids))]).cast("array<bigint>")
    return found.select(
        "vec_id", "cluster", "distance",
        F.get(each, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)).cast("array<string>"), F.col("cluster")).alias("centroid_sha256"),
    )


def _oracle() -> str:
    parts = [
        f"""x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (
    SELECT sha256('{SEED}:' || vec_id::VARCHAR) AS h, v FROM x WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {K})
)""",
    ]
    pairs = "SELECT r, vec_id, v, k, list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS d FROM x, {c}"
    near = "SELECT r, vec_id, v, k, d FROM (" + pairs + ") QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1"
    for n in range(ROUNDS):
        c = f"c{n}"
        parts.append(f"a{n} AS MATERIALIZED ({near.format(c=c)})")
        parts.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT {c}.k, coalesce(m.c, {c}.c) AS c FROM {c} LEFT JOIN (
    SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
      SELECT k, i, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT k, generate_subscripts(v, 1) AS i, unnest(v) AS y FROM a{n}) GROUP BY k, i) GROUP BY k
  ) m USING (k)
)""")
    parts.append(f"z AS MATERIALIZED ({near.format(c=f'c{ROUNDS}')})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, k::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c{ROUNDS}.c, ',')) AS centroid_sha256
FROM z JOIN c{ROUNDS} USING (k)
"""


ORACLE_SQL = _oracle()
