"""Centroid clustering of whole-numbered vectors by Spark expressions.

The centroids of a round are literal arrays.  zip_with and aggregate compute the
squared distance to each, array_min of (distance, number) structs chooses the
cluster, and one aggregate of component sums per cluster gives the next
centroids.  A task sends at most one row per cluster, so a cluster of any
size is never gathered; the driver sees ``clusters`` rows a round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3

# Whole-numbered components beyond this could overflow a 64-bit distance of 2 ** 10 dimensions.
LARGEST = 1 << 25


def finite(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, odd), F.lit(False))


def whole_vectors(rows: DataFrame, vector: str, vec_id: str, dimensions: int, scale: int) -> DataFrame:
    """Rows (vec_id, v): vectors of finite components, each as floor(scale * component).  Written once."""
    col = F.col(f"`{vector}`")
    kept = rows.where((F.size(col) == dimensions) & finite(col))
    whole = F.transform(col, lambda x: F.floor(x.cast("double") * scale))
    kept = materialize(kept.select(F.col(f"`{vec_id}`").alias("vec_id"), whole.alias("v")))
    most = kept.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()[0]
    if dimensions > 1 << 10 or (most or 0) > LARGEST:
        raise ValueError(f"distances need more than 64 bits: {dimensions} dimensions, largest component {most}")
    return kept


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``; repeated ids by vector, null ids last."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in kept.orderBy(mark.asc_nulls_last(), "v").limit(clusters).select("v").collect()]


def literal(vector: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{x}L' for x in vector)})")


def nearest(centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid to ``v``; the smaller number wins ties."""

    def squared(centroid: list[int]) -> Column:
        parts = F.zip_with("v", literal(centroid), lambda a, b: (a - b) * (a - b))
        return F.aggregate(parts, F.lit(0).cast("long"), lambda s, x: s + x)

    return F.array_min(F.array(*[F.struct(squared(c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(centroids)]))


def move(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid at the floor of the mean of its vectors; one without vectors stays."""
    near = kept.select("v", nearest(centroids).alias("near"))
    # components are at most 2 ** 25, so sums of 2 ** 38 rows fit; beyond that Spark stops with an error
    sums = [F.expr(f"sum(v[{i}]) AS s{i}") for i in range(len(centroids[0]))]
    out = list(centroids)
    for r in near.groupBy(F.col("near.cluster").alias("cluster")).agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(len(centroids[0]))]
    return out


def cluster_vectors(
    rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS,
    scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """One row per vector kept: vec_id, cluster, distance, centroid (its final centroid), cluster_size, cluster_inertia, inertia.

    Vectors with exactly ``dimensions`` components, none of them null, NaN or
    infinite, are kept and turned into floor(scale * component).  The first
    centroids are ``clusters`` kept vectors (fewer if there are fewer) in the order of the
    SHA-256 of ``seed:vec_id``; null ids come last, rows of one id in the order of
    their vectors.  Each of ``rounds`` rounds assigns every vector to the nearest
    centroid (squared distance, ties to the smaller number) and moves every
    centroid that has vectors to the floor of their mean.  Equal centroids stay
    equal; the larger number has no vectors then.  All rows of a repeated id
    are returned.  No vector kept gives an empty table.  Components beyond 2 ** 25
    after scaling are refused, since distances would not fit 64 bits.
    """
    kept = whole_vectors(rows, vector, vec_id, dimensions, scale)
    centroids = first_centroids(kept, clusters, seed)
    if not centroids:
        kind = kept.schema["vec_id"].dataType.simpleString()
        return kept.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long, centroid array<bigint>, cluster_size long, cluster_inertia long, inertia long")
    for _ in range(rounds):
        centroids = move(kept, centroids)
    near = kept.select("vec_id", nearest(centroids).alias("near"))
    sums = near.groupBy("near.cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("near.distance").alias("inertia")).collect()
    # one literal entry per cluster
    entry = {r.cluster: (r.n, r.inertia) for r in sums}
    size, inertia = (literal([entry.get(k, (0, 0))[i] for k in range(len(centroids))]) for i in (0, 1))
    at = F.col("near.cluster")
    return near.select(
        "vec_id", at.alias("cluster"), F.col("near.distance").alias("distance"), F.get(F.array(*map(literal, centroids)), at).alias("centroid"),
        F.get(size, at).alias("cluster_size"), F.get(inertia, at).alias("cluster_inertia"), F.lit(sum(r.inertia for r in sums)).cast("long").alias("inertia"),
    )


def with_centroid_sha(found: DataFrame) -> DataFrame:
    """Replace ``centroid`` by the SHA-256 of its components as decimal numbers joined by commas."""
    return found.withColumn("centroid_sha256", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)).drop("centroid")
