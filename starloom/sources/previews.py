"""Looks into a stored catalog that read few of its files.

Partitions are the tiles in order of the sky index.  The first and last rows come from as
many tiles at an end as hold them.  Samples come from a table beside the
catalog that keeps, per tile, the rows with the smallest hashes; such samples
merge: the smallest hashes of two samples are those of both tables together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.ordered import top_k
from starloom.sources.catalogs import INDEX, _get_json, _in_tiles, _put_json

HASH = "sample_hash"
TILE = ["Norder", "Dir", "Npix"]


def _start() -> Column:
    """The first order-29 index of a tile."""
    return F.expr("shiftleft(cast(Npix AS bigint), cast(2 * (29 - Norder) AS int))")


def _tiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/partition_info").select("Norder", "Npix", "rows", _start().alias("start"))


def tile_at(spark: SparkSession, path: str, i: int) -> tuple[int, int]:
    """Norder and Npix of partition ``i``, counted from 0 in sky order; from the end if below 0."""
    order = F.col("start") if i >= 0 else F.col("start").desc()
    row = _tiles(spark, path).orderBy(order).offset(i if i >= 0 else -i - 1).limit(1).collect()
    if not row:
        raise IndexError(f"no partition {i}")
    return row[0]["Norder"], row[0]["Npix"]


def partition(spark: SparkSession, path: str, i: int, table: str = "dataset") -> DataFrame:
    """The rows of partition ``i``; other tiles are not opened."""
    return spark.read.parquet(f"{path}/{table}").where(_in_tiles([tile_at(spark, path, i)]))


def head(spark: SparkSession, path: str, n: int, tie: list[str] = ()) -> DataFrame:
    """The first ``n`` rows in sky order, equal places by ``tie``."""
    return _end(spark, path, n, tie, F.asc)


def tail(spark: SparkSession, path: str, n: int, tie: list[str] = ()) -> DataFrame:
    """The last ``n`` rows in sky order, equal places by ``tie``."""
    return _end(spark, path, n, tie, F.desc)


def _end(spark: SparkSession, path: str, n: int, tie, way) -> DataFrame:
    # a stored tile has a row at least, so n tiles are enough
    near, tiles, have = _tiles(spark, path).orderBy(way("start")).limit(n).collect(), [], 0
    for t in near:
        if have >= n:
            break
        tiles.append((t["Norder"], t["Npix"]))
        have += t["rows"]
    df = spark.read.parquet(f"{path}/dataset")
    return df.where(_in_tiles(tiles)).orderBy(way(INDEX), *[way(c) for c in tie]).limit(n) if tiles else df.limit(0)


def smallest(df: DataFrame, k: int, tie: list[str]) -> DataFrame:
    """The ``k`` rows of each tile with the smallest hashes; Spark keeps ``k`` per tile and task before the shuffle."""
    return top_k(df, TILE, [HASH, *tie], k, "__rank").drop("__rank")


def write_samples(spark: SparkSession, path: str, key: Column, k: int = 1000, tie: list[str] = ()) -> None:
    """Store the sample table of a catalog: per tile the ``k`` rows with the smallest ``key``, a hash of the row.

    ``tie`` orders equal hashes; columns that tell rows apart make the sample repeatable.
    """
    rows = smallest(spark.read.parquet(f"{path}/dataset").withColumn(HASH, key), k, list(tie))
    rows.repartition(*TILE).write.mode("overwrite").option("compression", "zstd").partitionBy(*TILE).parquet(f"{path}/samples")
    _put_json(spark, {"k": k, "tie": list(tie)}, f"{path}/samples_properties")


def merge_samples(one: DataFrame, two: DataFrame, k: int, tie: list[str] = ()) -> DataFrame:
    """The sample of two tables of the same tiles from their samples of ``k`` rows or more a tile."""
    return smallest(one.unionByName(two), k, list(tie))


def sample(spark: SparkSession, path: str, i: int, n: int) -> DataFrame:
    """``n`` rows of partition ``i`` by smallest hash, from the sample table alone."""
    own = _stored(spark, path, n)
    return partition(spark, path, i, "samples").orderBy(HASH, *own["tie"]).limit(n).drop(HASH)


def random_sample(spark: SparkSession, path: str, n: int) -> DataFrame:
    """``n`` rows of the whole catalog by smallest hash, from the sample table alone.

    Right for ``n`` up to the stored rows a tile: what is among the smallest n of all is among those of its tile.
    """
    own = _stored(spark, path, n)
    return spark.read.parquet(f"{path}/samples").orderBy(HASH, *own["tie"]).limit(n).drop(HASH)


def _stored(spark: SparkSession, path: str, n: int) -> dict:
    own = _get_json(spark, f"{path}/samples_properties")
    if n > own["k"]:
        raise ValueError(f"the stored sample has {own['k']} rows a tile, {n} were asked for")
    return own
