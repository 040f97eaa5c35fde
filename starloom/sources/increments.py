"""A tiled catalog that grows by batches.

    leaves/batch=/Norder=/Dir=/Npix=   rows; a batch writes new leaves, old ones are never changed
    state/batch=/tiles, counts         live tiles with the batch that wrote their leaf, rows per fine pixel
    commits/batch=                     written last; a batch counts once it is there

Tiles follow from the pixel counts of all rows so far, so batches give the
tiles of one import.  Counts only grow: a tile may split, but never joins
others, and a batch rewrites just the tiles that it brings rows for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.healpix import with_healpix
from starloom.operators.tiling import assign_tiles, pixel_counts
from starloom.sources.catalogs import INDEX, CatalogInfo
from starloom.sources.readers import filters_to_column, project

TILE = ["Norder", "Npix"]
# Leaves that may be named in a plan; more of them are a join.
MAX_LITERAL = 1000


class TiledTable:
    """Rows under adaptive tiles, imported batch by batch by one writer; ``schema`` are the columns of the batches."""

    def __init__(self, spark: SparkSession, path: str, info: CatalogInfo, schema: T.StructType):
        self.spark, self.path, self.info, self.schema = spark, path.rstrip("/"), info, schema

    def committed(self, before: int | None = None) -> int | None:
        """The newest complete batch, older than ``before`` if given."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return None
        ids = self.spark.read.schema("id long").json(f"{self.path}/commits/*")
        return (ids if before is None else ids.where(F.col("id") < before)).agg(F.max("id")).first()[0]

    def live(self, at: int | None) -> DataFrame:
        """Rows (Norder, Npix, rows, batch) of the live leaves after batch ``at``."""
        schema = "Norder int, Npix long, rows long, batch long"
        return self.spark.createDataFrame([], schema) if at is None else self.spark.read.schema(schema).parquet(f"{self.path}/state/batch={at}/tiles")

    def _leaves(self, live: DataFrame) -> DataFrame:
        """Rows of the named leaves; up to a thousand of them prune partitions as literals."""
        named = live.select(*TILE, "batch").limit(MAX_LITERAL + 1).collect()
        places = T.StructType([T.StructField("batch", T.LongType()), T.StructField("Norder", T.IntegerType()), T.StructField("Dir", T.LongType()), T.StructField("Npix", T.LongType())])
        schema = T.StructType([*self.schema.fields, T.StructField(INDEX, T.LongType()), *places.fields])
        if not named:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(f"{self.path}/leaves")
        if len(named) > MAX_LITERAL:
            return df.join(live.select(*TILE, "batch"), [*TILE, "batch"], "left_semi").select(*schema.names)
        return df.where(_any_of(named))

    def import_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Add the rows of ``batch``.  A repeated batch overwrites its own leaves, so it fits ``foreachBatch``.

        ``batch`` is read twice, for its counts and its rows.
        """
        at, order = self.committed(batch_id), self.info.max_order
        rows = with_healpix(batch.select(*self.schema.names), self.info.ra_column, self.info.dec_column, name=INDEX)
        state = f"{self.path}/state/batch={batch_id}"
        added = self._store(pixel_counts(rows, order, INDEX), f"{state}/added")
        before = self.live(at)
        counts = added
        if at is not None:
            old = self.spark.read.parquet(f"{self.path}/state/batch={at}/counts")
            counts = old.unionByName(added).groupBy("pixel").agg(F.sum("n").alias("n"))
        counts = self._store(counts, f"{state}/counts")

        # live tiles that hold a pixel of the batch: one row per pixel and order present
        above = F.expr(f"transform(sequence(0, {order}), o -> struct(o AS Norder, shiftright(pixel, cast(2 * ({order} - o) AS int)) AS Npix))")
        met = added.select(F.explode(above).alias("t")).select("t.Norder", "t.Npix").distinct()
        touched = self._store(before.join(met, TILE, "left_semi"), f"{state}/touched")
        sums = [df.agg(F.sum(c)).first()[0] or 0 for df, c in ((touched, "rows"), (added, "n"))]
        if sums[1]:
            both = self._leaves(touched).select(*self.schema.names, INDEX).unionByName(rows)
            tasks = max(1, min(self.spark.sparkContext.defaultParallelism * 64, -(-sum(sums) // 2_000_000)))
            tiled = assign_tiles(both, self.info.threshold, order, INDEX, counts)
            written = f"{self.path}/leaves/batch={batch_id}"
            (
                tiled.repartitionByRange(tasks, *TILE, INDEX)
                .sortWithinPartitions(*TILE, INDEX)
                .write.mode("overwrite").option("compression", "zstd").partitionBy("Norder", "Dir", "Npix").parquet(written)
            )
            # partition values and row counts of the footers
            new = self.spark.read.parquet(written).groupBy(F.col("Norder").cast("int").alias("Norder"), F.col("Npix").cast("long").alias("Npix"))
            new = new.agg(F.count(F.lit(1)).alias("rows")).withColumn("batch", F.lit(batch_id).cast("long"))
            self._store(before.join(touched, TILE, "left_anti").unionByName(new), f"{state}/tiles")
        else:
            self._store(before, f"{state}/tiles")
        self.spark.createDataFrame([(batch_id,)], "id long").coalesce(1).write.mode("overwrite").json(f"{self.path}/commits/batch={batch_id}")

    def open(self, columns=None, filters=None) -> DataFrame:
        """The rows of all committed batches under their tiles; dead leaves are not opened."""
        df = self._leaves(self.live(self.committed())).drop("batch")
        if filters:
            df = df.where(filters_to_column(filters))
        return project(df, columns, self.info.default_columns or None)

    def _store(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _any_of(named) -> Column:
    """Partition filter for (Norder, Npix, batch) rows."""
    cond = F.lit(False)
    for batch, order in sorted({(r["batch"], r["Norder"]) for r in named}):
        pixels = [r["Npix"] for r in named if (r["batch"], r["Norder"]) == (batch, order)]
        cond = cond | ((F.col("batch") == batch) & (F.col("Norder") == order) & F.col("Npix").isin(pixels))
    return cond
