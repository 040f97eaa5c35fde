"""Incremental import of object versions and detections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path

# Rows of one file of a bucket.
MAX_RECORDS = 5_000_000


def latest(df: DataFrame, key: str, version: list[str]) -> DataFrame:
    """Newest version per id, by ``version`` columns in order; a combining aggregate."""
    rest = [c for c in df.columns if c != key]
    g = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("__r"))
    return g.select(*[F.col(key) if c == key else F.col(f"__r.{c}").alias(c) for c in df.columns])


class VersionedTable:
    """Latest version of each id, kept in buckets that a batch rewrites only where it touches them.

    Each batch writes the new content of its buckets under ``batch=<id>`` and
    then a small list of bucket -> batch.  A repeated batch overwrites its own
    files, and readers see a batch only once its list is there.  Lateness does
    not matter: versions are compared, not arrival.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, version: list[str], schema, buckets: int = 64, parts: int = 4):
        self.spark, self.path, self.key, self.version, self.schema, self.buckets, self.parts = spark, path, key, version, schema, buckets, parts

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _map(self, before: int) -> dict[int, int]:
        """bucket -> batch that wrote it last; at most ``buckets`` entries."""
        try:
            lists = self.spark.read.schema("bucket int, batch bigint").json(f"{self.path}/lists/*")
        except Exception as e:  # no batch yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return {}
        return {r[0]: r[1] for r in lists.where(F.col("batch") < before).groupBy("bucket").agg(F.max("batch")).collect()}

    def _read(self, mapping: dict[int, int]) -> DataFrame | None:
        paths = [f"{self.path}/data/batch={b}/bucket={k}" for k, b in mapping.items()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else None

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        # the batch is read twice (its buckets, its rows); both reads see the same files
        touched = [r[0] for r in batch.select(self._bucket().alias("b")).distinct().collect()]
        if not touched:
            return
        known = self._map(batch_id)
        old = self._read({k: b for k, b in known.items() if k in touched})
        rows = batch.select(*[f.name for f in self.schema.fields])
        both = rows if old is None else rows.unionByName(old)
        new = latest(both, self.key, self.version).withColumn("bucket", self._bucket())
        # a bucket is dealt to several tasks by a second hash, so its size is no task's size
        part = F.pmod(F.xxhash64(self.key, F.lit("part")), F.lit(self.parts))
        (
            new.repartition("bucket", part).write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS).partitionBy("bucket")
            .parquet(f"{self.path}/data/batch={batch_id}")
        )
        self.spark.createDataFrame([(b, batch_id) for b in touched], "bucket int, batch bigint").coalesce(1).write.mode("overwrite").json(f"{self.path}/lists/{batch_id}")

    def read(self) -> DataFrame:
        df = self._read(self._map(1 << 62))
        return df if df is not None else self.spark.createDataFrame([], self.schema)


def import_versions(stream: DataFrame, key: str, version: list[str], path: str | None = None, buckets: int = 256, parts: int = 4) -> DataFrame:
    """Run a stream of versions into a VersionedTable over all files present.

    Repeated arrivals need no removal of their own: keep detections under their
    id and the newest version absorbs them, however late they come.  ``buckets``
    should grow with the table: a bucket is the unit that a batch rewrites, by
    ``parts`` tasks.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "versions")
    schema = stream.schema
    table = VersionedTable(spark, path, key, version, schema, buckets, parts)
    q = stream.writeStream.foreachBatch(table.merge).option("checkpointLocation", f"{path}/_progress").trigger(availableNow=True).start()
    q.awaitTermination()
    return table.read()


