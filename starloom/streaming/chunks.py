"""Consume a table file by file."""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path


def read_chunks(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1, glob: str | None = None) -> DataFrame:
    """Stream over the leaf files of a table, a folder or a single file.

    A plain path is given to the source as a pattern that only it matches, since
    the source takes a plain path for a folder.
    """
    if not any(c in folder for c in "*?[{"):
        folder = folder.rstrip("/")
        folder = f"{folder[:-1]}[{folder[-1]}]"
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(folder)


def run_available(stream: DataFrame, transform=lambda df: df, path: str | None = None) -> DataFrame:
    """Run a stream over all files present, chunk by chunk, into a table; the result equals the batch result.

    Progress is kept in a checkpoint beside the table, so a restarted run goes
    on where it stopped and no chunk is written twice.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "chunks")
    out = transform(stream)
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{path}/_progress").option("path", f"{path}/rows").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/rows")


def consume_until(stream: DataFrame, n_rows: int, path: str | None = None) -> DataFrame:
    """Take chunks until at least ``n_rows`` rows are stored, then stop the stream; whole chunks are kept.

    Rows are counted chunk by chunk as they are written.  A restarted run counts
    what is there once and goes on from its progress.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "until")
    enough, counts = threading.Event(), _stored(spark, path)

    def store(batch: DataFrame, batch_id: int):
        if enough.is_set():
            return
        # files are named by batch, so a repeated batch replaces itself
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        counts[batch_id] = spark.read.schema(batch.schema).parquet(f"{path}/rows/batch={batch_id}").count()
        if sum(counts.values()) >= n_rows:
            enough.set()

    if sum(counts.values()) < n_rows:
        q = stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{path}/_progress").trigger(availableNow=True).start()
        while not q.awaitTermination(0.2):
            if enough.is_set():
                q.stop()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{path}/rows")


def _stored(spark: SparkSession, path: str) -> dict[int, int]:
    """Rows per stored chunk; empty before the first run."""
    try:
        rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return {}
    return {r[0]: r[1] for r in rows.groupBy("batch").agg(F.count(F.lit(1))).collect()}
