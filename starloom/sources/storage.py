"""Storage reports from file footers and codec comparisons."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Writer settings that hold a codec's level.
LEVELS = {"zstd": "parquet.compression.codec.zstd.level", "gzip": "zlib.compress.level"}


def column_storage(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Compressed bytes and values per column over all files of ``files`` (path).

    Footers are read inside tasks; only one small row per column and file
    leaves them, and the sums combine before the shuffle.
    """

    def footers(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, local = pafs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
                meta = pq.ParquetFile(fs.open_input_file(local)).metadata
                names, size, raw, values = [], [], [], []
                for g in range(meta.num_row_groups):
                    for c in range(meta.num_columns):
                        col = meta.row_group(g).column(c)
                        names.append(col.path_in_schema)
                        size.append(col.total_compressed_size)
                        raw.append(col.total_uncompressed_size)
                        values.append(col.num_values)
                yield pa.RecordBatch.from_pydict({"name": names, "size": size, "raw_size": raw, "values": values})

    per_file = files.select("path").mapInArrow(footers, "name string, size bigint, raw_size bigint, values bigint")
    rep = per_file.groupBy("name").agg(F.sum("size").alias("size"), F.sum("raw_size").alias("raw_size"), F.sum("values").alias("values"))
    total = rep.agg(F.sum("size").alias("total")).withColumn("one", F.lit(1))
    return (
        rep.withColumn("one", F.lit(1))
        .join(F.broadcast(total), "one")  # exactly one row
        .select(
            "name", "size", "raw_size", "values",
            (F.col("size") / F.nullif(F.col("values"), F.lit(0))).alias("bytes_per_value"),
            (F.col("size") * 100.0 / F.nullif(F.col("total"), F.lit(0))).alias("percent"),
        )
    )


def merge_reports(reports: dict[str, DataFrame]) -> DataFrame:
    """Outer join of storage reports by column name; absent columns stay null."""
    out = None
    for label, rep in reports.items():
        r = rep.select("name", F.col("size").alias(f"size_{label}"), F.col("percent").alias(f"percent_{label}"))
        out = r if out is None else out.join(r, "name", "full_outer")
    return out


def recompress(df: DataFrame, path: str, codecs: list[str]) -> DataFrame:
    """Write the table once per codec; report bytes and seconds of each.

    A codec may carry a level, as ``zstd:9`` or ``gzip:9``.
    """
    from starloom.sources.catalogs import file_sizes

    spark = df.sparkSession
    out = None
    for codec in codecs:
        t0 = time.time()
        name, _, level = codec.partition(":")
        out_path = f"{path}/{codec.replace(':', '-')}"
        writer = df.write.mode("overwrite").option("compression", name)
        if level:
            writer = writer.option(LEVELS[name], level)
        writer.parquet(out_path)
        seconds = time.time() - t0
        row = file_sizes(spark, out_path).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
        row = row.select(F.lit(codec).alias("codec"), "bytes", "files", F.lit(seconds).alias("seconds"))
        out = row if out is None else out.unionByName(row)
    return out


def tile_threshold(sizes: DataFrame) -> DataFrame:
    """Rows that fill 300 MiB and 1 GiB, from (bytes, rows) of sampled files."""
    agg = sizes.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    per_row = F.col("bytes") / F.nullif(F.col("rows"), F.lit(0))
    return agg.select(
        "bytes", "rows",
        F.floor(F.lit(300 * 2**20) / per_row).alias("rows_300mib"),
        F.floor(F.lit(2**30) / per_row).alias("rows_1gib"),
    )


def file_bounds(df: DataFrame, ra: str, dec: str) -> DataFrame:
    """Position bounds per source file and whether they are usable."""
    g = df.select(F.col("_metadata.file_path").alias("file"), ra, dec).groupBy("file").agg(
        F.min(ra).alias("ra_min"), F.max(ra).alias("ra_max"), F.min(dec).alias("dec_min"), F.max(dec).alias("dec_max"),
        F.count_if(F.col(ra).isNull() | F.col(dec).isNull()).alias("null_positions"),
    )
    return g.withColumn("usable", F.col("ra_min").isNotNull() & F.col("dec_min").isNotNull())
