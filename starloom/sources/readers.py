"""Readers: column files, text tables, file manifests."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_OPS = {
    "==": lambda c, v: c == v,
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "not in": lambda c, v: ~c.isin(list(v)),
}


def filters_to_column(filters: list[tuple[str, str, object]]) -> Column:
    """AND list of (column, operator, value) as one predicate; comparisons reach the Parquet scan."""
    return reduce(lambda a, b: a & b, [_OPS[op](F.col(c), v) for c, op, v in filters])


def clean(df: DataFrame) -> DataFrame:
    """NaN to null in top-level floating columns, so aggregates skip both alike."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in fl})


def _pick(name: str, fields: list[str]) -> Column:
    return F.transform(name, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name)


def project(df: DataFrame, columns: list[str] | str | None, default: list[str] | None = None) -> DataFrame:
    """Select named columns, all, or the default set.

    ``list.field`` keeps just those fields of an array of structs; names that
    are absent are skipped when they come from the default set.
    """
    if columns == "all" or (columns is None and not default):
        return df
    wanted = columns if columns is not None else default
    flat = [c for c in wanted if "." not in c]
    nested: dict[str, list[str]] = {}
    for c in wanted:
        if "." in c:
            head, leaf = c.split(".", 1)
            nested.setdefault(head, []).append(leaf)
    missing = [c for c in [*flat, *nested] if c not in df.columns]
    if missing and columns is not None:
        raise ValueError(f"no such columns: {missing}")
    out = [F.col(c) for c in flat if c not in missing]
    for head, leaves in nested.items():
        if head in missing:
            continue
        have = df.schema[head].dataType.elementType.fieldNames()
        out.append(_pick(head, [f for f in leaves if f in have]))
    return df.select(*out)


def scan(spark: SparkSession, path, columns=None, filters=None, region=None, ra="ra", dec="dec", default=None) -> DataFrame:
    """Open a column table with projection, filters and a region."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if filters:
        df = df.where(filters_to_column(filters))
    if region is not None:
        df = df.where(region.predicate(ra, dec))
    return project(df, columns, default)


def pinned_schema(spark: SparkSession, template: str, columns: list[str], dimensions: list[str] = ()) -> T.StructType:
    """Schema of one file, cut to ``columns`` in file order, with dimensions appended as long."""
    src = spark.read.parquet(template).schema
    fields = [f for f in src.fields if f.name in columns]
    return T.StructType(fields + [T.StructField(d, T.LongType()) for d in dimensions if d not in columns])


def manifest_scan(
    spark: SparkSession, manifest: DataFrame, columns: list[str] | None = None, schema: T.StructType | None = None, max_paths: int = 10_000, tasks: int | None = None
) -> DataFrame:
    """Read the files listed in ``manifest`` (path plus dimension columns).

    Each row gets its file's dimension values unless the data has the column.
    Up to ``max_paths`` files become one scan, whose paths the driver holds; the
    values come from a join on the file name, without a forced broadcast.  More
    files stay rows of the manifest, and tasks open them (``manifest_blocks``).
    """
    paths = [r["path"] for r in manifest.select("path").distinct().limit(max_paths + 1).collect()]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if len(paths) > max_paths:
        return manifest_blocks(manifest, schema if schema is not None else reader.parquet(paths[0]).schema, columns, tasks)
    df = reader.parquet(*paths)
    if columns:
        df = df.select(*columns)
    dims = [c for c in manifest.columns if c != "path" and c not in df.columns]
    # the scan reports percent-encoded URIs; compare on the decoded path part
    key = F.regexp_replace(F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")), r"^[a-z0-9]+:/+", "/")
    m = manifest.select(F.regexp_replace("path", r"^[a-z0-9]+:/+", "/").alias("__path"), *dims)
    return df.select("*", key.alias("__path")).join(m, "__path").drop("__path")


# Row groups that one task should read.
GROUPS_PER_TASK = 16


def manifest_blocks(manifest: DataFrame, schema: T.StructType, columns: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """``manifest_scan`` for any number of files: the driver never sees the paths.

    Tasks read the footers of their manifest rows; the row groups found are dealt
    anew, so a large file is read by several tasks.  Only the wanted columns are
    read, and columns that a file lacks are null.  Paths are those that Arrow's
    file systems know (local, hdfs, s3, gs); ``path`` may be a URI or a plain path.
    """
    picked = T.StructType([schema[c] for c in columns]) if columns else schema
    dims = [f for f in manifest.schema.fields if f.name != "path" and f.name not in picked.names]
    out = T.StructType(picked.fields + dims)
    files = manifest.select("path", *[f.name for f in dims])

    def footers(batches):
        for b in batches:
            for k, path in enumerate(b.column("path").to_pylist()):
                with _open_parquet(path) as file:
                    n = file.metadata.num_row_groups
                if n:
                    one = b.slice(k, 1).take(pa.array([0] * n))
                    yield pa.RecordBatch.from_arrays([*one.columns, pa.array(range(n), pa.int32())], [*one.schema.names, "__group"])

    arrow = to_arrow_schema(out)

    def read(batches):
        for b in batches:
            for row in b.to_pylist():
                with _open_parquet(row["path"]) as file:
                    have = [c for c in picked.names if c in file.schema_arrow.names]
                    for part in file.iter_batches(row_groups=[row["__group"]], columns=have):
                        n = part.num_rows
                        cols = [part.column(f.name).cast(arrow.field(f.name).type) if f.name in have else pa.nulls(n, arrow.field(f.name).type) for f in picked.fields]
                        cols += [pa.array([row[f.name]] * n, arrow.field(f.name).type) for f in dims]
                        yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    listed = files.mapInArrow(footers, T.StructType([*files.schema.fields, T.StructField("__group", T.IntegerType())]))
    if tasks is None:
        tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, -(-manifest.count() // GROUPS_PER_TASK))
    return listed.repartition(tasks, "path", "__group").mapInArrow(read, out)


def _open_parquet(path: str) -> pq.ParquetFile:
    """A Parquet file by its plain path or its URI, neither percent-encoded."""
    if path.startswith("file:"):
        return pq.ParquetFile("/" + path[5:].lstrip("/"))
    if not re.match(r"^[a-z0-9]+:/", path):
        return pq.ParquetFile(path)
    system, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    return pq.ParquetFile(system.open_input_file(name))


def read_csv(spark: SparkSession, path: str, schema: str, constants: dict[str, object] | None = None) -> DataFrame:
    """CSV with header and a declared schema; names lower-cased, constant columns added."""
    df = spark.read.csv(path, header=True, schema=schema)
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.withColumns({k: F.lit(v) for k, v in (constants or {}).items()})


def read_fixed_width(spark: SparkSession, path: str, fields: list[tuple[str, int, int, str]]) -> DataFrame:
    """Fixed-width text; comment, blank, header and dash lines are skipped.

    ``fields`` lists (name, start, length, type), start counted from 1.  A line
    is data when its first field reads as a number.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    name0, start0, len0, _ = fields[0]
    lines = lines.where(F.trim(F.substring("value", start0, len0)).rlike(r"^[-+]?[0-9.]+([eE][-+]?[0-9]+)?$"))
    return lines.select(*[F.expr(f"try_cast(nullif(trim(substring(value, {s}, {n})), '') AS {t})").alias(c) for c, s, n, t in fields])


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document holding a list of records."""
    return spark.read.schema(schema).json(path, multiLine=True)


_WORD = re.compile(r"'(?:[^'\\]|\\.)*'|`[^`]*`|&&?|\|\|?|~|[^&|~'`]+")


def query_text(text: str) -> str:
    """Rewrite the dialect's ``&``, ``|``, ``~`` and ``==`` to SQL, leaving quoted parts alone."""
    out = []
    for tok in _WORD.findall(text):
        if tok[0] in "'`":
            out.append(tok)
        elif tok[0] == "&":
            out.append(" AND ")
        elif tok[0] == "|":
            out.append(" OR ")
        elif tok == "~":
            out.append(" NOT ")
        else:
            out.append(tok)
    return "".join(out)


def query(df: DataFrame, text: str) -> DataFrame:
    """Filter by a text predicate."""
    return df.where(query_text(text))
