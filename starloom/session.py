"""Session settings shared by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Largest number of rows of one group that a single task may sort or hold.
# Groups beyond it are cut into pieces (see operators/ordered.py).
DEFAULT_HOT_ROWS = 2_000_000

_LOCAL: dict[str, str | None] = {}


def get_spark(app: str = "starloom", master: str | None = None, **conf) -> SparkSession:
    """Build a session; ``conf`` keys use ``__`` for dots."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def hot_rows(spark: SparkSession, override: int | None = None) -> int:
    """Rows of one group a task may hold: argument, session setting, default."""
    if override is not None:
        return override
    return int(spark.conf.get("spark.starloom.hotRows", str(DEFAULT_HOT_ROWS)))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A private folder is used only where the setting is absent and Spark runs in
    one local JVM, as in tests.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _LOCAL.setdefault(sc.applicationId, None) or tempfile.mkdtemp(prefix="starloom-")
        _LOCAL[sc.applicationId] = base
    return base


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder; ``clear_scratch`` removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """A mark for ``clear_scratch``: tables written later lie behind it."""
    return len(_SCRATCH)


def clear_scratch(spark: SparkSession, since: int = 0, keep_last: int = 0) -> int:
    """Delete the tables that this process wrote to the shared folder behind the mark ``since``, but for the last ``keep_last``; returns their number.

    Results are lazy and read these tables, so call it once they are stored or
    collected, never before.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    end = max(since, len(_SCRATCH) - keep_last)
    gone, _SCRATCH[since:end] = _SCRATCH[since:end], []
    return sum(bool((path := hadoop(p)).getFileSystem(conf).delete(path, True)) for p in gone)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used where a non-repeatable step (range cuts, a loop) must be fixed before
    two branches read it; the written files survive the loss of executors.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
