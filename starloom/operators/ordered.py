"""Grouped statistics and ordered computations that survive one huge group.

A window over a group runs in one task.  That is right while every group is
small, so each ordered operator first counts the rows of the largest group (a
pre-aggregated job over the key columns only).  Up to ``hotRows`` rows per
group the plain window is used.  Beyond it the rows are range-partitioned on
(keys, order), which cuts a huge group into several consecutive pieces; each
piece is processed by its own task and small per-piece totals carry ranks, sums
and previous rows across the cuts.  Results are the same either way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starloom.session import hot_rows as _limit
from starloom.session import materialize

PIECE = "__piece"


def _cols(items) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


_SEEN: dict[tuple[int, int], tuple[int, int]] = {}

# Rows per task where each row costs far more time than bytes.
COSTLY_ROWS = 200_000


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group."""
    return _group_sizes(df, keys)[0]


def costly_tasks(df: DataFrame, keys: list[str], counted: bool = True) -> int:
    """Task count for numpy work on packed groups.

    Adaptive execution joins small shuffle partitions by bytes, which would put
    heavy scans of little data into one task; an explicit count is kept.  It
    grows with the rows where they have been counted, else with the session's
    shuffle partitions.
    """
    spark = df.sparkSession
    floor = spark.sparkContext.defaultParallelism
    if not counted:
        return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return max(floor, -(-_group_sizes(df, keys)[1] // COSTLY_ROWS))


def _group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest group and of all; one map-side combined aggregate over the key columns.

    The answer for a plan is remembered, so a chain of operators on one table
    counts it once.  It only chooses between two exact ways, so an answer that
    has become old cannot change a result.
    """
    plan = df.select(*keys)
    tag = (id(df.sparkSession.sparkContext), plan.semanticHash())
    if tag not in _SEEN:
        row = plan.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"), F.sum("n").alias("total")).first()
        if len(_SEEN) > 1000:
            _SEEN.clear()
        _SEEN[tag] = (row["n"] or 0, row["total"] or 0)
    return _SEEN[tag]


def is_hot(df: DataFrame, keys: list[str], hot_rows: int | None = None, biggest: int | None = None) -> bool:
    """Whether a group exceeds the limit; a known upper bound within the limit saves the counting job."""
    limit = _limit(df.sparkSession, hot_rows)
    if biggest is not None and biggest <= limit:
        return False
    return largest_group(df, keys) > limit


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on null-safe key equality, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def with_stats(df: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    """Attach per-group aggregates to each row.

    Aggregate-and-join rather than a window: the aggregate combines before its
    shuffle, the join side is one row per group, and a hot group stays spread
    (broadcast if the measured size allows, else skew-split sort-merge join).
    """
    stats = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return same_keys(df, stats, keys, "left")


def cut_pieces(df: DataFrame, keys: list[str], order: list, hot_rows: int | None = None) -> DataFrame:
    """Number the range partitions on (keys, order) and fix them by writing."""
    limit = _limit(df.sparkSession, hot_rows)
    total = df.count()
    parts = max(2, -(-2 * total // limit))
    ranged = df.repartitionByRange(parts, *_cols(keys), *_cols(order))
    return materialize(ranged.withColumn(PIECE, F.spark_partition_id()))


def ordered(
    df: DataFrame,
    keys: list[str],
    order: list,
    *,
    rank: str | None = None,
    sums: dict[str, Column] | None = None,
    lags: dict[str, str] | None = None,
    hot_rows: int | None = None,
    biggest: int | None = None,
) -> DataFrame:
    """Rank, running sums and previous-row values within groups.

    rank   name of a 1-based row number column
    sums   name -> expression; sum from the first row of the group to this one
    lags   name -> column; its value in the previous row of the group
    biggest  an upper bound of the group sizes, if one is known
    """
    sums, lags = sums or {}, lags or {}
    order = _cols(order)
    if not is_hot(df, keys, hot_rows, biggest):
        w = W.partitionBy(*keys).orderBy(*order)
        upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
        new = {n: F.sum(e).over(upto) for n, e in sums.items()}
        new |= {n: F.lag(c).over(w) for n, c in lags.items()}
        if rank:
            new[rank] = F.row_number().over(w).cast("long")
        return df.withColumns(new)

    cut = cut_pieces(df, keys, order, hot_rows)
    w = W.partitionBy(*keys, PIECE).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    new = {n: F.sum(e).over(upto) for n, e in sums.items()}
    new |= {n: F.lag(c).over(w) for n, c in lags.items()}
    new["__rl"] = F.row_number().over(w).cast("long")
    local = cut.withColumns(new)

    # one row per (group, piece): far fewer than rows, at most one per range partition and group
    tot = {f"__t_{n}": F.sum(e) for n, e in sums.items()}
    tot["__t_rn"] = F.count(F.lit(1))
    if lags:
        tot["__last"] = F.max_by(F.struct(*[F.col(c).alias(n) for n, c in lags.items()]), F.struct(*order))
    totals = cut.groupBy(*keys, PIECE).agg(*[c.alias(n) for n, c in tot.items()])
    wp = W.partitionBy(*keys).orderBy(PIECE)
    before = wp.rowsBetween(W.unboundedPreceding, -1)
    carry = {f"__c_{n[4:]}": F.sum(n).over(before) for n in tot if n.startswith("__t_")}
    if lags:
        carry["__prev"] = F.lag("__last").over(wp)
    totals = totals.select(*keys, PIECE, *[c.alias(n) for n, c in carry.items()])

    out = same_keys(local, totals, [*keys, PIECE], "left")
    fix = {n: F.when(F.col(f"__c_{n}").isNull(), F.col(n)).otherwise(F.coalesce(F.col(n), F.lit(0)) + F.col(f"__c_{n}")) for n in sums}
    fix |= {n: F.when(F.col("__rl") == 1, F.col(f"__prev.{n}")).otherwise(F.col(n)) for n in lags}
    if rank:
        fix[rank] = F.col("__rl") + F.coalesce(F.col("__c_rn"), F.lit(0))
    out = out.withColumns(fix)
    return out.drop(PIECE, "__rl", *carry)


def percentiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], hot_rows: int | None = None, biggest: int | None = None
) -> DataFrame:
    """Exact linear-interpolated percentiles per group, nulls ignored.

    Small groups use the built-in aggregate.  It holds all distinct values of a
    group, so larger groups are ranked in pieces and only the two neighbouring
    order statistics of each probability are kept.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias(value))
    if not is_hot(rows, keys, hot_rows, biggest):
        names = list(probs)
        q = rows.groupBy(*keys).agg(F.percentile(value, F.array(*[F.lit(float(p)) for p in probs.values()])).alias("__q"))
        return q.select(*keys, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    ranked = same_keys(ordered(rows, keys, [value], rank="__r", hot_rows=hot_rows), counts, keys, "left")
    aggs = []
    for n, p in probs.items():
        pos = F.lit(float(p)) * (F.col("__n") - 1)
        r = F.col("__r") - 1
        lo = F.max(F.when(r == F.floor(pos), F.col(value)))
        hi = F.max(F.when(r == F.ceil(pos), F.col(value)))
        frac = F.max(pos - F.floor(pos))
        aggs.append((lo + (hi - lo) * frac).alias(n))
    return ranked.groupBy(*keys).agg(*aggs)


def top_k(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group.

    Filtering directly on row_number lets Spark keep only ``k`` rows per group
    and task before the shuffle, so a hot group never meets in one task whole.
    """
    w = W.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_row(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per group, the first in ``order``; a combining aggregate, no sort."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*_cols(order))).alias("__r"))
    return picked.select(*[F.col(k) if k in keys else F.col(f"__r.{k}") for k in df.columns])
