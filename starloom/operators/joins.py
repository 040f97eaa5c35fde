"""Joins with the catalog conventions: suffixes, lookups, nearest in time, close pairs.

No side is broadcast by hint; Spark broadcasts a side whose measured size is
under its threshold and otherwise uses sort-merge joins, splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.match import rename_overlap


def join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, suffixes=("", "_right"), how: str = "inner") -> DataFrame:
    """Equi-join that renames shared column names by suffix."""
    lf, rf = rename_overlap(left, right, suffixes, "overlapping_columns")
    lk = lf.columns[left.columns.index(left_on)]
    rk = rf.columns[right.columns.index(right_on)]
    return lf.join(rf, lf[lk] == rf[rk], how)


def visit_time_lookup(df: DataFrame, visits: DataFrame, name: str = "midpointMjdTai") -> DataFrame:
    """Attach the mid-exposure time of each visit; unknown visits give null.

    Refuses tables that already have the column or lack ``visit``.
    """
    if name in df.columns:
        raise ValueError(f"column {name} exists already")
    if "visit" not in df.columns:
        raise ValueError("table has no visit column")
    v = visits.select(F.col("visitId").alias("visit"), F.col("expMidptMJD").alias(name))
    return df.join(v, "visit", "left")


def lookup_distinct(df: DataFrame, source: DataFrame, on: str, values: list[str]) -> DataFrame:
    """Attach values found as distinct (key, values) rows of another table."""
    return df.join(source.select(on, *values).dropDuplicates([on, *values]), on)


def association_join(left: DataFrame, association: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Reach the other table's rows through a stored (left id, right id) match table."""
    return left.join(association, left_id).join(right, right_id)


def close_in_time(df: DataFrame, keys: list[str], time: str, row_id: str, values: list[str], max_lag: float, min_lag: float = 0.0) -> DataFrame:
    """Pairs of rows of one group with min_lag < t2 - t1 <= max_lag.

    Time is cut into buckets of ``max_lag``; the second row is in the bucket of
    the first or the next one, so this is an equi-join on (group, bucket) and a
    long series is spread over its buckets.  Equal times make no pair.
    """
    b = F.floor(F.col(time) / F.lit(max_lag))
    cols = [time, row_id, *values]
    first = df.select(*keys, b.alias("__b"), *[F.col(c).alias(f"{c}1") for c in cols])
    second = df.select(*keys, F.explode(F.array(b, b - 1)).alias("__b"), *[F.col(c).alias(f"{c}2") for c in cols])
    dt = F.col(f"{time}2") - F.col(f"{time}1")
    pairs = first.join(second, [*keys, "__b"]).withColumn("dt", dt)
    return pairs.where((F.col("dt") > min_lag) & (F.col("dt") <= max_lag)).drop("__b")


def nearest_in_time(df: DataFrame, keys: list[str], time: str, value: str, start: float, stop: float, step: float, tie: str) -> DataFrame:
    """For each grid time the row of the group closest to it (earlier row on a tie).

    Grid times and rows are merged into one ordered stream per group; the last
    row before and the first row after each grid time come from running
    aggregates, so the cost is rows plus grid, not rows times grid.
    """
    n = int(round((stop - start) / step)) + 1
    obs = df.select(*keys, F.col(time).alias("__t"), F.struct(F.col(time).alias("t"), F.col(tie).alias("id"), F.col(value).alias("v")).alias("__o"), F.lit(None).cast("int").alias("__g"))
    grid = df.groupBy(*keys).agg(F.lit(1).alias("__one")).drop("__one").withColumn("__g", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    grid = grid.select(*keys, (F.lit(start) + F.col("__g") * F.lit(step)).alias("__t"), F.lit(None).cast(obs.schema["__o"].dataType).alias("__o"), "__g")
    both = obs.unionByName(grid)
    return _last_and_next(both, keys).where(F.col("__g").isNotNull()).select(
        *keys, F.col("__g").alias("grid"), F.col("__t").alias("grid_time"),
        F.when(F.col("__next.t").isNull() | (F.col("__t") - F.col("__last.t") <= F.col("__next.t") - F.col("__t")), F.col("__last")).otherwise(F.col("__next")).alias("__n"),
    ).select(*keys, "grid", "grid_time", F.col("__n.t").alias(time), F.col("__n.id").alias(tie), F.col("__n.v").alias(value))


def _last_and_next(both: DataFrame, keys: list[str]) -> DataFrame:
    from pyspark.sql import Window as W

    from starloom.operators.ordered import PIECE, cut_pieces, is_hot, same_keys

    # rows before grid points at equal times, so a row at the grid time is its own "last"
    order = ["__t", F.col("__g").isNotNull(), F.col("__o.id")]
    # the next row is the last one in reverse order: a running frame, where a frame
    # that reaches forward would be computed anew for every row
    back = [F.desc("__t"), F.col("__g").isNotNull().desc(), F.desc("__o.id")]
    if not is_hot(both, keys):
        w = W.partitionBy(*keys)
        return both.withColumns({
            "__last": F.last("__o", ignorenulls=True).over(w.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)),
            "__next": F.last("__o", ignorenulls=True).over(w.orderBy(*back).rowsBetween(W.unboundedPreceding, 0)),
        })
    cut = cut_pieces(both, keys, order)
    w = W.partitionBy(*keys, PIECE)
    local = cut.withColumns({
        "__l": F.last("__o", ignorenulls=True).over(w.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)),
        "__f": F.last("__o", ignorenulls=True).over(w.orderBy(*back).rowsBetween(W.unboundedPreceding, 0)),
    })
    ends = cut.groupBy(*keys, PIECE).agg(F.max("__o").alias("__hi"), F.min("__o").alias("__lo"))
    wp = W.partitionBy(*keys).orderBy(PIECE)
    ends = ends.withColumns({
        "__before": F.last("__hi", ignorenulls=True).over(wp.rowsBetween(W.unboundedPreceding, -1)),
        "__after": F.first("__lo", ignorenulls=True).over(wp.rowsBetween(1, W.unboundedFollowing)),
    }).drop("__hi", "__lo")
    out = same_keys(local, ends, [*keys, PIECE], "left")
    return out.withColumns({"__last": F.coalesce("__l", "__before"), "__next": F.coalesce("__f", "__after")})


