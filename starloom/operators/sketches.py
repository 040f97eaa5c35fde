"""Stored sketches of groups that merge later: distinct counts and quantiles.

A table of sketches holds one row per group (a tile and a day, say) of bounded size,
whatever the rows of the group.  Later questions merge stored rows and never
read the data again.  Distinct counts use HyperLogLog (relative standard error about
1.04 / sqrt(2 ** lg)), quantiles use KLL (rank error about 2.3 / k ** 0.9).
Nulls do not count; a group without a value has an estimate of 0 and null quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sketch(df: DataFrame, keys: list[str], distinct: list[str] = (), quantiles: list[str] = (), lg: int = 12, k: int = 400) -> DataFrame:
    """Rows (keys, n, hll_<column>..., kll_<column>...); partial sketches are built before the shuffle."""
    aggs = [F.count(F.lit(1)).alias("n")]
    # the built-in takes whole numbers, strings and bytes; as text every type works
    aggs += [F.hll_sketch_agg(F.col(c).cast("string"), lg).alias(f"hll_{c}") for c in distinct]
    aggs += [F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"kll_{c}") for c in quantiles]
    return df.groupBy(*keys).agg(*aggs)


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One row per ``keys`` from the rows of finer groups; merging in any order and grouping tells the same distinct counts."""
    aggs = [F.sum("n").alias("n")]
    aggs += [F.hll_union_agg(c).alias(c) for c in sketches.columns if c.startswith("hll_")]
    aggs += [F.kll_merge_agg_double(c).alias(c) for c in sketches.columns if c.startswith("kll_")]
    return sketches.groupBy(*keys).agg(*aggs)


def estimates(sketches: DataFrame, probs: list[float] = (0.5,)) -> DataFrame:
    """Sketch columns replaced by distinct_<column> (long) and quantiles_<column> (one value per probability, null if there is none)."""
    out = sketches
    for c in sketches.columns:
        if c.startswith("hll_"):
            out = out.withColumn(f"distinct_{c[4:]}", F.hll_sketch_estimate(c)).drop(c)
        elif c.startswith("kll_"):
            some = F.kll_sketch_get_n_double(c) > 0
            each = F.array(*[F.kll_sketch_get_quantile_double(F.when(some, F.col(c)), F.lit(float(p))) for p in probs])
            out = out.withColumn(f"quantiles_{c[4:]}", F.when(some, each)).drop(c)
    return out
