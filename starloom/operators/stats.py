"""Grouped statistics, profiles and audits.

All are plain aggregates with map-side combination; results per group are small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.ordered import is_hot, percentiles, same_keys

# Rows whose groups a task clips at a time; a larger group is held alone.
CLIP_ROWS = 200_000


def _missing(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    return F.col(c).isNull() | F.isnan(c) if t in ("float", "double") else F.col(c).isNull()


def column_statistics(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """Min, max, null count and row count per column, in one pass, one row per column (and key)."""
    keys = list(keys)
    aggs = []
    for c in columns:
        v = F.when(~_missing(df, c), F.col(c).cast("double"))
        aggs.append(F.struct(F.lit(c).alias("name"), F.min(v).alias("min_value"), F.max(v).alias("max_value"),
                             F.count_if(_missing(df, c)).alias("null_count"), F.count(F.lit(1)).alias("row_count")).alias(f"__{c}"))
    one = df.groupBy(*keys).agg(*aggs)
    return one.select(*keys, F.explode(F.array(*[f"__{c}" for c in columns])).alias("s")).select(*keys, "s.*")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with nulls or NaNs: count and percent, largest first."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(_missing(df, c)).alias(c) for c in cols])
    long = one.select("__n", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("null_count")) for c in cols])).alias("s"))
    out = long.select("s.name", "s.null_count", (F.col("s.null_count") * 100.0 / F.col("__n")).alias("percent"))
    return out.where(F.col("null_count") > 0).orderBy(F.desc("percent"), "name")


def range_check(df: DataFrame, rules: dict[str, tuple[str, float, float]]) -> DataFrame:
    """Pass or fail per column against (kind, low, high)."""
    s = column_statistics(df, list(rules))
    kind = lo = hi = None
    for c, (k, a, b) in rules.items():
        m = F.col("name") == c
        kind = F.when(m, F.lit(k)) if kind is None else kind.when(m, F.lit(k))
        lo = F.when(m, F.lit(float(a))) if lo is None else lo.when(m, F.lit(float(a)))
        hi = F.when(m, F.lit(float(b))) if hi is None else hi.when(m, F.lit(float(b)))
    return s.select("name", kind.alias("kind"), "min_value", "max_value", ((F.col("min_value") >= lo) & (F.col("max_value") <= hi)).alias("ok"))


def band_stats(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Mean, min, max of columns and row count per key."""
    aggs = [F.count(columns[0]).alias("len")]
    for c in columns:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(*keys).agg(*aggs)


def weighted_combine(parts: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Combine partial band statistics: weighted mean of means, min of mins, max of maxes."""
    n = F.nullif(F.sum("len"), F.lit(0))
    aggs = [F.sum("len").alias("len")]
    for c in columns:
        aggs += [(F.sum(F.col(f"mean_{c}") * F.col("len")) / n).alias(f"mean_{c}"), F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}")]
    return parts.groupBy(*keys).agg(*aggs)


def tag_regions(df: DataFrame, regions: dict[str, object], ra: str, dec: str, name: str = "field") -> DataFrame:
    """One row per (row, region it lies in); a fixed short list of regions, so no join."""
    tags = F.array_compact(F.array(*[F.when(r.predicate(ra, dec), F.lit(k)) for k, r in regions.items()]))
    return df.withColumn(name, F.explode(tags))


def histogram(df: DataFrame, value: str, lo: float, width: float, bins: int, keys: list[str] = ()) -> DataFrame:
    """Counts per equal-width bin, [lo + i w, lo + (i+1) w), empty bins included for each present key."""
    keys = list(keys)
    b = F.floor((F.col(value) - F.lit(lo)) / F.lit(width)).cast("int")
    counts = df.withColumn("bin", b).where(F.col("bin").between(0, bins - 1)).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    if keys:
        # the keys present, each with a fixed number of bins
        dense = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    else:
        dense = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = same_keys(dense, counts, [*keys, "bin"], "left")
    return out.withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def moments(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Count, sum, sum of squares per key, with population mean and variance.

    The three sums are mergeable: add them over tables or days and derive again.
    """
    s = df.groupBy(*keys).agg(F.count(value).alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("ss"))
    mean = F.col("s") / F.nullif(F.col("n"), F.lit(0))
    var = F.col("ss") / F.nullif(F.col("n"), F.lit(0)) - mean * mean
    s = s.withColumns({"mean": mean, "variance": var})
    # error of the standard deviation: sqrt(2 v^2 / (n - 1) / v) / 2
    err = F.sqrt(2 * F.col("variance") / F.nullif(F.col("n") - 1, F.lit(0))) / 2
    return s.withColumns({"std": F.sqrt(F.greatest(F.lit(0.0), "variance")), "std_err": err})


def percentiles_by_bin(df: DataFrame, value: str, bin_col: str, probs: dict[str, float], min_rows: int) -> DataFrame:
    """Percentiles of the bins with at least ``min_rows`` rows."""
    n = df.where(F.col(value).isNotNull()).groupBy(bin_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows)
    return same_keys(percentiles(df, [bin_col], value, probs), n, [bin_col], "inner")


def median_clip(df: DataFrame, value: str, err: str, keys: list[str], n_err: float = 5.0) -> DataFrame:
    """Keep rows within ``n_err`` median errors of the median."""
    m = percentiles(df, keys, value, {"__med": 0.5})
    e = percentiles(df, keys, err, {"__mederr": 0.5})
    out = same_keys(same_keys(df, m, keys, "inner"), e, keys, "inner")
    return out.where(F.abs(F.col(value) - F.col("__med")) <= n_err * F.col("__mederr")).drop("__med", "__mederr")


def duplicate_groups(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Rows whose key values occur under more than one ``member``."""
    dup = df.groupBy(*keys).agg(F.min(member).alias("__a"), F.max(member).alias("__b")).where(F.col("__a") != F.col("__b")).select(*keys)
    return same_keys(df, dup, keys, "left_semi")


def count_mismatch(a: DataFrame, b: DataFrame, keys: list[str], name_a: str = "n_a", name_b: str = "n_b") -> DataFrame:
    """Keys whose counts differ or which one side lacks."""
    both = a.join(b, keys, "full_outer")
    return both.where(~F.col(name_a).eqNullSafe(F.col(name_b)))


def sigma_clip(df: DataFrame, keys: list[str], value: str, n_sigma: float = 5.0, hot_rows: int | None = None) -> DataFrame:
    """Drop rows at ``n_sigma`` sample deviations or more from the group mean until nothing changes.

    Only the limits of each group change between passes, and they only narrow.
    Keys and values are shuffled once; a task runs all passes over its groups in
    memory and returns two limits per group, which then filter the rows.  Groups
    beyond ``hot_rows`` rows are never gathered: there each pass is a combining
    aggregate.  Null values go, unless the group has no limits (fewer than two values).
    """
    narrow = _clip_in_tasks if not is_hot(df, keys, hot_rows) else _clip_by_aggregates
    inside = F.col("__lo").isNull() | ((F.col(value) > F.col("__lo")) & (F.col(value) < F.col("__hi")))
    return same_keys(df, narrow(df, keys, value, n_sigma), keys, "inner").where(inside).drop("__lo", "__hi")


def clip_limits(group: np.ndarray, x: np.ndarray, n_groups: int, n_sigma: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Final limits of each group, and which groups have none: those of fewer than two values.  ``group`` numbers the values' groups."""
    lo, hi = np.full(n_groups, -np.inf), np.full(n_groups, np.inf)
    before = np.bincount(group, minlength=n_groups)
    few = before < 2
    while len(x):
        n = np.bincount(group, minlength=n_groups)
        mean = np.bincount(group, x, n_groups) / np.maximum(n, 1)
        spread = np.sqrt(np.bincount(group, (x - mean[group]) ** 2, n_groups) / np.maximum(n - 1, 1))
        # one value left narrows nothing
        known = n > 1
        lo, hi = np.where(known, np.maximum(lo, mean - n_sigma * spread), lo), np.where(known, np.minimum(hi, mean + n_sigma * spread), hi)
        keep = (x > lo[group]) & (x < hi[group])
        after = np.bincount(group[keep], minlength=n_groups)
        live = keep & (after != n)[group]
        group, x = group[live], x[live]
    return lo, hi, few


def _clip_in_tasks(df: DataFrame, keys: list[str], value: str, n_sigma: float) -> DataFrame:
    """Limits (keys, __lo, __hi); rows are dealt and sorted by key, so a task sees each group as one run."""
    rows = df.select(*keys, F.col(value).cast("double").alias("__x"))
    schema = rows.drop("__x").schema.add("__lo", "double").add("__hi", "double")

    def first_rows(t: pa.Table) -> np.ndarray:
        change = np.zeros(t.num_rows, bool)
        change[0] = True
        for k in keys:
            change[1:] |= np.diff(t[k].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()) != 0
        return np.flatnonzero(change)

    def settle(t: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, t.num_rows)))
        known = t["__x"].is_valid().to_numpy()
        lo, hi, none = clip_limits(group[known], t["__x"].drop_null().to_numpy(), len(first), n_sigma)
        heads = t.select(keys).take(pa.array(first))
        limits = [pa.array(v, pa.float64(), mask=none) for v in (lo, hi)]
        return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in heads.columns), *limits], schema.names)

    def task(batches):
        held, size, enough = [], 0, CLIP_ROWS
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size < enough:
                continue
            # the last group may go on in the next batch
            t = pa.Table.from_batches(held)
            first = first_rows(t)
            if len(first) > 1:
                yield settle(t.slice(0, first[-1]), first[:-1])
            held = t.slice(first[-1]).to_batches()
            size = t.num_rows - int(first[-1])
            enough = CLIP_ROWS + size
        if held:
            t = pa.Table.from_batches(held)
            yield settle(t, first_rows(t))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(task, schema)


def _clip_by_aggregates(df: DataFrame, keys: list[str], value: str, n_sigma: float) -> DataFrame:
    """Limits (keys, __lo, __hi) by one combining aggregate per pass over the groups that still lose rows.

    The limits are written per pass, which keeps plans short and lets a pass be
    repeated when executors are lost.  Each pass removes a row at least, so the
    loop ends by itself.
    """
    from starloom.session import materialize

    inside = F.col("__lo").isNull() | ((F.col(value) > F.col("__lo")) & (F.col(value) < F.col("__hi")))

    def limits(rows: DataFrame) -> DataFrame:
        s = rows.groupBy(*keys).agg(F.count(value).alias("__n"), F.avg(value).alias("__m"), F.stddev_samp(value).alias("__s"))
        return s.select(*keys, "__n", (F.col("__m") - n_sigma * F.col("__s")).alias("__lo"), (F.col("__m") + n_sigma * F.col("__s")).alias("__hi"))

    open_ = materialize(limits(df))
    settled = None
    while True:
        kept = same_keys(df, open_, keys, "inner").where(inside)
        # a row dropped once stays dropped: limits only ever narrow
        now = limits(kept).withColumnsRenamed({"__n": "__n2", "__lo": "__lo2", "__hi": "__hi2"})
        both = same_keys(open_, now, keys, "left").withColumn("__n2", F.coalesce("__n2", F.lit(0)))
        both = materialize(both.withColumns({"__lo2": F.greatest("__lo", "__lo2"), "__hi2": F.least("__hi", "__hi2"), "__done": F.col("__n2") == F.col("__n")}))
        done = both.where("__done").select(*keys, "__lo", "__hi")
        settled = done if settled is None else settled.unionByName(done)
        open_ = both.where("not __done").select(*keys, F.col("__n2").alias("__n"), F.col("__lo2").alias("__lo"), F.col("__hi2").alias("__hi"))
        if not open_.limit(1).count():
            return settled
