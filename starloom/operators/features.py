"""Light-curve features, one grouped aggregate each where possible.

Definitions follow Malanchev et al. 2021 (MNRAS 502, 5147) and the papers
named there; std is the sample standard deviation throughout.  Every function
gives one row per group of ``keys``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.photometry import weight, weighted_mean
from starloom.functions.special import normal_cdf
from starloom.operators.ordered import ordered, percentiles, same_keys, with_stats

KEYS = ["objectId", "band"]


def _div(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def basic(df: DataFrame, keys=KEYS, time="mjd") -> DataFrame:
    """Observation count and duration."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("observation_count"), (F.max(time) - F.min(time)).alias("duration"))


def value_range(df: DataFrame, keys=KEYS, value="psfFlux") -> DataFrame:
    """Amplitude, percent amplitude, magnitude percentage ratio (40-60 over 5-95), interpercentile ranges 0.05 and 0.2, median."""
    keys = list(keys)
    probs = {"q05": 0.05, "q20": 0.2, "q40": 0.4, "q50": 0.5, "q60": 0.6, "q80": 0.8, "q95": 0.95}
    ends = df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    j = same_keys(percentiles(df, keys, value, probs), ends, keys, "inner")
    return j.select(
        *keys,
        ((F.col("hi") - F.col("lo")) / 2).alias("amplitude"),
        F.greatest(F.col("hi") - F.col("q50"), F.col("q50") - F.col("lo")).alias("percent_amplitude"),
        _div(F.col("q60") - F.col("q40"), F.col("q95") - F.col("q05")).alias("magnitude_percentage_ratio"),
        (F.col("q95") - F.col("q05")).alias("inter_percentile_range_5"),
        (F.col("q80") - F.col("q20")).alias("inter_percentile_range_20"),
        F.col("q50").alias("median"),
    )


def beyond_n_std(df: DataFrame, n_std=(2.0, 3.0), keys=KEYS, value="psfFlux") -> DataFrame:
    """Share of points more than n std from the mean."""
    s = with_stats(df, list(keys), __m=F.avg(value), __s=F.stddev_samp(value))
    far = F.abs(F.col(value) - F.col("__m"))
    return s.groupBy(*keys).agg(*[F.avg(F.when(far > n * F.col("__s"), 1.0).otherwise(0.0)).alias(f"beyond_{int(n)}_std") for n in n_std])


def moments(df: DataFrame, keys=KEYS, value="psfFlux", err="psfFluxErr") -> DataFrame:
    """Mean variance (std / mean), excess variance, and unbiased skew and kurtosis."""
    n = F.count(F.lit(1)).cast("double")
    g = df.groupBy(*keys).agg(
        n.alias("n"), F.avg(value).alias("m"), F.stddev_samp(value).alias("s"), F.avg(F.col(err) * F.col(err)).alias("e2"),
        F.when(n > 2, F.skewness(value)).alias("g1"), F.when(n > 3, F.kurtosis(value)).alias("g2"),
    )
    c = F.col("n")
    return g.select(
        *keys,
        _div(F.col("s"), F.col("m")).alias("mean_variance"),
        _div(F.col("s") * F.col("s") - F.col("e2"), F.col("m") * F.col("m")).alias("excess_variance"),
        F.when(c > 2, F.col("g1") * F.sqrt(c * (c - 1)) / F.nullif(c - 2, F.lit(0.0))).alias("skew"),
        F.when(c > 3, ((c + 1) * F.col("g2") + 6) * (c - 1) / F.nullif((c - 2) * (c - 3), F.lit(0.0))).alias("kurtosis"),
    )


def chi2(df: DataFrame, keys=KEYS, value="psfFlux", err="psfFluxErr") -> DataFrame:
    """Weighted mean and reduced chi2 about it."""
    s = with_stats(df, list(keys), __wm=weighted_mean(value, err))
    d = (F.col(value) - F.col("__wm")) / F.col(err)
    return s.groupBy(*keys).agg(F.first("__wm").alias("weighted_mean"), _div(F.sum(d * d), F.count(F.lit(1)) - F.lit(1.0)).alias("reduced_chi2"))


def linear(df: DataFrame, keys=KEYS, time="mjd", value="psfFlux", err="psfFluxErr") -> DataFrame:
    """Straight line with weights (slope, its sigma, reduced chi2) and without (slope, its sigma, noise).

    Times and values are centred per group first.
    """
    keys = list(keys)
    s = with_stats(df, keys, __t=F.avg(time), __y=F.avg(value))
    t, y, w = F.col(time) - F.col("__t"), F.col(value) - F.col("__y"), weight(err)
    r = s.select(*keys, t.alias("t"), y.alias("y"), w.alias("w"))
    t, y, w = F.col("t"), F.col("y"), F.col("w")
    one = F.lit(1.0)
    aggs = {}
    for p, v in (("u", one), ("v", w)):
        aggs |= {f"{p}0": F.sum(v), f"{p}t": F.sum(v * t), f"{p}y": F.sum(v * y), f"{p}tt": F.sum(v * t * t), f"{p}ty": F.sum(v * t * y), f"{p}yy": F.sum(v * y * y)}
    g = r.groupBy(*keys).agg(F.count(one).cast("double").alias("n"), *[e.alias(c) for c, e in aggs.items()])
    for p in "uv":
        z = F.col(f"{p}0")
        g = g.withColumns({
            f"{p}x": F.col(f"{p}tt") - F.col(f"{p}t") * F.col(f"{p}t") / z, f"{p}c": F.col(f"{p}ty") - F.col(f"{p}t") * F.col(f"{p}y") / z, f"{p}d": F.col(f"{p}yy") - F.col(f"{p}y") * F.col(f"{p}y") / z,
        }).withColumns({f"{p}s": _div(F.col(f"{p}c"), F.col(f"{p}x"))}).withColumn(f"{p}r", F.greatest(F.lit(0.0), F.col(f"{p}d") - F.col(f"{p}s") * F.col(f"{p}c")))
    dof = F.nullif(F.col("n") - 2, F.lit(0.0))
    return g.select(
        *keys,
        F.col("vs").alias("linear_fit_slope"), F.sqrt(_div(F.lit(1.0), F.col("vx"))).alias("linear_fit_slope_sigma"), (F.col("vr") / dof).alias("linear_fit_reduced_chi2"),
        F.col("us").alias("linear_trend"), F.sqrt(_div(F.col("ur") / dof, F.col("ux"))).alias("linear_trend_sigma"), F.sqrt(F.col("ur") / dof).alias("linear_trend_noise"),
    )


def eta(df: DataFrame, keys=KEYS, time="mjd", value="psfFlux", tie="visit") -> DataFrame:
    """Von Neumann ratio: mean square successive difference over the variance."""
    keys = list(keys)
    o = ordered(df.select(*keys, time, value, tie), keys, [time, tie], lags={"__p": value})
    d = F.col(value) - F.col("__p")
    return o.groupBy(*keys).agg(_div(F.sum(d * d), (F.count(F.lit(1)) - 1) * F.var_samp(value)).alias("eta"))


def stetson_k(df: DataFrame, keys=KEYS, value="psfFlux", err="psfFluxErr") -> DataFrame:
    s = with_stats(df, list(keys), __wm=weighted_mean(value, err))
    d = (F.col(value) - F.col("__wm")) / F.col(err)
    return s.groupBy(*keys).agg(_div(F.sum(F.abs(d)), F.sqrt(F.count(F.lit(1)) * F.sum(d * d))).alias("stetson_k"))


def anderson_darling(df: DataFrame, keys=KEYS, value="psfFlux", tie="visit") -> DataFrame:
    """Normality statistic with unknown mean and variance, (1 + 4/n - 25/n^2) A^2."""
    keys = list(keys)
    s = with_stats(df.select(*keys, value, tie), keys, __m=F.avg(value), __s=F.stddev_samp(value), __n=F.count(F.lit(1)))
    o = ordered(s.where(F.col("__s") > 0), keys, [value, tie], rank="__i")
    z = (F.col(value) - F.col("__m")) / F.col("__s")
    o = o.withColumns({"__lo": F.log(normal_cdf(z)), "__hi": F.log(normal_cdf(-z))})
    n, i = F.col("__n").cast("double"), F.col("__i")
    g = o.groupBy(*keys).agg(F.first(n).alias("n"), F.sum((2 * i - 1) * F.col("__lo") + (2 * (n - i) + 1) * F.col("__hi")).alias("a"))
    n = F.col("n")
    return g.select(*keys, ((1 + 4 / n - 25 / (n * n)) * (-n - F.col("a") / n)).alias("anderson_darling_normal"))


def otsu(df: DataFrame, keys=KEYS, value="psfFlux", tie="visit") -> DataFrame:
    """Split of the sorted values with the largest between-class variance.

    Difference of class means, class stds, share of the lower class.
    """
    keys = list(keys)
    s = with_stats(df.select(*keys, F.col(value).cast("double").alias("x"), tie), keys, __m=F.avg("x"))
    s = s.withColumn("x", F.col("x") - F.col("__m"))
    s = with_stats(s, keys, N=F.count(F.lit(1)).cast("double"), SX=F.sum("x"), SXX=F.sum(F.col("x") * F.col("x")))
    o = ordered(s, keys, ["x", tie], rank="i", sums={"c1": F.col("x"), "c2": F.col("x") * F.col("x")}).where(F.col("i") < F.col("N"))
    i, N = F.col("i").cast("double"), F.col("N")
    lo, hi = F.col("c1") / i, (F.col("SX") - F.col("c1")) / (N - i)
    between = i / N * (1 - i / N) * (hi - lo) * (hi - lo)
    row = F.struct(i.alias("i"), lo.alias("lo"), hi.alias("hi"), F.col("c2").alias("c2"), (F.col("SXX") - F.col("c2")).alias("d2"), N.alias("N"))
    b = o.groupBy(*keys).agg(F.max_by(row, F.struct(F.round(between, 6), -i)).alias("b"))
    i, N, lo, hi = F.col("b.i"), F.col("b.N"), F.col("b.lo"), F.col("b.hi")
    std = lambda ss, n, m: F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (ss - n * m * m) / F.nullif(n - 1, F.lit(0.0))))).otherwise(0.0)
    return b.select(
        *keys, (hi - lo).alias("otsu_mean_diff"), std(F.col("b.c2"), i, lo).alias("otsu_std_lower"), std(F.col("b.d2"), N - i, hi).alias("otsu_std_upper"), (i / N).alias("otsu_lower_to_all_ratio")
    )


def combine(parts: list[DataFrame], keys=KEYS) -> DataFrame:
    """Join feature tables of the same groups."""
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), parts)


def feature_table(df: DataFrame, bands: list[str], fluxes: dict[str, tuple[str, str]], key="objectId", time="mjd", tie="visit", n_sigma: float = 5.0, fill: float = -1.0, both_signs: tuple[str, ...] = ("dia",)) -> DataFrame:
    """Wide table: features of each band and flux kind on detections above ``n_sigma``; missing ones get ``fill``.

    Kinds in ``both_signs`` count by size whatever their sign.

    ``fluxes`` maps a kind to (flux, error) columns.  The kinds are stacked, so
    all features of all kinds and bands come from one set of aggregates.
    """
    from starloom.operators.series import cusum

    long = None
    for kind, (f, e) in fluxes.items():
        s = df.where(F.col("band").isin(bands)).select(key, "band", F.lit(kind).alias("kind"), F.col(time).alias("mjd"), F.col(f).alias("psfFlux"), F.col(e).alias("psfFluxErr"), F.col(tie).alias("visit"))
        # a difference flux may be negative, a direct one is a detection only above zero
        size = F.abs(F.col("psfFlux")) if kind in both_signs else F.col("psfFlux")
        s = s.where(size > n_sigma * F.col("psfFluxErr"))
        long = s if long is None else long.unionByName(s)
    keys = [key, "band", "kind"]
    parts = [
        basic(long, keys), value_range(long, keys), beyond_n_std(long, (2.0, 3.0), keys), moments(long, keys), chi2(long, keys), linear(long, keys),
        eta(long, keys), stetson_k(long, keys), anderson_darling(long, keys), otsu(long, keys), cusum(long, keys=keys),
    ]
    table = combine(parts, keys)
    names = [c for c in table.columns if c not in keys]
    slots = [f"{b}_{k}" for k in fluxes for b in bands]
    wide = table.withColumn("slot", F.concat_ws("_", "band", "kind")).groupBy(key).pivot("slot", slots).agg(*[F.first(n).cast("double").alias(n) for n in names])
    # objects with no detection at all also get a row of fill values
    ids = df.select(key).distinct()
    out = ids.join(wide, key, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(fill)) for c in out.columns if c != key})
