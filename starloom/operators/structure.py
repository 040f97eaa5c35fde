"""Structure functions of many light curves without listing pairs.

For a lag bin [a, b) the sums over pairs i < j are

    sum over i of  S(t_i + b) - S(t_i + a)

where S(x) is a running total over the observations before x.  With running
totals of 1, t, f, f^2 and e^2 this gives the pair count, the summed lag, the
summed squared difference and the summed squared errors.  Each observation
asks for the totals at its own shifted edges, so the work is rows * edges * log,
not rows^2.  Light curves of bounded length are packed and done by numpy in
their task.  If any is longer, questions and observations are put in one
time-ordered stream, which ``ordered`` cuts into pieces.

Medians over pairs cannot be had from running totals; see ``pairs``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from starloom.operators import pairs
from starloom.operators.joins import close_in_time
from starloom.operators.nested import MAX_LIST
from starloom.operators.ordered import costly_tasks, largest_group, ordered, percentiles, same_keys, with_stats
from starloom.session import hot_rows

KEYS = ["objectId", "band"]


def lag_sums(
    df: DataFrame, keys: list[str], edges: Column, time: str = "mjd", value: str = "psfFlux", err: str | None = None, tie: str = "visit"
) -> DataFrame:
    """Per (keys, bin): n, s_dt, s_df2, s_err2 over pairs with edge[bin] <= dt < edge[bin + 1].

    ``edges`` is an array column of ascending lags >= 0, the same for all rows of
    a group.  ``tie`` orders rows of equal time, so that such a pair counts once
    in a bin that starts at 0.  Values are centred per group first to keep digits.
    """
    e2 = F.col(err) * F.col(err) if err else F.lit(0.0)
    base = df.select(*keys, F.col(time).cast("double").alias("t"), F.col(value).cast("double").alias("f"), e2.alias("e2"), F.col(tie).alias("__tie"), edges.alias("__edges"))
    base = base.where(F.col("t").isNotNull() & F.col("f").isNotNull())
    if largest_group(df, keys) <= min(MAX_LIST, hot_rows(df.sparkSession)):
        return _lag_sums_packed(base, keys, costly_tasks(df, keys)).drop("lo", "hi")
    return _lag_sums_stream(base, keys)


def _lag_sums_packed(base: DataFrame, keys: list[str], tasks: int, log_bins: int | None = None) -> DataFrame:
    """Light curves of bounded length: running totals and edge positions by numpy in the task that holds the list.

    With ``log_bins`` the edges come from each light curve itself, from twice
    its smallest gap to half its span; columns lo and hi tell them.
    """
    base = base.repartition(tasks, *keys)
    lists = base.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("t", "__tie", "f", "e2"))).alias("lc"), F.first("__edges").alias("edges"))
    lists = lists.select(*keys, "edges", *[F.transform("lc", _field(c)).alias(c) for c in ("t", "f", "e2")])
    types = [f for f in lists.schema.fields if f.name in keys]
    out = [("bin", T.IntegerType()), ("n", T.LongType()), ("s_dt", T.DoubleType()), ("s_df2", T.DoubleType()), ("s_err2", T.DoubleType()), ("lo", T.DoubleType()), ("hi", T.DoubleType())]
    schema = T.StructType(types + [T.StructField(c, ty) for c, ty in out])

    def run(frames):
        for pdf in frames:
            parts = []
            for row in pdf.itertuples(index=False):
                t, f, e2 = (np.asarray(x, dtype=float) for x in (row.t, row.f, row.e2))
                if log_bins:
                    gaps = np.diff(t)
                    gaps = gaps[gaps > 0]
                    lo, hi = (2 * gaps.min(), 0.5 * (t[-1] - t[0])) if len(gaps) else (0.0, 0.0)
                    if not lo < hi:
                        continue
                    edges = 10 ** (np.log10(lo) + np.arange(log_bins + 1) * ((np.log10(hi) - np.log10(lo)) / log_bins))
                else:
                    edges = np.asarray(row.edges, dtype=float)
                    lo, hi = edges[0], edges[-1]
                q = _totals_at(t, f - f.mean(), e2, edges)
                d = np.diff(q, axis=1)
                one = {k: [getattr(row, k)] * d.shape[1] for k in keys}
                one |= {"bin": np.arange(d.shape[1]), "n": d[0].round().astype(np.int64), "s_dt": d[1], "s_df2": d[2], "s_err2": d[3], "lo": lo, "hi": hi}
                parts.append(pd.DataFrame(one))
            if parts:
                yield pd.concat(parts)[[f.name for f in schema.fields]]

    return lists.mapInPandas(run, schema)


def _field(name: str):
    return lambda x: x[name]


def _totals_at(t, f, e2, edges):
    """Sums over pairs of lag below each edge (plus a constant per edge): n, lag, squared difference, squared errors."""
    pre = [np.concatenate([[0.0], np.cumsum(x)]) for x in (np.ones(len(t)), t - t[0], f, f * f, e2)]
    tc = t - t[0]
    q = np.empty((4, len(edges)))
    for i, edge in enumerate(edges):
        pos = np.arange(1, len(t) + 1) if edge <= 0 else np.searchsorted(t, t + edge, side="left")
        n, st, sf, sff, se = (p[pos] for p in pre)
        q[:, i] = n.sum(), (st - n * tc).sum(), (sff - 2 * f * sf + f * f * n).sum(), (se + n * e2).sum()
    return q


def _kth_lag(t, rank, below, lo, hi):
    """The lag of 0-based ``rank`` among all pairs, known to lie in [lo, hi); ``below`` pairs are closer than lo.

    Halves the interval by counting pairs below a lag until about as many pairs
    as points are left in it, and picks among those.
    """
    i = np.arange(len(t))

    def first_at(x):
        return np.searchsorted(t, t + x, side="left") if x > 0 else i + 1

    a, b = first_at(lo), first_at(hi)
    while True:
        mid = 0.5 * (lo + hi)
        if (b - a).sum() <= 4 * len(t) + 64 or not lo < mid < hi:
            break
        m = first_at(mid)
        n = int((m - i - 1).sum())
        if n <= rank:
            lo, a, below = mid, m, n
        else:
            hi, b = mid, m
    count = b - a
    if count.sum() > 4 * len(t) + 64 and not lo < 0.5 * (lo + hi) < hi:
        # the interval holds no other number: all lags left in it are one
        k = int(np.flatnonzero(count > 0)[0])
        return t[a[k]] - t[k]
    left = np.repeat(i, count)
    right = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a, count)
    lags = t[right] - t[left]
    return np.partition(lags, rank - below)[rank - below]


def median_lags(df: DataFrame, keys: list[str], edges: list[float], time: str = "mjd", tie: str = "visit") -> DataFrame:
    """Median pair lag per (keys, bin) for light curves of bounded length, by counting."""
    lists = df.where(F.col(time).isNotNull()).select(*keys, time).repartition(costly_tasks(df, keys), *keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.col(time).cast("double"))).alias("t"))
    types = [f for f in lists.schema.fields if f.name in keys]
    schema = T.StructType(types + [T.StructField("bin", T.IntegerType()), T.StructField("tau_median", T.DoubleType())])

    def run(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                t = np.asarray(row.t, dtype=float)
                i = np.arange(len(t))
                below = [0 if e <= 0 else int((np.searchsorted(t, t + e, side="left") - i - 1).sum()) for e in edges]
                for b in range(len(edges) - 1):
                    n = below[b + 1] - below[b]
                    if n > 0:
                        ranks = {below[b] + (n - 1) // 2, below[b] + n // 2}
                        out.append((*[getattr(row, k) for k in keys], b, float(np.mean([_kth_lag(t, r, below[b], edges[b], edges[b + 1]) for r in ranks]))))
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return lists.mapInPandas(run, schema)


def _lag_sums_stream(base: DataFrame, keys: list[str]) -> DataFrame:
    """Light curves of any length: questions and observations as one ordered stream."""
    base = with_stats(base, keys, __tm=F.avg("t"), __fm=F.avg("f"))
    base = base.select(*keys, "t", (F.col("t") - F.col("__tm")).alias("tc"), (F.col("f") - F.col("__fm")).alias("f"), "e2", "__tie", "__edges")
    zero = F.lit(0.0)
    obs = base.select(
        *keys, F.col("t").alias("x"), F.lit(1).alias("kind"), "__tie", F.lit(0).alias("sub"), F.lit(None).cast("int").alias("edge"), F.lit(None).cast("double").alias("qt"), F.lit(None).cast("double").alias("qf"),
        F.lit(None).cast("double").alias("qe"), F.lit(1.0).alias("c"), F.col("tc").alias("ct"), F.col("f").alias("cf"), "e2",
    )
    at_zero = F.col("lag") <= 0
    ask = base.select(*keys, "t", "tc", "f", "e2", "__tie", F.posexplode("__edges").alias("edge", "lag")).select(
        *keys, (F.col("t") + F.greatest(F.lit(0.0), "lag")).alias("x"), F.when(at_zero, 1).otherwise(0).alias("kind"), F.when(at_zero, F.col("__tie")).alias("__tie"), F.lit(1).alias("sub"), "edge", F.col("tc").alias("qt"), F.col("f").alias("qf"), F.col("e2").alias("qe"),
        zero.alias("c"), zero.alias("ct"), zero.alias("cf"), zero.alias("e2"),
    )
    # a question comes before the observations at its time (strictly earlier rows count);
    # a question at lag 0 comes right after its own row
    run = ordered(
        obs.unionByName(ask), keys, ["x", "kind", "__tie", "sub"],
        sums={"S": F.col("c"), "St": F.col("ct"), "Sf": F.col("cf"), "Sff": F.col("cf") * F.col("cf"), "Se": F.col("e2")},
    ).where(F.col("edge").isNotNull())
    n, f, t = F.col("S"), F.col("qf"), F.col("qt")
    q = run.groupBy(*keys, "edge").agg(
        F.sum(n).alias("n"), F.sum(F.col("St") - n * t).alias("s_dt"), F.sum(F.col("Sff") - 2 * f * F.col("Sf") + f * f * n).alias("s_df2"), F.sum(F.col("Se") + n * F.col("qe")).alias("s_err2")
    )
    # at most one row per edge and group
    w = W.partitionBy(*keys).orderBy("edge")
    nxt = {c: F.lead(c).over(w) - F.col(c) for c in ("n", "s_dt", "s_df2", "s_err2")}
    out = q.select(*keys, F.col("edge").alias("bin"), *[e.alias(c) for c, e in nxt.items()])
    return out.where(F.col("n").isNotNull()).withColumn("n", F.round("n").cast("long"))


def log_edges(lo: Column, hi: Column, n: int) -> Column:
    """n + 1 edges, even in log10, from lo to hi."""
    step = (F.log10(hi) - F.log10(lo)) / n
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.pow(F.lit(10.0), F.log10(lo) + i * step))


def fixed_edges(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def sf_log_bins(df: DataFrame, nstep: int = 50, keys=KEYS, time: str = "mjd", value: str = "psfFlux", tie: str = "visit") -> DataFrame:
    """sqrt(mean squared difference) in log bins from twice the smallest gap above 0 to half the span."""
    keys = list(keys)
    if largest_group(df, keys) <= min(MAX_LIST, hot_rows(df.sparkSession)):
        base = df.select(
            *keys, F.col(time).cast("double").alias("t"), F.col(value).cast("double").alias("f"), F.lit(0.0).alias("e2"), F.col(tie).alias("__tie"), F.array().cast("array<double>").alias("__edges")
        ).where(F.col("t").isNotNull() & F.col("f").isNotNull())
        s = _lag_sums_packed(base, keys, costly_tasks(df, keys), nstep)
    else:
        gaps = ordered(df.select(*keys, time, value, tie), keys, [time, tie], lags={"__p": time})
        lim = gaps.groupBy(*keys).agg((2 * F.min(F.when(F.col(time) > F.col("__p"), F.col(time) - F.col("__p")))).alias("lo"), (0.5 * (F.max(time) - F.min(time))).alias("hi"))
        lim = lim.where((F.col("lo") > 0) & (F.col("hi") > F.col("lo")))
        edged = same_keys(df, lim, keys, "inner")
        s = lag_sums(edged, keys, log_edges(F.col("lo"), F.col("hi"), nstep), time, value, tie=tie)
        s = same_keys(s, lim, keys, "inner")
    step = (F.log10("hi") - F.log10("lo")) / nstep
    return s.select(
        *keys, "bin", F.pow(F.lit(10.0), F.log10("lo") + F.col("bin") * step).alias("tau"), F.when(F.col("n") > 0, F.sqrt(F.greatest(F.lit(0.0), "s_df2") / F.col("n"))).alias("SF"), F.col("n").alias("N")
    )


def sf_fixed_bins(df: DataFrame, edges: list[float], keys=KEYS, time: str = "mjd", value: str = "psfFlux", tie: str = "visit", medians: bool = True) -> DataFrame:
    """Given edges: median lag, sqrt(mean) / sqrt(2), pair count.

    Lags below zero do not occur, so a first edge below zero acts as zero.
    """
    keys = list(keys)
    pos = [max(0.0, float(e)) for e in edges]
    s = lag_sums(df, keys, fixed_edges(pos), time, value, tie=tie)
    s = s.select(*keys, "bin", F.when(F.col("n") > 0, F.sqrt(F.greatest(F.lit(0.0), "s_df2") / F.col("n")) / F.sqrt(F.lit(2.0))).alias("SF"), F.col("n").alias("N"))
    if not medians:
        return s
    if largest_group(df, keys) <= min(MAX_LIST, hot_rows(df.sparkSession)):
        return same_keys(s, median_lags(df, keys, pos, time, tie), [*keys, "bin"], "left")
    p = close_in_time(df, keys, time, tie, [], pos[-1]).where(F.col("dt") < pos[-1])
    p = p.withColumn("bin", bin_of(F.col("dt"), pos)).where(F.col("bin").isNotNull())
    return same_keys(s, percentiles(p, [*keys, "bin"], "dt", {"tau_median": 0.5}), [*keys, "bin"], "left")


def bin_of(x: Column, edges: list[float]) -> Column:
    """Index of the half-open bin holding x; null outside."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        out = F.when((x >= edges[i]) & (x < edges[i + 1]), F.lit(i)).otherwise(out)
    return out


def sf_equal_count(df: DataFrame, nbins: int, keys=KEYS, time: str = "mjd", value: str = "psfFlux", tie: str = "visit") -> DataFrame:
    """All pairs sorted by lag (then by ``tie``, a whole number) and cut into ``nbins`` bins of equal count, the last takes the rest.

    Median lag, sqrt(mean squared difference), count.  Pairs of equal times do not count.
    """
    fields = [("bin", T.IntegerType()), ("SF", T.DoubleType()), ("N", T.LongType()), ("tau_median", T.DoubleType())]
    return pairs.per_light_curve(df, list(keys), lambda t, v, f, e2: pairs.equal_count(t, v, f, nbins), lambda c: c.equal_count(nbins), fields, time, value, tie)


def sf_median(df: DataFrame, nbins: int, keys=KEYS, time: str = "mjd", value: str = "psfFlux", tie: str = "visit") -> DataFrame:
    """sqrt(median squared difference) of all pairs in log bins from the smallest lag above 0 to the largest.

    Bin centres are geometric means of the edges; the last edge is exclusive.
    """
    fields = [("bin", T.IntegerType()), ("tau", T.DoubleType()), ("SF", T.DoubleType())]
    return pairs.per_light_curve(df, list(keys), lambda t, v, f, e2: pairs.log_median(t, v, f, nbins), lambda c: c.log_median(nbins), fields, time, value, tie)


def sf_ensemble(df: DataFrame, edges: list[float], mag: str, keys=KEYS, min_pairs: int = 10, **kw) -> DataFrame:
    """Median, 16 and 84 percentiles of the objects' structure functions by magnitude and lag bin.

    An object's bin counts if it has more than ``min_pairs`` pairs.  The
    magnitude bin is the floor of the object's median magnitude.
    """
    keys = list(keys)
    sf = sf_fixed_bins(df, edges, keys, medians=False, **kw).where(F.col("N") > min_pairs)
    m = percentiles(df, keys, mag, {"__m": 0.5}).select(*keys, F.floor("__m").alias("mag_bin"))
    j = same_keys(sf, m, keys, "inner")
    return percentiles(j, ["mag_bin", "bin"], "SF", {"SF_median": 0.5, "SF_16": 0.16, "SF_84": 0.84})


def sf2_basic(df: DataFrame, edges: list[float], keys=KEYS, combine: list[str] | None = None, time="mjd", value="psfFlux", err="psfFluxErr", tie="visit") -> DataFrame:
    """Squared structure function: mean squared difference less the mean summed squared errors.

    ``combine`` gives the keys left after pooling the pairs of several light curves.
    """
    s = lag_sums(df, list(keys), fixed_edges(edges), time, value, err, tie).where(F.col("n") > 0)
    if combine is not None:
        s = s.groupBy(*combine, "bin").agg(*[F.sum(c).alias(c) for c in ("n", "s_dt", "s_df2", "s_err2")])
    left = combine if combine is not None else list(keys)
    n = F.col("n")
    return s.select(*left, "bin", n.alias("n"), (F.col("s_dt") / n).alias("dt"), ((F.col("s_df2") - F.col("s_err2")) / n).alias("sf2"))


def sf2_bootstrap(df: DataFrame, edges: list[float], keys=KEYS, replicates: int = 20, seed: int = 0, time="mjd", value="psfFlux", err="psfFluxErr", tie="visit") -> DataFrame:
    """Squared structure function with the spread over resampled pairs.

    Each replicate weighs a pair by a Poisson(1) count drawn from a hash of the
    pair, replicate and seed, the usual large-sample form of drawing with
    replacement.  ``tie`` is a whole number that tells rows apart.
    """
    fields = [("bin", T.IntegerType()), ("n", T.LongType()), ("sf2", T.DoubleType()), ("lower", T.DoubleType()), ("upper", T.DoubleType())]
    edges = [float(e) for e in edges]
    one = lambda t, v, f, e2: pairs.bootstrap(t, v, f, e2, edges, replicates, seed)
    g = pairs.per_light_curve(df, list(keys), one, lambda c: c.bootstrap(edges, replicates, seed), fields, time, value, tie, err)
    return g.withColumn("sigma", (F.col("upper") - F.col("lower")) / 2)
