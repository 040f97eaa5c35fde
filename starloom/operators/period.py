"""Period search over all objects of a table."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.special import log_gamma
from starloom.operators.scan import BoxSearch, LombScargle, best_of_scores, combine_scores, fixed_grid, scan_all, scan_best

# Alias periods in days, their relative half width, and the period limits.
BAD_PERIODS = (1 / 3, 0.25, 0.5, 2 / 3, 1.0, 2.0, 29.5)
BAD_PERIOD_REL_RANGE = 10 / 365.2422
MIN_PERIOD = 5 / 60 / 24
MAX_PERIOD = 1.0
PERIOD_MULTIPLES = (0.25, 0.5, 1.0, 2.0, 4.0)


def alias_ok(period, bad=BAD_PERIODS, rel=BAD_PERIOD_REL_RANGE, lo=MIN_PERIOD, hi=MAX_PERIOD) -> Column:
    """Not near an alias period and inside the limits."""
    p = F.col(period) if isinstance(period, str) else period
    return reduce(lambda a, b: a & b, [F.abs(p / F.lit(b) - 1.0) > rel for b in bad], (p >= lo) & (p <= hi))


def false_alarm(z: Column, n: Column, f_max: Column, t_var: Column) -> Column:
    """Chance of a peak this high in noise (Baluev 2008, standard normalisation)."""
    nh, nk = n - 1.0, n - 3.0
    gam = F.sqrt(2.0 / nh) * F.exp(log_gamma(nh / 2.0) - log_gamma((nh - 1.0) / 2.0))
    w = f_max * F.sqrt(4 * math.pi * t_var)
    single = F.pow(1.0 - z, 0.5 * nk)
    tau = gam * w * F.pow(1.0 - z, 0.5 * (nk - 1.0)) * F.sqrt(0.5 * nh * z)
    return -F.expm1(-tau) + single * F.exp(-tau)


def best_period(df: DataFrame, keys: list[str], grid: dict[str, Column], model: LombScargle = LombScargle(), f_max: float | None = None, **kw) -> DataFrame:
    """Best period of each light curve with power, signal to noise and false-alarm probability.

    ``f_max`` enters the false-alarm probability; without it the best
    frequency's own grid end is not known here and the column is left out.
    """
    b = scan_best(df, keys, model, grid, **kw)
    freq = F.col("f0") + F.col("k") * F.col("step")
    b = b.withColumn("freq", freq).withColumns({
        "period": 1.0 / F.col("freq"),
        "power": F.col("score"),
        "s_to_n": (F.col("score") - F.col("mean_score")) / F.nullif(F.col("std_score"), F.lit(0.0)),
    })
    out = [*keys, "n", "freq", "period", "power", "s_to_n"]
    if f_max is not None:
        b = b.withColumn("fap", false_alarm(F.least(F.lit(1.0), F.col("score")), F.col("n").cast("double"), F.lit(float(f_max)), F.col("t_var")))
        out.append("fap")
    return b.select(*out)


def band_agreement(periods: DataFrame, key: str, bands: str) -> DataFrame:
    """Smallest relative period difference over band pairs and multiples.

    ``periods`` has (key, band, period, fap), at most one row per band of
    ``bands``; pairs follow the order of ``bands``.  The period of the pair's
    band with the lower false-alarm probability is taken (the second on a tie).
    """
    order = F.instr(F.lit(bands), F.col("band"))
    p = periods.withColumn("__o", order).where(F.col("__o") > 0)
    a = p.select(key, *[F.col(c).alias(f"{c}_a") for c in ("band", "period", "fap", "__o")])
    b = p.select(key, *[F.col(c).alias(f"{c}_b") for c in ("band", "period", "fap", "__o")])
    pairs = a.join(b, key).where(F.col("__o_a") < F.col("__o_b"))
    diff = F.least(*[F.abs(F.col("period_a") - m * F.col("period_b")) / F.col("period_a") for m in PERIOD_MULTIPLES])
    first = F.col("fap_a") < F.col("fap_b")
    pick = F.struct(
        F.when(first, F.col("band_a")).otherwise(F.col("band_b")).alias("best_period_band"),
        F.when(first, F.col("period_a")).otherwise(F.col("period_b")).alias("period_0"),
        F.when(first, F.col("fap_a")).otherwise(F.col("fap_b")).alias("period_0_false_alarm_prob"),
        diff.alias("min_rel_period_diff"),
    )
    return pairs.groupBy(key).agg(F.min_by(pick, F.struct(diff, "__o_a", "__o_b")).alias("r")).select(key, "r.*")


def multiband_weighted(df: DataFrame, key: str, grid, **kw) -> DataFrame:
    """Mean of unweighted band powers, weighted by each band's chi2 about its weighted mean."""
    power = scan_all(df, [key, "band"], LombScargle(), grid, err=None, **kw)
    chi = df.groupBy(key, "band").agg(*_weight_sums("psfFlux", "psfFluxErr")).withColumn("chi2", F.col("__yy") - F.col("__y") * F.col("__y") / F.col("__w"))
    p = power.join(chi.select(key, "band", "chi2"), [key, "band"])
    return best_of_scores(combine_scores(p, [key], F.col("chi2")), [key])


def multiband_joint(df: DataFrame, key: str, grid, **kw) -> DataFrame:
    """Shared period, own sinusoid and mean per band (VanderPlas & Ivezic 2015, one term per band).

    The joint power is the sum of the bands' chi2 reductions over the sum of
    their constant-model chi2.
    """
    power = scan_all(df, [key, "band"], LombScargle(), grid, **kw)
    chi = F.col("wyy") - F.col("wy") * F.col("wy") / F.col("w")
    return best_of_scores(combine_scores(power, [key], chi), [key])


def _weight_sums(flux, err):
    w = 1.0 / (F.col(err) * F.col(err))
    return [F.sum(w).alias("__w"), F.sum(w * F.col(flux)).alias("__y"), F.sum(w * F.col(flux) * F.col(flux)).alias("__yy")]


def box_period(df: DataFrame, keys: list[str], periods: tuple[float, float, int], bins: int = 20, max_width: int = 5, **kw) -> DataFrame:
    """Best box period: (first period, spacing, count)."""
    b = scan_best(df, keys, BoxSearch(bins, max_width), fixed_grid(*periods), **kw)
    return b.select(*keys, (F.col("f0") + F.col("k") * F.col("step")).alias("period"), F.col("score").alias("power"))


def verify_period(df: DataFrame, keys: list[str], known: str, **kw) -> DataFrame:
    """Scan 100 frequencies from 0.9 to 1.1 of the known one (a column of ``df``, one value per key)."""
    grid = {"f0": 0.9 / F.col(known), "step": 0.2 / F.col(known) / 99.0, "nf": F.lit(100)}
    b = scan_best(df, [*keys, known], LombScargle(), grid, err=None, **kw)
    return b.select(*keys, known, (1.0 / (F.col("f0") + F.col("k") * F.col("step"))).alias("period"), F.col("score").alias("maxpower"))


def compare_periods(found: DataFrame, known: DataFrame, key: str, fap_max: float = 1e-3, tol: float = 0.01) -> DataFrame:
    """Residual and class of each found period: match, half, double or other."""
    j = found.join(known.select(key, F.col("period").alias("true_period")), key)
    rel = lambda m: F.abs(F.col("period") / (F.col("true_period") * m) - 1.0) < tol
    return j.withColumns({
        "delta": F.col("period") - F.col("true_period"),
        "within": F.abs(F.col("period") - F.col("true_period")) < tol,
        "significant": F.col("fap") < fap_max,
        "alias": F.when(rel(1.0), "match").when(rel(0.5), "half").when(rel(2.0), "double").otherwise("other"),
    })


def sinusoid_fit(df: DataFrame, keys: list[str], period: Column, time="mjd", flux="psfFlux", err="psfFluxErr", t_ref: float = 60000.0) -> DataFrame:
    """Weighted least squares of mean + A sin(2 pi phase + phi) at a known period.

    Seven sums per light curve, then the 3x3 normal equations in closed form.
    """
    arg = 2 * math.pi * (F.col(time) - t_ref) / period
    r = df.withColumns({"__c": F.cos(arg), "__s": F.sin(arg), "__w": 1.0 / (F.col(err) * F.col(err))})
    w, c, s, y = (F.col(x) for x in ("__w", "__c", "__s", flux))
    g = r.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("W"), F.sum(w * c).alias("C"), F.sum(w * s).alias("S"), F.sum(w * c * c).alias("CC"), F.sum(w * c * s).alias("CS"),
        F.sum(w * s * s).alias("SS"), F.sum(w * y).alias("Y"), F.sum(w * y * c).alias("YC"), F.sum(w * y * s).alias("YS"),
    )
    W, C, S = F.col("W"), F.col("C"), F.col("S")
    g = g.select(
        *keys, "n", "W", "C", "S", "Y", (F.col("CC") - C * C / W).alias("vcc"), (F.col("CS") - C * S / W).alias("vcs"), (F.col("SS") - S * S / W).alias("vss"),
        (F.col("YC") - F.col("Y") * C / W).alias("vyc"), (F.col("YS") - F.col("Y") * S / W).alias("vys"),
    )
    det = F.nullif(F.col("vcc") * F.col("vss") - F.col("vcs") * F.col("vcs"), F.lit(0.0))
    g = g.withColumns({"bc": (F.col("vyc") * F.col("vss") - F.col("vys") * F.col("vcs")) / det, "bs": (F.col("vys") * F.col("vcc") - F.col("vyc") * F.col("vcs")) / det})
    return g.select(
        *keys, "n", F.sqrt(F.col("bc") * F.col("bc") + F.col("bs") * F.col("bs")).alias("amplitude"), F.atan2("bc", "bs").alias("phase"),
        ((F.col("Y") - F.col("bc") * F.col("C") - F.col("bs") * F.col("S")) / F.col("W")).alias("mean"),
    )
