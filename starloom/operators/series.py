"""Light-curve operations on flat rows (object, band, time, flux, error)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.photometry import weight, weighted_mean
from starloom.operators.ordered import first_row, ordered, percentiles, same_keys, with_stats

KEYS = ["objectId", "band"]


def consecutive_diff(df: DataFrame, time: str = "mjd", flux: str = "psfFlux", tie: str = "visit", max_gap: float | None = None, keys=KEYS) -> DataFrame:
    """Time and flux steps between neighbouring observations."""
    o = ordered(df, list(keys), [time, tie], lags={"__t": time, "__f": flux})
    o = o.withColumns({"dt": F.col(time) - F.col("__t"), "dflux": F.col(flux) - F.col("__f")}).drop("__t", "__f").where(F.col("dt").isNotNull())
    return o.where(F.col("dt") < max_gap) if max_gap is not None else o


def phase_fold(df: DataFrame, period: str, time: str = "mjd", flux: str = "psfFlux", tie: str = "visit", keys=KEYS) -> DataFrame:
    """Phase counted from the time of the brightest observation."""
    s = with_stats(df, list(keys), __t0=F.max_by(F.col(time), F.struct(flux, -F.col(time))))
    return s.withColumn("phase", F.pmod(F.col(time) - F.col("__t0"), F.col(period)) / F.col(period)).drop("__t0")


def unique_time(df: DataFrame, time: str = "mjd", tie: str = "visit", keys=KEYS) -> DataFrame:
    """First row of each distinct time."""
    return first_row(df, [*keys, time], [tie])


def nights_detected(df: DataFrame, time: str, flux: str, err: str, n_sigma: float = 5.0, key: str = "objectId") -> DataFrame:
    """Number of distinct nights with a detection of ``n_sigma`` or more."""
    night = F.when(F.abs(F.col(flux)) >= n_sigma * F.col(err), F.floor(time))
    return df.groupBy(key).agg(F.count_distinct(night).alias("nights"))


def night_bins(df: DataFrame, time: str = "mjd", flux: str = "psfFlux", err: str = "psfFluxErr", keys=KEYS, window: float = 1.0, offset: float = 0.0) -> DataFrame:
    """Equal time bins: mean time, weighted mean flux and its error, count.

    The error of a bin is sqrt(n / sum(w)) with weights err^-2.
    """
    b = F.floor((F.col(time) - F.lit(offset)) / F.lit(window))
    return df.groupBy(*keys, b.alias("night")).agg(
        F.avg(time).alias(time), weighted_mean(flux, err).alias(flux), F.sqrt(F.count(F.lit(1)) / F.sum(weight(err))).alias(err), F.count(F.lit(1)).alias("n")
    )


def baseline_subtract(df: DataFrame, before: float, time: str = "mjd", flux: str = "psfDiffFlux", err: str = "psfDiffFluxErr", keys=KEYS) -> DataFrame:
    """Subtract the weighted mean flux before a time; signal to noise with the combined error.

    Baseline error: hypot(1 / sqrt(mean(err^-2)), sample std of the flux).
    """
    q = df.where(F.col(time) < before)
    base = q.groupBy(*keys).agg(weighted_mean(flux, err).alias("baseline"), F.hypot(1.0 / F.sqrt(F.avg(weight(err))), F.stddev_samp(flux)).alias("baseline_err"))
    out = same_keys(df, base, list(keys), "left").withColumn("adjusted", F.col(flux) - F.col("baseline"))
    return out.withColumn("s2n", F.col("adjusted") / F.hypot(F.col(err), F.col("baseline_err")))


def cusum(df: DataFrame, time: str = "mjd", value: str = "psfFlux", tie: str = "visit", keys=KEYS) -> DataFrame:
    """Range of the running sum of deviations over n times the sample std."""
    keys = list(keys)
    s = with_stats(df, keys, __m=F.avg(value), __s=F.stddev_samp(value), __n=F.count(value))
    o = ordered(s, keys, [time, tie], sums={"__run": F.col(value) - F.col("__m")})
    return o.groupBy(*keys).agg(((F.max("__run") - F.min("__run")) / F.nullif(F.first("__n") * F.first("__s"), F.lit(0.0))).alias("cusum"))


def whitened_residuals(df: DataFrame, time: str = "mjd", flux: str = "psfFlux", err: str = "psfFluxErr", tie: str = "visit", keys=KEYS) -> DataFrame:
    """Independent unit-variance residuals about the weighted mean.

    Recursive form: the k-th residual is measured against the weighted mean of
    the rows before it, (x - m) / sqrt(e^2 + 1/W).  n rows give n - 1 residuals.
    They have the distribution of the matrix form, in another basis.
    """
    w = weight(err)
    o = ordered(df.withColumn("__w", w), list(keys), [time, tie], sums={"__sw": F.col("__w"), "__X": F.col("__w") * F.col(flux)})
    W = F.col("__sw") - F.col("__w")
    m = (F.col("__X") - F.col("__w") * F.col(flux)) / W
    z = F.when(W > F.col("__w") * 1e-12, (F.col(flux) - m) / F.sqrt(F.col(err) * F.col(err) + 1.0 / W))
    return o.withColumn("whitened", z).where(F.col("whitened").isNotNull()).drop("__w", "__sw", "__X")


def relative_deviation(df: DataFrame, flux: str = "psfFlux", err: str = "psfFluxErr", keys=KEYS, max_variability: float = 10.0, min_obs: int = 10) -> DataFrame:
    """(flux - weighted mean) / err for the constant objects.

    Constant: more than ``min_obs`` rows and no row ``max_variability`` errors
    or more from the plain mean.
    """
    keys = list(keys)
    s = with_stats(df, keys, __m=F.avg(flux), wmean_flux=weighted_mean(flux, err), __n=F.count(F.lit(1))).where(F.col("__n") > min_obs)
    s = with_stats(s, keys, max_variability=F.max(F.abs((F.col(flux) - F.col("__m")) / F.col(err))))
    return s.where(F.col("max_variability") < max_variability).withColumn("rel_dev", (F.col(flux) - F.col("wmean_flux")) / F.col(err)).drop("__m", "__n")


def variability_prefilter(
    df: DataFrame, band: str, time: str, flux: str, err: str, key: str = "objectId", tie: str = "visit",
    min_nobs: int = 50, min_nobs_band: int = 30, min_amplitude: float = 0.05, min_rchi2: float = 2.0,
) -> DataFrame:
    """Objects with enough points, spread (q95 - q5) and reduced chi2 in one band."""
    total = df.groupBy(key).agg(F.count(F.lit(1)).alias("nobs")).where(F.col("nobs") >= min_nobs)
    one = unique_time(df.where(F.col("band") == band), time, tie, [key])
    q = percentiles(one, [key], flux, {"__lo": 0.05, "__hi": 0.95})
    s = reduced_chi2(one, flux, err, [key]).withColumnRenamed("n", "nobs_band")
    out = total.join(s, key).join(q, key).withColumn("amplitude", F.col("__hi") - F.col("__lo")).drop("__lo", "__hi", "wmean")
    return out.where((F.col("nobs_band") >= min_nobs_band) & (F.col("amplitude") > min_amplitude) & (F.col("rchi2") >= min_rchi2))


def reduced_chi2(df: DataFrame, flux: str, err: str, keys=KEYS) -> DataFrame:
    """n, weighted mean and chi2 / (n - 1) about it; two combining aggregates."""
    keys = list(keys)
    s = with_stats(df, keys, __wm=weighted_mean(flux, err))
    d = (F.col(flux) - F.col("__wm")) / F.col(err)
    n = F.count(F.lit(1))
    return s.groupBy(*keys).agg(n.alias("n"), F.first("__wm").alias("wmean"), (F.sum(d * d) / F.nullif(n - 1, F.lit(0))).alias("rchi2"))


def detector_rel_diff(df: DataFrame, objects: DataFrame, key: str = "objectId", flux: str = "psfFlux", err: str = "psfFluxErr", band: str = "band", detector: str = "detector") -> DataFrame:
    """Moments per (band, detector) of (f - F) / sqrt(e^2 + E^2) against the object flux.

    ``objects`` has (key, band, objFlux, objErr).  A list (object and band) with
    any null error counts as zeros.
    """
    from starloom.operators.stats import moments

    j = df.join(objects, [key, band])
    j = with_stats(j, [key, band], __bad=F.bool_or(F.col(err).isNull() | F.isnan(err) | F.col("objErr").isNull()))
    z = F.when(F.col("__bad"), F.lit(0.0)).otherwise((F.col(flux) - F.col("objFlux")) / F.sqrt(F.col(err) * F.col(err) + F.col("objErr") * F.col("objErr")))
    return moments(j.withColumn("rel_diff", z), "rel_diff", [band, detector])


def brightness_check(df: DataFrame, mag: str, reference: str, key: str = "objectId", cutoff: float = 1.0) -> DataFrame:
    """Any |dm| above the cutoff, largest |dm| and sample std per object."""
    d = F.abs(F.col(mag) - F.col(reference))
    return df.where(F.col(mag).isNotNull()).groupBy(key).agg(
        F.coalesce(F.bool_or(d > cutoff), F.lit(False)).alias("any_greater"), F.coalesce(F.max(d), F.lit(0.0)).alias("max_mag_sep"), F.stddev_samp(mag).alias("mag_std")
    )
