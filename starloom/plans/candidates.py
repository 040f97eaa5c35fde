"""Candidate searches: compositions of filters, scans and fits into ranked lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import photometry as ph
from starloom.operators import fits, nested, period, series
from starloom.operators.ordered import largest_group
from starloom.operators.scan import LombScargle, fixed_grid


def periodic_candidates(objects: DataFrame, sources: DataFrame, grid=(1.0, 2.99 / 399, 400), band: str = "r", max_err: float = 145.0, min_points: int = 50, n: int = 20) -> DataFrame:
    """Light curves of one band of the objects, long ones only, scan for periods, drop aliases, rank.

    Ranked by signal to noise of the peak, ties by id.
    """
    # the cuts reach the scan of the sources; the scan packs the rows of an object and drops short light curves
    rows = sources.where((F.col("psfFluxErr") < max_err) & (F.col("band") == band)).select("objectId", "mjd", "psfFlux", "psfFluxErr")
    rows = rows.join(objects.select("objectId"), "objectId", "left_semi")
    best = period.best_period(rows, ["objectId"], fixed_grid(*grid), LombScargle(), f_max=grid[0] + grid[1] * (grid[2] - 1), min_points=min_points + 1)
    best = best.where(period.alias_ok("period"))
    return best.orderBy(F.desc(F.round("s_to_n", 6)), "objectId").limit(n)


def periodic_pairs(sources: DataFrame, grid, bands: str = "griz", max_diff: float = 0.001, max_log_fap: float = -10.0, min_points: int = 30) -> DataFrame:
    """Objects whose bands agree on a period with a low false-alarm probability."""
    p = period.best_period(
        sources.where(F.instr(F.lit(bands), F.col("band")) > 0), ["objectId", "band"], fixed_grid(*grid), f_max=grid[0] + grid[1] * (grid[2] - 1), min_points=min_points
    )
    a = period.band_agreement(p.select("objectId", "band", "period", "fap"), "objectId", bands)
    ok = (F.log10(F.greatest(F.col("period_0_false_alarm_prob"), F.lit(1e-300))) < max_log_fap) & (F.col("min_rel_period_diff") < max_diff)
    return a.where(ok)


def transient_candidates(
    sources: DataFrame, band: str = "r", flux: str = "psfDiffFlux", err: str = "psfDiffFluxErr", tie: str = "diaSourceId",
    min_detections: int = 5, min_points: int = 8, min_chi2: float = 1.0, min_ratio: float = 3.0, max_fit: float = 10.0,
) -> DataFrame:
    """Objects better described by a pulse than by a constant, on nightly bins.

    At least ``min_detections`` points of 3 sigma before binning; the constant's
    reduced chi2 above ``min_chi2``; chi2 ratio above ``min_ratio``; the pulse's
    reduced chi2 below ``max_fit``.
    """
    s = sources.where(F.col("band") == band)
    enough = s.groupBy("objectId").agg(F.count_if(F.abs(F.col(flux) / F.col(err)) > 3.0).alias("d")).where(F.col("d") >= min_detections)
    s = series.unique_time(s.join(enough, "objectId", "left_semi"), "mjd", tie, ["objectId"])
    bins = series.night_bins(s, "mjd", flux, err, ["objectId"])
    fit = fits.bazin_grid_fit(bins, ["objectId"], flux=flux, err=err, min_points=min_points)
    ok = (F.col("chi2_const") > min_chi2) & (F.col("chi2_const") / F.col("chi2_bazin") > min_ratio) & (F.col("chi2_bazin") < max_fit)
    return fit.where(ok)


def rrlyrae_candidates(sources: DataFrame, grid, max_err: float, min_points: int, color: tuple[float, float], periods: tuple[float, float], min_s_to_n: float) -> DataFrame:
    """Colour cut, one-band light-curve cuts, a period range and a peak significance."""
    mean = sources.groupBy("objectId").agg(
        F.avg(F.when(F.col("band") == "g", F.col("psfFlux"))).alias("g_psfFlux"), F.avg(F.when(F.col("band") == "r", F.col("psfFlux"))).alias("r_psfFlux")
    )
    gr = mean.where("g_psfFlux > 0 AND r_psfFlux > 0").withColumn("gr", ph.color("g_psfFlux", "r_psfFlux")).where((F.col("gr") > color[0]) & (F.col("gr") < color[1]))
    r = sources.where((F.col("band") == "r") & (F.col("psfFluxErr") < max_err)).join(gr.select("objectId"), "objectId", "left_semi")
    p = period.best_period(r, ["objectId"], fixed_grid(*grid), err=None, min_points=min_points + 1)
    p = p.where((F.col("period") > periods[0]) & (F.col("period") < periods[1]) & (F.col("s_to_n") > min_s_to_n))
    return p.join(gr.select("objectId", "gr"), "objectId")
