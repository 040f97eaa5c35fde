"""Light-curve features and user functions."""

from __future__ import annotations


from starloom.functions.special import ERFC
from starloom.operators import features, series
from starloom.plans.q_stats import _NIGHT, rounded
from starloom.plans.registry import query

F_ = "forced_source"


@query("lc_features_basic", "SELECT objectId, band, count(*) AS observation_count, R6(max(mjd) - min(mjd)) AS duration FROM forced_source GROUP BY 1, 2")
def lc_basic(t):
    return rounded(features.basic(t(F_)))


@query(
    "lc_features_range",
    """WITH q AS (SELECT objectId, band, min(psfFlux) AS lo, max(psfFlux) AS hi, quantile_cont(psfFlux, 0.05) AS a, quantile_cont(psfFlux, 0.2) AS b, quantile_cont(psfFlux, 0.4) AS c, median(psfFlux) AS m,
      quantile_cont(psfFlux, 0.6) AS d, quantile_cont(psfFlux, 0.8) AS e, quantile_cont(psfFlux, 0.95) AS f FROM forced_source GROUP BY 1, 2)
      SELECT objectId, band, R6((hi - lo) / 2) AS amplitude, R6(greatest(hi - m, m - lo)) AS percent_amplitude, R6((d - c) / (f - a)) AS magnitude_percentage_ratio, R6(f - a) AS inter_percentile_range_5, R6(e - b) AS inter_percentile_range_20, R6(m) AS median FROM q""",
)
def lc_range(t):
    return rounded(features.value_range(t(F_)))


@query(
    "lc_beyond_nstd",
    """WITH s AS (SELECT *, avg(psfFlux) OVER w AS m, stddev_samp(psfFlux) OVER w AS sd FROM forced_source WINDOW w AS (PARTITION BY objectId, band))
      SELECT objectId, band, R6(avg(CASE WHEN abs(psfFlux - m) > 1 * sd THEN 1e0 ELSE 0e0 END)) AS beyond_1_std, R6(avg(CASE WHEN abs(psfFlux - m) > 2 * sd THEN 1e0 ELSE 0e0 END)) AS beyond_2_std FROM s GROUP BY 1, 2""",
)
def lc_beyond(t):
    return rounded(features.beyond_n_std(t(F_), (1.0, 2.0)))


_MOMENTS = "R6(stddev_samp(psfFlux) / avg(psfFlux)) AS mean_variance, R6((var_samp(psfFlux) - avg(psfFluxErr * psfFluxErr)) / (avg(psfFlux) * avg(psfFlux))) AS excess_variance, R6(skewness(psfFlux)) AS skew, R6(kurtosis(psfFlux)) AS kurtosis"


@query("lc_features_moments", f"SELECT objectId, band, {_MOMENTS} FROM forced_source GROUP BY 1, 2")
def lc_moments(t):
    return rounded(features.moments(t(F_)))


def _chi_sql(src="forced_source", keys="objectId, band"):
    return f"""SELECT {keys}, sum(psfFlux / (psfFluxErr * psfFluxErr)) / sum(1 / (psfFluxErr * psfFluxErr)) AS weighted_mean,
      (sum(psfFlux * psfFlux / (psfFluxErr * psfFluxErr)) - power(sum(psfFlux / (psfFluxErr * psfFluxErr)), 2) / sum(1 / (psfFluxErr * psfFluxErr))) / nullif(count(*) - 1, 0) AS reduced_chi2 FROM {src} GROUP BY {keys}"""


@query("lc_chi2", f"SELECT objectId, band, R4(weighted_mean) AS weighted_mean, R2(reduced_chi2) AS reduced_chi2 FROM ({_chi_sql()})")
def lc_chi2(t):
    return rounded(features.chi2(t(F_)), 4, reduced_chi2=2)


@query(
    "lc_linear",
    """WITH c AS (SELECT objectId, band, mjd - avg(mjd) OVER w AS t, psfFlux - avg(psfFlux) OVER w AS y, 1 / (psfFluxErr * psfFluxErr) AS w FROM forced_source WINDOW w AS (PARTITION BY objectId, band)),
      s AS (SELECT objectId, band, count(*) AS n, sum(w) AS w0, sum(w * t) AS wt, sum(w * y) AS wy, sum(w * t * t) AS wtt, sum(w * t * y) AS wty, sum(w * y * y) AS wyy, regr_slope(y, t) AS us, regr_sxx(y, t) AS sxx, regr_syy(y, t) AS syy, regr_sxy(y, t) AS sxy FROM c GROUP BY 1, 2),
      d AS (SELECT *, wtt - wt * wt / w0 AS vx, wty - wt * wy / w0 AS vc, wyy - wy * wy / w0 AS vy FROM s)
      SELECT objectId, band, R6(vc / vx) AS linear_fit_slope, R8(sqrt(1 / vx)) AS linear_fit_slope_sigma, R3((vy - vc * vc / vx) / (n - 2)) AS linear_fit_reduced_chi2,
      R6(us) AS linear_trend, R6(sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx)) AS linear_trend_sigma, R4(sqrt((syy - sxy * sxy / sxx) / (n - 2))) AS linear_trend_noise FROM d""",
)
def lc_linear(t):
    return rounded(features.linear(t(F_)), 6, linear_fit_slope_sigma=8, linear_fit_reduced_chi2=3, linear_trend_noise=4)


@query(
    "lc_eta",
    """WITH d AS (SELECT *, psfFlux - lag(psfFlux) OVER (PARTITION BY objectId, band ORDER BY mjd, visit) AS d FROM forced_source)
      SELECT objectId, band, R6(sum(d * d) / ((count(*) - 1) * var_samp(psfFlux))) AS eta FROM d GROUP BY 1, 2""",
)
def lc_eta(t):
    return rounded(features.eta(t(F_)))


@query(
    "lc_stetson_k",
    """WITH s AS (SELECT *, sum(psfFlux / (psfFluxErr * psfFluxErr)) OVER w / sum(1 / (psfFluxErr * psfFluxErr)) OVER w AS wm FROM forced_source WINDOW w AS (PARTITION BY objectId, band))
      SELECT objectId, band, R6(sum(abs((psfFlux - wm) / psfFluxErr)) / sqrt(count(*) * sum(power((psfFlux - wm) / psfFluxErr, 2)))) AS stetson_k FROM s GROUP BY 1, 2""",
)
def lc_stetson(t):
    return rounded(features.stetson_k(t(F_)))


def _erfc(x: str) -> str:
    t = f"(1 / (1 + 0.5e0 * abs({x})))"
    poly = f"({ERFC[-1]!r}e0)"
    for c in reversed(ERFC[:-1]):
        poly = f"(({c!r}e0) + {t} * {poly})"
    v = f"({t} * exp(-({x}) * ({x}) + {poly}))"
    return f"(CASE WHEN {x} >= 0 THEN {v} ELSE 2 - {v} END)"


@query(
    "lc_anderson_darling",
    f"""WITH s AS (SELECT *, (psfFlux - avg(psfFlux) OVER w) / stddev_samp(psfFlux) OVER w / sqrt(2e0) AS q, count(*) OVER w AS n, row_number() OVER (PARTITION BY objectId, band ORDER BY psfFlux, visit) AS i FROM forced_source WINDOW w AS (PARTITION BY objectId, band)),
      l AS (SELECT objectId, band, n, i, ln(0.5e0 * {_erfc('(-q)')}) AS lo, ln(0.5e0 * {_erfc('q')}) AS hi FROM s)
      SELECT objectId, band, R6((1 + 4e0 / max(n) - 25e0 / (max(n) * max(n))) * (-max(n) - sum((2 * i - 1) * lo + (2 * (n - i) + 1) * hi) / max(n))) AS anderson_darling_normal FROM l GROUP BY 1, 2""",
)
def lc_ad(t):
    return rounded(features.anderson_darling(t(F_)))


@query(
    "lc_otsu",
    """WITH c AS (SELECT objectId, band, visit, psfFlux - avg(psfFlux) OVER (PARTITION BY objectId, band) AS x FROM forced_source),
      s AS (SELECT *, count(*) OVER g AS n, sum(x) OVER g AS sx, sum(x * x) OVER g AS sxx, row_number() OVER o AS i, sum(x) OVER (o ROWS UNBOUNDED PRECEDING) AS c1, sum(x * x) OVER (o ROWS UNBOUNDED PRECEDING) AS c2 FROM c WINDOW g AS (PARTITION BY objectId, band), o AS (PARTITION BY objectId, band ORDER BY x, visit)),
      v AS (SELECT *, c1 / i AS lo, (sx - c1) / (n - i) AS hi FROM s WHERE i < n),
      k AS (SELECT *, row_number() OVER (PARTITION BY objectId, band ORDER BY R6(i / n * (1 - i / n) * (hi - lo) * (hi - lo)) DESC, i) AS rn FROM v)
      SELECT objectId, band, R2(hi - lo) AS otsu_mean_diff, R4(CASE WHEN i > 1 THEN sqrt((c2 - i * lo * lo) / (i - 1)) ELSE 0 END) AS otsu_std_lower, R4(CASE WHEN n - i > 1 THEN sqrt((sxx - c2 - (n - i) * hi * hi) / (n - i - 1)) ELSE 0 END) AS otsu_std_upper, R6(i / n) AS otsu_lower_to_all_ratio FROM k WHERE rn = 1""",
)
def lc_otsu(t):
    return rounded(features.otsu(t(F_)), 4, otsu_lower_to_all_ratio=6, otsu_mean_diff=2)


def _binned_sql():
    """Every family of the single-light-curve queries, on the night bins."""
    return f"""WITH nb AS ({_NIGHT}),
      st AS (SELECT *, avg(psfFlux) OVER w AS m, stddev_samp(psfFlux) OVER w AS sd, mjd - avg(mjd) OVER w AS t, 1 / (psfFluxErr * psfFluxErr) AS w,
        psfFlux - lag(psfFlux) OVER (PARTITION BY objectId, band ORDER BY mjd, night) AS d FROM nb WINDOW w AS (PARTITION BY objectId, band)),
      g AS (SELECT objectId, band, count(*) AS n, max(mjd) - min(mjd) AS duration, min(psfFlux) AS lo, max(psfFlux) AS hi, quantile_cont(psfFlux, 0.05) AS q05, quantile_cont(psfFlux, 0.2) AS q20,
        quantile_cont(psfFlux, 0.4) AS q40, median(psfFlux) AS q50, quantile_cont(psfFlux, 0.6) AS q60, quantile_cont(psfFlux, 0.8) AS q80, quantile_cont(psfFlux, 0.95) AS q95,
        avg(CASE WHEN abs(psfFlux - m) > 2 * sd THEN 1e0 ELSE 0e0 END) AS beyond_2_std, avg(CASE WHEN abs(psfFlux - m) > 3 * sd THEN 1e0 ELSE 0e0 END) AS beyond_3_std, {_MOMENTS},
        sum(d * d) / nullif((count(*) - 1) * var_samp(psfFlux), 0) AS eta,
        sum(w) AS w0, sum(w * t) AS wt, sum(w * (psfFlux - m)) AS wy, sum(w * t * t) AS wtt, sum(w * t * (psfFlux - m)) AS wty, regr_slope(psfFlux - m, t) AS us FROM st GROUP BY 1, 2),
      l AS (SELECT *, nullif(wtt - wt * wt / w0, 0) AS vx, wty - wt * wy / w0 AS vc FROM g)
      SELECT l.objectId, l.band, n AS observation_count, R6(duration) AS duration, R6((hi - lo) / 2) AS amplitude, R6(greatest(hi - q50, q50 - lo)) AS percent_amplitude,
        R4((q60 - q40) / nullif(q95 - q05, 0)) AS magnitude_percentage_ratio, R6(q95 - q05) AS inter_percentile_range_5, R6(q80 - q20) AS inter_percentile_range_20, R6(q50) AS median,
        R6(beyond_2_std) AS beyond_2_std, R6(beyond_3_std) AS beyond_3_std, mean_variance, excess_variance, skew, kurtosis, R4(weighted_mean) AS weighted_mean, R2(reduced_chi2) AS reduced_chi2,
        R6(eta) AS eta, R4(CASE WHEN n > 1 THEN vc / vx END) AS linear_fit_slope, R4(us) AS linear_trend
      FROM l JOIN ({_chi_sql('nb')}) x ON x.objectId = l.objectId AND x.band = l.band"""


@query("lc_features_binned", _binned_sql())
def lc_binned(t):
    nb = series.night_bins(t("periodic_source"))
    parts = [
        features.basic(nb), features.value_range(nb), features.beyond_n_std(nb), features.moments(nb), features.chi2(nb), features.eta(nb, tie="night"),
        features.linear(nb).select("objectId", "band", "linear_fit_slope", "linear_trend"),
    ]
    return rounded(features.combine(parts), 6, weighted_mean=4, reduced_chi2=2, magnitude_percentage_ratio=4, linear_fit_slope=4, linear_trend=4)


# columns of the table and the digits they are compared at; all families, all bands, both kinds of flux
_TABLE = {
    "observation_count": 6, "duration": 6, "amplitude": 6, "percent_amplitude": 6, "magnitude_percentage_ratio": 4, "inter_percentile_range_5": 6,
    "inter_percentile_range_20": 6, "median": 6, "beyond_2_std": 6, "beyond_3_std": 6, "mean_variance": 4, "skew": 4, "weighted_mean": 4, "reduced_chi2": 2,
    "linear_trend": 4, "eta": 4, "stetson_k": 4, "cusum": 4, "excess_variance": 4, "kurtosis": 4, "otsu_mean_diff": 6, "otsu_lower_to_all_ratio": 6,
    "anderson_darling_normal": 4,
}
_KINDS = {"direct": ("psfFlux", "psfFluxErr"), "dia": ("psfDiffFlux", "psfDiffFluxErr")}
_BANDS = ["g", "r", "i", "z", "y"]


def _table_sql():
    stack = " UNION ALL ".join(f"SELECT objectId, band, '{k}' AS kind, mjd, {f} AS y, {e} AS e, diaSourceId AS id FROM dia_source WHERE {'abs(' + f + ')' if k == 'dia' else f} > 5 * {e}" for k, (f, e) in _KINDS.items())
    aggs = []
    for k in _KINDS:
        for b in _BANDS:
            aggs += [f"coalesce(round(CAST(max({c}) FILTER (band = '{b}' AND kind = '{k}') AS DOUBLE), {d}) + 0e0, -1e0) AS {b}_{k}_{c}" for c, d in _TABLE.items()]
    return f"""WITH st AS ({stack}), c AS (SELECT *, avg(y) OVER w AS m, stddev_samp(y) OVER w AS sd, sum(y / (e * e)) OVER w / sum(1 / (e * e)) OVER w AS wm FROM st WINDOW w AS (PARTITION BY objectId, band, kind)),
      ou AS (SELECT *, c1 / i AS blo, (sx - c1) / (n - i) AS bhi FROM (SELECT objectId, band, kind, count(*) OVER w AS n, sum(y - m) OVER w AS sx, row_number() OVER o AS i, sum(y - m) OVER (o ROWS UNBOUNDED PRECEDING) AS c1 FROM c WINDOW w AS (PARTITION BY objectId, band, kind), o AS (PARTITION BY objectId, band, kind ORDER BY y, id)) WHERE i < n),
      ot AS (SELECT objectId, band, kind, bhi - blo AS otsu_mean_diff, i / n AS otsu_lower_to_all_ratio FROM ou QUALIFY row_number() OVER (PARTITION BY objectId, band, kind ORDER BY R6(i / n * (1 - i / n) * (bhi - blo) * (bhi - blo)) DESC, i) = 1),
      an0 AS (SELECT objectId, band, kind, (y - m) / sd / sqrt(2e0) AS q, count(*) OVER (PARTITION BY objectId, band, kind) AS n, row_number() OVER (PARTITION BY objectId, band, kind ORDER BY y, id) AS i FROM c WHERE sd > 0),
      an AS (SELECT objectId, band, kind, (1 + 4e0 / max(n) - 25e0 / (max(n) * max(n))) * (-max(n) - sum((2 * i - 1) * ln(0.5e0 * {_erfc('(-q)')}) + (2 * (n - i) + 1) * ln(0.5e0 * {_erfc('q')})) / max(n)) AS anderson_darling_normal FROM an0 GROUP BY 1, 2, 3),
      r AS (SELECT *, sum(y - m) OVER o AS run, y - lag(y) OVER (PARTITION BY objectId, band, kind ORDER BY mjd, id) AS d FROM c WINDOW o AS (PARTITION BY objectId, band, kind ORDER BY mjd, id ROWS UNBOUNDED PRECEDING)),
      g AS (SELECT objectId, band, kind, count(*) AS n, max(mjd) - min(mjd) AS duration, min(y) AS lo, max(y) AS hi, quantile_cont(y, 0.05) AS q05, quantile_cont(y, 0.2) AS q20, quantile_cont(y, 0.4) AS q40, median(y) AS q50, quantile_cont(y, 0.6) AS q60,
        quantile_cont(y, 0.8) AS q80, quantile_cont(y, 0.95) AS q95, avg(CASE WHEN abs(y - m) > 2 * sd THEN 1e0 ELSE 0e0 END) AS beyond_2_std, avg(CASE WHEN abs(y - m) > 3 * sd THEN 1e0 ELSE 0e0 END) AS beyond_3_std,
        stddev_samp(y) / nullif(avg(y), 0) AS mean_variance, skewness(y) AS skew, max(wm) AS weighted_mean, sum(power((y - wm) / e, 2)) / nullif(count(*) - 1, 0) AS reduced_chi2, regr_slope(y, mjd - 60000e0) AS linear_trend,
        sum(d * d) / nullif((count(*) - 1) * var_samp(y), 0) AS eta, sum(abs((y - wm) / e)) / nullif(sqrt(count(*) * sum(power((y - wm) / e, 2))), 0) AS stetson_k, (max(run) - min(run)) / nullif(count(*) * max(sd), 0) AS cusum,
        (var_samp(y) - avg(e * e)) / nullif(avg(y) * avg(y), 0) AS excess_variance, kurtosis(y) AS kurtosis FROM r GROUP BY 1, 2, 3),
      a AS (SELECT *, n AS observation_count, (hi - lo) / 2 AS amplitude, greatest(hi - q50, q50 - lo) AS percent_amplitude, (q60 - q40) / nullif(q95 - q05, 0) AS magnitude_percentage_ratio, q95 - q05 AS inter_percentile_range_5, q80 - q20 AS inter_percentile_range_20, q50 AS median FROM g LEFT JOIN ot USING (objectId, band, kind) LEFT JOIN an USING (objectId, band, kind))
      SELECT o.objectId, {', '.join(aggs)} FROM (SELECT DISTINCT objectId FROM dia_source) o LEFT JOIN a USING (objectId) GROUP BY 1"""


@query("lc_feature_table", _table_sql())
def lc_table(t):
    w = features.feature_table(t("dia_source"), _BANDS, _KINDS, tie="diaSourceId")
    keep = {f"{b}_{k}_{f}": d for k in _KINDS for b in _BANDS for f, d in _TABLE.items()}
    return rounded(w.select("objectId", *keep), 6, **keep)
