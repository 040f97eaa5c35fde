"""Period search, template fits and candidate lists.

The oracle multiplies points by the frequency grid in plain SQL; Spark scans
packed light curves.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import fits, period
from starloom.operators.scan import LombScargle, auto_grid, explode_scores, fixed_grid, scan_all
from starloom.plans import candidates
from starloom.plans.q_stats import rounded
from starloom.plans.registry import query, rnd

F0, STEP, NF = 1.0, 2.99 / 399, 400
GRID = (F0, STEP, NF)
R_BAND = "band = 'r'"
FMAX = F0 + STEP * (NF - 1)


def ls_ctes(keys: str, where: str = "true", weighted: bool = True, src: str = "periodic_source", grid: str | None = None, nf: str = str(NF)) -> str:
    """CTEs: lc (points), s (sums), p (power per key and frequency)."""
    k = keys
    g = grid or f"({F0}e0 + k * {STEP!r}e0)"
    w = "1 / (psfFluxErr * psfFluxErr)" if weighted else "1e0"
    return f"""lc AS (SELECT *, mjd - 60000e0 AS t, psfFlux AS y, {w} AS w FROM {src} WHERE {where}),
     x AS (SELECT *, {g} AS freq, cos(2 * pi() * {g} * t) AS c, sin(2 * pi() * {g} * t) AS s FROM lc, range({nf}) r(k)),
     s AS (SELECT {k}, k, any_value(freq) AS freq, count(*) AS n, var_pop(t) AS tv, sum(w) AS W_, sum(w * y * y) - sum(w * y) * sum(w * y) / sum(w) AS chi, sum(w * c) / sum(w) AS c, sum(w * s) / sum(w) AS s, sum(w * y) / sum(w) AS y,
       sum(w * y * y) / sum(w) AS yy, sum(w * c * c) / sum(w) AS cc, sum(w * c * s) / sum(w) AS cs, sum(w * s * s) / sum(w) AS ss, sum(w * y * c) / sum(w) AS yc, sum(w * y * s) / sum(w) AS ys FROM x GROUP BY {k}, k),
     v AS (SELECT {k}, k, freq, n, tv, chi, yy - y * y AS yy, cc - c * c AS cc, cs - c * s AS cs, ss - s * s AS ss, yc - y * c AS yc, ys - y * s AS ys FROM s),
     p AS (SELECT {k}, k, freq, n, tv, chi, (ss * yc * yc + cc * ys * ys - 2 * cs * yc * ys) / (yy * (cc * ss - cs * cs)) AS power FROM v WHERE cc * ss - cs * cs > 1e-12)"""


def fap_sql(z: str, n: str, tv: str, fmax: float = FMAX) -> str:
    gam = f"sqrt(2e0 / ({n} - 1)) * exp(lgamma(({n} - 1) / 2e0) - lgamma(({n} - 2) / 2e0))"
    tau = f"{gam} * {fmax!r}e0 * sqrt(4 * pi() * {tv}) * power(1 - {z}, ({n} - 4) / 2e0) * sqrt(({n} - 1) / 2e0 * {z})"
    # 1 - exp(-x) loses all digits of a small x
    rise = f"CASE WHEN {tau} < 1e-4 THEN {tau} - power({tau}, 2) / 2 + power({tau}, 3) / 6 ELSE 1 - exp(-({tau})) END"
    return f"({rise} + power(1 - {z}, ({n} - 3) / 2e0) * exp(-({tau})))"


@query("ls_power", f"WITH {ls_ctes('objectId', R_BAND)} SELECT objectId, CAST(k AS INT) AS k, R6(freq) AS freq, R6(power) AS power FROM p")
def ls_power(t):
    s = scan_all(t("periodic_source").where("band = 'r'"), ["objectId"], LombScargle(), fixed_grid(*GRID))
    e = explode_scores(s, ["objectId"])
    return e.select("objectId", "k", rnd("x").alias("freq"), rnd("score").alias("power"))


@query(
    "ls_best_period",
    f"WITH {ls_ctes('objectId, band')} SELECT objectId, band, R6(1 / arg_max(freq, power)) AS period, R6(max(power)) AS power FROM p GROUP BY 1, 2",
)
def ls_best_period(t):
    return rounded(period.best_period(t("periodic_source"), ["objectId", "band"], fixed_grid(*GRID)).select("objectId", "band", "period", "power"))


# just above the grids that are summed directly
WIDE_NF = 17_000
WIDE_STEP = 2.99 / (WIDE_NF - 1)


@query(
    "ls_wide_grid",
    f"WITH {ls_ctes('objectId', R_BAND, grid=f'({F0}e0 + k * {WIDE_STEP!r}e0)', nf=str(WIDE_NF))} SELECT objectId, R6(1 / arg_max(freq, power)) AS period, R6(max(power)) AS power FROM p GROUP BY 1",
)
def ls_wide_grid(t):
    """Best period in one band on a grid wide enough for transforms."""
    grid = fixed_grid(F0, WIDE_STEP, WIDE_NF)
    return rounded(period.best_period(t("periodic_source").where("band = 'r'"), ["objectId"], grid).select("objectId", "period", "power"))


_AUTO = "(1 / 0.9e0 + k / (span * 5))"


@query(
    "ls_autogrid",
    f"""WITH q AS (SELECT *, max(mjd) OVER (PARTITION BY objectId) - min(mjd) OVER (PARTITION BY objectId) AS span FROM periodic_source WHERE band = 'r'),
      {ls_ctes('objectId', src='q', grid=_AUTO, nf='1000').replace('FROM lc, range(1000) r(k)', 'FROM lc, range(1000) r(k) WHERE k < 1 + round((1 / 0.25e0 - 1 / 0.9e0) * span * 5)')}
      SELECT objectId, count(*) AS n_freq, R6(1 / arg_max(freq, power)) AS period, R6(max(power)) AS power FROM p GROUP BY 1""",
)
def ls_autogrid(t):
    from starloom.operators.scan import scan_best

    b = scan_best(t("periodic_source").where("band = 'r'"), ["objectId"], LombScargle(), auto_grid(0.25, 0.9, 5))
    return rounded(b.select("objectId", F.col("n_scores").alias("n_freq"), (1 / (F.col("f0") + F.col("k") * F.col("step"))).alias("period"), F.col("score").alias("power")))


@query(
    "ls_fap",
    f"WITH {ls_ctes('objectId', R_BAND)}, b AS (SELECT objectId, max(power) AS z, any_value(n) AS n, any_value(tv) AS tv FROM p GROUP BY 1) SELECT objectId, n, R6(z) AS power, R4(log10({fap_sql('z', 'n', 'tv')})) AS log10_fap FROM b",
)
def ls_fap(t):
    b = period.best_period(t("periodic_source").where("band = 'r'"), ["objectId"], fixed_grid(*GRID), f_max=FMAX)
    return rounded(b.select("objectId", "n", "power", F.log10("fap").alias("log10_fap")), 6, log10_fap=4)


@query(
    "ls_peak_snr",
    f"WITH {ls_ctes('objectId, band')} SELECT objectId, band, R4((max(power) - avg(power)) / stddev_samp(power)) AS s_to_n FROM p GROUP BY 1, 2",
)
def ls_peak_snr(t):
    return rounded(period.best_period(t("periodic_source"), ["objectId", "band"], fixed_grid(*GRID)).select("objectId", "band", "s_to_n"), 4)


_BAD = " AND ".join(f"abs(period / {b!r}e0 - 1) > {period.BAD_PERIOD_REL_RANGE!r}e0" for b in period.BAD_PERIODS)


@query("alias_filter", f"SELECT objectId, diaSourceId, R8(period) AS period FROM (SELECT objectId, diaSourceId, psfFluxErr / 400e0 AS period FROM dia_source) WHERE {_BAD} AND period BETWEEN {period.MIN_PERIOD!r}e0 AND 1")
def alias_filter(t):
    d = t("dia_source").select("objectId", "diaSourceId", (F.col("psfFluxErr") / 400.0).alias("period"))
    return rounded(d.where(period.alias_ok("period")), 8)


@query(
    "best_period_pair",
    f"""WITH {ls_ctes('objectId, band')}, b AS (SELECT objectId, band, 1 / arg_max(freq, power) AS period, max(power) AS z, any_value(n) AS n, any_value(tv) AS tv FROM p WHERE band IN ('g', 'r', 'i', 'z') GROUP BY 1, 2),
      f AS (SELECT *, {fap_sql('z', 'n', 'tv')} AS fap, instr('griz', band) AS o FROM b),
      pr AS (SELECT a.objectId, a.o AS oa, c.o AS ob, CASE WHEN a.fap < c.fap THEN a.band ELSE c.band END AS best_period_band, CASE WHEN a.fap < c.fap THEN a.period ELSE c.period END AS period_0,
        least({', '.join(f'abs(a.period - {m}e0 * c.period) / a.period' for m in period.PERIOD_MULTIPLES)}) AS d FROM f a JOIN f c ON a.objectId = c.objectId AND a.o < c.o),
      k AS (SELECT *, row_number() OVER (PARTITION BY objectId ORDER BY R9(d), oa, ob) AS rn FROM pr)
      SELECT objectId, R6(period_0) AS period_0, R6(d) AS min_rel_period_diff FROM k WHERE rn = 1""",
)
def best_period_pair(t):
    p = period.best_period(t("periodic_source").where("band IN ('g', 'r', 'i', 'z')"), ["objectId", "band"], fixed_grid(*GRID), f_max=FMAX)
    a = period.band_agreement(p.select("objectId", "band", "period", "fap"), "objectId", "griz")
    return rounded(a.select("objectId", "period_0", "min_rel_period_diff"))


@query(
    "ls_multiband_weighted",
    f"""WITH {ls_ctes('objectId, band', weighted=False)}, e AS (SELECT objectId, band, sum(psfFlux * psfFlux / (psfFluxErr * psfFluxErr)) - power(sum(psfFlux / (psfFluxErr * psfFluxErr)), 2) / sum(1 / (psfFluxErr * psfFluxErr)) AS chi2 FROM periodic_source GROUP BY 1, 2),
      m AS (SELECT objectId, k, any_value(freq) AS freq, sum(power * chi2) / sum(chi2) AS power FROM p JOIN e USING (objectId, band) GROUP BY 1, 2)
      SELECT objectId, R6(1 / arg_max(freq, power)) AS period, R6(max(power)) AS power FROM m GROUP BY 1""",
)
def ls_multiband_weighted(t):
    b = period.multiband_weighted(t("periodic_source"), "objectId", fixed_grid(*GRID))
    return rounded(b.select("objectId", (1 / F.col("x")).alias("period"), F.col("score").alias("power")))


@query(
    "ls_multiband_joint",
    f"""WITH {ls_ctes('objectId, band')}, m AS (SELECT objectId, k, any_value(freq) AS freq, sum(power * chi) / sum(chi) AS power FROM p GROUP BY 1, 2)
      SELECT objectId, R6(1 / arg_max(freq, power)) AS period, R6(max(power)) AS power FROM m GROUP BY 1""",
)
def ls_multiband_joint(t):
    b = period.multiband_joint(t("periodic_source"), "objectId", fixed_grid(*GRID))
    return rounded(b.select("objectId", (1 / F.col("x")).alias("period"), F.col("score").alias("power")))


@query(
    "bls",
    """WITH lc AS (SELECT objectId, mjd - 60000e0 AS t, psfFlux AS y, 1 / (psfFluxErr * psfFluxErr) AS w FROM periodic_source WHERE band = 'r'),
      m AS (SELECT objectId, sum(w) AS W_, sum(w * y) / sum(w) AS ym FROM lc GROUP BY 1),
      b AS (SELECT objectId, k, least(19, floor((t / (0.3e0 + k * 0.01e0) - floor(t / (0.3e0 + k * 0.01e0))) * 20)) AS bin, sum(w) / any_value(W_) AS r, sum(w * (y - ym)) / any_value(W_) AS s FROM lc JOIN m USING (objectId), range(51) r(k) GROUP BY 1, 2, 3),
      x AS (SELECT objectId, k, st, width, sum(r) AS r, sum(s) AS s FROM b, range(20) q(st), range(1, 6) u(width) WHERE (CAST(bin AS BIGINT) - st + 20) % 20 < width GROUP BY 1, 2, 3, 4),
      z AS (SELECT objectId, k, max(s * s / (r * (1 - r))) AS power FROM x WHERE r > 0 AND r < 1 GROUP BY 1, 2)
      SELECT objectId, R6(0.3e0 + arg_max(k, power) * 0.01e0) AS period, R2(max(power)) AS power FROM z GROUP BY 1""",
)
def bls(t):
    return rounded(period.box_period(t("periodic_source").where("band = 'r'"), ["objectId"], (0.3, 0.01, 51)), 6, power=2)


@query(
    "period_verify",
    f"""WITH q AS (SELECT *, 0.3e0 + objectId % 10 * 0.05e0 AS true_period FROM periodic_source WHERE band = 'r'),
      {ls_ctes('objectId, true_period', weighted=False, src='q', grid='(0.9e0 / true_period + k * (0.2e0 / true_period / 99e0))', nf='100')}
      SELECT objectId, R6(true_period) AS true_period, R6(1 / arg_max(freq, power)) AS period, R6(max(power)) AS maxpower FROM p GROUP BY 1, 2""",
)
def period_verify(t):
    d = t("periodic_source").where("band = 'r'").withColumn("true_period", 0.3 + F.col("objectId") % 10 * 0.05)
    return rounded(period.verify_period(d, ["objectId"], "true_period"))


@query(
    "period_compare",
    f"""WITH {ls_ctes('objectId')}, b AS (SELECT objectId, 1 / arg_max(freq, power) AS period, max(power) AS z, any_value(n) AS n, any_value(tv) AS tv FROM p GROUP BY 1),
      c AS (SELECT *, 0.3e0 + objectId % 10 * 0.05e0 AS tp, {fap_sql('z', 'n', 'tv')} AS fap FROM b)
      SELECT objectId, R6(period - tp) AS delta, abs(period - tp) < 0.01 AS within, fap < 1e-3 AS significant,
      CASE WHEN abs(period / tp - 1) < 0.01 THEN 'match' WHEN abs(period / (tp * 0.5e0) - 1) < 0.01 THEN 'half' WHEN abs(period / (tp * 2) - 1) < 0.01 THEN 'double' ELSE 'other' END AS alias FROM c""",
)
def period_compare(t):
    found = period.best_period(t("periodic_source"), ["objectId"], fixed_grid(*GRID), f_max=FMAX)
    known = t("periodic_source").select("objectId", (0.3 + F.col("objectId") % 10 * 0.05).alias("period")).distinct()
    return rounded(period.compare_periods(found, known, "objectId").select("objectId", "delta", "within", "significant", "alias"))


@query(
    "sinusoid_fit",
    """WITH x AS (SELECT objectId, band, psfFlux AS y, 1 / (psfFluxErr * psfFluxErr) AS w, cos(2 * pi() * (mjd - 60000e0) / (0.3e0 + objectId % 10 * 0.05e0)) AS c, sin(2 * pi() * (mjd - 60000e0) / (0.3e0 + objectId % 10 * 0.05e0)) AS s FROM periodic_source),
      s AS (SELECT objectId, band, count(*) AS n, sum(w * y) / sum(w) AS ym, sum(w * c) / sum(w) AS cm, sum(w * s) / sum(w) AS sm, sum(w * c * c) / sum(w) AS cc, sum(w * s * s) / sum(w) AS ss, sum(w * c * s) / sum(w) AS cs, sum(w * y * c) / sum(w) AS yc, sum(w * y * s) / sum(w) AS ys FROM x GROUP BY 1, 2),
      v AS (SELECT objectId, band, n, ym, cm, sm, cc - cm * cm AS cc, ss - sm * sm AS ss, cs - cm * sm AS cs, yc - ym * cm AS yc, ys - ym * sm AS ys FROM s),
      b AS (SELECT *, (yc * ss - ys * cs) / (cc * ss - cs * cs) AS bc, (ys * cc - yc * cs) / (cc * ss - cs * cs) AS bs FROM v)
      SELECT objectId, band, n, R4(sqrt(bc * bc + bs * bs)) AS amplitude, R6(atan2(bc, bs)) AS phase, R4(ym - bc * cm - bs * sm) AS mean FROM b""",
)
def sinusoid_fit(t):
    f = period.sinusoid_fit(t("periodic_source"), ["objectId", "band"], 0.3 + F.col("objectId") % 10 * 0.05)
    return rounded(f, 4, phase=6)


def _bazin_ctes(src: str, min_points: int) -> str:
    return f"""o AS (SELECT objectId, min(t) AS t0, max(t) AS t1, count(*) AS n, sum(w) AS W_, sum(w * y) AS wy, sum(w * y * y) AS wyy FROM {src} GROUP BY 1 HAVING count(*) >= {min_points}),
      x AS (SELECT l.objectId, k, t - (t0 + (k // 4) * (t1 - t0) / 11) AS x, CASE WHEN (k % 4) // 2 = 0 THEN 2e0 ELSE 8e0 END AS rise, CASE WHEN k % 2 = 0 THEN 10e0 ELSE 40e0 END AS fall, y, w, n, W_, wy, wyy, t0 + (k // 4) * (t1 - t0) / 11 AS tp FROM {src} l JOIN o USING (objectId), range(48) r(k)),
      g AS (SELECT *, exp(-x / fall - (greatest(-x / rise, 0) + ln(1 + exp(-abs(x / rise))))) AS g FROM x),
      s AS (SELECT objectId, k, any_value(tp) AS tp, any_value(rise) AS rise, any_value(fall) AS fall, any_value(n) AS n, any_value(W_) AS W_, any_value(wy) AS wy, any_value(wyy) AS wyy, sum(w * g) AS sg, sum(w * g * g) AS sgg, sum(w * g * y) AS syg FROM g GROUP BY 1, 2),
      q AS (SELECT *, (syg / W_ - sg / W_ * (wy / W_)) * (syg / W_ - sg / W_ * (wy / W_)) / ((sgg / W_ - sg / W_ * (sg / W_)) * (wyy / W_ - wy / W_ * (wy / W_))) AS score FROM s WHERE sgg / W_ - sg / W_ * (sg / W_) > 1e-12),
      k1 AS (SELECT *, row_number() OVER (PARTITION BY objectId ORDER BY R9(score) DESC, k) AS rn FROM q),
      fit AS (SELECT objectId, n, tp AS t0, rise, fall, (wyy - wy * wy / W_) / (n - 1) AS chi2_const, (wyy - wy * wy / W_) * (1 - score) / (n - 5) AS chi2_bazin FROM k1 WHERE rn = 1)"""


@query(
    "bazin_grid_fit",
    f"""WITH l AS (SELECT objectId, mjd AS t, psfDiffFlux AS y, 1 / (psfDiffFluxErr * psfDiffFluxErr) AS w FROM dia_source WHERE band = 'r'), {_bazin_ctes('l', 8)}
      SELECT objectId, n, R4(chi2_const) AS chi2_const, R4(chi2_bazin) AS chi2_bazin FROM fit""",
)
def bazin_grid_fit(t):
    f = fits.bazin_grid_fit(t("dia_source").where("band = 'r'"), ["objectId"], flux="psfDiffFlux", err="psfDiffFluxErr")
    return rounded(f.select("objectId", "n", "chi2_const", "chi2_bazin"), 4)


@query(
    "periodic_candidates",
    f"""WITH q AS (SELECT p.* FROM periodic_source p JOIN sky_object o USING (objectId) WHERE psfFluxErr < 145 AND band = 'r'), c AS (SELECT objectId FROM q GROUP BY 1 HAVING count(*) > 50),
      q2 AS (SELECT q.* FROM q JOIN c USING (objectId)), {ls_ctes('objectId', src='q2')},
      b AS (SELECT objectId, 1 / arg_max(freq, power) AS period, R6((max(power) - avg(power)) / stddev_samp(power)) AS s_to_n, R6(max(power)) AS power, any_value(n) AS n FROM p GROUP BY 1)
      SELECT objectId, n, R6(period) AS period, power, s_to_n FROM b WHERE {_BAD} AND period BETWEEN {period.MIN_PERIOD!r}e0 AND 1 ORDER BY s_to_n DESC, objectId LIMIT 20""",
)
def periodic_candidates(t):
    c = candidates.periodic_candidates(t("sky_object"), t("periodic_source"), GRID)
    return rounded(c.select("objectId", "n", "period", "power", "s_to_n"))


@query(
    "transient_candidates",
    f"""WITH d AS (SELECT * FROM dia_source WHERE band = 'r' AND objectId IN (SELECT objectId FROM dia_source WHERE band = 'r' AND abs(psfDiffFlux / psfDiffFluxErr) > 3 GROUP BY 1 HAVING count(*) >= 5)),
      u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY objectId, mjd ORDER BY diaSourceId) AS rn FROM d) WHERE rn = 1),
      nb AS (SELECT objectId, floor(mjd) AS night, avg(mjd) AS t, sum(psfDiffFlux / (psfDiffFluxErr * psfDiffFluxErr)) / sum(1 / (psfDiffFluxErr * psfDiffFluxErr)) AS y, sum(1 / (psfDiffFluxErr * psfDiffFluxErr)) / count(*) AS w FROM u GROUP BY 1, 2),
      {_bazin_ctes('nb', 8)}
      SELECT objectId, n, R4(chi2_const) AS chi2_const, R4(chi2_bazin) AS chi2_bazin FROM fit WHERE chi2_const > 1 AND chi2_const / chi2_bazin > 1.2 AND chi2_bazin < 100000""",
)
def transient_candidates(t):
    c = candidates.transient_candidates(t("dia_source"), min_ratio=1.2, max_fit=100000.0)
    return rounded(c.select("objectId", "n", "chi2_const", "chi2_bazin"), 4)


@query(
    "rrlyrae_candidates",
    f"""WITH m AS (SELECT objectId, 2.5e0 * log10(avg(psfFlux) FILTER (band = 'r') / avg(psfFlux) FILTER (band = 'g')) AS gr FROM periodic_source GROUP BY 1),
      q AS (SELECT p.* FROM periodic_source p JOIN m USING (objectId) WHERE gr > -0.1 AND gr < 0.5 AND band = 'r' AND psfFluxErr < 140), c AS (SELECT objectId FROM q GROUP BY 1 HAVING count(*) > 50),
      q2 AS (SELECT q.* FROM q JOIN c USING (objectId)), {ls_ctes('objectId', weighted=False, src='q2')},
      b AS (SELECT objectId, 1 / arg_max(freq, power) AS period, (max(power) - avg(power)) / stddev_samp(power) AS s_to_n FROM p GROUP BY 1)
      SELECT objectId, R6(period) AS period, R4(s_to_n) AS s_to_n, R6(gr) AS gr FROM b JOIN m USING (objectId) WHERE period > 0.3 AND period < 0.6 AND s_to_n > 5""",
)
def rrlyrae_candidates(t):
    c = candidates.rrlyrae_candidates(t("periodic_source"), GRID, 140.0, 50, (-0.1, 0.5), (0.3, 0.6), 5.0)
    return rounded(c.select("objectId", "period", "s_to_n", "gr"), 6, s_to_n=4)
