"""Aggregates, windows and residual studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import photometry as ph
from starloom.functions.healpix import with_healpix
from starloom.operators import series, sketches, stats
from starloom.operators.columns import numeric_columns
from starloom.operators.nested import flatten, pack
from starloom.operators.ordered import first_row, percentiles, same_keys, top_k, with_stats
from starloom.operators.regions import ConeSearch
from starloom.plans.q_sky import dist, hp
from starloom.plans.registry import query, rnd, scatter_sql
from starloom.session import scratch_path

MAG = "(31.4e0 - 2.5e0 * log10(psfFlux))"


def rounded(df, digits=6, **only):
    cols = [n for n, ty in df.dtypes if ty in ("double", "float")]
    return df.withColumns({c: rnd(c, only.get(c, digits)) for c in cols})


@query("group_agg", "SELECT objectId, band, R4(sum(psfFlux)) AS total, R6(avg(psfFlux)) AS mean, min(visit) AS visit FROM forced_source GROUP BY 1, 2")
def group_agg(t):
    return t("forced_source").groupBy("objectId", "band").agg(rnd(F.sum("psfFlux"), 4).alias("total"), rnd(F.avg("psfFlux")).alias("mean"), F.min("visit").alias("visit"))


@query("tile_stats", hp(2) + " SELECT CAST(2 AS INT) AS norder, pixel AS npix, R6(min(dec)) AS min_dec, R6(max(dec)) AS max_dec, R6(avg(dec)) AS mean_dec, count(*) AS n FROM hp GROUP BY pixel")
def tile_stats(t):
    df = with_healpix(t("sky_object"), "ra", "dec", 2, "npix")
    return df.groupBy(F.lit(2).alias("norder"), "npix").agg(rnd(F.min("dec")).alias("min_dec"), rnd(F.max("dec")).alias("max_dec"), rnd(F.avg("dec")).alias("mean_dec"), F.count(F.lit(1)).alias("n"))


@query("global_stats", "SELECT R6(min(ra)) AS min_ra, R6(max(ra)) AS max_ra, R6(avg(ra)) AS mean_ra, count(*) AS n FROM sky_object")
def global_stats(t):
    return t("sky_object").agg(rnd(F.min("ra")).alias("min_ra"), rnd(F.max("ra")).alias("max_ra"), rnd(F.avg("ra")).alias("mean_ra"), F.count(F.lit(1)).alias("n"))


@query("distinct_ratio", "SELECT count(DISTINCT diaObjectId) AS ids, count(*) AS n, R6(count(DISTINCT diaObjectId) / count(*)) AS ratio FROM object_version")
def distinct_ratio(t):
    # ids are grouped first, so the distinct count is a plain count of groups
    g = t("object_version").groupBy("diaObjectId").agg(F.count(F.lit(1)).alias("c"))
    return g.agg(F.count(F.lit(1)).alias("ids"), F.sum("c").alias("n")).select("ids", "n", rnd(F.col("ids") / F.col("n")).alias("ratio"))


@query("latest_version", "SELECT diaObjectId, versionId, validityStart, R6(psfFluxMean) AS psfFluxMean FROM (SELECT *, row_number() OVER (PARTITION BY diaObjectId ORDER BY validityStart DESC, versionId DESC) AS rn FROM object_version) WHERE rn = 1")
def latest_version(t):
    v = t("object_version").groupBy("diaObjectId").agg(F.max_by(F.struct("versionId", "validityStart", "psfFluxMean"), F.struct("validityStart", "versionId")).alias("r"))
    return v.select("diaObjectId", "r.versionId", "r.validityStart", rnd("r.psfFluxMean").alias("psfFluxMean"))


@query("first_per_id", "SELECT objectId, visit, band, R6(mjd) AS mjd, n_in FROM (SELECT *, row_number() OVER (PARTITION BY objectId ORDER BY mjd, visit) AS rn, count(*) OVER (PARTITION BY objectId) AS n_in FROM forced_source) WHERE rn = 1")
def first_per_id(t):
    df = t("forced_source").select("objectId", "visit", "band", "mjd")
    f = first_row(df, ["objectId"], ["mjd", "visit"]).join(df.groupBy("objectId").agg(F.count(F.lit(1)).alias("n_in")), "objectId")
    return f.withColumn("mjd", rnd("mjd"))


@query("value_counts", "SELECT objectId, count(*) AS n FROM dia_source GROUP BY 1 HAVING count(*) > 60")
def value_counts(t):
    return t("dia_source").groupBy("objectId").agg(F.count(F.lit(1)).alias("n")).where("n > 60")


@query(
    "sketches_merged",
    """SELECT band, count(*) AS n, count(DISTINCT objectId) AS n_objects, true AS objects_within, true AS median_within FROM forced_source GROUP BY 1""",
)
def sketches_merged(t):
    """Daily sketches are stored, then merged per band; estimates are held against exact counts and ranks."""
    f = t("forced_source")
    path = scratch_path(t.spark, "sketches")
    sketches.sketch(f.withColumn("day", F.floor("mjd")), ["band", "day"], ["objectId"], ["psfFlux"]).write.parquet(path)
    merged = sketches.estimates(sketches.merge(t.spark.read.parquet(path), ["band"]))
    merged = merged.select("band", "distinct_objectId", F.col("quantiles_psfFlux")[0].alias("median"))
    below = F.avg((F.col("psfFlux") <= F.col("median")).cast("double"))
    exact = f.join(merged, "band").groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("objectId").alias("n_objects"), F.first("distinct_objectId").alias("d"), below.alias("r"))
    within = (F.abs(F.col("d") / F.col("n_objects") - 1) < 0.1).alias("objects_within"), (F.abs(F.col("r") - 0.5) < 0.03).alias("median_within")
    return exact.select("band", "n", "n_objects", *within)


@query(
    "duplicate_rows",
    """WITH d AS (SELECT l_partkey AS part, CAST(floor((epoch_us(l_shipdate) / 86400e6 + 40587e0) / 30) AS BIGINT) AS epoch, l_suppkey AS objectId FROM lineitem),
       k AS (SELECT part, epoch FROM d GROUP BY 1, 2 HAVING min(objectId) <> max(objectId)) SELECT d.* FROM d JOIN k USING (part, epoch)""",
)
def duplicate_rows(t):
    from starloom.functions.timefn import timestamp_to_mjd

    d = t("lineitem").select(F.col("l_partkey").alias("part"), F.floor(timestamp_to_mjd("l_shipdate") / 30).alias("epoch"), F.col("l_suppkey").alias("objectId"))
    return stats.duplicate_groups(d, ["part", "epoch"], "objectId")


def _holes(t):
    """Table with nulls and NaNs made from the given flags."""
    nan = F.lit(float("nan"))
    return t("forced_source").select(
        "objectId", F.when(~F.col("psfFlux_flag"), F.col("psfFlux")).alias("psfFlux"), F.when(F.col("pixelFlags_bad"), nan).otherwise(F.col("psfFluxErr")).alias("psfFluxErr"),
        F.when(F.col("detector") != 9, F.col("band")).alias("band"),
    )


@query(
    "null_profile",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (psfFlux_flag) AS a, count(*) FILTER (pixelFlags_bad) AS b, count(*) FILTER (detector = 9) AS c FROM forced_source)
       SELECT 'psfFlux' AS name, a AS null_count, R6(a * 100e0 / n) AS percent FROM c UNION ALL SELECT 'psfFluxErr', b, R6(b * 100e0 / n) FROM c UNION ALL SELECT 'band', c, R6(c * 100e0 / n) FROM c""",
)
def null_profile(t):
    return rounded(stats.null_profile(_holes(t)))


_RULES = {"ra": ("RIGHT ASCENSION", 0.0, 360.0), "dec": ("DECLINATION", -90.0, 90.0), "r_psfFlux": ("FLUX", 0.0, 100_000_000.0)}


@query(
    "range_check",
    " UNION ALL ".join(f"SELECT '{c}' AS name, '{k}' AS kind, R6(min({c})) AS min_value, R6(max({c})) AS max_value, min({c}) >= {a} AND max({c}) <= {b} AS ok FROM sky_object" for c, (k, a, b) in _RULES.items()),
)
def range_check(t):
    return rounded(stats.range_check(t("sky_object"), _RULES))


@query(
    "band_stats",
    "SELECT band, count(psfFlux) AS len, R6(avg(psfFlux)) AS mean_psfFlux, R6(min(psfFlux)) AS min_psfFlux, R6(max(psfFlux)) AS max_psfFlux, R6(avg(psfFluxErr)) AS mean_psfFluxErr, R6(min(psfFluxErr)) AS min_psfFluxErr, R6(max(psfFluxErr)) AS max_psfFluxErr FROM forced_source WHERE NOT pixelFlags_bad GROUP BY 1",
)
def band_stats(t):
    df = t("forced_source").where(~F.col("pixelFlags_bad")).select("band", "objectId", "psfFlux", "psfFluxErr")
    return rounded(stats.band_stats(df, [c for c in numeric_columns(df)], ["band"]))


# The six survey fields (centre in degrees).
FIELDS = {
    "south_deep": (53.13, -28.10),
    "euclid_south": (59.10, -48.73),
    "low_ecliptic": (37.86, 6.98),
    "low_galactic": (95.00, -25.00),
    "globular": (6.02, -72.08),
    "dwarf": (40.00, -34.45),
}
BANDS = "ugrizy"

# the test positions lie on one curve of the sky, so wider cones on it are used beside the six of 2 degrees
WIDE = {"curve_a": (180.0, 30.0, 20.0), "curve_b": (252.0, 6.0, 20.0), "curve_c": (350.0, -26.0, 20.0)}


def _field_sql():
    rows = [(n, r, d, 7200.0) for n, (r, d) in FIELDS.items()] + [(n, r, d, w * 3600) for n, (r, d, w) in WIDE.items()]
    return " UNION ALL ".join(f"SELECT '{n}' AS field, objectId FROM sky_object WHERE {dist(r, d)} <= {w}" for n, r, d, w in rows)


@query(
    "field_band_stats",
    f"""WITH m AS ({_field_sql()}), j AS (SELECT m.field, f.* FROM m JOIN forced_source f USING (objectId))
      SELECT field, """ + ", ".join(f"R6(avg(psfFlux) FILTER (band = '{b}')) AS mean_{b}, R6(min(psfFlux) FILTER (band = '{b}')) AS min_{b}, R6(max(psfFlux) FILTER (band = '{b}')) AS max_{b}, count(*) FILTER (band = '{b}') AS len_{b}" for b in BANDS) + " FROM j GROUP BY field",
)
def field_band_stats(t):
    regions = {n: ConeSearch(r, d, 7200.0) for n, (r, d) in FIELDS.items()} | {n: ConeSearch(r, d, w * 3600) for n, (r, d, w) in WIDE.items()}
    fields = stats.tag_regions(t("sky_object"), regions, "ra", "dec").select("field", "objectId")
    parts = stats.band_stats(t("forced_source"), ["psfFlux"], ["objectId", "band"])
    comb = stats.weighted_combine(fields.join(parts, "objectId"), ["psfFlux"], ["field", "band"])
    wide = comb.groupBy("field").pivot("band", list(BANDS)).agg(F.first("mean_psfFlux").alias("mean"), F.first("min_psfFlux").alias("min"), F.first("max_psfFlux").alias("max"), F.first("len").alias("len"))
    out = [rnd(f"{b}_{s}").alias(f"{s}_{b}") for b in BANDS for s in ("mean", "min", "max")]
    return wide.select("field", *out, *[F.coalesce(f"{b}_len", F.lit(0)).cast("long").alias(f"len_{b}") for b in BANDS])


@query(
    "histogram",
    f"WITH m AS (SELECT band, CAST(floor(({MAG} - 18e0) / 0.25e0) AS INT) AS bin FROM forced_source), g AS (SELECT band, CAST(i AS INT) AS bin FROM (SELECT DISTINCT band FROM m), range(16) r(i)) SELECT g.band, g.bin, count(m.bin) AS n FROM g LEFT JOIN m USING (band, bin) GROUP BY 1, 2",
)
def histogram(t):
    df = t("forced_source").select("band", ph.flux_to_mag("psfFlux").alias("mag"))
    return stats.histogram(df, "mag", 18.0, 0.25, 16, ["band"])


@query("detector_counts", "SELECT CAST(i AS INT) AS bin, count(f.detector) AS n FROM range(189) r(i) LEFT JOIN forced_source f ON f.detector = i AND f.band = 'r' GROUP BY 1")
def detector_counts(t):
    return stats.histogram(t("forced_source").where("band = 'r'"), "detector", 0.0, 1.0, 189)


@query(
    "moments_by_bin",
    f"""WITH s AS (SELECT band, CAST(floor({MAG}) AS BIGINT) AS mag_bin, count(psfFluxErr) AS n, sum(psfFluxErr) AS s, sum(psfFluxErr * psfFluxErr) AS ss FROM forced_source GROUP BY 1, 2),
       v AS (SELECT *, s / n AS mean, ss / n - (s / n) * (s / n) AS variance FROM s)
       SELECT band, mag_bin, n, R4(s) AS s, R4(ss) AS ss, R6(mean) AS mean, R4(variance) AS variance, R6(sqrt(greatest(0, variance))) AS std, R6(sqrt(2 * variance / nullif(n - 1, 0)) / 2) AS std_err FROM v""",
)
def moments_by_bin(t):
    df = t("forced_source").withColumn("mag_bin", F.floor(ph.flux_to_mag("psfFlux")))
    m = stats.moments(df, "psfFluxErr", ["band", "mag_bin"])
    return rounded(m, 6, s=4, ss=4, variance=4)


@query(
    "percentiles_by_bin",
    f"""SELECT half_bin, R6(quantile_cont(psfFluxErr, 0.16)) AS q16, R6(quantile_cont(psfFluxErr, 0.5)) AS q50, R6(quantile_cont(psfFluxErr, 0.84)) AS q84, count(*) AS n
       FROM (SELECT CAST(ceil(({MAG} - 16e0) / 0.5e0) AS BIGINT) AS half_bin, psfFluxErr FROM forced_source) GROUP BY 1 HAVING count(*) >= 100""",
)
def percentiles_by_bin(t):
    df = t("forced_source").withColumn("half_bin", F.ceil((ph.flux_to_mag("psfFlux") - 16.0) / 0.5))
    return rounded(stats.percentiles_by_bin(df, "psfFluxErr", "half_bin", {"q16": 0.16, "q50": 0.5, "q84": 0.84}, 100))


@query("weighted_mean", "SELECT objectId, band, R6(sum(psfFlux / (psfFluxErr * psfFluxErr)) / sum(1 / (psfFluxErr * psfFluxErr))) AS wmean FROM forced_source GROUP BY 1, 2")
def weighted_mean(t):
    return rounded(t("forced_source").groupBy("objectId", "band").agg(ph.weighted_mean("psfFlux", "psfFluxErr").alias("wmean")))


@query(
    "median_clip",
    """WITH m AS (SELECT objectId, band, median(psfFlux) AS med, median(psfFluxErr) AS mederr FROM forced_source GROUP BY 1, 2)
       SELECT f.objectId, f.band, f.visit, R6(f.psfFlux) AS psfFlux FROM forced_source f JOIN m USING (objectId, band) WHERE abs(psfFlux - med) <= 5 * mederr""",
)
def median_clip(t):
    return rounded(stats.median_clip(t("forced_source"), "psfFlux", "psfFluxErr", ["objectId", "band"]).select("objectId", "band", "visit", "psfFlux"))


@query("arg_extreme", "SELECT objectId, band, R6(arg_max(mjd, psfFlux)) AS peak_time, R6(max(psfFlux)) AS peak, R6(min(mjd) FILTER (psfFlux >= 300 * psfFluxErr)) AS first_detection FROM forced_source GROUP BY 1, 2")
def arg_extreme(t):
    return rounded(t("forced_source").groupBy("objectId", "band").agg(
        F.max_by("mjd", "psfFlux").alias("peak_time"), F.max("psfFlux").alias("peak"), F.min(F.when(F.col("psfFlux") >= 300 * F.col("psfFluxErr"), F.col("mjd"))).alias("first_detection")))


@query("row_count_audit", "SELECT objectId, count(*) AS flat, count(*) AS nested, true AS agree FROM forced_source GROUP BY 1")
def row_count_audit(t):
    flat = t("forced_source").groupBy("objectId").agg(F.count(F.lit(1)).alias("flat"))
    nest = pack(t("forced_source"), ["objectId"], ["visit"], ["mjd"]).groupBy("objectId").agg(F.sum(F.size("lc")).alias("nested"))
    return flat.join(nest, "objectId", "full_outer").withColumn("agree", F.col("flat").eqNullSafe(F.col("nested")))


@query(
    "error_budget",
    f"""WITH d AS (SELECT objectId, band, mjd, psfFlux, psfFluxErr, lag(psfFlux) OVER w AS pf, lag(mjd) OVER w AS pm FROM forced_source WINDOW w AS (PARTITION BY objectId, band ORDER BY mjd, visit)),
       g AS (SELECT CAST(floor({MAG} * 2) AS BIGINT) AS half_bin, {MAG} - (31.4e0 - 2.5e0 * log10(pf)) AS dm, psfFlux, psfFluxErr FROM d WHERE mjd - pm < 10),
       s AS (SELECT half_bin, count(*) AS n, quantile_cont(dm, 0.16) AS q16, quantile_cont(dm, 0.5) AS q50, quantile_cont(dm, 0.84) AS q84, avg(psfFlux) AS mf, avg(psfFluxErr) AS me FROM g GROUP BY 1 HAVING count(*) >= 100)
       SELECT half_bin, n, R6((q84 - q16) / 2) AS spread, R6(abs(2.5e0 * log10((mf + me) / (mf - me))) / 2) AS claimed,
         R6(sqrt(greatest(0e0, (q84 - q16) / 2 * (q84 - q16) / 2 - abs(2.5e0 * log10((mf + me) / (mf - me))) / 2 * (abs(2.5e0 * log10((mf + me) / (mf - me))) / 2)))) AS excess FROM s""",
)
def error_budget(t):
    d = series.consecutive_diff(t("forced_source"), max_gap=10.0)
    mag = ph.flux_to_mag("psfFlux")
    g = d.select(F.floor(mag * 2).alias("half_bin"), (mag - ph.flux_to_mag(F.col("psfFlux") - F.col("dflux"))).alias("dm"), "psfFlux", "psfFluxErr")
    q = stats.percentiles_by_bin(g, "dm", "half_bin", {"q16": 0.16, "q50": 0.5, "q84": 0.84}, 100)
    e = g.groupBy("half_bin").agg(F.avg("psfFlux").alias("mf"), F.avg("psfFluxErr").alias("me"))
    j = same_keys(q, e, ["half_bin"], "inner")
    j = j.withColumn("spread", (F.col("q84") - F.col("q16")) / 2).withColumn("claimed", ph.mag_error("mf", "me"))
    return rounded(j.select("half_bin", "n", "spread", "claimed", F.sqrt(F.greatest(F.lit(0.0), F.col("spread") * F.col("spread") - F.col("claimed") * F.col("claimed"))).alias("excess")))


@query(
    "group_sample",
    f"""WITH h AS (SELECT objectId, visit, band, mjd, {scatter_sql("visit", 11)} AS h FROM forced_source)
      SELECT objectId, visit, band, R6(mjd) AS mjd, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY objectId ORDER BY h, visit, mjd) AS INT) AS rank FROM h) WHERE rank <= 5""",
)
def group_sample(t):
    """Five rows per object, chosen by a scattered row key and seed; the same rows on every run."""
    df = t("forced_source").select("objectId", "visit", "band", "mjd").withColumn("h", F.expr(scatter_sql("visit", 11)))
    return top_k(df, ["objectId"], ["h", "visit", "mjd"], 5).drop("h").withColumn("mjd", rnd("mjd"))


@query(
    "cadence_topk",
    """WITH c AS (SELECT objectId, band, count(*) AS n, R6(count(*) / (max(mjd) - min(mjd))) AS cadence FROM forced_source GROUP BY 1, 2 HAVING max(mjd) > min(mjd))
       SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY band ORDER BY cadence DESC, objectId) AS INT) AS rank FROM c) WHERE rank <= 10""",
)
def cadence_topk(t):
    c = t("forced_source").groupBy("objectId", "band").agg(F.count(F.lit(1)).alias("n"), (F.max("mjd") - F.min("mjd")).alias("span")).where("span > 0")
    c = c.withColumn("cadence", rnd(F.col("n") / F.col("span"))).drop("span")
    return top_k(c, ["band"], [F.desc("cadence"), "objectId"], 10)


@query(
    "color_fraction",
    """WITH c AS (SELECT objectId, 2.5e0 * log10(avg(psfFlux) FILTER (band = 'r') / avg(psfFlux) FILTER (band = 'g')) AS gr FROM forced_source GROUP BY 1)
       SELECT CASE WHEN gr > 0 THEN 'red' ELSE 'blue' END AS class, count(*) AS n, R6(avg(CASE WHEN psfFlux > 200 * psfFluxErr THEN 1e0 ELSE 0e0 END)) AS share FROM forced_source JOIN c USING (objectId) GROUP BY 1""",
)
def color_fraction(t):
    f = t("forced_source")
    f = with_stats(f, ["objectId"], g=F.avg(F.when(F.col("band") == "g", F.col("psfFlux"))), r=F.avg(F.when(F.col("band") == "r", F.col("psfFlux"))))
    f = f.withColumn("class", F.when(ph.color("g", "r") > 0, "red").otherwise("blue"))
    return f.groupBy("class").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg(F.when(ph.snr("psfFlux", "psfFluxErr") > 200, 1.0).otherwise(0.0))).alias("share"))


@query(
    "wide_to_long",
    """SELECT objectId, band, R6(avg(psfFlux)) AS value, 'mean' AS origin FROM forced_source GROUP BY 1, 2
       UNION ALL SELECT objectId, band, R6(psfFlux), 'row' FROM dia_source WHERE psfFlux > 3000""",
)
def wide_to_long(t):
    wide = t("forced_source").groupBy("objectId").pivot("band", list(BANDS)).agg(F.avg("psfFlux"))
    long = wide.unpivot(["objectId"], list(BANDS), "band", "value").where("value IS NOT NULL").withColumn("origin", F.lit("mean"))
    rows = flatten(pack(t("dia_source"), ["objectId"], ["band", "psfFlux"], ["mjd", "diaSourceId"]), "lc").where("psfFlux > 3000")
    return rounded(long.unionByName(rows.select("objectId", "band", F.col("psfFlux").alias("value"), F.lit("row").alias("origin"))))


# ---- ordered functions

_LAG = "SELECT *, lag(mjd) OVER w AS pm, lag(psfFlux) OVER w AS pf FROM forced_source WINDOW w AS (PARTITION BY objectId, band ORDER BY mjd, visit)"


@query("consecutive_diff", f"SELECT objectId, band, visit, R6(mjd - pm) AS dt, R4(psfFlux - pf) AS dflux FROM ({_LAG}) WHERE mjd - pm < 5")
def consecutive_diff(t):
    return rounded(series.consecutive_diff(t("forced_source"), max_gap=5.0).select("objectId", "band", "visit", "dt", "dflux"), 6, dflux=4)


@query(
    "phase_fold",
    """WITH p AS (SELECT *, 0.3e0 + objectId % 10 * 0.05e0 AS period, max(mjd) OVER (PARTITION BY objectId, band) AS dummy FROM periodic_source),
       r AS (SELECT objectId, band, arg_max(mjd, psfFlux) AS t0 FROM periodic_source GROUP BY 1, 2)
       SELECT objectId, band, R6(mjd) AS mjd, R6((mjd - t0) / period - floor((mjd - t0) / period)) AS phase FROM p JOIN r USING (objectId, band)""",
)
def phase_fold(t):
    df = t("periodic_source").withColumn("period", 0.3 + F.col("objectId") % 10 * 0.05)
    return rounded(series.phase_fold(df, "period").select("objectId", "band", "mjd", "phase"))


def _clip_sql():
    # more passes than any group needs: the last ones change nothing
    ctes = ["c0 AS (SELECT objectId, band, visit, psfFlux FROM forced_source)"]
    for i in range(40):
        ctes.append(f"c{i + 1} AS MATERIALIZED (SELECT c.* FROM c{i} c JOIN (SELECT objectId, band, avg(psfFlux) AS m, stddev_samp(psfFlux) AS s FROM c{i} GROUP BY 1, 2) USING (objectId, band) WHERE abs(psfFlux - m) < 1.8e0 * s)")
    return "WITH " + ", ".join(ctes) + " SELECT objectId, band, visit, R6(psfFlux) AS psfFlux FROM c40"


@query("sigma_clip", _clip_sql())
def sigma_clip(t):
    df = t("forced_source").select("objectId", "band", "visit", "psfFlux")
    return rounded(stats.sigma_clip(df, ["objectId", "band"], "psfFlux", 1.8))


@query("unique_time", "SELECT objectId, band, R6(night) AS night, visit FROM (SELECT objectId, band, floor(mjd / 10) * 10 AS night, visit, row_number() OVER (PARTITION BY objectId, band, floor(mjd / 10) ORDER BY visit) AS rn FROM forced_source) WHERE rn = 1")
def unique_time(t):
    df = t("forced_source").select("objectId", "band", (F.floor(F.col("mjd") / 10) * 10.0).alias("night"), "visit")
    return rounded(series.unique_time(df, "night"))


@query("nights_detected", "SELECT objectId, count(DISTINCT CASE WHEN abs(psfDiffFlux) >= 5 * psfDiffFluxErr THEN floor(mjd) END) AS nights FROM dia_source GROUP BY 1")
def nights_detected(t):
    return series.nights_detected(t("dia_source"), "mjd", "psfDiffFlux", "psfDiffFluxErr")


_NIGHT = "SELECT objectId, band, CAST(floor(mjd) AS BIGINT) AS night, avg(mjd) AS mjd, sum(psfFlux / (psfFluxErr * psfFluxErr)) / sum(1 / (psfFluxErr * psfFluxErr)) AS psfFlux, sqrt(count(*) / sum(1 / (psfFluxErr * psfFluxErr))) AS psfFluxErr, count(*) AS n FROM periodic_source GROUP BY 1, 2, 3"


@query("night_bins", f"SELECT objectId, band, night, R6(mjd) AS mjd, R6(psfFlux) AS psfFlux, R6(psfFluxErr) AS psfFluxErr, n FROM ({_NIGHT})")
def night_bins(t):
    return rounded(series.night_bins(t("periodic_source")))


@query(
    "baseline_subtract",
    """WITH b AS (SELECT objectId, band, sum(psfDiffFlux / (psfDiffFluxErr * psfDiffFluxErr)) / sum(1 / (psfDiffFluxErr * psfDiffFluxErr)) AS base,
         sqrt(1 / avg(1 / (psfDiffFluxErr * psfDiffFluxErr)) + stddev_samp(psfDiffFlux) * stddev_samp(psfDiffFlux)) AS base_err FROM dia_source WHERE mjd < (SELECT quantile_cont(mjd, 0.5) FROM dia_source) GROUP BY 1, 2),
       s AS (SELECT d.*, psfDiffFlux - base AS adjusted, (psfDiffFlux - base) / sqrt(psfDiffFluxErr * psfDiffFluxErr + base_err * base_err) AS s2n FROM dia_source d LEFT JOIN b USING (objectId, band))
       SELECT objectId, band, R6(min(mjd) FILTER (s2n >= 1)) AS first_detection, R4(max(adjusted)) AS peak, R6(max(s2n)) AS best FROM s GROUP BY 1, 2""",
)
def baseline_subtract(t):
    d = t("dia_source")
    cut = percentiles(d.withColumn("all", F.lit(1)), ["all"], "mjd", {"q": 0.5}).first()["q"]
    s = series.baseline_subtract(d, cut)
    g = s.groupBy("objectId", "band").agg(F.min(F.when(F.col("s2n") >= 1, F.col("mjd"))).alias("first_detection"), F.max("adjusted").alias("peak"), F.max("s2n").alias("best"))
    return rounded(g, 6, peak=4)


@query(
    "cusum",
    """WITH s AS (SELECT *, avg(psfFlux) OVER (PARTITION BY objectId, band) AS m, stddev_samp(psfFlux) OVER (PARTITION BY objectId, band) AS sd, count(*) OVER (PARTITION BY objectId, band) AS n FROM forced_source),
       r AS (SELECT *, sum(psfFlux - m) OVER (PARTITION BY objectId, band ORDER BY mjd, visit ROWS UNBOUNDED PRECEDING) AS run FROM s)
       SELECT objectId, band, R6((max(run) - min(run)) / (max(n) * max(sd))) AS cusum FROM r GROUP BY 1, 2""",
)
def cusum(t):
    return rounded(series.cusum(t("forced_source")))


# ---- residual studies

@query(
    "variability_prefilter",
    f"""WITH n AS (SELECT objectId, count(*) AS nobs FROM forced_source GROUP BY 1), r AS (SELECT objectId, psfFlux, psfFluxErr, row_number() OVER (PARTITION BY objectId, mjd ORDER BY visit) AS rn FROM forced_source WHERE band = 'r'),
       u AS (SELECT *, sum(psfFlux / (psfFluxErr * psfFluxErr)) OVER (PARTITION BY objectId) / sum(1 / (psfFluxErr * psfFluxErr)) OVER (PARTITION BY objectId) AS wm FROM r WHERE rn = 1),
       s AS (SELECT objectId, count(*) AS nobs_band, sum(power((psfFlux - wm) / psfFluxErr, 2)) / (count(*) - 1) AS rchi2, quantile_cont(psfFlux, 0.95) - quantile_cont(psfFlux, 0.05) AS amplitude FROM u GROUP BY 1)
       SELECT objectId, nobs, nobs_band, R4(rchi2) AS rchi2, R4(amplitude) AS amplitude FROM n JOIN s USING (objectId) WHERE nobs >= 50 AND nobs_band >= 100 AND amplitude > 10 AND rchi2 >= 2""",
)
def variability_prefilter(t):
    return rounded(series.variability_prefilter(t("forced_source"), "r", "mjd", "psfFlux", "psfFluxErr", min_nobs_band=100, min_amplitude=10.0), 4)


@query(
    "relative_deviation",
    """WITH d AS (SELECT objectId, band, diaSourceId, psfDiffFlux AS f, psfDiffFluxErr AS e FROM dia_source),
       s AS (SELECT *, avg(f) OVER w AS m, sum(f / (e * e)) OVER w / sum(1 / (e * e)) OVER w AS wm, count(*) OVER w AS n FROM d WINDOW w AS (PARTITION BY objectId, band)),
       v AS (SELECT *, max(abs((f - m) / e)) OVER (PARTITION BY objectId, band) AS mv FROM s)
       SELECT objectId, band, diaSourceId, R6(wm) AS wmean_flux, R6(mv) AS max_variability, R6((f - wm) / e) AS rel_dev FROM v WHERE n > 5 AND mv < 40""",
)
def relative_deviation(t):
    d = t("dia_source")
    r = series.relative_deviation(d, "psfDiffFlux", "psfDiffFluxErr", max_variability=40.0, min_obs=5)
    return rounded(r.select("objectId", "band", "diaSourceId", "wmean_flux", "max_variability", "rel_dev"))


@query(
    "whitened_residuals",
    """WITH s AS (SELECT *, 1 / (psfFluxErr * psfFluxErr) AS w FROM forced_source),
       r AS (SELECT *, sum(w) OVER p AS bw, sum(w * psfFlux) OVER p / sum(w) OVER p AS m FROM s WINDOW p AS (PARTITION BY objectId, band ORDER BY mjd, visit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       SELECT objectId, band, visit, R4((psfFlux - m) / sqrt(psfFluxErr * psfFluxErr + 1 / bw)) AS whitened FROM r WHERE bw IS NOT NULL""",
)
def whitened_residuals(t):
    return rounded(series.whitened_residuals(t("forced_source")).select("objectId", "band", "visit", "whitened"), 4)


@query(
    "detector_rel_diff",
    """WITH o AS (SELECT objectId, band, avg(psfFlux) AS objFlux, avg(psfFluxErr) AS objErr, bool_or(visit % 400 = 0) AS bad FROM forced_source GROUP BY 1, 2),
       z AS (SELECT band, detector, CASE WHEN bad THEN 0e0 ELSE (psfFlux - objFlux) / sqrt(psfFluxErr * psfFluxErr + objErr * objErr) END AS z FROM forced_source JOIN o USING (objectId, band))
       SELECT band, detector, count(*) AS n, R4(sum(z)) AS s, R4(avg(z)) AS mean, R3(sum(z * z) / count(*) - avg(z) * avg(z)) AS variance FROM z GROUP BY 1, 2""",
)
def detector_rel_diff(t):
    f = t("forced_source")
    objects = f.groupBy("objectId", "band").agg(F.avg("psfFlux").alias("objFlux"), F.avg("psfFluxErr").alias("objErr"))
    holes = f.withColumn("psfFluxErr", F.when(F.col("visit") % 400 != 0, F.col("psfFluxErr")))
    m = series.detector_rel_diff(holes, objects)
    return rounded(m.select("band", "detector", "n", "s", "mean", "variance"), 4, variance=3)


@query(
    "brightness_check",
    f"""SELECT f.objectId, bool_or(abs({MAG} - (31.4e0 - 2.5e0 * log10(m))) > 1) AS any_greater, R6(max(abs({MAG} - (31.4e0 - 2.5e0 * log10(m))))) AS max_mag_sep, R6(stddev_samp({MAG})) AS mag_std
       FROM forced_source f JOIN (SELECT objectId, avg(psfFlux) AS m FROM forced_source WHERE band = 'i' GROUP BY 1) USING (objectId) WHERE band = 'r' GROUP BY 1""",
)
def brightness_check(t):
    f = t("forced_source")
    ref = f.where("band = 'i'").groupBy("objectId").agg(F.avg("psfFlux").alias("m")).select("objectId", ph.flux_to_mag("m").alias("ref"))
    r = f.where("band = 'r'").withColumn("mag", ph.flux_to_mag("psfFlux")).join(ref, "objectId")
    return rounded(series.brightness_check(r, "mag", "ref"))
