"""Filters, projections, scalar functions, sorts and set operations."""

from __future__ import annotations


from pyspark.sql import functions as F

from starloom.functions import photometry as ph
from starloom.functions import timefn
from starloom.operators.columns import any_flag, cast_narrow, shape_ellipse
from starloom.operators.ordered import percentiles, top_k
from starloom.plans.registry import query, rnd, scatter_sql
from starloom.sources.readers import query as text_query


@query("filter_query", "SELECT objectId, visit, band, R6(psfFlux) AS psfFlux FROM forced_source WHERE (band = 'r' OR band = 'i') AND psfFluxErr < 200 AND NOT psfFlux_flag")
def filter_query(t):
    df = text_query(t("forced_source"), "(band == 'r' | band == 'i') & psfFluxErr < 200 and ~psfFlux_flag")
    return df.select("objectId", "visit", "band", rnd("psfFlux").alias("psfFlux"))


@query("filter_mask", "SELECT objectId, visit, detector FROM forced_source WHERE psfFlux < 20000 AND detector <> 9")
def filter_mask(t):
    df = t("forced_source")
    return df.where((F.col("psfFlux") < 20000) & (F.col("detector") != 9)).select("objectId", "visit", "detector")


@query("any_flag_filter", "SELECT objectId, visit, band FROM forced_source WHERE NOT (psfFlux_flag OR pixelFlags_bad)")
def any_flag_filter(t):
    df = t("forced_source")
    return df.where(~any_flag(df)).select("objectId", "visit", "band")


@query(
    "quality_cut",
    """SELECT o.objectId, v.expMidptMJD IS NOT NULL AS timed, R6(o.psfFlux) AS psfFlux FROM forced_source o
       JOIN visit v ON o.visit = v.visitId WHERE o.band = 'r' AND NOT pixelFlags_bad AND v.expMidptMJD IS NOT NULL""",
)
def quality_cut(t):
    v = t("visit").withColumnRenamed("visitId", "visit")
    df = t("forced_source").where("band = 'r' AND NOT pixelFlags_bad").join(v, "visit", "left").dropna(subset=["expMidptMJD", "psfFlux"])
    return df.select("objectId", F.col("expMidptMJD").isNotNull().alias("timed"), rnd("psfFlux").alias("psfFlux"))


@query("filter_isin", "SELECT objectId, visit, band FROM forced_source WHERE band IN ('g', 'r', 'i') AND objectId IN (SELECT objectId FROM sky_object WHERE refBand = 'BUILDING')")
def filter_isin(t):
    wanted = t("sky_object").where(F.col("refBand") == "BUILDING").select("objectId")
    return t("forced_source").where(F.col("band").isin("g", "r", "i")).join(wanted, "objectId", "left_semi").select("objectId", "visit", "band")


@query(
    "project_assign",
    """SELECT objectId AS objectId_obj, R6(CASE WHEN r_psfFlux > 0 THEN 31.4e0 - 2.5e0 * log10(r_psfFlux) ELSE 30e0 END) AS mag_obj,
       refBand AS band_obj FROM sky_object""",
)
def project_assign(t):
    df = t("sky_object").withColumn("mag", F.coalesce(ph.flux_to_mag("r_psfFlux"), F.lit(30.0)))
    df = df.withColumnRenamed("refBand", "band").drop("ra", "dec", "r_psfFlux").withColumn("mag", rnd("mag"))
    return df.withColumnsRenamed({c: c + "_obj" for c in df.columns})


@query("cast_narrow", "SELECT objectId, R6(ra) AS ra, R6(dec) AS dec, round(CAST(CAST(r_psfFlux AS FLOAT) AS DOUBLE), 4) AS r_psfFlux, refBand FROM sky_object")
def narrow(t):
    df = cast_narrow(t("sky_object"), keep=["ra", "dec"])
    return df.select("objectId", rnd("ra").alias("ra"), rnd("dec").alias("dec"), F.round(F.col("r_psfFlux").cast("double"), 4).alias("r_psfFlux"), "refBand")


@query("preview_head", "SELECT objectId, visit, R6(mjd) AS mjd FROM forced_source ORDER BY mjd, objectId, visit LIMIT 100")
def preview_head(t):
    return t("forced_source").orderBy("mjd", "objectId", "visit").limit(100).select("objectId", "visit", rnd("mjd").alias("mjd"))


@query("sample_seeded", f"SELECT objectId, visit, band FROM forced_source WHERE {scatter_sql('(visit * 31 + CAST(floor(mjd) AS BIGINT))', 7)} < {2147483647 // 100}")
def sample_seeded(t):
    """About one row in a hundred by a scattered row key, the same rows wherever they lie."""
    return t("forced_source").where(F.expr(scatter_sql("(visit * 31 + CAST(floor(mjd) AS BIGINT))", 7)) < 2147483647 // 100).select("objectId", "visit", "band")


@query(
    "time_window_filter",
    "SELECT objectId, visit, R6(mjd) AS mjd FROM forced_source WHERE mjd > 50000.05 AND mjd < 50100.11 AND psfFluxErr < 300 AND abs(mjd - 50050e0) > 10",
)
def time_window_filter(t):
    df = t("forced_source").where((F.col("mjd") > 50000.05) & (F.col("mjd") < 50100.11) & (F.col("psfFluxErr") < 300))
    return df.where(F.abs(F.col("mjd") - 50050.0) > 10).select("objectId", "visit", rnd("mjd").alias("mjd"))


# ---- scalar functions

@query("flux_to_mag", "SELECT objectId, R6(CASE WHEN r_psfFlux > 0 THEN 31.4e0 - 2.5e0 * log10(r_psfFlux) END) AS mag FROM sky_object")
def flux_to_mag(t):
    return t("sky_object").select("objectId", rnd(ph.flux_to_mag("r_psfFlux")).alias("mag"))


@query(
    "mag_error",
    """SELECT diaSourceId,
       R6(CASE WHEN psfDiffFlux > 0 AND psfDiffFlux - psfDiffFluxErr > 0 THEN
         -((31.4e0 - 2.5e0 * log10(psfDiffFlux + psfDiffFluxErr)) - (31.4e0 - 2.5e0 * log10(psfDiffFlux - psfDiffFluxErr))) / 2 END) AS magErr,
       R6(CASE WHEN psfDiffFlux > 0 THEN 2.5e0 / ln(10e0) * psfDiffFluxErr / psfDiffFlux END) AS magErrLinear FROM dia_source""",
)
def mag_error(t):
    return t("dia_source").select(
        "diaSourceId", rnd(ph.mag_error("psfDiffFlux", "psfDiffFluxErr")).alias("magErr"),
        rnd(ph.mag_error_linear("psfDiffFlux", "psfDiffFluxErr")).alias("magErrLinear"),
    )


@query(
    "mag_to_flux",
    """WITH m AS (SELECT objectId, 15e0 + objectId % 10 + abs(r_psfFlux) / 10000e0 AS mag FROM sky_object)
       SELECT objectId, R6(power(10e0, -0.4e0 * (mag - 31.4e0))) AS flux,
       R6(power(10e0, -0.4e0 * (mag - (SELECT median(mag) FROM m)))) AS rel FROM m""",
)
def mag_to_flux(t):
    m = t("sky_object").select("objectId", (15.0 + F.col("objectId") % 10 + F.abs("r_psfFlux") / 10000.0).alias("mag"))
    m = m.withColumn("one", F.lit(1))
    # the other side is exactly one row
    out = m.join(F.broadcast(percentiles(m, ["one"], "mag", {"med": 0.5})), "one")
    return out.select("objectId", rnd(ph.mag_to_flux("mag", 31.4)).alias("flux"), rnd(ph.mag_to_flux(F.col("mag") - F.col("med"), 0.0)).alias("rel"))


@query(
    "band_zeropoint",
    """WITH z(band, zp) AS (VALUES ('u', 12.652350670009373e0), ('g', 14.689449213373276e0), ('r', 14.559501946792281e0),
         ('i', 14.378976834902065e0), ('z', 13.993052964496345e0), ('y', 13.017367314857484e0))
       SELECT f.objectId, f.visit, f.band, R6(zp - 2.5e0 * log10(f.psfFlux)) AS mag,
         R6(CASE f.band WHEN 'g' THEN 20e0 + 25.8010e0 - 25.6874e0 ELSE NULL END) AS ab
       FROM forced_source f JOIN z USING (band)""",
)
def band_zeropoint(t):
    ab = F.lit(20.0) + ph.by_band("band", {"g": ph.VEGA_TO_AB["g"]})
    return t("forced_source").select("objectId", "visit", "band", rnd(ph.band_magnitude("psfFlux", "band")).alias("mag"), rnd(ab).alias("ab"))


@query(
    "color_index",
    """SELECT a.objectId, R6((31.4e0 - 2.5e0 * log10(a.f)) - (31.4e0 - 2.5e0 * log10(b.f))) AS gr FROM
       (SELECT objectId, avg(psfFlux) f FROM forced_source WHERE band = 'g' GROUP BY objectId) a JOIN
       (SELECT objectId, avg(psfFlux) f FROM forced_source WHERE band = 'r' GROUP BY objectId) b USING (objectId)
       WHERE a.f > 0 AND b.f > 0 AND (31.4e0 - 2.5e0 * log10(a.f)) - (31.4e0 - 2.5e0 * log10(b.f)) BETWEEN -0.1e0 AND 0.5e0""",
)
def color_index(t):
    m = t("forced_source").groupBy("objectId").agg(
        F.avg(F.when(F.col("band") == "g", F.col("psfFlux"))).alias("g"), F.avg(F.when(F.col("band") == "r", F.col("psfFlux"))).alias("r")
    )
    return m.withColumn("gr", ph.color("g", "r")).where(F.col("gr").between(-0.1, 0.5)).select("objectId", rnd("gr").alias("gr"))


@query("snr_cut", "SELECT diaSourceId, R6(psfDiffFlux / psfDiffFluxErr) AS snr FROM dia_source WHERE abs(psfDiffFlux) > 3 * psfDiffFluxErr")
def snr_cut(t):
    df = t("dia_source").where(F.abs("psfDiffFlux") > 3.0 * F.col("psfDiffFluxErr"))
    return df.select("diaSourceId", rnd(ph.snr("psfDiffFlux", "psfDiffFluxErr")).alias("snr"))


@query(
    "value_bins",
    """WITH m AS (SELECT objectId, 31.4e0 - 2.5e0 * log10(psfFlux) AS mag, mjd FROM forced_source)
       SELECT CAST(floor(mag) AS INT) AS mag_bin, CAST(trunc(mjd / 100e0) AS INT) AS z_bin, CAST(trunc(0.5e0 * mag) AS INT) AS mass_bin,
       16e0 + 0.5e0 * (ceil((mag - 16e0) / 0.5e0) - 1) AS half_left, count(*) AS n FROM m GROUP BY 1, 2, 3, 4""",
)
def value_bins(t):
    m = t("forced_source").select(ph.flux_to_mag("psfFlux").alias("mag"), "mjd")
    b = m.select(
        F.floor("mag").cast("int").alias("mag_bin"), (F.col("mjd") / 100.0).cast("int").alias("z_bin"), (0.5 * F.col("mag")).cast("int").alias("mass_bin"),
        (16.0 + 0.5 * (F.ceil((F.col("mag") - 16.0) / 0.5) - 1)).alias("half_left"),
    )
    return b.groupBy("mag_bin", "z_bin", "mass_bin", "half_left").agg(F.count(F.lit(1)).alias("n"))


@query("to_mjd", "SELECT event_id, R6(MJD_(ts)) AS mjd, R6(MJD_(ts) + 2400000.5e0 - 2400000.5e0) AS mjd_from_jd FROM events".replace("MJD_(ts)", "(epoch_us(ts) / 86400e6 + 40587e0)"))
def to_mjd(t):
    m = t("events").select("event_id", timefn.timestamp_to_mjd("ts").alias("mjd"))
    return m.select("event_id", rnd("mjd").alias("mjd"), rnd(timefn.jd_to_mjd(F.col("mjd") + 2400000.5)).alias("mjd_from_jd"))


def _helio_sql():
    steps = "m"
    ctes = ["b AS (SELECT objectId, ra, dec, 50000e0 + objectId AS mjd FROM sky_object)", "k0 AS (SELECT *, radians(357.51716e0) + 2 * pi() / 365.256363004e0 * (mjd - 51544.5e0) AS m FROM b)"]
    prev = "k0"
    for i in range(1, 6):
        e = "m" if i == 1 else f"e{i - 1}"
        ctes.append(f"k{i} AS (SELECT *, {e} - ({e} - 0.0167086e0 * sin({e}) - m) / (1 - 0.0167086e0 * cos({e})) AS e{i} FROM {prev})")
        prev = f"k{i}"
    ctes.append("p AS (SELECT *, 1.000001018e0 * (1 - 0.0167086e0 * cos(e5)) AS r, 2 * atan2(sqrt(1 + 0.0167086e0) * sin(e5 / 2), sqrt(1 - 0.0167086e0) * cos(e5 / 2)) + radians(102.9373e0) AS nu FROM k5)")
    last = """SELECT objectId, R6(mjd + (r * cos(nu) * cos(radians(dec)) * cos(radians(ra)) + r * sin(nu) * (cos(radians(23.4392911e0)) * cos(radians(dec)) * sin(radians(ra))
        + sin(radians(23.4392911e0)) * sin(radians(dec)))) * 499.004783836e0 / 86400e0) AS helioMjd FROM p"""
    del steps
    return "WITH " + ", ".join(ctes) + " " + last


@query("heliocentric_mjd", _helio_sql())
def heliocentric(t):
    df = t("sky_object").select("objectId", "ra", "dec", (50000.0 + F.col("objectId")).alias("mjd"))
    return timefn.heliocentric_mjd(df, "mjd", "ra", "dec").select("objectId", rnd("helioMjd").alias("helioMjd"))


@query(
    "regexp_pixel",
    "SELECT page_id, regexp_extract(url, '([0-9]+)', 1) AS digits, try_cast(regexp_extract(url, '/([a-z]*)([0-9]+)', 2) AS BIGINT) AS number FROM pages",
)
def regexp_pixel(t):
    return t("pages").select(
        "page_id", F.regexp_extract("url", "([0-9]+)", 1).alias("digits"), F.expr("try_cast(regexp_extract(url, '/([a-z]*)([0-9]+)', 2) AS BIGINT)").alias("number")
    )


@query(
    "string_predicates",
    r"SELECT p_partkey, trim(p_type) AS kind, regexp_replace(p_type, '^(STANDARD|SMALL|MEDIUM|LARGE|ECONOMY|PROMO) ', '') AS rest FROM part WHERE starts_with(trim(p_type), 'S') OR starts_with(p_type, 'P')",
)
def string_predicates(t):
    kind = F.trim("p_type")
    df = t("part").where(kind.startswith("S") | F.col("p_type").startswith("P"))
    return df.select("p_partkey", kind.alias("kind"), F.regexp_replace("p_type", "^(STANDARD|SMALL|MEDIUM|LARGE|ECONOMY|PROMO) ", "").alias("rest"))


@query(
    "shape_ellipse",
    """WITH s AS (SELECT l_orderkey, l_linenumber, 4e0 + l_quantity AS xx, 3e0 + l_quantity / 2 AS yy, (l_discount - 0.05e0) * 40 AS xy FROM lineitem WHERE l_tax > 0),
       e AS (SELECT *, (xx + yy) / 2 AS mid, sqrt((xx - yy) * (xx - yy) / 4 + xy * xy) AS half FROM s)
       SELECT l_orderkey, l_linenumber, R6(sqrt(mid + half)) AS a, R6(CASE WHEN mid - half >= 0 THEN sqrt(mid - half) END) AS b, R6(0.5e0 * atan2(2 * xy, xx - yy)) AS theta FROM e""",
)
def ellipse(t):
    s = t("lineitem").where("l_tax > 0").select(
        "l_orderkey", "l_linenumber", (4.0 + F.col("l_quantity")).alias("xx"), (3.0 + F.col("l_quantity") / 2).alias("yy"), ((F.col("l_discount") - 0.05) * 40).alias("xy")
    )
    e = shape_ellipse(s, "xx", "yy", "xy")
    return e.select("l_orderkey", "l_linenumber", rnd("a").alias("a"), rnd("b").alias("b"), rnd("theta").alias("theta"))


# ---- sorts, limits, set operations

@query("sort_global", "SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM sky_object ORDER BY dec DESC, objectId")
def sort_global(t):
    return t("sky_object").orderBy(F.desc("dec"), "objectId").select("objectId", rnd("ra").alias("ra"), rnd("dec").alias("dec"))


@query("topk_limit", "SELECT objectId, visit, band, R6(psfFlux) AS psfFlux FROM forced_source ORDER BY psfFlux DESC, objectId, visit, band LIMIT 200")
def topk_limit(t):
    return t("forced_source").orderBy(F.desc("psfFlux"), "objectId", "visit", "band").limit(200).select("objectId", "visit", "band", rnd("psfFlux").alias("psfFlux"))


@query(
    "topk",
    """SELECT band, objectId, visit, R6(psfFlux) AS psfFlux, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY band ORDER BY psfFlux DESC, objectId, visit, mjd) AS INT) AS rank
       FROM forced_source) WHERE rank <= 5""",
)
def topk(t):
    df = top_k(t("forced_source"), ["band"], [F.desc("psfFlux"), "objectId", "visit", "mjd"], 5)
    return df.select("band", "objectId", "visit", rnd("psfFlux").alias("psfFlux"), "rank")


@query(
    "union_by_name",
    """SELECT objectId AS id, 'object' AS origin, R6(r_psfFlux) AS flux, refBand FROM sky_object UNION ALL
       SELECT otherId, 'other', R6(meanFlux), NULL FROM sky_other""",
)
def union_by_name(t):
    a = t("sky_object").select(F.col("objectId").alias("id"), F.lit("object").alias("origin"), rnd("r_psfFlux").alias("flux"), "refBand")
    b = t("sky_other").select(F.col("otherId").alias("id"), F.lit("other").alias("origin"), rnd("meanFlux").alias("flux"))
    return a.unionByName(b, allowMissingColumns=True)


@query("set_except", "SELECT objectId FROM sky_object EXCEPT SELECT diaObjectId FROM object_version WHERE psfFluxMean > 100000")
def set_except(t):
    return t("sky_object").select("objectId").subtract(t("object_version").where("psfFluxMean > 100000").select(F.col("diaObjectId").alias("objectId")))


@query("set_intersect", "SELECT objectId FROM sky_object INTERSECT SELECT objectId FROM dia_source")
def set_intersect(t):
    return t("sky_object").select("objectId").intersect(t("dia_source").select("objectId"))


@query("distinct_rows", "SELECT DISTINCT detector, band FROM forced_source")
def distinct_rows(t):
    return t("forced_source").select("detector", "band").distinct()


