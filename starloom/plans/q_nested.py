"""Nested light curves and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import joins, nested
from starloom.operators.match import matched_ids
from starloom.operators.stats import count_mismatch
from starloom.plans.registry import query, rnd
from starloom.plans.q_scans import _PAIR

FIELDS = ["visit", "band", "psfFlux", "psfFluxErr", "psfFlux_flag", "pixelFlags_bad", "detector"]
ORDER = ["mjd"]


def packed(t, fields=FIELDS):
    return nested.pack(t("forced_source"), ["objectId"], fields, ORDER)


def summary(df, name="lc", value="psfFlux", keys=("objectId",)):
    """Per-object checks of a nested column, segments added up: count, sum, ends, and the order."""
    return df.groupBy(*keys).agg(
        F.sum(F.coalesce(F.size(name), F.lit(0))).cast("long").alias("n"),
        rnd(F.sum(nested.list_sum(name, lambda x: x[value])), 4).alias("total"),
        rnd(F.min(F.array_min(F.transform(name, lambda x: x["mjd"])))).alias("first"),
        rnd(F.max(F.array_max(F.transform(name, lambda x: x["mjd"])))).alias("last"),
    )


SUMMARY = "count(mjd) AS n, R4(sum(psfFlux)) AS total, R6(min(mjd)) AS first, R6(max(mjd)) AS last"


@query("join_nested", f"SELECT o.objectId, o.refBand, {SUMMARY} FROM sky_object o LEFT JOIN forced_source f USING (objectId) GROUP BY 1, 2")
def join_nested(t):
    df = nested.join_nested(t("sky_object"), t("forced_source"), "objectId", "objectId", FIELDS, ORDER, "lc")
    return summary(df, keys=("objectId", "refBand"))


@query("nest_from_flat", f"SELECT objectId, band, {SUMMARY} FROM forced_source GROUP BY 1, 2")
def nest_from_flat(t):
    return summary(nested.pack(t("forced_source"), ["objectId", "band"], FIELDS, ORDER), keys=("objectId", "band"))


@query(
    "nest_lists",
    """WITH e AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings)
       SELECT vec_id, count(*) AS n, R4(sum(CAST(x AS DOUBLE) * (i + 1))) AS checksum FROM e GROUP BY vec_id""",
)
def nest_lists(t):
    e = t("embeddings").withColumn("pos", F.sequence(F.lit(1), F.size("embedding")))
    z = nested.nest_lists(e, ["embedding", "pos"], "lc")
    return z.select("vec_id", F.size("lc").cast("long").alias("n"), rnd(nested.list_sum("lc", lambda x: x["embedding"].cast("double") * x["pos"]), 4).alias("checksum"))


@query("nested_flatten", "SELECT objectId, visit, band, R6(mjd) AS mjd, detector FROM forced_source")
def nested_flatten(t):
    return nested.flatten(packed(t), "lc").select("objectId", "visit", "band", rnd("mjd").alias("mjd"), "detector")


@query("nested_filter", "SELECT objectId, count(*) FILTER (band = 'r' AND NOT psfFlux_flag) AS n, R4(coalesce(sum(psfFlux) FILTER (band = 'r' AND NOT psfFlux_flag), 0)) AS total FROM forced_source GROUP BY 1")
def nested_filter(t):
    df = nested.filter_nested(packed(t), "lc", lambda x: (x["band"] == "r") & ~x["psfFlux_flag"])
    return summary(df).select("objectId", "n", "total")


@query("nested_dropna", "SELECT objectId, count(*) AS n, R4(sum(psfFlux)) AS total FROM forced_source WHERE psfFlux > 60000 AND detector % 5 <> 0 AND detector % 7 <> 0 GROUP BY 1")
def nested_dropna(t):
    nan = F.when(F.col("detector") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("psfFlux"))
    src = t("forced_source").withColumn("psfFlux", F.when(F.col("detector") % 5 != 0, nan))
    df = nested.dropna_elements(nested.pack(src, ["objectId"], ["psfFlux"], ["mjd", "visit"]), "lc", ["psfFlux"])
    df = nested.drop_empty(nested.filter_nested(df, "lc", lambda x: x["psfFlux"] > 60000), "lc")
    return summary(df).select("objectId", "n", "total")


@query("nested_sort", "SELECT objectId, R6(arg_max(mjd, psfFlux)) AS brightest, R6(arg_min(mjd, psfFlux)) AS faintest, count(*) AS n FROM forced_source GROUP BY 1")
def nested_sort(t):
    df = nested.sort_nested(packed(t), "lc", "psfFlux")
    ends = df.groupBy("objectId").agg(
        F.max_by(F.element_at("lc", -1)["mjd"], F.element_at("lc", -1)["psfFlux"]).alias("b"), F.min_by(F.element_at("lc", 1)["mjd"], F.element_at("lc", 1)["psfFlux"]).alias("f"), F.sum(F.size("lc")).alias("n")
    )
    return ends.select("objectId", rnd("b").alias("brightest"), rnd("f").alias("faintest"), "n")


@query("nested_derive", "SELECT objectId, count(*) AS n, R4(sum(psfFlux / psfFluxErr)) AS snr, R5(sum(mjd - 50000e0)) AS t FROM forced_source GROUP BY 1")
def nested_derive(t):
    df = nested.derive(packed(t), "lc", snr=lambda x: x["psfFlux"] / x["psfFluxErr"], mjd=lambda x: x["mjd"] - 50000.0)
    return df.groupBy("objectId").agg(
        F.sum(F.size("lc")).alias("n"), rnd(F.sum(nested.list_sum("lc", lambda x: x["snr"])), 4).alias("snr"), rnd(F.sum(nested.list_sum("lc", lambda x: x["mjd"])), 5).alias("t")
    )


@query("count_nested", "SELECT o.objectId, count(f.mjd) AS n_lc FROM sky_object o LEFT JOIN forced_source f USING (objectId) GROUP BY 1")
def count_nested(t):
    df = nested.join_nested(t("sky_object"), t("forced_source"), "objectId", "objectId", ["band"], ORDER, "lc")
    return nested.count_nested(df, ["objectId"], "lc")


@query(
    "count_nested_by",
    "SELECT o.objectId, count(*) FILTER (band = 'g') AS n_lc_g, count(*) FILTER (band = 'r') AS n_lc_r, CAST(0 AS BIGINT) AS n_lc_w FROM sky_object o LEFT JOIN forced_source f USING (objectId) GROUP BY 1",
)
def count_nested_by(t):
    df = nested.join_nested(t("sky_object"), t("forced_source"), "objectId", "objectId", ["band"], ORDER, "lc")
    return nested.count_nested(df, ["objectId"], "lc", "band", ["g", "r", "w"])


BANDS = "ugrizy"


@query(
    "nested_split_by",
    "WITH c AS (SELECT objectId, " + ", ".join(f"count(*) FILTER (band = '{b}') AS {b}, R4(coalesce(sum(psfFlux) FILTER (band = '{b}'), 0)) AS {b}_total" for b in BANDS)
    + " FROM forced_source GROUP BY 1) SELECT * FROM c WHERE " + " OR ".join(f"{b} >= 100" for b in BANDS),
)
def nested_split_by(t):
    df = nested.split_by(nested.select_fields(packed(t), "lc", ["mjd", "band", "psfFlux"]), "lc", "band", list(BANDS))
    df = nested.long_enough(df, ["objectId"], [f"lc_{b}" for b in BANDS], 100)
    counts = [F.sum(F.size(f"lc_{b}")).alias(b) for b in BANDS]
    totals = [rnd(F.sum(nested.list_sum(f"lc_{b}", lambda x: x["psfFlux"])), 4).alias(f"{b}_total") for b in BANDS]
    return df.groupBy("objectId").agg(*counts, *totals)


@query(
    "nested_result",
    "SELECT objectId, count(*) AS n, R4(sum((psfFlux - m) / psfFluxErr)) AS total, R4(max(abs((psfFlux - m) / psfFluxErr))) AS largest FROM forced_source JOIN (SELECT objectId, avg(psfFlux) AS m FROM forced_source GROUP BY 1) USING (objectId) GROUP BY 1",
)
def nested_result(t):
    p = packed(t, ["psfFlux", "psfFluxErr"])
    mean = p.groupBy("objectId").agg((F.sum(nested.list_sum("lc", lambda x: x["psfFlux"])) / F.sum(F.size("lc"))).alias("m"))
    df = p.join(mean, "objectId").withColumn("result", F.transform("lc", lambda x: F.struct(x["mjd"].alias("mjd"), ((x["psfFlux"] - F.col("m")) / x["psfFluxErr"]).alias("z"))))
    return df.groupBy("objectId").agg(
        F.sum(F.size("result")).alias("n"), rnd(F.sum(nested.list_sum("result", lambda x: x["z"])), 4).alias("total"), rnd(F.max(F.array_max(F.transform("result", lambda x: F.abs(x["z"])))), 4).alias("largest")
    )


# ---- joins

@query("join_inner", "SELECT f.objectId, f.diaSourceId, R6(f.mjd) AS mjd, R6(o.r_psfFlux) AS psfFlux_obj FROM dia_source f JOIN sky_object o USING (objectId)")
def join_inner(t):
    o = t("sky_object").select("objectId", F.col("r_psfFlux").alias("psfFlux"))
    j = joins.join(t("dia_source"), o, "objectId", "objectId", ("", "_obj"))
    return j.select("objectId", "diaSourceId", rnd("mjd").alias("mjd"), rnd("psfFlux_obj").alias("psfFlux_obj"))


@query("join_left", "SELECT o.objectId, refBand, n FROM sky_object o LEFT JOIN (SELECT objectId, count(*) AS n FROM dia_source GROUP BY 1) d USING (objectId)")
def join_left(t):
    n = t("dia_source").groupBy("objectId").agg(F.count(F.lit(1)).alias("n"))
    return t("sky_object").join(n, "objectId", "left").select("objectId", "refBand", "n")


@query("join_full_outer", "SELECT objectId, a.n AS n_dia, b.n AS n_version FROM (SELECT objectId, count(*) AS n FROM dia_source GROUP BY 1) a FULL JOIN (SELECT diaObjectId AS objectId, count(*) AS n FROM object_version GROUP BY 1) b USING (objectId)")
def join_full_outer(t):
    a = t("dia_source").groupBy("objectId").agg(F.count(F.lit(1)).alias("n_dia"))
    b = t("object_version").groupBy(F.col("diaObjectId").alias("objectId")).agg(F.count(F.lit(1)).alias("n_version"))
    return a.join(b, "objectId", "full_outer")


@query("join_semi", "SELECT objectId, refBand FROM sky_object WHERE objectId IN (SELECT objectId FROM dia_source WHERE psfDiffFlux > 20000)")
def join_semi(t):
    return t("sky_object").join(t("dia_source").where("psfDiffFlux > 20000").select("objectId"), "objectId", "left_semi").select("objectId", "refBand")


@query(
    "count_mismatch",
    """SELECT objectId, a.n AS n_a, b.n AS n_b FROM (SELECT objectId, count(*) AS n FROM dia_source GROUP BY 1) a FULL JOIN
       (SELECT objectId, count(*) AS n FROM dia_source WHERE psfDiffFlux < 15000 GROUP BY 1) b USING (objectId) WHERE a.n IS DISTINCT FROM b.n""",
)
def mismatch(t):
    a = t("dia_source").groupBy("objectId").agg(F.count(F.lit(1)).alias("n_a"))
    b = t("dia_source").where("psfDiffFlux < 15000").groupBy("objectId").agg(F.count(F.lit(1)).alias("n_b"))
    return count_mismatch(a, b, ["objectId"])


@query("visit_time_lookup", "SELECT objectId, visit, R6(expMidptMJD) AS midpointMjdTai FROM forced_source LEFT JOIN visit v ON visit = v.visitId")
def visit_time_lookup(t):
    return joins.visit_time_lookup(t("forced_source"), t("visit")).select("objectId", "visit", rnd("midpointMjdTai").alias("midpointMjdTai"))


@query("lookup_distinct", "SELECT f.objectId, f.visit, f.band, d.detector FROM forced_source f JOIN (SELECT DISTINCT visit, detector FROM forced_source WHERE band = 'u') d USING (visit)")
def lookup_distinct(t):
    f = t("forced_source")
    return joins.lookup_distinct(f.select("objectId", "visit", "band"), f.where("band = 'u'"), "visit", ["detector"]).select("objectId", "visit", "band", "detector")


@query("join_split_tables", "SELECT objectId, R6(ra) AS ra, R6(r_psfFlux) AS r_psfFlux FROM sky_object")
def join_split_tables(t):
    from starloom.session import scratch_path

    path = scratch_path(t.spark, "split")
    o = t("sky_object").withColumn("pixel", F.col("objectId") % 8)
    o.select("objectId", "ra", "pixel").write.partitionBy("pixel").parquet(f"{path}/positions")
    o.select("objectId", "r_psfFlux", "pixel").write.partitionBy("pixel").parquet(f"{path}/fluxes")
    a, b = t.spark.read.parquet(f"{path}/positions"), t.spark.read.parquet(f"{path}/fluxes")
    return a.join(b, ["pixel", "objectId"]).select("objectId", rnd("ra").alias("ra"), rnd("r_psfFlux").alias("r_psfFlux"))


@query(
    "association_join",
    f"""WITH p AS (SELECT a.objectId, b.otherId, {_PAIR} AS d FROM sky_object a JOIN sky_other b ON abs(a.dec - b.dec) < 0.001e0 AND {_PAIR} <= 1e0),
       k AS (SELECT *, row_number() OVER (PARTITION BY objectId ORDER BY d, otherId) AS rn FROM p)
       SELECT otherId, {SUMMARY} FROM k JOIN forced_source USING (objectId) WHERE rn = 1 GROUP BY 1""",
)
def association_join(t):
    m = matched_ids(t("sky_object"), t("sky_other"), ("objectId", "ra", "dec"), ("otherId", "ra", "dec"), 1.0).select(F.col("lid").alias("objectId"), F.col("rid").alias("otherId"))
    j = joins.association_join(t("sky_other").select("otherId"), m.select("objectId", "otherId"), t("forced_source"), "otherId", "objectId")
    return summary(nested.pack(j, ["otherId"], ["objectId", "psfFlux"], ["mjd", "visit"]), keys=("otherId",))


@query(
    "pair_self_join",
    """SELECT a.objectId, a.band, a.visit AS visit1, b.visit AS visit2, R6(b.mjd - a.mjd) AS dt, R4(b.psfFlux - a.psfFlux) AS df
       FROM forced_source a JOIN forced_source b ON a.objectId = b.objectId AND a.band = b.band AND b.mjd > a.mjd AND b.mjd - a.mjd <= 20""",
)
def pair_self_join(t):
    p = joins.close_in_time(t("forced_source"), ["objectId", "band"], "mjd", "visit", ["psfFlux"], 20.0)
    return p.select("objectId", "band", "visit1", "visit2", rnd("dt").alias("dt"), rnd(F.col("psfFlux2") - F.col("psfFlux1"), 4).alias("df"))


@query(
    "nearest_time_join",
    """WITH g AS (SELECT objectId, i AS grid, 50000e0 + i * 200 AS gt FROM (SELECT DISTINCT objectId FROM forced_source) o, range(11) r(i)),
       d AS (SELECT g.objectId, g.grid, g.gt, f.mjd, f.visit, f.psfFlux, row_number() OVER (PARTITION BY g.objectId, g.grid ORDER BY abs(f.mjd - gt), f.mjd, f.visit) AS rn FROM g JOIN forced_source f USING (objectId))
       SELECT objectId, CAST(grid AS INT) AS grid, R6(gt) AS grid_time, R6(mjd) AS mjd, R6(psfFlux) AS psfFlux FROM d WHERE rn = 1""",
)
def nearest_time_join(t):
    df = joins.nearest_in_time(t("forced_source"), ["objectId"], "mjd", "psfFlux", 50000.0, 52000.0, 200.0, "visit")
    return df.select("objectId", "grid", rnd("grid_time").alias("grid_time"), rnd("mjd").alias("mjd"), rnd("psfFlux").alias("psfFlux"))
