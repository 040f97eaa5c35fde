"""Sky tiling, region searches and positional matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.healpix import ancestor, with_healpix
from starloom.functions.sphere import propagate, separation_arcsec
from starloom.operators import coverage, match, regions, tiling
from starloom.operators.ordered import percentiles
from starloom.plans.q_scans import HEALPIX_CTES, OBJ_INFO, TILE_CTES, _PAIR, _tiled_sql
from starloom.plans.registry import query, rnd
from starloom.session import scratch_path
from starloom.sources import catalogs

L_ON, R_ON = ("objectId", "ra", "dec"), ("otherId", "ra", "dec")


def hp(order: int) -> str:
    return HEALPIX_CTES.format(order=order, ns=1 << order, mask=(1 << order) - 1)


def dist(ra: float, dec: float) -> str:
    return (
        f"degrees(2 * asin(least(1e0, sqrt(power(sin(radians(dec - ({dec}e0)) / 2), 2) + cos(radians(dec)) * cos(radians({dec}e0)) "
        f"* power(sin(radians(ra - {ra}e0) / 2), 2))))) * 3600"
    )


def positions(df, *keep):
    return df.select("objectId", rnd("ra").alias("ra"), rnd("dec").alias("dec"), *keep)


@query("healpix_index", hp(29) + " SELECT objectId, pixel, pixel >> 42 AS pixel8 FROM hp")
def healpix_index(t):
    return with_healpix(t("sky_object"), "ra", "dec", name="pixel").select("objectId", "pixel", ancestor("pixel", 8).alias("pixel8"))


@query("pixel_ancestor", hp(8) + " SELECT objectId, pixel AS p8, pixel >> 6 AS p5, pixel >> 16 AS p0 FROM hp")
def pixel_ancestor(t):
    df = with_healpix(t("sky_object"), "ra", "dec", 8, "p8")
    return df.select("objectId", "p8", ancestor("p8", 5, 8).alias("p5"), ancestor("p8", 0, 8).alias("p0"))


def _tiles(t, threshold, max_order):
    df = with_healpix(t("sky_object"), "ra", "dec")
    return tiling.adaptive_tiles(tiling.pixel_counts(df, max_order), threshold, max_order)


@query("adaptive_tiles", _tiled_sql("SELECT CAST(ord AS INT) AS Norder, pix AS Npix, n AS rows FROM tiles"))
def adaptive_tiles(t):
    return _tiles(t, 40, 5).select(F.col("order").alias("Norder"), F.col("pixel").alias("Npix"), F.col("n").alias("rows"))


@query("retile", hp(6) + ", " + TILE_CTES.format(max=6, thr=8) + " SELECT CAST(ord AS INT) AS Norder, CAST(pix AS INT) AS Npix, n AS rows FROM tiles")
def retile(t):
    path = scratch_path(t.spark, "retile")
    catalogs.write_catalog(t("sky_object"), f"{path}/coarse", catalogs.CatalogInfo(**(OBJ_INFO | {"threshold": 400})))
    stored = catalogs.open_catalog(t.spark, f"{path}/coarse")
    catalogs.write_catalog(stored, f"{path}/fine", catalogs.CatalogInfo(**(OBJ_INFO | {"threshold": 8, "max_order": 6})))
    return catalogs.partition_info(t.spark.read.parquet(f"{path}/fine/dataset")).select("Norder", "Npix", "rows")


@query("cone_search", f"SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM sky_object WHERE {dist(350.0, 80.0)} <= 72000")
def cone_search(t):
    return positions(regions.search(t("sky_object"), regions.ConeSearch(350.0, 80.0, 72000.0)))


@query("box_search", "SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM sky_object WHERE (ra >= 340 OR ra <= 25) AND dec BETWEEN -30 AND 30")
def box_search(t):
    return positions(regions.search(t("sky_object"), regions.BoxSearch((340.0, 385.0), (-30.0, 30.0))))


_POLY = ((230.0, -15.0), (280.0, -12.0), (275.0, 25.0), (235.0, 20.0))


def _poly_sql():
    def v(r, d):
        return f"cos(radians({d}e0)) * cos(radians({r}e0))", f"cos(radians({d}e0)) * sin(radians({r}e0))", f"sin(radians({d}e0))"

    tests = []
    for p, q in zip(_POLY, _POLY[1:] + _POLY[:1]):
        (a, b, c), (d, e, f) = v(*p), v(*q)
        tests.append(f"(({b}) * ({f}) - ({c}) * ({e})) * x + (({c}) * ({d}) - ({a}) * ({f})) * y + (({a}) * ({e}) - ({b}) * ({d})) * z >= 0")
    return (
        "WITH u AS (SELECT *, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z FROM sky_object) "
        "SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM u WHERE " + " AND ".join(tests)
    )


@query("polygon_search", _poly_sql())
def polygon_search(t):
    return positions(regions.search(t("sky_object"), regions.PolygonSearch(_POLY)))


@query("pixel_search", hp(3) + " SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM hp WHERE (pixel >> 2) IN (17, 40) OR pixel IN (300, 301, 77) OR (pixel >> 6) = 6")
def pixel_search(t):
    df = with_healpix(t("sky_object"), "ra", "dec")
    return positions(regions.search(df, regions.PixelSearch(((2, 17), (2, 40), (3, 300), (3, 301), (3, 77), (0, 6)))))


@query("moc_filter", hp(4) + " SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM hp WHERE (pixel >> 4) % 7 = 2 OR pixel % 11 = 5")
def moc_filter(t):
    df = with_healpix(t("sky_object"), "ra", "dec")
    coarse = t.spark.range(12 * 16).where("id % 7 = 2").select(F.lit(2).alias("order"), F.col("id").alias("pixel"))
    fine = t.spark.range(12 * 256).where("id % 11 = 5").select(F.lit(4).alias("order"), F.col("id").alias("pixel"))
    return positions(regions.coverage_filter(df, coarse.unionByName(fine)))


def pixel_grid_sql(order: int) -> str:
    """CTE grid: all pixels of an order with base pixel, column, row, and the two constants of the base pixel."""
    bits = lambda k: f"list_sum(list_transform(range({order}), lambda i: ((p >> (2 * i + {k})) & 1) << i))"
    return (
        f"grid AS (SELECT p, CAST({bits(0)} AS BIGINT) AS x, CAST({bits(1)} AS BIGINT) AS y, 2 + f // 4 AS rf, "
        f"CASE WHEN f // 4 = 1 THEN 2 * (f % 4) ELSE 2 * (f % 4) + 1 END AS lf FROM (SELECT p, p >> {2 * order} AS f FROM range({12 * 4**order}) g(p)))"
    )


def cone_sample_sql(ra: float, dec: float, radius: float, order: int) -> str:
    """CTEs grid and met: the pixels of an order whose centre lies in the cone."""
    ns = 1 << order
    return (
        f"{pixel_grid_sql(order)}, ring AS (SELECT p, x, y, lf, rf * {ns} - x - y - 1 AS r FROM grid), "
        f"wide AS (SELECT *, least({ns}, r, 4 * {ns} - r) AS w FROM ring), "
        f"centre AS (SELECT p, degrees(asin(CASE WHEN r < {ns} THEN 1 - w * w / (3e0 * {ns} * {ns}) WHEN r > {3 * ns} THEN w * w / (3e0 * {ns} * {ns}) - 1 "
        f"ELSE (2 * {ns} - r) * 2 / (3e0 * {ns}) END)) AS dec, 45e0 * (lf * w + x - y) / w AS ra FROM wide), "
        f"met AS (SELECT p FROM centre WHERE {dist(ra, dec)} <= {radius})"
    )


@query("cone_coarse", hp(3) + f", {cone_sample_sql(200.0, 23.0, 54000.0, 8)} SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM hp WHERE pixel IN (SELECT p >> 10 FROM met)")
def cone_coarse(t):
    df = with_healpix(t("sky_object"), "ra", "dec")
    return positions(regions.search_tiles(df, regions.ConeSearch(200.0, 23.0, 54000.0), 3))


def _stored(t, label: str, threshold: int = 40) -> str:
    path = scratch_path(t.spark, label)
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**(OBJ_INFO | {"threshold": threshold})))
    return path


@query(
    "cone_coarse_stored",
    hp(5) + ", " + TILE_CTES.format(max=5, thr=40) + f", {cone_sample_sql(300.0, -41.0, 60000.0, 8)} "
    "SELECT objectId, CAST(ord AS INT) AS Norder, CAST(pix AS INT) AS Npix FROM hp JOIN tiles ON hp.pixel >> (2 * (5 - ord)) = pix "
    "WHERE EXISTS (SELECT 1 FROM met WHERE met.p >> (2 * (8 - ord)) = pix)",
)
def cone_coarse_stored(t):
    """Whole stored tiles that the cone meets, read through their partition folders alone."""
    found = catalogs.open_catalog(t.spark, _stored(t, "coarse"), ["objectId", "Norder", "Npix"], region=regions.ConeSearch(300.0, -41.0, 60000.0, fine=False))
    return found.select("objectId", "Norder", "Npix")


@query("cone_stored", f"SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM sky_object WHERE {dist(350.0, 80.0)} <= 72000")
def cone_stored(t):
    return positions(catalogs.open_catalog(t.spark, _stored(t, "cone"), ["objectId", "ra", "dec"], region=regions.ConeSearch(350.0, 80.0, 72000.0)))


@query("polygon_stored", _poly_sql())
def polygon_stored(t):
    return positions(catalogs.open_catalog(t.spark, _stored(t, "polygon"), ["objectId", "ra", "dec"], region=regions.PolygonSearch(_POLY)))


_MAPS = "hp5 AS (SELECT pixel, dec, r_psfFlux FROM hp JOIN sky_object USING (objectId, dec))"
_MAP_A, _MAP_B = "SELECT DISTINCT pixel >> 2 AS c FROM hp5 WHERE r_psfFlux > 2000", "SELECT DISTINCT pixel >> 4 AS c FROM hp5 WHERE dec > 0"


def _maps(t):
    """Two coverage maps of different orders, the first with its tiles named twice at two orders."""
    df = with_healpix(t("sky_object"), "ra", "dec")
    tiles = lambda rows, order: rows.select(F.lit(order).alias("order"), ancestor("healpix29", order).alias("pixel")).distinct()
    bright = df.where("r_psfFlux > 2000")
    return tiles(bright, 4).unionByName(tiles(bright, 5)), tiles(df.where("dec > 0"), 3)


@query(
    "moc_algebra",
    hp(5) + f""", {_MAPS}, a AS (SELECT c * 4 + i AS p FROM ({_MAP_A}), range(4) r(i)), b AS (SELECT c * 16 + i AS p FROM ({_MAP_B}), range(16) r(i))
    SELECT 'union' AS how, p AS pixel FROM (SELECT p FROM a UNION SELECT p FROM b) UNION ALL
    SELECT 'intersection', p FROM (SELECT p FROM a INTERSECT SELECT p FROM b) UNION ALL
    SELECT 'difference', p FROM (SELECT p FROM a EXCEPT SELECT p FROM b) UNION ALL
    SELECT 'symmetric_difference', p FROM ((SELECT p FROM a EXCEPT SELECT p FROM b) UNION (SELECT p FROM b EXCEPT SELECT p FROM a))""",
)
def moc_algebra(t):
    a, b = _maps(t)
    out = None
    for how in ("union", "intersection", "difference", "symmetric_difference"):
        found = coverage.combine(a, b, how)
        cells = found.select(F.lit(how).alias("how"), F.explode(F.sequence(F.shiftright("lo", 48), F.shiftright(F.col("hi") - 1, 48))).alias("pixel"))
        out = cells if out is None else out.unionByName(cells)
    return out


@query(
    "moc_tiles",
    hp(5) + f""", {_MAPS}, f AS (SELECT c * 4 + i AS p FROM ({_MAP_A}), range(4) r(i) UNION SELECT c * 16 + i FROM ({_MAP_B}), range(16) r(i)),
    lv AS (SELECT o, p >> (2 * (5 - o)) AS q, count(*) AS n FROM f, range(6) l(o) GROUP BY 1, 2),
    whole AS (SELECT o, q FROM lv WHERE n = 4 ** (5 - o) AND o >= 4)
    SELECT CAST(w.o AS INT) AS "order", w.q AS pixel FROM whole w LEFT JOIN whole u ON u.o = w.o - 1 AND u.q = w.q >> 2 WHERE u.q IS NULL""",
)
def moc_tiles(t):
    """The union of two maps as tiles, as coarse as the cells of the sweep allow."""
    return coverage.to_tiles(coverage.combine(*_maps(t), "union"), 5)


@query(
    "moc_tree_filter",
    _tiled_sql("SELECT DISTINCT CAST(ord AS INT) AS Norder, pix AS Npix, n AS rows FROM tiles JOIN (SELECT pixel FROM hp JOIN sky_object USING (objectId) WHERE r_psfFlux > 8000) b ON b.pixel >> (2 * (5 - ord)) = pix"),
)
def moc_tree_filter(t):
    """Tiles of one catalog that overlap the coverage of another, trees of different orders."""
    own = _tiles(t, 40, 5).select(F.col("order").alias("Norder"), F.col("pixel").alias("Npix"), F.col("n").alias("rows"))
    other = with_healpix(t("sky_object").where("r_psfFlux > 8000"), "ra", "dec")
    return coverage.tiles_within(own, other.select(F.lit(7).alias("order"), ancestor("healpix29", 7).alias("pixel")).distinct())


@query(
    "stacked_regions",
    f"SELECT 'object' AS origin, objectId AS id FROM sky_object WHERE {dist(200.0, 23.0)} <= 90000 AND dec > 15 UNION ALL SELECT 'other', otherId FROM sky_other WHERE {dist(200.0, 23.0)} <= 90000 AND dec >= 15",
)
def stacked_regions(t):
    both = regions.StackedSearch((regions.ConeSearch(200.0, 23.0, 90000.0), regions.BoxSearch((0.0, 360.0), (15.0, 90.0))))
    a = regions.search(t("sky_object"), both).select(F.lit("object").alias("origin"), F.col("objectId").alias("id"))
    return a.unionByName(regions.search(t("sky_other"), both).select(F.lit("other").alias("origin"), F.col("otherId").alias("id")))


# ---- matching; the oracle is the brute-force pair search

def _pairs_sql(radius: float, k: int | None, tail: str, extra: str = "") -> str:
    ranked = f", k AS (SELECT *, CAST(row_number() OVER (PARTITION BY objectId ORDER BY d, otherId) AS INT) AS rn FROM p{extra})" if k else ""
    return (
        f"WITH p AS (SELECT a.objectId, b.otherId, {_PAIR} AS d FROM sky_object a JOIN sky_other b ON abs(a.dec - b.dec) <= {radius / 3600 * 1.001:.9f}e0 "
        f"AND {_PAIR} <= {radius}){ranked} {tail}"
    )


@query("crossmatch_1nn", _pairs_sql(0.5, 1, "SELECT objectId, otherId, R6(d) AS dist FROM k WHERE rn = 1"))
def crossmatch_1nn(t):
    m = match.matched_ids(t("sky_object"), t("sky_other"), L_ON, R_ON, 0.5, 1)
    return m.select(F.col("lid").alias("objectId"), F.col("rid").alias("otherId"), rnd("_dist_arcsec").alias("dist"))


@query("crossmatch_knn", _pairs_sql(7200, 3, "SELECT objectId, otherId, rn AS rank, R6(d) AS dist FROM k WHERE rn <= 3"))
def crossmatch_knn(t):
    m = match.matched_ids(t("sky_object"), t("sky_other"), L_ON, R_ON, 7200.0, 3)
    return m.select(F.col("lid").alias("objectId"), F.col("rid").alias("otherId"), "rank", rnd("_dist_arcsec").alias("dist"))


@query(
    "crossmatch_nested",
    _pairs_sql(3600, 2, "SELECT o.objectId, coalesce(n, 0) AS n, R6(first) AS first, s AS ids FROM sky_object o LEFT JOIN (SELECT objectId, count(*) AS n, min(d) AS first, CAST(sum(otherId) AS BIGINT) AS s FROM k WHERE rn <= 2 GROUP BY 1) USING (objectId)"),
)
def crossmatch_nested(t):
    m = match.crossmatch_nested(t("sky_object"), t("sky_other"), L_ON, R_ON, 3600.0, 2, "m")
    return m.select(
        "objectId", F.coalesce(F.size("m"), F.lit(0)).cast("long").alias("n"), rnd(F.try_element_at("m", F.lit(1))["_dist_arcsec"]).alias("first"),
        F.when(F.col("m").isNotNull(), F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + x["otherId"])).alias("ids"),
    )


@query("crossmatch_anti", _pairs_sql(0.5, None, "SELECT objectId FROM sky_object WHERE objectId NOT IN (SELECT objectId FROM p)"))
def crossmatch_anti(t):
    return match.unmatched(t("sky_object"), t("sky_other"), L_ON, R_ON, 0.5).select("objectId")


@query(
    "crossmatch_suffix",
    _pairs_sql(1, 1, "SELECT k.objectId, R6(a.ra) AS ra_obj, R6(b.ra) AS ra_oth, R6(b.meanFlux) AS meanFlux, a.refBand FROM k JOIN sky_object a ON a.objectId = k.objectId JOIN sky_other b ON b.otherId = k.otherId WHERE rn = 1"),
)
def crossmatch_suffix(t):
    m = match.crossmatch(t("sky_object"), t("sky_other"), L_ON, R_ON, 1.0, 1, ("_obj", "_oth"), "overlapping_columns")
    return m.select("objectId", rnd("ra_obj").alias("ra_obj"), rnd("ra_oth").alias("ra_oth"), rnd("meanFlux").alias("meanFlux"), "refBand")


_AT = 6


@query(
    "margin_halo",
    hp(_AT) + ", " + TILE_CTES.format(max=_AT, thr=40) + f""", {pixel_grid_sql(_AT)},
      c0 AS (SELECT p, rf * {1 << _AT} - x - dx - y - dy AS r, x + dx - y - dy AS d, lf FROM grid, range(2) a(dx), range(2) b(dy)),
      corner AS (SELECT p, r, CASE WHEN w = 0 THEN 0 ELSE ((lf * w + d) % (8 * w) + 8 * w) % (8 * w) END AS k FROM (SELECT *, least({1 << _AT}, r, {4 << _AT} - r) AS w FROM c0)),
      edge AS (SELECT DISTINCT ord, pix, r, k FROM tiles JOIN corner ON corner.p >> (2 * ({_AT} - ord)) = pix)
      SELECT DISTINCT objectId, CAST(ord AS INT) AS Norder, CAST(pix AS INT) AS Npix FROM hp JOIN corner ON corner.p = hp.pixel JOIN edge USING (r, k)
      WHERE hp.pixel >> (2 * ({_AT} - ord)) <> pix""",
)
def margin_halo(t):
    """The margin of every tile of a stored catalog; the oracle finds touching pixels by their common corners."""
    path = scratch_path(t.spark, "halo")
    info = catalogs.CatalogInfo(**(OBJ_INFO | {"threshold": 40, "max_order": _AT}))
    catalogs.write_collection(t("sky_object"), path, info, margin_arcsec=1200.0, margin_at=_AT)
    return catalogs.open_collection(t.spark, path, ["objectId", "Norder", "Npix"]).margin.select("objectId", "Norder", "Npix")


_H, _R = 5.0, 0.5


@query(
    "margin_cells",
    f"""WITH z AS (SELECT o.*, zn.z AS zone, floor((dec + 90) / {_H}) AS home FROM sky_object o, range(36) zn(z)
         WHERE zn.z BETWEEN floor((greatest(-90e0, dec - {_R}e0) + 90) / {_H}) AND floor((least(90e0, dec + {_R}e0) + 90) / {_H})),
       n AS (SELECT *, greatest(1, floor(360 * cos(radians(least(90e0, greatest(abs(zone * {_H} - 90), abs(zone * {_H} + {_H} - 90))))) / {_H})) AS nc,
         greatest(1, floor(360 * cos(radians(least(90e0, greatest(abs(home * {_H} - 90), abs(home * {_H} + {_H} - 90))))) / {_H})) AS hn,
         CASE WHEN abs(dec) + {_R}e0 >= 90 THEN 180e0 ELSE degrees(asin(least(1e0, sin(radians({_R}e0)) / cos(radians(dec))))) END AS w FROM z),
       c AS (SELECT *, g.c AS cell FROM n, range(72) g(c) WHERE g.c < nc AND (
         (g.c + 1) * 360 / nc >= ra - w AND g.c * 360 / nc <= ra + w OR (g.c + 1) * 360 / nc >= ra - w + 360 AND g.c * 360 / nc <= ra + w + 360
         OR (g.c + 1) * 360 / nc >= ra - w - 360 AND g.c * 360 / nc <= ra + w - 360))
       SELECT objectId, CAST(zone AS BIGINT) AS zone, CAST(cell AS BIGINT) AS cell FROM c WHERE NOT (zone = home AND cell = floor(ra / 360 * hn) % hn)""",
)
def margin_cells(t):
    m = match.margin_rows(t("sky_object"), "ra", "dec", _R * 3600, _H)
    return m.select("objectId", F.col("margin_zone").alias("zone"), F.col("margin_cell").alias("cell"))


@query("id_search", "SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM sky_object WHERE objectId IN (3, 77, 1000)")
def id_search(t):
    path = scratch_path(t.spark, "index")
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**(OBJ_INFO | {"threshold": 400})))
    catalogs.write_id_index(t.spark, path, "objectId")
    return positions(catalogs.id_search(t.spark, path, "objectId", [3, 77, 1000]))


@query("best_match", _pairs_sql(5, 1, "SELECT objectId, otherId, R6(d) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY objectId ORDER BY d, otherId) AS r2 FROM k WHERE rn <= 20 AND d < 0.35) WHERE r2 = 1"))
def best_match(t):
    m = match.crossmatch_nested(t("sky_object"), t("sky_other"), L_ON, R_ON, 5.0, 20, "m")
    b = m.withColumn("b", match.best_match(F.col("m"), "_dist_arcsec", 0.35, "otherId")).where(F.col("b").isNotNull())
    return b.select("objectId", F.col("b.otherId").alias("otherId"), rnd("b._dist_arcsec").alias("dist"))


@query("angular_separation", f"SELECT objectId, R4({dist(266.4, -28.9)}) AS sep FROM sky_object")
def angular_separation(t):
    return t("sky_object").select("objectId", rnd(separation_arcsec("ra", "dec", 266.4, -28.9), 4).alias("sep"))


@query(
    "epoch_propagation",
    """WITH s AS (SELECT objectId, ra, dec, radians(ra) AS a, radians(dec) AS d, (objectId % 13) / 206264806.24709636e0 AS ma, (objectId % 13 - 6) / 206264806.24709636e0 AS md,
         (objectId % 40 - 20) / 4.740470463533348e0 * (1 + objectId % 5) / 206264806.24709636e0 AS mr FROM sky_object WHERE objectId % 13 < 12),
       v AS (SELECT *, cos(d) * cos(a) * (1 + mr * 9.5e0) + (-sin(a) * ma - sin(d) * cos(a) * md) * 9.5e0 AS x,
         cos(d) * sin(a) * (1 + mr * 9.5e0) + (cos(a) * ma - sin(d) * sin(a) * md) * 9.5e0 AS y, sin(d) * (1 + mr * 9.5e0) + cos(d) * md * 9.5e0 AS z FROM s)
       SELECT objectId, R6(ra) AS ra, R6(dec) AS dec, R8(((degrees(atan2(y, x)) % 360) + 360) % 360) AS ra_corr, R8(degrees(atan2(z, sqrt(x * x + y * y)))) AS dec_corr FROM v""",
)
def epoch_propagation(t):
    o = t("sky_object").withColumns({
        "pmra": (F.col("objectId") % 13).cast("double"), "pmdec": (F.col("objectId") % 13 - 6).cast("double"),
        "plx": (1 + F.col("objectId") % 5).cast("double"), "rv": (F.col("objectId") % 40 - 20).cast("double"),
    }).where(F.col("pmra") < 12)
    p = propagate(o, "ra", "dec", "pmra", "pmdec", "plx", "rv", 9.5)
    return positions(p, rnd("ra_corr", 8).alias("ra_corr"), rnd("dec_corr", 8).alias("dec_corr"))


@query(
    "coverage_summary",
    _tiled_sql("SELECT CAST(ord AS INT) AS norder, count(*) AS tiles, CAST(sum(n) AS BIGINT) AS rows, min(n) AS min_rows, max(n) AS max_rows, R6(count(*) * 41252.96124941927e0 / 12 / power(4, ord)) AS area, R6(count(*) / (12e0 * power(4, ord))) AS share FROM tiles GROUP BY ord"),
)
def coverage_summary(t):
    s = tiling.coverage_summary(_tiles(t, 40, 5))
    return s.select(F.col("order").alias("norder"), "tiles", "rows", "min_rows", "max_rows", rnd("area_deg2").alias("area"), rnd("sky_share").alias("share"))


@query("percentile_tile", _tiled_sql("SELECT R6(quantile_cont(n, 0.1)) AS p10, R6(quantile_cont(n, 0.5)) AS p50, R6(quantile_cont(n, 0.9)) AS p90 FROM tiles"))
def percentile_tile(t):
    tiles = _tiles(t, 40, 5).withColumn("all", F.lit(1))
    return percentiles(tiles, ["all"], "n", {"p10": 0.1, "p50": 0.5, "p90": 0.9}).select(*[rnd(c).alias(c) for c in ("p10", "p50", "p90")])


@query(
    "match_quality",
    _pairs_sql(0.35, 1, """, m AS (SELECT objectId, otherId FROM k WHERE rn = 1), truth AS (SELECT otherId, otherId % 100000 AS objectId FROM sky_other WHERE otherId < 200000)
       SELECT (SELECT count(*) FROM m) AS matched, (SELECT count(*) FROM m JOIN truth USING (objectId, otherId)) AS correct, (SELECT count(*) FROM truth) AS truth,
       R6((SELECT count(*) FROM m JOIN truth USING (objectId, otherId)) / (SELECT count(*) FROM truth)) AS completeness, R6((SELECT count(*) FROM m JOIN truth USING (objectId, otherId)) / (SELECT count(*) FROM m)) AS purity"""),
)
def match_quality(t):
    from starloom.operators.quality import match_quality as mq

    m = match.matched_ids(t("sky_object"), t("sky_other"), L_ON, R_ON, 0.35).select(F.col("lid").alias("objectId"), F.col("rid").alias("otherId"))
    truth = t("sky_other").where("otherId < 200000").select((F.col("otherId") % 100000).alias("objectId"), "otherId")
    q = mq(m, truth, ["objectId", "otherId"])
    return q.withColumns({"completeness": rnd("completeness"), "purity": rnd("purity")})


@query(
    "pixel_map_join",
    hp(5) + """, m AS (SELECT pixel >> 6 AS pixel, CAST(floor(pixel / 1000) AS BIGINT) AS zbin FROM (SELECT i * 64 AS pixel FROM range(192) r(i)))
    SELECT zbin, count(*) AS n, R6(avg(dec)) AS mean_dec FROM hp JOIN m ON m.pixel = (hp.pixel >> 6) GROUP BY zbin""",
)
def pixel_map_join(t):
    df = with_healpix(t("sky_object"), "ra", "dec")
    pmap = t.spark.range(192).select(F.col("id").alias("pixel"), F.floor(F.col("id") * 64 / 1000).alias("zbin"))
    j = tiling.pixel_map_join(df, pmap, 2)
    return j.groupBy("zbin").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("dec")).alias("mean_dec"))


@query(
    "sql_cone_lightcurve",
    f"""SELECT f.objectId, R6(f.mjd) AS mjd, R6(f.psfFlux) AS flux, f.band FROM forced_source f JOIN sky_object o USING (objectId) WHERE {dist(200.0, 0.0)} <= 108000
       AND f.band IN ('g', 'r', 'i') AND f.psfFlux IS NOT NULL AND f.psfFluxErr > 0 ORDER BY f.mjd""",
)
def sql_cone_lightcurve(t):
    from starloom.operators.quality import sql_cone

    df = sql_cone(t.spark, t("forced_source"), t("sky_object"), 200.0, 0.0, 108000.0, ["g", "r", "i"])
    return df.select("objectId", rnd("mjd").alias("mjd"), rnd("flux").alias("flux"), "band")
