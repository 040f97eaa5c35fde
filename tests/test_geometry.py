"""Shapes of pixels, region covers, margins of tiles and the algebra of coverage maps."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import geometry, healpix
from starloom.operators import coverage, regions
from starloom.sources import catalogs


def sky(n, seed=0):
    v = np.random.default_rng(seed).normal(size=(n, 3))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.mark.parametrize("order", [0, 1, 3, 8, 16])
def test_positions_and_pixels_agree(order):
    v = sky(3000, order)
    p = geometry.pixel_of(order, v)
    assert (geometry.pixel_of(order, geometry.centers(order, p)) == p).all()
    assert (geometry.angle(v, geometry.centers(order, p)) < 1.1 * geometry.pixel_size(order)).all()
    # points just inside the border belong to the pixel
    middle = geometry.centers(order, p)[:, None]
    inner = middle + 0.98 * (geometry.vertices(order, p, 4) - middle)
    inner /= np.linalg.norm(inner, axis=-1, keepdims=True)
    assert (geometry.pixel_of(order, inner) == p[:, None]).mean() > 0.99


def test_columns_and_arrays_give_the_same_pixels(spark):
    rng = random.Random(1)
    rows = [(rng.uniform(0, 360), rng.uniform(-90, 90)) for _ in range(500)] + [(0.0, 90.0), (0.0, -90.0), (0.0, 0.0), (360.0, 10.0), (45.0, 41.81)]
    out = healpix.with_healpix(spark.createDataFrame(rows, "ra double, dec double"), "ra", "dec", 9, "p").collect()
    want = geometry.pixel_of(9, geometry.unit_vector(np.array([r.ra for r in out]), np.array([r.dec for r in out])))
    assert [r.p for r in out] == want.tolist()


@pytest.mark.parametrize("order", [1, 2, 4])
def test_neighbours(order):
    """Eight of each pixel but for the 24 at the corners where three base pixels meet; both ways."""
    every = np.arange(12 * 4**order)
    n = geometry.neighbours(order, every)
    count = np.bincount(n[:, 0])
    assert (count == 7).sum() == 24 and (count == 8).sum() == len(every) - 24
    pairs = {(int(a), int(b)) for a, b in zip(every[n[:, 0]], n[:, 1])}
    assert all((b, a) in pairs for a, b in pairs)
    size = geometry.angle(geometry.centers(order, every[n[:, 0]]), geometry.centers(order, n[:, 1]))
    assert size.max() < 2.2 * geometry.pixel_size(order)


def test_no_pixel_is_narrower_than_said():
    """Opposite sides of a pixel stay apart, which the order of a margin rests on."""
    for order in (0, 1, 2, 3, 5):
        v = geometry.vertices(order, np.arange(12 * 4**order), 64).reshape(12 * 4**order, 4, 64, 3)
        for a, b in ((0, 2), (1, 3)):
            gap = min(geometry.angle(v[k, a][:, None], v[k, b][None]).min() for k in range(0, len(v), max(1, len(v) // 300)))
            assert gap > geometry.NARROWEST * geometry.pixel_size(order)


@pytest.mark.parametrize("ra,dec,radius", [(350.0, 80.0, 72000.0), (10.0, -3.0, 5.0), (45.0, 41.8, 3600.0), (0.0, 90.0, 20000.0), (120.0, -41.0, 300.0)])
def test_cone_cover_holds_the_cone(ra, dec, radius):
    c, r = geometry.unit_vector(ra, dec), np.radians(radius / 3600)
    v = c + np.random.default_rng(2).normal(size=(4000, 3)) * r
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    inside = geometry.pixel_of(29, v[geometry.angle(v, c) <= r])
    ranges = regions.ConeSearch(ra, dec, radius).ranges()
    assert len(ranges) < 400 and all((ranges[k][1] < ranges[k + 1][0]) for k in range(len(ranges) - 1))
    assert len(inside) > 200 and all(any(lo <= p < hi for lo, hi in ranges) for p in inside.tolist())
    area = sum(hi - lo for lo, hi in ranges) * 4 * np.pi / (12 * 4**29)
    assert area < 2.0 * 2 * np.pi * (1 - np.cos(r))


def test_polygon_cover_holds_the_polygon():
    corners = ((230.0, -15.0), (280.0, -12.0), (275.0, 25.0), (235.0, 20.0))
    v = sky(20_000, 5)
    points = geometry.unit_vector(*np.array(corners).T)
    normal = np.cross(points, np.roll(points, -1, axis=0))
    inside = geometry.pixel_of(29, v[(v @ normal.T >= 0).all(axis=1)])
    for order in (corners, corners[::-1]):
        ranges = regions.PolygonSearch(order).ranges()
        assert len(inside) > 300 and all(any(lo <= p < hi for lo, hi in ranges) for p in inside.tolist())
        assert sum(hi - lo for lo, hi in ranges) / (12 * 4**29) < 1.4 * len(inside) / len(v)


def test_cone_tiles_are_the_tiles_met():
    for ra, dec, radius, order in ((200.0, 23.0, 54000.0, 3), (300.0, -41.0, 60000.0, 2)):
        c, r = geometry.unit_vector(ra, dec), np.radians(radius / 3600)
        fine = np.arange(12 * 4**8)
        near = fine[geometry.angle(geometry.centers(8, fine), c) <= r]
        assert geometry.cone_tiles(ra, dec, radius, order) == np.unique(near >> (2 * (8 - order))).tolist()
    # where pixels are small, points all over the cone and its rim name no other tile, and only slivers are not hit
    c, r = geometry.unit_vector(45.0, 41.81), np.radians(2.0)
    v = c + np.random.default_rng(4).normal(size=(400_000, 3)) * r
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    d = geometry.angle(v, c)
    rim = c * np.cos(r) + np.sin(r) * (v - c * (v @ c)[:, None]) / np.linalg.norm(v - c * (v @ c)[:, None], axis=1, keepdims=True)
    hit = set(geometry.pixel_of(5, np.concatenate([v[d <= r], rim])).tolist())
    tiles = set(geometry.cone_tiles(45.0, 41.81, 7200.0, 5))
    assert hit <= tiles and len(tiles - hit) <= 1 and len(tiles) > 10
    # a cone far smaller than its tile
    assert geometry.cone_tiles(10.0, 10.0, 1.0, 2) == [int(geometry.pixel_of(2, geometry.unit_vector(10.0, 10.0)))]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(3)
    near = [(k, 40.0 + rng.gauss(0, 4), 41.0 + rng.gauss(0, 4)) for k in range(2500)]
    wide = [(5000 + k, rng.uniform(0, 360), np.degrees(np.arcsin(rng.uniform(-1, 1)))) for k in range(2500)]
    df = spark.createDataFrame([(i, float(a) % 360, float(d), i % 10) for i, a, d in near + wide], "id long, ra double, dec double, grade int")
    path = str(tmp_path_factory.mktemp("catalog"))
    catalogs.write_collection(df, path, catalogs.CatalogInfo("objects", id_column="id", threshold=200, max_order=8), margin_arcsec=900.0)
    return path, df


def test_margin_holds_all_rows_near_a_tile(spark, stored):
    path, df = stored
    rows = df.collect()
    v = geometry.unit_vector(np.array([r.ra for r in rows]), np.array([r.dec for r in rows]))
    tiles = [(r.Norder, r.Npix) for r in spark.read.parquet(f"{path}/partition_info").collect()]
    assert len({o for o, _ in tiles}) > 2
    margin = {}
    for r in spark.read.parquet(f"{path}/margin").select("id", "Norder", "Npix").collect():
        margin.setdefault((r.Norder, r.Npix), []).append(r.id)
    assert set(margin) <= set(tiles) and all(len(x) == len(set(x)) for x in margin.values())
    for order, pixel in tiles:
        border = geometry.vertices(order, np.array([pixel]), 256)[0]
        own = geometry.pixel_of(order, v) == pixel
        reach = geometry.angle(v[:, None], border[None]).min(axis=1)
        near = {rows[k].id for k in np.flatnonzero(~own & (reach <= np.radians(900 / 3600)))}
        got = set(margin.get((order, pixel), []))
        assert near <= got
        assert not any(own[k] for k in range(len(rows)) if rows[k].id in got)
        # pixels of the margin's order bound how far it reaches
        assert all(reach[k] < 2 * geometry.pixel_size(geometry.margin_order(900.0) - 6) for k in range(len(rows)) if rows[k].id in got)


def test_collection_opens_main_and_margin_alike(spark, stored):
    path, df = stored
    cone = regions.ConeSearch(40.0, 41.0, 7200.0)
    col = catalogs.open_collection(spark, path, ["id", "ra", "dec", "Norder", "Npix"], [("grade", "<", 5)], cone)
    for part in (col.main, col.margin):
        plan = part._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters: [") : plan.index("PushedFilters")]
        assert "Norder" in filters and "Npix" in filters
    want = {r.id for r in regions.search(df, cone).where("grade < 5").collect()}
    assert {r.id for r in col.main.collect()} == want and len(want) > 100
    assert {r.id for r in col.margin.collect()} <= want
    whole = catalogs.open_collection(spark, path, ["id", "Norder", "Npix"], region=regions.ConeSearch(40.0, 41.0, 7200.0, fine=False))
    met = {o: set(geometry.cone_tiles(40.0, 41.0, 7200.0, o)) for o in range(9)}
    every = catalogs.open_collection(spark, path, ["id", "Norder", "Npix"])
    for part, full in ((whole.main, every.main), (whole.margin, every.margin)):
        assert sorted(part.collect()) == sorted(r for r in full.collect() if r.Npix in met[r.Norder])


def test_cover_prunes_tiles_that_the_box_keeps(spark, stored):
    path, df = stored
    near_pole = regions.ConeSearch(30.0, 88.0, 4 * 3600.0)
    tiles = catalogs.region_tiles(spark, path, near_pole)
    every = spark.read.parquet(f"{path}/partition_info").count()
    assert tiles and len(tiles) < every / 3
    found = catalogs.open_catalog(spark, path, ["id"], region=near_pole)
    assert {r.id for r in found.collect()} == {r.id for r in regions.search(df, near_pole).select("id").collect()}


def test_wide_margins_are_refused(spark, stored):
    with pytest.raises(ValueError):
        catalogs.write_margin(spark, stored[0], 36000.0)


def spans(df):
    return sorted((r.lo, r.hi) for r in df.collect())


def members(df, shift):
    return {p for lo, hi in spans(df) for p in range(lo >> shift, hi >> shift)}


def test_coverage_algebra(spark):
    rng = random.Random(9)
    shift = 2 * (healpix.MAX_ORDER - 6)
    maps, sets = [], []
    for _ in range(2):
        tiles = [(o, rng.randrange(12 * 4**o)) for o in (0, 1, 2, 3, 4, 5, 6) for _ in range(3 * o + 1)]
        tiles += tiles[:3]
        maps.append(spark.createDataFrame(tiles, "order int, pixel long"))
        sets.append({p for o, t in tiles for p in range(t << (2 * (6 - o)), (t + 1) << (2 * (6 - o)))})
    a, b = sets
    none = maps[0].limit(0)
    for how, want in (("union", a | b), ("intersection", a & b), ("difference", a - b), ("symmetric_difference", a ^ b)):
        for cell_order in (0, 4, 8):
            out = coverage.combine(*maps, how, cell_order)
            assert members(out, shift) == want
            found = spans(out)
            assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))
    assert members(coverage.combine(maps[0], none, "union"), shift) == a and not spans(coverage.combine(none, maps[0], "difference"))
    with pytest.raises(ValueError):
        coverage.combine(*maps, "xor")
    whole = spark.createDataFrame([(0, p) for p in range(12)], "order int, pixel long")
    assert abs(coverage.area_deg2(whole.unionByName(maps[0])).first()[0] - 41252.96) < 0.01 and coverage.area_deg2(none).first()[0] == 0
    # as tiles and back; the union of a sweep without inner cuts is as coarse as can be
    tiles = coverage.to_tiles(coverage.normalize(maps[0], 0), 6).collect()
    back = [p for r in tiles for p in range(r.pixel << (2 * (6 - r.order)), (r.pixel + 1) << (2 * (6 - r.order)))]
    assert len(back) == len(set(back)) and set(back) == a
    named = {(r.order, r.pixel) for r in tiles}
    assert not any(all((o, 4 * (p >> 2) + k) in named for k in range(4)) for o, p in named if o > 0)
    coarse = coverage.to_tiles(coverage.normalize(maps[0], 0), 2).collect()
    assert {(r.pixel) << (2 * (2 - r.order)) for r in coarse if r.order == 2} <= {p >> 8 for p in a}


def test_tiles_within_another_tree(spark):
    tiles = spark.createDataFrame([(0, 3, "x"), (1, 5, "y"), (3, 100, "z"), (3, 101, "z")], "Norder int, Npix long, order string")
    other = spark.createDataFrame([(2, 3 * 16 + 7), (4, 402), (0, 9)], "order int, pixel long")
    assert sorted((r.Norder, r.Npix) for r in coverage.tiles_within(tiles, other).collect()) == [(0, 3), (3, 100)]
    assert coverage.tiles_within(tiles, other.limit(0)).count() == 0
