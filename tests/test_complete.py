"""Results that must not depend on lateness, sizes, ties or the number of passes."""

import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from starloom.operators import nested, regions, stats, structure, udf
from starloom.sources import catalogs
from starloom.streaming import chunks, versions


def test_late_versions_are_kept(spark, tmp_path):
    """Rows months behind the newest ones, one file per batch, are merged like any other."""
    rows = [(1, 10, dt.datetime(2025, 6, 1)), (2, 11, dt.datetime(2025, 5, 2)), (3, 12, dt.datetime(2025, 1, 2)), (1, 9, dt.datetime(2025, 5, 1))]
    schema = "id long, version long, at timestamp"
    for k, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = chunks.read_chunks(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
    out = versions.import_versions(s, "id", ["at", "version"], path=str(tmp_path / "out"), buckets=2)
    assert sorted((r.id, r.version) for r in out.collect()) == [(1, 10), (2, 11), (3, 12)]


def test_clipping_runs_until_stable(spark):
    """Powers of two lose one row per pass for many passes."""
    values = [2.0**k for k in range(40)]
    left = list(values)
    while True:
        m, s = np.mean(left), np.std(left, ddof=1)
        new = [v for v in left if abs(v - m) < 1.8 * s]
        if new == left:
            break
        left = new
    df = spark.createDataFrame([(1, v) for v in values] + [(2, 1.0), (2, 2.0), (3, 5.0)], "g int, v double")
    for hot in (1000, 10):
        out = stats.sigma_clip(df, ["g"], "v", 1.8, hot)
        assert sorted(r.v for r in out.where("g = 1").collect()) == sorted(left)
        assert out.where("g > 1").count() == 3


def test_clipping_in_tasks_equals_clipping_by_aggregates(spark, monkeypatch):
    """Many groups, null keys and values, groups over several batches; every row of a kept group comes back once."""
    rng = np.random.default_rng(6)
    rows = [(int(g) if g else None, "ab"[g % 2], float(v), k) for k, (g, v) in enumerate(zip(rng.integers(0, 40, 3000), rng.standard_t(1.5, 3000)))]
    rows += [(7, None, None, 9000), (None, None, 1.0, 9001), (8, None, 3.0, 9002), (8, None, 3.0, 9003)]
    df = spark.createDataFrame(rows, "g int, h string, v double, id long").repartition(5)
    monkeypatch.setattr(stats, "CLIP_ROWS", 100)
    want = sorted(r.id for r in stats.sigma_clip(df, ["g", "h"], "v", 2.0, 10).collect())
    for batch in ("10000", "64"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            assert sorted(r.id for r in stats.sigma_clip(df, ["g", "h"], "v", 2.0).collect()) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert 1000 < len(want) < 2900 and stats.sigma_clip(df.limit(0), ["g"], "v").count() == 0


def test_equal_times_keep_their_light_curve(spark):
    rng = np.random.default_rng(3)
    t = np.sort(rng.uniform(0, 100, 60))
    rows = [(1, "g", float(x), float(k), k) for k, x in enumerate(t)]
    rows += [(2, "g", float(x), float(k), k) for k, x in enumerate(t)] + [(2, "g", float(t[30]), 7.0, 99)]
    df = spark.createDataFrame(rows, "objectId long, band string, mjd double, psfFlux double, visit long")
    plain = structure.sf_log_bins(df, 10).orderBy("objectId", "bin").collect()
    assert {r.objectId for r in plain} == {1, 2}
    spark.conf.set("spark.starloom.hotRows", "20")
    try:
        cut = structure.sf_log_bins(df, 10).orderBy("objectId", "bin").collect()
    finally:
        spark.conf.unset("spark.starloom.hotRows")
    assert [(r.objectId, r.bin, r.N) for r in cut] == [(r.objectId, r.bin, r.N) for r in plain]


def test_many_equal_lags_need_no_list():
    """A regular cadence has few distinct lags; the search must not list the pairs that share one."""
    t = np.arange(3000) * 0.5
    assert structure._kth_lag(t, 100, 0, 0.0, 2000.0) == 0.5
    lags = np.sort(np.concatenate([t[k:] - t[:-k] for k in range(1, 50)]))
    assert structure._kth_lag(t[:400], 5000, 0, 0.0, 1e4) == np.sort([b - a for i, a in enumerate(t[:400]) for b in t[i + 1 : 400]])[5000]
    assert lags[0] == 0.5


def test_one_call_per_object(spark):
    rows = [(k % 2, float(k), k) for k in range(300)]
    df = spark.createDataFrame(rows, "objectId long, psfFlux double, visit long")
    spark.conf.set("spark.starloom.hotRows", "40")
    try:
        p = nested.pack(df, ["objectId"], ["psfFlux"], ["visit"])
        out = udf.reduce_rows(p, lambda f: {"n": len(f)}, "lc.psfFlux", schema="n long", append_columns=True)
        assert sorted((r.objectId, r.n) for r in out.collect()) == [(0, 150), (1, 150)]
        parent = spark.createDataFrame([(0,), (1,), (2,)], "objectId long")
        assert nested.join_nested(parent, df, "objectId", "objectId", ["psfFlux"], ["visit"], "lc").count() == 3
    finally:
        spark.conf.unset("spark.starloom.hotRows")


def test_tile_functions_know_their_tile(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS tile")
    fn = lambda pdf, key, add: pd.DataFrame({"tile": [key[0]], "n": [len(pdf) + add]})
    out = udf.map_tiles(df, ["tile"], fn, "tile long, n long", include_tile=True, add=1)
    assert sorted(tuple(r) for r in out.collect()) == [(0, 35), (1, 34), (2, 34)]


def stored(spark, tables, path):
    catalogs.write_catalog(tables("sky_object"), path, catalogs.CatalogInfo("objects", id_column="objectId", threshold=20, max_order=4))
    catalogs.write_id_index(spark, path, "objectId")
    return spark.read.parquet(f"{path}/dataset")


def test_regions_on_a_stored_catalog(spark, tables, tmp_path):
    path = str(tmp_path / "cat")
    whole = stored(spark, tables, path)
    pixels = regions.PixelSearch(((2, 17), (1, 40), (0, 6)))
    poly = regions.PolygonSearch(((230.0, -15.0), (280.0, -12.0), (275.0, 25.0), (235.0, 20.0)))
    for region in (pixels, poly, regions.ConeSearch(350.0, 80.0, 72000.0)):
        got = catalogs.open_catalog(spark, path, region=region)
        want = whole.where(region.predicate("ra", "dec"))
        assert sorted(r.objectId for r in got.select("objectId").collect()) == sorted(r.objectId for r in want.select("objectId").collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "Npix" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_coverage_map_is_one_join(spark, tables, tmp_path):
    whole = stored(spark, tables, str(tmp_path / "cov"))
    tiles = [(0, 6), (1, 40), (3, 300), (3, 301), (5, 4000), (0, 6)]
    cover = spark.createDataFrame(tiles, "order int, pixel long")
    got = regions.coverage_filter(whole, cover)
    ranges = [(p << 2 * (29 - o), (p + 1) << 2 * (29 - o)) for o, p in tiles]
    want = [r.objectId for r in whole.collect() if any(a <= r.healpix29 < b for a, b in ranges)]
    assert sorted(r.objectId for r in got.collect()) == sorted(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert regions.coverage_filter(whole, cover.limit(0)).count() == 0


def test_ids_from_a_table(spark, tables, tmp_path):
    path = str(tmp_path / "ids")
    whole = stored(spark, tables, path)
    ids = [r.objectId for r in whole.select("objectId").limit(40).collect()]
    frame = spark.createDataFrame([(i,) for i in ids] + [(-1,)], "objectId long")
    for values in (ids, frame):
        for most in (1000, 2):
            got = catalogs.id_search(spark, path, "objectId", values, max_tiles=most)
            assert sorted(r.objectId for r in got.select("objectId").collect()) == sorted(ids)


def test_stream_stops_when_there_is_enough(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(2000).selectExpr("id", "id % 20 AS part").repartition(20, "part").write.partitionBy("part").parquet(src)
    s = chunks.read_chunks(spark, f"{src}/*", spark.range(1).schema)
    path = str(tmp_path / "until")
    got = chunks.consume_until(s, 250, path)
    assert got.count() == 300
    # nothing more is taken when it is asked again
    assert chunks.consume_until(chunks.read_chunks(spark, f"{src}/*", spark.range(1).schema), 250, path).count() == 300


def test_streams_read_tables_of_many_files(spark, tmp_path):
    src = str(tmp_path / "table.parquet")
    spark.range(121).repartition(3).write.parquet(src)
    s = chunks.read_chunks(spark, src, spark.range(1).schema)
    assert chunks.run_available(s, path=str(tmp_path / "rows")).count() == 121
    assert math.isfinite(s.isStreaming)


def test_direct_fluxes_are_detected_above_zero_only(spark):
    from starloom.operators.features import feature_table

    rows = [(1, "g", float(k), -100.0, 1.0, -100.0, 1.0, k) for k in range(5)]
    df = spark.createDataFrame(rows, "objectId long, band string, mjd double, f double, e double, df double, de double, visit long")
    r = feature_table(df, ["g"], {"direct": ("f", "e"), "dia": ("df", "de")}, tie="visit").select(F.col("g_direct_observation_count").alias("a"), F.col("g_dia_observation_count").alias("b")).first()
    assert (r.a, r.b) == (-1.0, 5.0)


def test_all_pairs_in_blocks(spark, monkeypatch):
    """Order statistics by repeated narrowing, with blocks and histograms far smaller than the pairs, equal a plain sort."""
    from starloom.operators import pairs

    rng = np.random.default_rng(5)
    t = np.sort(np.concatenate([rng.uniform(0, 50, 60), np.arange(40) * 0.5]))
    f, tie = rng.normal(size=100).round(1), rng.permutation(100)
    plain = (pairs.equal_count(t, tie, f, 6), pairs.log_median(t, tie, f, 5), pairs.bootstrap(t, tie, f, f * 0, [0.0, 5.0, 20.0], 8, 1))
    i, j = np.triu_indices(100, 1)
    ok = t[j] > t[i]
    i, j = i[ok], j[ok]
    order = np.lexsort((tie[j], tie[i], t[j] - t[i]))
    dt, d2 = (t[j] - t[i])[order], ((f[j] - f[i]) ** 2)[order]
    per = len(dt) // 6
    for k, (b, sf, n, tau) in enumerate(plain[0]):
        own = slice(k * per, (k + 1) * per if k < 5 else None)
        assert b == k and n == len(dt[own]) and math.isclose(sf, math.sqrt(d2[own].mean())) and math.isclose(tau, np.median(dt[own]))
    for name, value in (("BLOCK_PAIRS", 300), ("COLLECT", 5), ("CELLS", 7)):
        monkeypatch.setattr(pairs, name, value)
    small = (pairs.equal_count(t, tie, f, 6), pairs.log_median(t, tie, f, 5), pairs.bootstrap(t, tie, f, f * 0, [0.0, 5.0, 20.0], 8, 1))
    for a, b in zip(plain, small):
        assert np.allclose(np.array(a), np.array(b))


def test_short_and_constant_light_curves_have_pairs_or_none():
    from starloom.operators import pairs

    one, none = np.array([1.0]), np.zeros(0)
    for t in (none, one, np.array([1.0, 1.0])):
        z = np.zeros(len(t))
        assert pairs.equal_count(t, z.astype(int), z, 3) == [] and pairs.log_median(t, z.astype(int), z, 3) == [] and pairs.bootstrap(t, z.astype(int), z, z, [0.0, 1.0], 3, 0) == []
    t = np.arange(30.0)
    assert [r[2] for r in pairs.log_median(t, np.arange(30), np.zeros(30), 3)] == [0.0] * 3
    assert pairs.equal_count(t[:2], np.arange(2), t[:2], 4) == [(3, 1.0, 1, 1.0)]


def test_scratch_goes_at_the_end_of_a_job(spark, monkeypatch):
    import os

    from starloom import session

    monkeypatch.setattr(session, "_SCRATCH", [])
    df = session.materialize(spark.range(10))
    path = session._SCRATCH[0]
    assert df.count() == 10 and os.path.exists(path)
    unused = session.scratch_path(spark, "unused")
    assert session.clear_scratch(spark) == 1
    assert not os.path.exists(path) and not os.path.exists(unused)
