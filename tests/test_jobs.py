"""Files, streams and resampling."""

import re

import pytest
from pyspark.sql import functions as F

from starloom.operators import structure, udf
from starloom.plans.catalogue import QUERIES
from starloom.session import scratch_path
from starloom.sources import catalogs, storage
from starloom.streaming import chunks, versions


def test_filters_and_region_reach_the_scan(spark, tables):
    from starloom.sources.readers import scan

    df = scan(spark, tables.path("lineitem"), ["l_orderkey"], [("l_quantity", "<", 5.0)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_quantity,5.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_id_search_prunes_partitions(spark, tables):
    path = scratch_path(spark, "ids")
    catalogs.write_catalog(tables("sky_object"), path, catalogs.CatalogInfo("o", threshold=20, max_order=4))
    catalogs.write_id_index(spark, path, "objectId")
    df = catalogs.id_search(spark, path, "objectId", [3])
    assert [r["objectId"] for r in df.collect()] == [3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    part = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S).group(1)
    assert "Norder" in part and "Npix" in part
    assert catalogs.id_search(spark, path, "objectId", [-5]).count() == 0
    assert catalogs.catalog_info(spark, path).total_rows == tables("sky_object").count()


def test_region_prunes_tiles_and_keeps_all_rows(spark, tables):
    from starloom.operators.regions import BoxSearch, ConeSearch, StackedSearch, search

    path = scratch_path(spark, "region")
    catalogs.write_catalog(tables("sky_object"), path, catalogs.CatalogInfo("o", threshold=10, max_order=5))
    every = spark.read.parquet(f"{path}/partition_info").count()
    for region in (ConeSearch(350.0, -26.0, 90000.0), BoxSearch((340.0, 380.0), (-40.0, 0.0)), ConeSearch(90.0, -89.0, 90000.0), StackedSearch((ConeSearch(252.0, 6.0, 72000.0), BoxSearch((240.0, 260.0))))):
        want = sorted(r[0] for r in search(tables("sky_object"), region).select("objectId").collect())
        got = sorted(r[0] for r in catalogs.open_catalog(spark, path, region=region).select("objectId").collect())
        assert want and got == want
        assert len(catalogs.region_tiles(spark, path, region)) < every
    assert catalogs.region_tiles(spark, path, ConeSearch(350.0, -26.0, 90000.0), max_tiles=1) is None


def test_stream_equals_batch_and_resumes(spark, tables):
    src, out = scratch_path(spark, "src"), scratch_path(spark, "out")
    v = tables("object_version")
    v.where("versionId % 2 = 0").repartition(3).write.parquet(src)
    chunks.run_available(chunks.read_chunks(spark, src, v.schema), path=out)
    v.where("versionId % 2 = 1").repartition(2).write.mode("append").parquet(src)
    again = chunks.run_available(chunks.read_chunks(spark, src, v.schema), path=out)
    assert sorted(r[0] for r in again.select("versionId").collect()) == sorted(r[0] for r in v.select("versionId").collect())


def test_consume_until_stops(spark, tables):
    src = scratch_path(spark, "src")
    v = tables("object_version").repartition(10)
    v.write.parquet(src)
    n = chunks.consume_until(chunks.read_chunks(spark, src, v.schema), 300).count()
    assert 300 <= n < tables("object_version").count()


def test_late_old_version_does_not_win_and_batches_repeat(spark, tables):
    v = tables("object_version")
    t = versions.VersionedTable(spark, scratch_path(spark, "vt"), "diaObjectId", ["validityStart", "versionId"], v.schema, buckets=4)
    t.merge(v.where("versionId % 3 = 0"), 0)
    t.merge(v.where("versionId % 3 > 0"), 1)
    t.merge(v.where("versionId % 3 > 0"), 1)
    want = versions.latest(v, "diaObjectId", ["validityStart", "versionId"])
    key = lambda df: sorted((r["diaObjectId"], r["versionId"]) for r in df.collect())
    assert key(t.read()) == key(want)


def test_repeated_detections_are_absorbed(spark, tables):
    src = scratch_path(spark, "dup")
    d = tables("dia_source").limit(300).withColumn("seen", F.timestamp_seconds(F.lit(1_700_000_000)))
    d.coalesce(1).write.parquet(src)
    d.coalesce(1).write.mode("append").parquet(src)
    out = versions.import_versions(chunks.read_chunks(spark, src, d.schema, 1), "diaSourceId", ["mjd"], buckets=4)
    assert out.count() == 300


def test_samples_are_repeatable(spark, tables):
    for key in ("sample_seeded", "group_sample"):
        a, b = (sorted(map(tuple, QUERIES[key].run(tables).collect()), key=repr) for _ in range(2))
        assert a and a == b
    s = QUERIES["group_sample"].run(tables)
    assert s.groupBy("objectId").count().agg(F.max("count")).first()[0] <= 5


def test_storage_reports(spark, tables):
    report = {n: storage.column_storage(spark, catalogs.file_sizes(spark, tables.path(n))) for n in ("orders", "lineitem")}
    r = {x["name"]: x for x in storage.merge_reports(report).collect()}
    assert r["o_orderkey"]["size_orders"] > 0 and r["o_orderkey"]["size_lineitem"] is None
    assert sum(x["percent_lineitem"] or 0 for x in r.values()) == pytest.approx(100)
    c = {x["codec"]: x["bytes"] for x in storage.recompress(tables("lineitem"), scratch_path(spark, "codec"), ["snappy", "zstd", "zstd:12", "gzip"]).collect()}
    assert set(c) == {"snappy", "zstd", "zstd:12", "gzip"} and c["zstd:12"] < c["zstd"] < c["snappy"]


def test_bootstrap_brackets_the_estimate(spark, tables):
    f = tables("forced_source")
    edges = [1.0, 100.0, 400.0]
    boot = structure.sf2_bootstrap(f, edges, replicates=30)
    exact = structure.sf2_basic(f, edges).select("objectId", "band", "bin", F.col("sf2").alias("exact"), F.col("n").alias("pairs"))
    rows = boot.join(exact, ["objectId", "band", "bin"]).collect()
    assert rows and all(r["n"] == r["pairs"] for r in rows)
    assert all(r["sf2"] == pytest.approx(r["exact"], rel=1e-6) for r in rows)
    inside = sum(r["lower"] <= r["sf2"] <= r["upper"] for r in rows)
    assert inside > 0.6 * len(rows)


def test_whole_tiles_come_at_once(spark, tables):
    df = tables("forced_source").select("objectId", "psfFlux")
    fn = lambda pdf: pdf.groupby("objectId", as_index=False).agg(n=("psfFlux", "size"))
    out = udf.map_tiles(df, ["objectId"], fn, "objectId bigint, n bigint")
    assert out.agg(F.sum("n")).first()[0] == df.count()
    assert out.count() == df.select("objectId").distinct().count()
