"""Previews of a stored catalog, and manifests of more files than the driver lists."""

import pytest
from pyspark.sql import functions as F

from starloom.sources import catalogs, previews, readers


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("previews"))
    catalogs.write_catalog(tables("sky_object"), path, catalogs.CatalogInfo("o", id_column="objectId", threshold=20, max_order=4))
    previews.write_samples(spark, path, F.xxhash64("objectId"), k=8, tie=["objectId"])
    return path


def ids(df):
    return [r.objectId for r in df.select("objectId").collect()]


def test_both_ends(spark, stored):
    every = ids(spark.read.parquet(f"{stored}/dataset").orderBy(catalogs.INDEX, "objectId"))
    for n in (0, 1, 30, 10_000):
        assert ids(previews.head(spark, stored, n, ["objectId"])) == every[:n]
        assert ids(previews.tail(spark, stored, n, ["objectId"])) == every[::-1][:n]
    near = previews.head(spark, stored, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Norder" in near.split("PartitionFilters")[1].split("]")[0]


def test_partitions_in_sky_order(spark, stored):
    tiles = spark.read.parquet(f"{stored}/partition_info").count()
    every = [sorted(ids(previews.partition(spark, stored, i))) for i in range(tiles)]
    assert sum(map(len, every)) == spark.read.parquet(f"{stored}/dataset").count()
    assert sorted(ids(previews.partition(spark, stored, -1))) == every[-1]
    with pytest.raises(IndexError):
        previews.partition(spark, stored, tiles)


def test_samples(spark, stored):
    hashed = spark.read.parquet(f"{stored}/dataset").withColumn("h", F.xxhash64("objectId"))
    assert ids(previews.random_sample(spark, stored, 8)) == ids(hashed.orderBy("h", "objectId").limit(8))
    own = previews.partition(spark, stored, 2).withColumn("h", F.xxhash64("objectId")).orderBy("h", "objectId")
    assert ids(previews.sample(spark, stored, 2, 5)) == ids(own.limit(5))
    with pytest.raises(ValueError):
        previews.sample(spark, stored, 2, 9)


def test_samples_merge(spark, stored):
    """The sample of a whole is that of its parts' samples."""
    df = spark.read.parquet(f"{stored}/dataset").withColumn(previews.HASH, F.xxhash64("objectId"))
    parts = [previews.smallest(df.where(F.col("objectId") % 2 == k), 8, ["objectId"]) for k in (0, 1)]
    assert sorted(ids(previews.merge_samples(*parts, 8, ["objectId"]))) == sorted(ids(spark.read.parquet(f"{stored}/samples")))


def test_manifest_read_by_tasks(spark, tables, tmp_path):
    path = str(tmp_path / "a b+c")
    o = tables("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    o.where("o_orderkey % 2 = 0").repartition(3).write.parquet(f"{path}/x")
    o.where("o_orderkey % 2 = 1").drop("o_orderdate").write.option("parquet.block.size", "4096").parquet(f"{path}/y")
    o.limit(0).write.parquet(f"{path}/none")
    files = catalogs.file_sizes(spark, path).select(F.url_decode(F.regexp_replace("path", r"\+", "%2B")).alias("path"))
    m = files.withColumn("tract", F.when(F.col("path").contains("/x/"), 1).cast("long")).withColumn("o_totalprice", F.lit(0.0))
    for columns in (None, ["o_orderdate", "o_orderkey"]):
        listed = readers.manifest_scan(spark, m, columns, o.schema)
        dealt = readers.manifest_scan(spark, m, columns, o.schema, max_paths=1)
        assert dealt.columns == listed.columns
        assert sorted(dealt.collect(), key=str) == sorted(listed.collect(), key=str)
        assert dealt.count() == o.count()
    assert readers.manifest_scan(spark, m.limit(0), None, o.schema, max_paths=-1).count() == 0
