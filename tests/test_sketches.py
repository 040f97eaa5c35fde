"""Stored sketches merge to those of the whole, within their error bounds."""

from pyspark.sql import functions as F

from starloom.operators import sketches


def test_days_merge_to_the_whole(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("tile"), (F.col("id") % 11).alias("day"), (F.col("id") % 9000).alias("obj"), F.sqrt("id").alias("x"))
    df = df.unionByName(df.limit(50).withColumns({"obj": F.lit(None).cast("long"), "x": F.lit(None).cast("double")}))
    daily = sketches.sketch(df, ["tile", "day"], ["obj"], ["x"])
    whole = {r.tile: r for r in sketches.estimates(sketches.merge(sketches.sketch(df, ["tile"], ["obj"], ["x"]), ["tile"]), [0.1, 0.5]).collect()}
    merged = sketches.estimates(sketches.merge(daily, ["tile"]), [0.1, 0.5]).collect()
    exact = {r.tile: r for r in df.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("obj").alias("d")).collect()}
    assert len(merged) == 3
    for r in merged:
        assert r.n == exact[r.tile].n and r.distinct_obj == whole[r.tile].distinct_obj
        assert abs(r.distinct_obj / exact[r.tile].d - 1) < 0.05
        own = df.where((F.col("tile") == r.tile) & F.col("x").isNotNull())
        for p, q in zip((0.1, 0.5), r.quantiles_x):
            assert abs(own.where(F.col("x") <= q).count() / own.count() - p) < 0.03


def test_groups_without_values(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", 1.0), (2, "a", 1.0)], "g int, s string, x double")
    one = sketches.sketch(df, ["g"], ["s"], ["x"])
    got = {r.g: (r.n, r.distinct_s, r.quantiles_x) for r in sketches.estimates(one).collect()}
    assert got == {1: (1, 0, None), 2: (2, 1, [1.0])}
    both = sketches.estimates(sketches.merge(one, [])).first()
    assert (both.n, both.distinct_s, both.quantiles_x) == (3, 1, [1.0])
    assert sketches.estimates(sketches.sketch(df.limit(0), ["g"], ["s"], ["x"])).count() == 0
