"""The ways for huge groups give the same results as the plain ways.

Limits are set low so that small fixtures take the cut paths.
"""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import features, fits, match, nested, period, series, structure
from starloom.operators.joins import nearest_in_time
from starloom.operators.ordered import ordered, percentiles, top_k
from starloom.operators.scan import LombScargle, fixed_grid, scan_all, explode_scores

HOT = "spark.starloom.hotRows"


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; times repeat, some values are null."""
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        obj = 1 if i % 3 else 2 + i % 20
        rows.append((obj, "r", round(rnd.uniform(0, 40), 2), rnd.gauss(100, 10), rnd.uniform(1, 3), i))
    df = spark.createDataFrame(rows, "objectId bigint, band string, mjd double, psfFlux double, psfFluxErr double, visit bigint")
    path = spark.conf.get("spark.checkpoint.dir") + "/skewed"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def both(spark, job):
    """Run a job the plain way and the cut way; floats agree to 1e-7 relative (1e-6 absolute)."""

    def rows(df):
        out = [tuple(sorted(r.asDict().items())) for r in df.collect()]
        return sorted(out, key=lambda r: [(k, repr(v)) for k, v in r if not isinstance(v, float)] + [(k, v) for k, v in r if isinstance(v, float)])

    spark.conf.unset(HOT)
    plain = rows(job())
    spark.conf.set(HOT, "250")
    try:
        cut = rows(job())
    finally:
        spark.conf.unset(HOT)
    assert plain and len(plain) == len(cut)
    for a, b in zip(plain, cut):
        for (k, x), (_, y) in zip(a, b):
            assert x == (pytest.approx(y, rel=1e-7, abs=1e-6) if isinstance(y, float) else y), (k, a, b)


def test_ordered_rank_sums_lags(spark, skewed):
    both(spark, lambda: ordered(skewed, ["objectId"], ["mjd", "visit"], rank="rn", sums={"run": F.col("psfFlux")}, lags={"prev": "visit"}))


def test_percentiles(spark, skewed):
    both(spark, lambda: percentiles(skewed, ["objectId"], "psfFlux", {"a": 0.05, "b": 0.5, "c": 0.84}))


def test_features(spark, skewed):
    for fn in (features.eta, features.anderson_darling, features.otsu, features.value_range):
        both(spark, lambda fn=fn: fn(skewed))


def test_series(spark, skewed):
    both(spark, lambda: series.cusum(skewed))
    both(spark, lambda: series.whitened_residuals(skewed).select("visit", "whitened"))
    both(spark, lambda: series.consecutive_diff(skewed).select("visit", "dt", "dflux"))


def test_nearest_in_time(spark, skewed):
    both(spark, lambda: nearest_in_time(skewed, ["objectId"], "mjd", "psfFlux", 0.0, 40.0, 2.5, "visit"))


def test_structure(spark, skewed):
    edges = [0.0, 0.503, 3.003, 10.003]
    both(spark, lambda: structure.sf_fixed_bins(skewed, edges))
    both(spark, lambda: structure.sf2_basic(skewed, edges))
    both(spark, lambda: structure.sf_equal_count(skewed, 4))


def test_period_scans(spark, skewed):
    grid = fixed_grid(0.2, 0.01, 60)
    both(spark, lambda: period.best_period(skewed, ["objectId"], grid, f_max=0.79, tie="visit"))
    both(spark, lambda: explode_scores(scan_all(skewed, ["objectId"], LombScargle(), grid, tie="visit"), ["objectId"]))
    both(spark, lambda: fits.bazin_grid_fit(skewed, ["objectId"], tie="visit").select("objectId", "n", "chi2_const", "chi2_bazin"))


def test_packed_lists_are_cut_and_whole(spark, skewed):
    spark.conf.set(HOT, "50")
    try:
        # one row per object, however long its list, unless the caller asks for segments
        whole = nested.pack(skewed, ["objectId"], ["psfFlux"], ["mjd", "visit"])
        assert whole.count() == whole.select("objectId").distinct().count()
        p = nested.pack(skewed, ["objectId"], ["psfFlux"], ["mjd", "visit"], max_list=50)
        assert p.agg(F.max(F.size("lc"))).first()[0] <= 50
        assert p.where("objectId = 1").count() == 12
        flat = nested.flatten(p, "lc")
        assert flat.count() == 900 and flat.select("visit").distinct().count() == 900
        # segments follow one another in time
        ends = {r["segment"]: (r["a"], r["b"]) for r in p.where("objectId = 1").select("segment", F.col("lc")[0]["mjd"].alias("a"), F.element_at("lc", -1)["mjd"].alias("b")).collect()}
        assert all(ends[i][1] <= ends[i + 1][0] for i in range(len(ends) - 1))
    finally:
        spark.conf.unset(HOT)


def test_top_k_plan_limits_before_the_shuffle(skewed):
    plan = top_k(skewed, ["objectId"], ["mjd", "visit"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_crowded_match_is_exact(spark):
    rnd = random.Random(3)
    left = [(i, 10 + rnd.gauss(0, 1e-4), 20 + rnd.gauss(0, 1e-4)) for i in range(150)] + [(1000 + i, 10.0, 20.0) for i in range(60)]
    right = [(i, 10 + rnd.gauss(0, 2e-4), 20 + rnd.gauss(0, 2e-4)) for i in range(150)] + [(1000 + i, 10.0, 20.0) for i in range(80)] + [(5000, 10.0009, 20.0)]
    a = spark.createDataFrame(left, "lid bigint, lra double, ldec double")
    b = spark.createDataFrame(right, "rid bigint, rra double, rdec double")
    key = lambda df: sorted((r["lid"], r["rank"], r["rid"]) for r in df.collect())
    for k in (1, 4):
        plain = key(match.nearest(a, b, 3.6, k, dense_cell=10**9))
        dense = key(match.nearest(a, b, 3.6, k, dense_cell=5))
        assert plain and plain == dense
