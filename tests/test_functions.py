import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from starloom.functions import photometry as ph
from starloom.functions.healpix import ancestor, pixel_range, with_healpix
from starloom.functions.special import erfc, log_gamma
from starloom.functions.sphere import separation_arcsec
from starloom.operators import match, nested, regions, stats
from starloom.sources.readers import clean, query_text


def test_pixels_partition_the_sky_and_nest(spark):
    pts = [(float(i % 360), float(d)) for i in range(0, 720, 7) for d in (-90, -89.9, -60, -41.9, -10, 0, 30, 41.8, 66, 89.99, 90)]
    df = spark.createDataFrame(pts, "ra double, dec double")
    df = with_healpix(df, "ra", "dec")
    for o in (0, 3, 8):
        df = with_healpix(df, "ra", "dec", o, f"p{o}").withColumn(f"a{o}", ancestor("healpix29", o))
    for r in df.collect():
        for o in (0, 3, 8):
            assert r[f"p{o}"] == r[f"a{o}"] and 0 <= r[f"p{o}"] < 12 * 4**o
    assert pixel_range(3, 1, 3) == (48, 64)


def test_pixels_have_equal_area(spark):
    g = np.random.default_rng(1)
    n = 120_000
    ra, dec = g.uniform(0, 360, n), np.degrees(np.arcsin(g.uniform(-1, 1, n)))
    df = with_healpix(spark.createDataFrame(list(zip(ra.tolist(), dec.tolist())), "ra double, dec double"), "ra", "dec", 1, "p")
    counts = [r["count"] for r in df.groupBy("p").count().collect()]
    assert len(counts) == 48 and max(abs(c - n / 48) for c in counts) < 6 * math.sqrt(n / 48)


def test_known_pixels(spark):
    # base pixels: 0..3 north, 4..7 equator starting at ra 0, 8..11 south
    df = spark.createDataFrame([(45.0, 80.0, 0), (135.0, 80.0, 1), (0.0, 0.0, 4), (90.0, 0.0, 5), (315.0, -80.0, 11)], "ra double, dec double, want int")
    assert all(r["p"] == r["want"] for r in with_healpix(df, "ra", "dec", 0, "p").collect())


@pytest.mark.parametrize("radius", [0.5, 3600.0, 6 * 3600.0])
def test_match_at_poles_and_wrap_equals_brute_force(spark, radius):
    g = np.random.default_rng(2)
    pts = [(0.0, 90.0), (123.0, -90.0), (359.99999, 0.0), (0.00001, 0.0), (200.0, 89.99), (20.0, 89.99)] + [(float(a), float(d)) for a, d in zip(g.uniform(0, 360, 40), g.uniform(-90, 90, 40))]
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "lid bigint, lra double, ldec double")
    b = spark.createDataFrame([(i, (p[0] + 1e-5) % 360, max(-90.0, min(90.0, p[1] - 1e-5))) for i, p in enumerate(pts)], "rid bigint, rra double, rdec double")
    near = a.crossJoin(b).withColumn("d", separation_arcsec("lra", "ldec", "rra", "rdec")).where(F.col("d") <= radius)
    want = sorted((r["lid"], r["rid"]) for r in near.collect())
    for h in (None, 0.01, 7.0):
        if h == 0.01 and radius > 3600:
            continue
        got = sorted((r["lid"], r["rid"]) for r in match.close_pairs(a, b, radius, h).collect())
        assert got == want


def test_null_and_nan_rules(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (-1.0, 2.0), (None, 4.0)], "f double, e double")
    r = clean(df).select(ph.flux_to_mag("f").alias("m"), "e").collect()
    assert r[0]["m"] == pytest.approx(31.4) and r[0]["e"] is None and r[1]["m"] is None and r[2]["m"] is None
    p = {x["name"]: x["null_count"] for x in stats.null_profile(df).collect()}
    assert p == {"f": 1, "e": 1}


def test_nested_null_rules(spark):
    rows = [Row(id=1, lc=[Row(t=1.0, x=None), Row(t=2.0, x=3.0)]), Row(id=2, lc=[Row(t=1.0, x=float("nan"))]), Row(id=3, lc=[]), Row(id=4, lc=None)]
    df = spark.createDataFrame(rows, "id bigint, lc array<struct<t: double, x: double>>")
    d = nested.dropna_elements(df, "lc", ["x"])
    assert {r["id"]: None if r["lc"] is None else len(r["lc"]) for r in d.collect()} == {1: 1, 2: 0, 3: 0, 4: None}
    assert [r["id"] for r in nested.drop_empty(d, "lc").collect()] == [1]
    n = {r["id"]: r["n_lc"] for r in nested.count_nested(d, ["id"], "lc").collect()}
    assert n == {1: 1, 2: 0, 3: 0, 4: 0}


def test_query_text_rewrites_outside_quotes():
    assert query_text("a == 'x & ~y' & ~b") == "a == 'x & ~y'  AND   NOT b"


def test_special_functions(spark):
    r = spark.range(1).select(*[log_gamma(F.lit(x)).alias(f"g{i}") for i, x in enumerate((5.0, 17.5, 300.0))], *[erfc(F.lit(x)).alias(f"e{i}") for i, x in enumerate((-2.0, 0.3, 4.0))]).first()
    for i, x in enumerate((5.0, 17.5, 300.0)):
        assert r[f"g{i}"] == pytest.approx(math.lgamma(x), abs=1e-7)
    for i, x in enumerate((-2.0, 0.3, 4.0)):
        assert r[f"e{i}"] == pytest.approx(math.erfc(x), rel=2e-7)


def test_regions_agree_with_geometry(spark):
    g = np.random.default_rng(4)
    pts = list(zip(g.uniform(0, 360, 3000).tolist(), np.degrees(np.arcsin(g.uniform(-1, 1, 3000))).tolist()))
    df = spark.createDataFrame(pts, "ra double, dec double")
    for ra, dec, r in ((0.5, 0.0, 20.0), (80.0, 85.0, 10.0), (359.0, -70.0, 25.0)):
        want = df.where(separation_arcsec("ra", "dec", ra, dec) <= r * 3600).count()
        assert want > 0 and regions.search(df, regions.ConeSearch(ra, dec, r * 3600)).count() == want
    box = regions.search(df, regions.BoxSearch((350.0, 370.0), (-45.0, 45.0))).collect()
    assert box and all((x["ra"] >= 350 or x["ra"] <= 10) and abs(x["dec"]) <= 45 for x in box)


def test_visit_lookup_guards(spark):
    from starloom.operators.joins import visit_time_lookup

    v = spark.createDataFrame([(1, 5.0)], "visitId bigint, expMidptMJD double")
    with pytest.raises(ValueError):
        visit_time_lookup(spark.createDataFrame([(1, 2.0)], "visit bigint, midpointMjdTai double"), v)
    with pytest.raises(ValueError):
        visit_time_lookup(spark.createDataFrame([(1,)], "other bigint"), v)


def test_task_functions_travel_by_value(tmp_path):
    """A process without the package on its path can load what runs in tasks."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from starloom.operators.scan import LombScargle

    (tmp_path / "m.pkl").write_bytes(cloudpickle.dumps(LombScargle()))
    code = "import pickle; m = pickle.load(open('m.pkl', 'rb')); print(m.t_ref)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert out.stdout.strip() == "60000.0", out.stderr
