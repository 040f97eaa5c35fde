"""Pairs of curves dealt to many tasks equal the walk inside one task."""

import math

import numpy as np
import pytest

from starloom.operators import long_curves, pairs, structure


def curve(spark, n, gridded, seed=3):
    rng = np.random.default_rng(seed)
    t = rng.integers(0, 60, n) * 0.5 if gridded else rng.uniform(0, 400, n)
    rows = [(1, "r", float(t[k]), round(float(rng.normal(100, 3)), 1), 0.5, k) for k in rng.permutation(n).tolist()]
    rows += [(None, "g", float(k), float(k % 7), 0.1, k) for k in range(20)] + [(2, "r", None, 1.0, 1.0, 5), (1, "r", None, 1.0, 1.0, 9999)]
    return spark.createDataFrame(rows, "objectId long, band string, mjd double, psfFlux double, psfFluxErr double, visit long")


def forms(df):
    return (
        structure.sf_equal_count(df, 6),
        structure.sf_median(df, 5),
        structure.sf2_bootstrap(df, [0.0, 3.25, 12.25, 25.25], replicates=6, seed=2).select("objectId", "band", "bin", "n", "sf2", "lower", "upper", "sigma"),
    )


@pytest.mark.parametrize("gridded", [True, False])
def test_dealt_blocks_equal_one_task(spark, monkeypatch, gridded):
    df = curve(spark, 300, gridded).cache()
    plain = [sorted(f.collect(), key=str) for f in forms(df)]
    monkeypatch.setattr(pairs, "LONG", 100)
    monkeypatch.setattr(long_curves, "PIECE_ROWS", 90)
    monkeypatch.setattr(long_curves, "STEP", 16)
    for one, many in zip(plain, forms(df)):
        many = sorted(many.collect(), key=str)
        assert len(one) == len(many) >= 6
        for a, b in zip(one, many):
            assert a[:3] == b[:3]
            assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a[3:], b[3:]))


def test_one_time_only(spark, monkeypatch):
    """Points at one time make no pair; two times make one lag, all pairs tied at every edge."""
    monkeypatch.setattr(pairs, "LONG", 10)
    monkeypatch.setattr(long_curves, "PIECE_ROWS", 7)
    rows = [(1, "r", 5.0, float(k), 0.1, k) for k in range(30)] + [(2, "r", float(k // 10), float(k), 0.1, k) for k in range(20)]
    df = spark.createDataFrame(rows, "objectId long, band string, mjd double, psfFlux double, psfFluxErr double, visit long")
    got = sorted(tuple(r) for r in structure.sf_equal_count(df, 3).collect())
    d2 = [float(b - a) ** 2 for a in range(10) for b in range(10, 20)]
    cut = [d2[:33], d2[33:66], d2[66:]]
    assert [(r[0], r[2], r[4], r[5]) for r in got] == [(2, k, len(c), 1.0) for k, c in enumerate(cut)]
    assert all(math.isclose(r[3], math.sqrt(sum(c) / len(c))) for r, c in zip(got, cut))
    assert structure.sf_median(df, 3).count() == 0


def test_blocks_in_small_cells(monkeypatch):
    """Counts and sums of a block do not depend on the cells it is walked in, closed forms included."""
    import pandas as pd

    rng = np.random.default_rng(8)
    t = np.sort(np.concatenate([rng.uniform(0, 50, 150), np.arange(150) * 0.5]))
    one = {"t": t, "f": rng.normal(50, 2, 300).round(1), "e2": t * 0 + 0.1, "tie": rng.permutation(300)}
    a, b = (long_curves.Curve({k: v[s] for k, v in one.items()}) for s in (slice(0, 170), slice(170, 300)))
    row = {"r_prefix": [0], "r_bin": [0, 2], "lo": 0.001, "hi": 60.0, "nbins": 4, "edges": [0.5, 3.0, 3.0, 20.0]}
    for p, q in ((a, a), (a, b)):
        dt = q.t[None, :] - p.t[:, None]
        d2, dt = ((q.f[None, :] - p.f[:, None]) ** 2)[dt > 0], dt[dt > 0]
        lead = long_curves.bits(dt) >> 52
        deep = {**row, "r_prefix": sorted(set(lead[[3, 400, 900]].tolist()))}
        for step in (16, 1_000_000):
            monkeypatch.setattr(long_curves, "STEP", step)
            got = long_curves.lag_digits(p, q, row, 63, 52)
            assert dict(zip(got.digit, got.n)) == pd.Series(lead).value_counts().to_dict()
            got = long_curves.lag_digits(p, q, deep, 52, 41)
            want = pd.Series(long_curves.bits(dt)[np.isin(lead, deep["r_prefix"])] >> 41).value_counts().to_dict()
            assert dict(zip(got.prefix * 2048 + got.digit, got.n)) == want
            got = long_curves.difference_digits(p, q, {**row, "r_prefix": [0, 0]}, 63, 52)
            k = long_curves.log_bin(dt, 0.001, 60.0, 4)
            assert got.groupby("bin").n.sum().to_dict() == {x: int((k == x).sum()) for x in (0, 2) if (k == x).any()}
            got = long_curves.bin_sums(p, q, row)
            on, inner = got[got.edge.notna()], got[got.edge.isna()]
            tied = np.isin(dt, row["edges"])
            assert on.n.sum() == tied.sum() and math.isclose(on.s.sum(), d2[tied].sum(), abs_tol=1e-9)
            k = np.searchsorted(row["edges"], dt[~tied])
            assert dict(zip(inner.bin, inner.n)) == pd.Series(k).value_counts().to_dict()
            assert np.allclose(inner.s, [d2[~tied][k == x].sum() for x in inner.bin])
