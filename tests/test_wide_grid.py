"""Wide frequency grids: sums by transforms equal direct sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import scan


def direct(t, y, w, g, nf):
    m = scan.LombScargle()
    return np.concatenate([m.sums(t, y, w, k, g) for k in np.split(np.arange(nf), range(1000, nf, 1000))], axis=1)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 1000, 4096, 5000])
def test_even_sums(n):
    rng = np.random.default_rng(n)
    x, c = rng.uniform(-30, 30, 40), rng.normal(size=40) + 1j * rng.normal(size=40)
    x[:3] = 0.0, 1.0, -0.5
    want = np.exp(2j * np.pi * np.outer(np.arange(n), x)) @ c
    assert np.abs(scan.even_sums(x, c, n) - want).max() < 1e-9


def test_four_bands_and_300_000_frequencies(spark):
    rng = np.random.default_rng(4)
    nf, g = 300_000, {"f0": 0.5, "step": 3.0 / 300_000}
    curves = {}
    for band, period in zip("griz", (0.31, 0.47, 0.9, 1.7)):
        t = 60000 + rng.uniform(-400, 900, 60)
        curves[band] = t, np.sin(2 * np.pi * t / period) + rng.normal(0, 0.2, 60), rng.uniform(0.1, 0.3, 60)
    rows = [(b, float(t), float(y), float(e)) for b, c in curves.items() for t, y, e in zip(*c)]
    df = spark.createDataFrame(rows, "band string, mjd double, psfFlux double, psfFluxErr double")
    grid = scan.fixed_grid(g["f0"], g["step"], nf)
    best = {r["band"]: r for r in scan.scan_best(df, ["band"], scan.LombScargle(), grid).collect()}
    scores = scan.scan_all(df, ["band"], scan.LombScargle(), grid)
    assert scores.where(F.col("k0") % scan.BLOCK != 0).count() == 0
    held = {b: scores.where(F.col("band") == b).orderBy("k0").select("scores").collect() for b in ("g", "z")}
    for band, (t, y, e) in curves.items():
        w = e**-2.0
        p = scan.LombScargle().score(direct(t, y, w, g, nf), w.sum(), (w * y).sum(), (w * y * y).sum())
        assert best[band]["k"] == p.argmax() and abs(best[band]["score"] - p.max()) < 1e-7
        assert best[band]["n_scores"] == nf and abs(best[band]["mean_score"] - p.mean()) < 1e-7
        if band in held:
            got = np.concatenate([r[0] for r in held[band]])
            assert len(got) == nf and np.abs(got - p).max() < 1e-7
