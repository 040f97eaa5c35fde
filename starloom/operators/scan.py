"""Scans of a model grid over many light curves.

A model turns a light curve into a few weighted sums per grid point and the
sums into a score.  Sums are additive, so:

* an object whose list fits one segment is scanned inside one Arrow task and
  only its best grid point (or its score array) leaves the task: one shuffle,
  the packing;
* an object cut into several segments gives partial sums per segment and grid
  point, which Spark adds up before the score is taken.

Python is used here because the cost is a dense trigonometric matrix per light
curve; numpy on Arrow batches does it per block of grid points, with bounded
memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.nested import MAX_LIST, pack
from starloom.operators.ordered import costly_tasks, is_hot, same_keys
from starloom.session import hot_rows

BLOCK = 4096
_CELLS = 2_000_000
# Grids of more points than WIDE are summed by transforms of WIDE_BLOCK points (a multiple of BLOCK).
WIDE = 16_384
WIDE_BLOCK = 1 << 18
# Points to either side on which an observation is spread; twelve give some twelve digits.
_SPREAD = 12


def even_sums(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """Sums of c * exp(2 pi i k x) for k = 0 .. n - 1, by spreading the points onto an even grid (Greengard & Lee 2004).

    Each point becomes a narrow Gaussian on a grid of twice ``n`` cells; one
    transform and a division by the Gaussian's own transform give the sums.
    """
    half = 1 << max(4, int(n - 1).bit_length() - 1)
    cells = 4 * half
    tau = np.pi * _SPREAD / (3 * (2.0 * half) ** 2)
    x = x - np.floor(x)
    c = c * np.exp(2j * np.pi * half * x)
    grid = np.zeros(cells, complex)
    near = np.arange(-_SPREAD + 1, _SPREAD + 1)
    for lo in range(0, len(x), _CELLS // 64):
        u, v = x[lo : lo + _CELLS // 64], c[lo : lo + _CELLS // 64]
        at = np.floor(u * cells).astype(np.int64)[:, None] + near
        gauss = np.exp(-((2 * np.pi * (u[:, None] - at / cells)) ** 2) / (4 * tau)) * v[:, None]
        at = (at % cells).ravel()
        grid += np.bincount(at, gauss.real.ravel(), cells) + 1j * np.bincount(at, gauss.imag.ravel(), cells)
    k = np.arange(n) - half
    return np.fft.ifft(grid)[k % cells] * (np.sqrt(np.pi / tau) * np.exp(tau * k.astype(float) ** 2))


@dataclass(frozen=True)
class LombScargle:
    """Floating-mean sinusoid (Zechmeister & Kuerster 2009), power between 0 and 1.

    Grid point k is frequency f0 + k * step.
    """

    t_ref: float = 60000.0
    bad_periods: tuple[float, ...] = ()
    bad_range: float = 0.0
    min_period: float = 0.0
    max_period: float = float("inf")
    n_sums = 6

    def freq(self, k, g):
        return g["f0"] + k * g["step"]

    def valid(self, k, g):
        if not self.bad_periods and self.min_period <= 0 and self.max_period == float("inf"):
            return np.ones(len(k), dtype=bool)
        p = 1.0 / self.freq(k, g)
        ok = (p >= self.min_period) & (p <= self.max_period)
        for b in self.bad_periods:
            ok &= np.abs(p / b - 1.0) > self.bad_range
        return ok

    def sums(self, t, y, w, k, g):
        if len(k) > BLOCK:
            zw, z2 = self.wide_sums(t, y, w, k, g)
            return self.six(zw, z2, w)
        # k is a run of consecutive grid points: exp(i x) of an even grid is a
        # product of two short tables, far cheaper than one sine per cell
        tau = 2j * np.pi * (t - self.t_ref)
        m = int(np.ceil(np.sqrt(len(k))))
        coarse = np.exp(np.outer(self.freq(k[::m], g), tau))
        fine = np.exp(np.outer(np.arange(m) * g["step"], tau))
        z = (coarse[:, None, :] * fine[None, :, :]).reshape(-1, len(t))[: len(k)]
        zw = z @ np.stack([w, w * y], axis=1)
        return self.six(zw, (z * z) @ w, w)

    def wide_sums(self, t, y, w, k, g):
        d = t - self.t_ref
        first = np.exp(2j * np.pi * self.freq(k[0], g) * d)
        zw = np.stack([even_sums(g["step"] * d, v * first, len(k)) for v in (w, w * y)], axis=1)
        return zw, even_sums(2 * g["step"] * d, w * first * first, len(k))

    def six(self, zw, z2, w):
        # cos^2 = (1 + cos 2x) / 2, cos sin = sin 2x / 2
        return np.stack([zw[:, 0].real, zw[:, 0].imag, (w.sum() + z2.real) / 2, z2.imag / 2, zw[:, 1].real, zw[:, 1].imag])

    def score(self, a, w, y, yy):
        c, s, cc, cs, yc, ys = a / w
        m = y / w
        var = yy / w - m * m
        ss = 1.0 - cc - s * s
        cc = cc - c * c
        cs = cs - c * s
        yc = yc - m * c
        ys = ys - m * s
        d = cc * ss - cs * cs
        with np.errstate(divide="ignore", invalid="ignore"):
            p = (ss * yc * yc + cc * ys * ys - 2 * cs * yc * ys) / (var * d)
        return np.where((d > 1e-12) & np.isfinite(p), p, np.nan)


@dataclass(frozen=True)
class BoxSearch:
    """Box-shaped dip or bump (Kovacs et al. 2002): best s^2 / (r (1 - r)) over boxes of 1..max_width phase bins.

    Grid point k is period f0 + k * step.
    """

    bins: int = 20
    max_width: int = 5
    t_ref: float = 60000.0

    @property
    def n_sums(self):
        return 2 * self.bins

    def valid(self, k, g):
        return np.ones(len(k), dtype=bool)

    def sums(self, t, y, w, k, g):
        # one count over (grid point, phase bin) for the whole block
        ph = (t - self.t_ref)[None, :] / (g["f0"] + k * g["step"])[:, None]
        b = np.minimum(np.floor((ph - np.floor(ph)) * self.bins).astype(np.int64), self.bins - 1)
        cell = (np.arange(len(k))[:, None] * self.bins + b).ravel()
        sums = [np.bincount(cell, np.tile(v, len(k)), len(k) * self.bins).reshape(len(k), self.bins).T for v in (w, w * y)]
        return np.concatenate(sums)

    def score(self, a, w, y, yy):
        sw, sy = a[: self.bins] / w, (a[self.bins :] - a[: self.bins] * (y / w)) / w
        best = np.full(sw.shape[1:], np.nan)
        for width in range(1, self.max_width + 1):
            for start in range(self.bins):
                idx = [(start + j) % self.bins for j in range(width)]
                r, s = sw[idx].sum(0), sy[idx].sum(0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    q = s * s / (r * (1 - r))
                best = np.fmax(best, np.where((r > 0) & (r < 1), q, np.nan))
        return best


@dataclass(frozen=True)
class Bazin:
    """Rise-and-fall pulse A g(t) + B on a grid of (t0, rise, fall); A and B are linear.

    The score is the share of the constant model's chi2 that the pulse removes.
    t0 runs over ``n_t0`` points of the object's own time span (columns f0 and
    step give its start and spacing).
    """

    rises: tuple[float, ...] = (2.0, 8.0)
    falls: tuple[float, ...] = (10.0, 40.0)
    n_t0: int = 12
    n_sums = 3

    def params(self, k, g):
        n = len(self.rises) * len(self.falls)
        i, j = k // n, k % n
        rise = np.asarray(self.rises)[j // len(self.falls)]
        fall = np.asarray(self.falls)[j % len(self.falls)]
        return g["f0"] + i * g["step"], rise, fall

    def valid(self, k, g):
        return np.ones(len(k), dtype=bool)

    def sums(self, t, y, w, k, g):
        t0, rise, fall = (np.asarray(x, float)[:, None] for x in self.params(k, g))
        x = t[None, :] - t0
        u = -x / rise
        pulse = np.exp(-x / fall - (np.maximum(u, 0) + np.log1p(np.exp(-np.abs(u)))))
        return np.stack([pulse @ w, (pulse * pulse) @ w, pulse @ (w * y)])

    def score(self, a, w, y, yy):
        g, gg, yg = a / w
        m = y / w
        var = yy / w - m * m
        gg = gg - g * g
        yg = yg - m * g
        with np.errstate(divide="ignore", invalid="ignore"):
            p = yg * yg / (gg * var)
        return np.where((gg > 1e-12) & np.isfinite(p), p, np.nan)


def fixed_grid(f0: float, step: float, n: int) -> dict[str, Column]:
    return {"f0": F.lit(float(f0)), "step": F.lit(float(step)), "nf": F.lit(int(n))}


def auto_grid(min_period: float, max_period: float, samples_per_peak: int = 10):
    """Per-object frequency grid: spacing 1 / (time span * samples per peak)."""
    span = F.col("__t1") - F.col("__t0")
    step = 1.0 / (span * samples_per_peak)
    lo, hi = 1.0 / max_period, 1.0 / min_period
    return {"f0": F.lit(lo), "step": step, "nf": (1 + F.round((hi - lo) / step)).cast("int")}


def _arrays(df: DataFrame, keys, time, flux, err, tie, grid, min_points, limit, biggest=None) -> tuple[DataFrame, bool]:
    """Packed rows (keys, segment, t, y, e, f0, step, nf) and whether any object has several segments."""
    weights = F.col(err).cast("double") if err else F.lit(1.0)
    rows = df.select(*keys, F.col(time).cast("double").alias("t"), F.col(flux).cast("double").alias("y"), weights.alias("e"), *( [tie] if tie else []))
    rows = rows.where(F.col("t").isNotNull() & F.col("y").isNotNull() & (F.col("e") > 0))
    parts = is_hot(rows, keys, limit, biggest)
    lists = pack(rows, keys, ["y", "e"], ["t"] + ([tie] if tie else []), "lc", max_list=limit, biggest=None if parts else limit, tasks=costly_tasks(rows, keys, biggest is None or biggest > limit))
    cols = {"t": F.transform("lc", lambda x: x["t"]), "y": F.transform("lc", lambda x: x["y"]), "e": F.transform("lc", lambda x: x["e"])}
    out = lists.withColumns(cols).drop("lc")
    if parts:
        st = rows.groupBy(*keys).agg(F.min("t").alias("__t0"), F.max("t").alias("__t1"), F.count(F.lit(1)).alias("__n"))
        out = same_keys(out, st, keys, "left")
    else:
        out = out.withColumns({"__t0": F.element_at("t", 1), "__t1": F.element_at("t", -1), "__n": F.size("t").cast("long")})
    out = out.where(F.col("__n") >= min_points)
    return out.withColumns(grid).drop("__t0", "__t1", "__n"), parts


def _curve(row):
    t = np.asarray(row.t, dtype=float)
    y = np.asarray(row.y, dtype=float)
    e = np.asarray(row.e, dtype=float)
    return t, y, 1.0 / (e * e)


def _blocks(model, n_points, nf):
    wide = nf > WIDE and hasattr(model, "wide_sums")
    size = WIDE_BLOCK if wide else max(1, min(BLOCK, _CELLS // max(1, n_points)))
    for lo in range(0, nf, size):
        yield np.arange(lo, min(nf, lo + size))


def _key_fields(df, keys):
    return [f for f in df.schema.fields if f.name in keys]


_SCALARS = [("n", T.LongType()), ("w", T.DoubleType()), ("wy", T.DoubleType()), ("wyy", T.DoubleType()), ("st", T.DoubleType()), ("stt", T.DoubleType())]


def _scalars(t, y, w, ref):
    d = t - ref
    return len(t), w.sum(), (w * y).sum(), (w * y * y).sum(), d.sum(), (d * d).sum()


def _partial_sums(lists: DataFrame, keys, model, ref) -> DataFrame:
    """Rows (keys, k, sums..., scalars, grid) added over segments."""
    names = [f"a{i}" for i in range(model.n_sums)]
    fields = _key_fields(lists, keys) + [T.StructField("k", T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in names]
    fields += [T.StructField(c, ty) for c, ty in _SCALARS] + [T.StructField("f0", T.DoubleType()), T.StructField("step", T.DoubleType())]

    def run(frames):
        for pdf in frames:
            for row in pdf.itertuples(index=False):
                t, y, w = _curve(row)
                g = {"f0": row.f0, "step": row.step}
                sc = _scalars(t, y, w, ref)
                for k in _blocks(model, len(t), int(row.nf)):
                    ok = model.valid(k, g)
                    a = model.sums(t, y, w, k, g)[:, ok]
                    k = k[ok]
                    out = pd.DataFrame({c: a[i] for i, c in enumerate(names)})
                    for key in keys:
                        out[key] = getattr(row, key)
                    out["k"] = k
                    for (c, _), v in zip(_SCALARS, sc):
                        out[c] = v
                    out["f0"], out["step"] = row.f0, row.step
                    yield out[[f.name for f in fields]]

    part = lists.mapInPandas(run, T.StructType(fields))
    sums = [F.sum(c).alias(c) for c in [*names, *[c for c, _ in _SCALARS]]]
    return part.groupBy(*keys, "k").agg(*sums, F.first("f0").alias("f0"), F.first("step").alias("step"))


def _scored(sums: DataFrame, keys, model) -> DataFrame:
    names = [f"a{i}" for i in range(model.n_sums)]
    schema = T.StructType(sums.schema.fields + [T.StructField("score", T.DoubleType())])

    def run(frames):
        for pdf in frames:
            a = pdf[names].to_numpy().T
            s = model.score(a, pdf["w"].to_numpy(), pdf["wy"].to_numpy(), pdf["wyy"].to_numpy())
            yield pdf.assign(score=s)

    out = sums.mapInPandas(run, schema)
    return out.withColumn("score", F.when(~F.isnan("score"), F.col("score")))


def scan_best(
    df: DataFrame, keys: list[str], model, grid: dict[str, Column], time="mjd", flux="psfFlux", err: str | None = "psfFluxErr",
    tie: str | None = None, min_points: int = 4, max_list: int | None = None, biggest: int | None = None,
) -> DataFrame:
    """Best grid point of each light curve.

    Columns: k, score, the sums at k, f0, step, n, w, wy, wyy, t_var, and of all
    valid grid points n_scores, mean_score, std_score.
    """
    limit = max_list or min(MAX_LIST, hot_rows(df.sparkSession))
    lists, parts = _arrays(df, keys, time, flux, err, tie, grid, min_points, limit, biggest)
    ref = getattr(model, "t_ref", 0.0)
    names = [f"a{i}" for i in range(model.n_sums)]
    if parts:
        s = _scored(_partial_sums(lists, keys, model, ref), keys, model).where(F.col("score").isNotNull())
        best = F.max_by(F.struct("k", "score", *names, "f0", "step", "n", "w", "wy", "wyy", "st", "stt"), F.struct("score", -F.col("k"))).alias("b")
        out = s.groupBy(*keys).agg(best, F.count("score").alias("n_scores"), F.sum("score").alias("s1"), F.sum(F.col("score") * F.col("score")).alias("s2"))
        out = out.select(*keys, "b.*", "n_scores", "s1", "s2")
    else:
        fields = _key_fields(lists, keys) + [T.StructField("k", T.IntegerType()), T.StructField("score", T.DoubleType())]
        fields += [T.StructField(c, T.DoubleType()) for c in [*names, "f0", "step"]] + [T.StructField(c, ty) for c, ty in _SCALARS]
        fields += [T.StructField("n_scores", T.LongType()), T.StructField("s1", T.DoubleType()), T.StructField("s2", T.DoubleType())]
        cols = [f.name for f in fields]

        def run(frames):
            for pdf in frames:
                out = []
                for row in pdf.itertuples(index=False):
                    t, y, w = _curve(row)
                    g = {"f0": row.f0, "step": row.step}
                    sc = _scalars(t, y, w, ref)
                    top, n, s1, s2 = None, 0, 0.0, 0.0
                    for k in _blocks(model, len(t), int(row.nf)):
                        a = model.sums(t, y, w, k, g)
                        p = np.where(model.valid(k, g), model.score(a, sc[1], sc[2], sc[3]), np.nan)
                        ok = np.isfinite(p)
                        n, s1, s2 = n + int(ok.sum()), s1 + p[ok].sum(), s2 + (p[ok] ** 2).sum()
                        if ok.any():
                            i = int(np.nanargmax(p))
                            if top is None or p[i] > top[1]:
                                top = (int(k[i]), float(p[i]), *a[:, i])
                    if top is not None:
                        out.append((*[getattr(row, c) for c in keys], *top, row.f0, row.step, *sc, n, s1, s2))
                yield pd.DataFrame(out, columns=cols)

        out = lists.mapInPandas(run, T.StructType(fields))
    mean = F.col("s1") / F.col("n_scores")
    var = (F.col("s2") - F.col("s1") * mean) / F.nullif(F.col("n_scores") - 1, F.lit(0))
    tv = F.col("stt") / F.col("n") - (F.col("st") / F.col("n")) * (F.col("st") / F.col("n"))
    out = out.withColumns({"mean_score": mean, "std_score": F.sqrt(F.greatest(F.lit(0.0), var)), "t_var": tv})
    return out.drop("s1", "s2", "st", "stt")


def scan_all(
    df: DataFrame, keys: list[str], model, grid: dict[str, Column], time="mjd", flux="psfFlux", err: str | None = "psfFluxErr",
    tie: str | None = None, min_points: int = 4, max_list: int | None = None, biggest: int | None = None,
) -> DataFrame:
    """Scores of all grid points as arrays of at most BLOCK values, NaN where undefined.

    Columns: keys, k0 (first grid point of the block), scores, f0, step, w, wy, wyy.
    """
    limit = max_list or min(MAX_LIST, hot_rows(df.sparkSession))
    lists, parts = _arrays(df, keys, time, flux, err, tie, grid, min_points, limit, biggest)
    ref = getattr(model, "t_ref", 0.0)
    scal = ["f0", "step", "w", "wy", "wyy"]
    if parts:
        s = _scored(_partial_sums(lists, keys, model, ref), keys, model)
        blk = (F.floor(F.col("k") / BLOCK) * BLOCK).cast("int")
        out = s.groupBy(*keys, blk.alias("k0")).agg(F.array_sort(F.collect_list(F.struct("k", "score"))).alias("__s"), *[F.first(c).alias(c) for c in scal])
        return out.withColumn("scores", F.transform("__s", lambda x: F.coalesce(x["score"], F.lit(float("nan"))))).drop("__s").select(*keys, "k0", "scores", *scal)
    fields = _key_fields(lists, keys) + [T.StructField("k0", T.IntegerType()), T.StructField("scores", T.ArrayType(T.DoubleType()))] + [T.StructField(c, T.DoubleType()) for c in scal]
    cols = [f.name for f in fields]

    def run(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                t, y, w = _curve(row)
                g = {"f0": row.f0, "step": row.step}
                sc = _scalars(t, y, w, ref)
                nf = int(row.nf)
                held, start = [], 0
                for ks in _blocks(model, len(t), nf):
                    p = model.score(model.sums(t, y, w, ks, g), sc[1], sc[2], sc[3])
                    held.append(np.where(model.valid(ks, g) & np.isfinite(p), p, np.nan))
                    # arrays start at multiples of BLOCK
                    ready = np.concatenate(held)
                    whole = len(ready) if ks[-1] == nf - 1 else len(ready) // BLOCK * BLOCK
                    for lo in range(0, whole, BLOCK):
                        out.append((*[getattr(row, c) for c in keys], start + lo, ready[lo : min(whole, lo + BLOCK)], row.f0, row.step, *sc[1:4]))
                    held, start = [ready[whole:]], start + whole
                    if len(out) * BLOCK >= _CELLS:
                        yield pd.DataFrame(out, columns=cols)
                        out = []
            yield pd.DataFrame(out, columns=cols)

    return lists.mapInPandas(run, T.StructType(fields))


def explode_scores(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per grid point: keys, k, x = f0 + k * step, score."""
    e = df.select(*keys, "k0", "f0", "step", F.posexplode("scores").alias("pos", "score"))
    k = (F.col("k0") + F.col("pos")).cast("int")
    return e.select(*keys, k.alias("k"), (F.col("f0") + k * F.col("step")).alias("x"), F.when(~F.isnan("score"), F.col("score")).alias("score"))


def combine_scores(df: DataFrame, keys: list[str], weight: Column) -> DataFrame:
    """Weighted mean over the other key (bands) of score arrays on one common grid."""
    g = df.withColumn("__w", weight).groupBy(*keys, "k0").agg(
        F.collect_list(F.struct("__w", "scores")).alias("__l"), F.sum("__w").alias("__total"), F.first("f0").alias("f0"), F.first("step").alias("step")
    )
    zero = F.transform(F.col("__l")[0]["scores"], lambda _: F.lit(0.0))
    total = F.aggregate("__l", zero, lambda acc, b: F.zip_with(acc, b["scores"], lambda u, v: u + v * b["__w"]))
    return g.select(*keys, "k0", "f0", "step", F.transform(total, lambda v: v / F.col("__total")).alias("scores"))


def best_of_scores(df: DataFrame, keys: list[str]) -> DataFrame:
    """Best grid point over all blocks: k, x, score; the first of equals."""
    tops = F.array_max(F.filter(F.transform("scores", lambda s, i: F.struct(s.alias("score"), (-i).alias("neg"))), lambda s: ~F.isnan(s["score"])))
    t = df.select(*keys, "k0", "f0", "step", tops.alias("__t")).where(F.col("__t").isNotNull())
    k = (F.col("k0") - F.col("__t.neg")).cast("int")
    t = t.select(*keys, k.alias("k"), (F.col("f0") + k * F.col("step")).alias("x"), F.col("__t.score").alias("score"))
    return t.groupBy(*keys).agg(F.max_by(F.struct("k", "x", "score"), F.struct("score", -F.col("k"))).alias("b")).select(*keys, "b.*")
