"""Statistics over all pairs of a light curve that running totals cannot give.

A light curve is packed and its pairs are walked in blocks of bounded size
inside the task that holds it; no pair leaves the task and, but for ties at
the edges of equal counts, none is kept beyond its block.  Longer curves than
``LONG`` are dealt to many tasks by ``long_curves``.  Order statistics come from repeated passes: each narrows the
interval of a wanted rank by a histogram until few values are left in it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.ordered import costly_tasks, largest_group, same_keys
from starloom.session import hot_rows

# Points of the longest light curve that one task walks alone.
LONG = 5_000

# Pairs in one block, values that a last pass may collect per rank, and cells of a histogram.
BLOCK_PAIRS = 2_000_000
COLLECT = 500_000
CELLS = 4096


def pair_blocks(t: np.ndarray):
    """Index arrays (i, j) of all pairs with t[i] < t[j]; ``t`` is ascending."""
    m, start = len(t), 0
    while start < m - 1:
        stop = min(m - 1, start + max(1, BLOCK_PAIRS // (m - start)))
        later = np.arange(start + 1, m)
        i, j = np.nonzero(t[later][None, :] > t[start:stop, None])
        yield i + start, later[j]
        start = stop


def select_ranks(stream, wanted: list[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """Values at 0-based ranks: ``stream()`` yields (bin, value) arrays, ``wanted`` lists (bin, rank).

    A rank is known to lie in a region: a chain of histogram cells, each within
    the one before.  Ranks in one region share its histogram.
    """
    regions = {(b, ()) for b, _ in wanted}
    at = {w: ((w[0], ()), 0) for w in wanted}  # rank -> region, values below it
    while True:
        size, low, high = (dict.fromkeys(regions, x) for x in (0, np.inf, -np.inf))
        for region, v in _inside(stream, regions):
            size[region] += len(v)
            low[region], high[region] = min(low[region], v.min()), max(high[region], v.max())
        wide = {r for r in regions if low[r] < high[r] and size[r] > COLLECT}
        if not wide:
            break
        scale = {r: CELLS / (high[r] - low[r]) for r in wide}
        count = {r: np.zeros(CELLS, np.int64) for r in wide}
        for region, v in _inside(stream, wide):
            count[region] += np.bincount(_cells(v, low[region], scale[region]), minlength=CELLS)
        for w, (region, below) in at.items():
            if region in wide:
                upto = np.cumsum(count[region])
                c = int(np.searchsorted(upto, w[1] - below, side="right"))
                at[w] = (region[0], (*region[1], (low[region], scale[region], c))), below + int(upto[c] - count[region][c])
        regions = {r for r, _ in at.values()}
    few: dict = {r: [] for r in regions if low[r] < high[r]}
    for region, v in _inside(stream, set(few)):
        few[region].append(v)
    few = {r: np.sort(np.concatenate(p)) for r, p in few.items()}
    return {w: float(few[r][w[1] - below] if r in few else low[r]) for w, (r, below) in at.items()}


def _cells(v: np.ndarray, low: float, scale: float) -> np.ndarray:
    return np.minimum(((v - low) * scale).astype(np.int64), CELLS - 1)


def _inside(stream, regions: set):
    """The values of each region, block by block; regions of one bin share its first cells."""
    heads = {(b, chain[:1][0][:2] if chain else None) for b, chain in regions}
    for b, v in stream():
        for k, head in heads:
            own = v[b == k]
            cell = _cells(own, *head) if head else None
            for region in regions:
                if region[0] != k or (region[1][0][:2] if region[1] else None) != head:
                    continue
                part = own if cell is None else own[cell == region[1][0][2]]
                for lo, scale, c in region[1][1:]:
                    part = part[_cells(part, lo, scale) == c]
                if len(part):
                    yield region, part


def middle(n: int, first: int = 0) -> list[int]:
    """The one or two middle ranks of ``n`` values from rank ``first``."""
    return sorted({first + (n - 1) // 2, first + n // 2})


def equal_count(t, tie, f, nbins: int) -> list[tuple[int, float, int, float]]:
    """(bin, sqrt of mean squared difference, pairs, median lag): pairs by lag, then by their rows' ties, in bins of equal count."""
    total = sum(len(i) for i, _ in pair_blocks(t))
    if not total:
        return []
    per = total // nbins
    starts = [k * per for k in range(nbins)] if per else [0]
    names = list(range(nbins)) if per else [nbins - 1]
    sizes = np.diff([*starts, total]).tolist()

    def lags():
        for i, j in pair_blocks(t):
            yield np.zeros(len(i), np.int64), t[j] - t[i]

    mids = [middle(n, s) for s, n in zip(starts, sizes)]
    at = select_ranks(lags, [(0, r) for r in sorted({*starts[1:], *(r for m in mids for r in m)})])
    edges = np.array([at[0, s] for s in starts[1:]])
    sums, counts = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
    ties: list[tuple[np.ndarray, ...]] = []
    for i, j in pair_blocks(t):
        dt, d2 = t[j] - t[i], (f[j] - f[i]) ** 2
        k = np.searchsorted(edges, dt, side="left")
        on = k < np.searchsorted(edges, dt, side="right")
        sums += np.bincount(k[~on], d2[~on], minlength=len(sums))
        counts += np.bincount(k[~on], minlength=len(sums))
        ties.append((dt[on], tie[i[on]], tie[j[on]], d2[on]))
    dt, a, b, d2 = (np.concatenate(c) for c in zip(*ties))
    order = np.lexsort((b, a, dt))
    dt, d2 = dt[order], d2[order]
    for e in np.unique(dt):
        own = np.flatnonzero(dt == e)
        # smaller lags, and the ties at smaller edges, come before
        rank = int(counts[: np.searchsorted(edges, e) + 1].sum()) + own
        sums += np.bincount(np.minimum(rank // per, len(sums) - 1), d2[own], minlength=len(sums))
    return [(names[k], float(np.sqrt(sums[k] / n)), int(n), float(np.mean([at[0, r] for r in mids[k]]))) for k, n in enumerate(sizes) if n]


def log_median(t, tie, f, nbins: int) -> list[tuple[int, float, float]]:
    """(bin, tau, sqrt of median squared difference) in log bins from the smallest to the largest lag, the last edge exclusive."""
    lo, hi = np.inf, -np.inf
    for i, j in pair_blocks(t):
        if len(i):
            dt = t[j] - t[i]
            lo, hi = min(lo, dt.min()), max(hi, dt.max())
    if not lo < hi:
        return []
    base, step = np.log10(lo), (np.log10(hi) - np.log10(lo)) / nbins

    def values():
        for i, j in pair_blocks(t):
            dt = t[j] - t[i]
            b = np.maximum(0, np.floor((np.log10(dt) - base) / step)).astype(np.int64)
            ok = (dt < hi) & (b < nbins)
            yield b[ok], (f[j[ok]] - f[i[ok]]) ** 2

    sizes = np.zeros(nbins, np.int64)
    for b, _ in values():
        sizes += np.bincount(b, minlength=nbins)
    mids = {k: middle(int(n)) for k, n in enumerate(sizes) if n}
    at = select_ranks(values, [(k, r) for k, m in mids.items() for r in m])
    return [(k, float(10 ** (base + (k + 0.5) * step)), float(np.sqrt(np.mean([at[k, r] for r in m])))) for k, m in mids.items()]


# Cumulative Poisson(1) probabilities.
POISSON = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940581, 0.99991676)
_PRIME = (1 << 31) - 1


def draws(a: np.ndarray, b: np.ndarray, replicate: int, seed: int) -> np.ndarray:
    """Poisson(1) counts from a hash of the two row numbers, the replicate and the seed; 64-bit integers suffice for each step."""
    h = (a % _PRIME * 48271 + b % _PRIME * 40692 + seed * 16807) % _PRIME
    h = (h * h + replicate * 69621 + 7919) % _PRIME
    h = (h * h + 12345) % _PRIME
    return np.searchsorted(np.array(POISSON), h / float(_PRIME), side="left")


def bootstrap(t, tie, f, e2, edges: list[float], replicates: int, seed: int) -> list[tuple[int, int, float, float, float]]:
    """(bin, n, sf2, 16 and 84 percentiles over the replicates)."""
    nb = len(edges) - 1
    n, sums, weight, weighted = np.zeros(nb, np.int64), np.zeros(nb), np.zeros((replicates, nb)), np.zeros((replicates, nb))
    tie = tie.astype(np.int64)
    for i, j in pair_blocks(t):
        b = np.searchsorted(edges, t[j] - t[i], side="right") - 1
        ok = (b >= 0) & (b < nb)
        i, j, b = i[ok], j[ok], b[ok]
        d = (f[j] - f[i]) ** 2 - (e2[i] + e2[j])
        n += np.bincount(b, minlength=nb)
        sums += np.bincount(b, d, minlength=nb)
        for r in range(replicates):
            w = draws(tie[i], tie[j], r, seed)
            weight[r] += np.bincount(b, w, minlength=nb)
            weighted[r] += np.bincount(b, w * d, minlength=nb)
    out = []
    for k in range(nb):
        got = weight[:, k] > 0
        if n[k] and got.any():
            lo, hi = np.quantile(weighted[got, k] / weight[got, k], [0.16, 0.84])
            out.append((k, int(n[k]), float(sums[k] / n[k]), float(lo), float(hi)))
    return out


def per_light_curve(df: DataFrame, keys: list[str], fn, dealt, fields: list[tuple[str, T.DataType]], time: str, value: str, tie: str, err: str | None = None) -> DataFrame:
    """Rows (keys, *fields) from ``fn(t, tie, f, e2)`` of each light curve, sorted by time and tie; rows without time or value are left out.

    Curves of more than ``LONG`` points go to ``dealt``, a function of a ``LongCurves``.
    """
    e2 = F.col(err) * F.col(err) if err else F.lit(0.0)
    rows = df.select(*keys, F.col(time).cast("double").alias("t"), F.col(tie).cast("long").alias("tie"), F.col(value).cast("double").alias("f"), e2.cast("double").alias("e2"))
    rows = rows.where(F.col("t").isNotNull() & ~F.isnan("t") & F.col("f").isNotNull())
    tasks, limit, long = costly_tasks(df, keys), min(LONG, hot_rows(df.sparkSession)), None
    if largest_group(df, keys) > limit:
        from starloom.operators.long_curves import LongCurves

        curves = LongCurves(rows, keys, limit)
        long = dealt(curves)
        rows = same_keys(rows, curves.groups.select(*keys), keys, "left_anti")
    lists = rows.withColumn("p", F.struct("t", "tie", "f", "e2")).repartition(tasks, *keys).groupBy(*keys).agg(F.array_sort(F.collect_list("p")).alias("lc"))
    lists = lists.select(*keys, *[F.col("lc")[c].alias(f"__{c}") for c in ("t", "tie", "f", "e2")])
    schema = T.StructType([f for f in lists.schema.fields if f.name in keys] + [T.StructField(n, k) for n, k in fields])

    def run(frames):
        for pdf in frames:
            out = []
            for _, row in pdf.iterrows():
                own = tuple(row[k] for k in keys)
                columns = [np.asarray(row[f"__{c}"], dtype=np.int64 if c == "tie" else float) for c in ("t", "tie", "f", "e2")]
                out += [(*own, *r) for r in fn(*columns)]
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    short = lists.mapInPandas(run, schema)
    return short if long is None else short.unionByName(long.select(*short.columns))
