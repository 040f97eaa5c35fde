"""All pairs of light curves too long for one task.

A curve is cut by time into pieces of bounded length.  Two pieces (or one with
itself) make a block, and blocks are dealt to tasks, so the pairs of one curve
are walked by as many tasks as it has blocks.  A block returns counts and sums;
Spark adds them up.

Ranks are found digit by digit.  A number from 0 on and its 64 bits as a whole
number have the same order, so each pass counts the pairs by the next digit
under the digits known so far, and after the last pass the value of a rank and the
number of pairs below it are exact.  For lags, blocks that a pass cannot need
are left out, and blocks inside one digit are counted without listing pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starloom.operators.ordered import ordered, same_keys
from starloom.operators.pairs import draws
from starloom.session import materialize

# Points of a piece, points of the cells in which a block is walked, and pairs that a task should meet.
PIECE_ROWS = 8192
STEP = 512
TASK_PAIRS = 250_000_000
# Right shifts after each pass: eleven bits a pass, the sign bit is always 0.
SHIFTS = (63, 52, 41, 30, 19, 8, 0)
G = "__g"


def from_bits(col):
    """The number whose 64 bits are the whole number ``col``."""

    @F.pandas_udf("double")
    def view(v: pd.Series) -> pd.Series:
        return pd.Series(v.to_numpy(dtype=np.int64).view(np.float64))

    return view(col)


def bits(x) -> np.ndarray:
    """The 64 bits of numbers; those below 0 count as 0."""
    return np.maximum(np.asarray(x, dtype=np.float64), 0.0).view(np.int64)


class Curve:
    """Columns of one piece."""

    def __init__(self, row):
        self.t, self.f, self.e2 = (np.asarray(row[c], dtype=float) for c in ("t", "f", "e2"))
        self.tie = np.asarray(row["tie"], dtype=np.int64)


def cells(a: Curve, b: Curve):
    """Slices (of a, of b) and the least and largest lag in them, where any lag is above 0."""
    for s in range(0, len(a.t), STEP):
        for r in range(0, len(b.t), STEP):
            p, q = slice(s, s + STEP), slice(r, r + STEP)
            lo, hi = b.t[q][0] - a.t[p][-1], b.t[q][-1] - a.t[p][0]
            if hi > 0:
                yield p, q, lo, hi


def listed(a: Curve, b: Curve, p: slice, q: slice):
    """Index arrays of the pairs of a cell with a lag above 0, and the lags."""
    dt = b.t[q][None, :] - a.t[p][:, None]
    i, j = np.nonzero(dt > 0)
    return i + p.start, j + q.start, dt[i, j]


def lag_digits(a: Curve, b: Curve, row, before: int, after: int):
    """Rows (bin 0, prefix, digit, n) of the lags whose leading bits are a wanted prefix."""
    wanted, mask = np.sort(np.asarray(row["r_prefix"], dtype=np.int64)), (1 << (before - after)) - 1
    count = np.zeros((len(wanted), mask + 1), np.int64)
    for p, q, lo, hi in cells(a, b):
        low, high = int(bits(lo)), int(bits(hi))
        first = np.searchsorted(wanted, low >> before)
        if first == np.searchsorted(wanted, high >> before, side="right"):
            continue
        if lo > 0 and low >> after == high >> after:
            count[first, (low >> after) & mask] += len(a.t[p]) * len(b.t[q])
            continue
        _tally(count, wanted, bits(listed(a, b, p, q)[2]), before, after, mask)
    r, c = np.nonzero(count)
    return pd.DataFrame({"bin": 0, "prefix": wanted[r], "digit": c, "n": count[r, c]})


def difference_digits(a: Curve, b: Curve, row, before: int, after: int):
    """Rows (log bin, prefix, digit, n) of the squared differences, as ``lag_digits``."""
    own, prefix, mask = np.asarray(row["r_bin"]), np.asarray(row["r_prefix"], dtype=np.int64), (1 << (before - after)) - 1
    wanted = {k: np.sort(prefix[own == k]) for k in np.unique(own)}
    count = {k: np.zeros((len(w), mask + 1), np.int64) for k, w in wanted.items()}
    for p, q, _, _ in cells(a, b):
        i, j, dt = listed(a, b, p, q)
        k = log_bin(dt, row["lo"], row["hi"], row["nbins"])
        d2 = bits((b.f[j] - a.f[i]) ** 2)
        for at, w in wanted.items():
            _tally(count[at], w, d2[k == at], before, after, mask)
    out = []
    for at, w in wanted.items():
        r, c = np.nonzero(count[at])
        out.append(pd.DataFrame({"bin": at, "prefix": w[r], "digit": c, "n": count[at][r, c]}))
    return pd.concat(out)


def _tally(count, wanted, v, before, after, mask) -> None:
    lead = v >> before
    r = np.minimum(np.searchsorted(wanted, lead), len(wanted) - 1)
    ok = wanted[r] == lead
    count += np.bincount(r[ok] * (mask + 1) + ((v[ok] >> after) & mask), minlength=count.size).reshape(count.shape)


def log_bin(dt, lo: float, hi: float, nbins: int) -> np.ndarray:
    """Log bins from the smallest to the largest lag; -1 outside, the last edge included in it."""
    base, step = np.log10(lo), (np.log10(hi) - np.log10(lo)) / nbins
    k = np.maximum(0, np.floor((np.log10(dt) - base) / step)).astype(np.int64)
    return np.where((dt < hi) & (k < nbins), k, -1)


def bin_sums(a: Curve, b: Curve, row):
    """Pairs and summed squared differences between the edges (``tie`` null), and of lags equal to an edge by the earlier row's tie."""
    edges = np.asarray(row["edges"], dtype=float)
    n, s, on = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1), []
    for p, q, lo, hi in cells(a, b):
        k = int(np.searchsorted(edges, lo, side="left"))
        if lo > 0 and k == np.searchsorted(edges, hi, side="right"):
            fa, fb = a.f[p] - a.f[p].mean(), b.f[q] - a.f[p].mean()
            n[k] += len(fa) * len(fb)
            s[k] += len(fa) * (fb @ fb) + len(fb) * (fa @ fa) - 2 * fa.sum() * fb.sum()
            continue
        i, j, dt = listed(a, b, p, q)
        d2 = (b.f[j] - a.f[i]) ** 2
        k = np.searchsorted(edges, dt, side="left")
        at = k < np.searchsorted(edges, dt, side="right")
        n += np.bincount(k[~at], minlength=len(n))
        s += np.bincount(k[~at], d2[~at], minlength=len(s))
        if at.any():
            on.append(pd.DataFrame({"edge": dt[at], "tie": a.tie[i[at]], "n": 1, "s": d2[at]}).groupby(["edge", "tie"], as_index=False).sum())
    out = pd.DataFrame({"bin": np.arange(len(n)), "n": n, "s": s})
    out = out[out.n > 0]
    if on:
        out = pd.concat([out, pd.concat(on)])
    return out.reindex(columns=["bin", "edge", "tie", "n", "s"])


def cut_ties(a: Curve, b: Curve, row):
    """The single pairs of rows whose ties at an edge are cut by a bin's end."""
    out = []
    for edge, tie in zip(row["c_edge"], row["c_tie"]):
        for i in np.flatnonzero(a.tie == tie):
            j = np.flatnonzero(b.t - a.t[i] == edge)
            out.append(pd.DataFrame({"edge": edge, "tie": tie, "tie2": b.tie[j], "s": (b.f[j] - a.f[i]) ** 2}))
    return pd.concat(out).reindex(columns=["edge", "tie", "tie2", "s"]) if out else None


def resampled(a: Curve, b: Curve, edges, replicates: int, seed: int):
    """Per bin and replicate: summed draws and drawn values; replicate -1 holds the plain count and sum."""
    nb = len(edges) - 1
    w, s = np.zeros((replicates + 1, nb)), np.zeros((replicates + 1, nb))
    for p, q, lo, hi in cells(a, b):
        if lo >= edges[-1] or hi < edges[0]:
            continue
        i, j, dt = listed(a, b, p, q)
        k = np.searchsorted(edges, dt, side="right") - 1
        ok = (k >= 0) & (k < nb)
        i, j, k = i[ok], j[ok], k[ok]
        d = (b.f[j] - a.f[i]) ** 2 - (a.e2[i] + b.e2[j])
        w[0] += np.bincount(k, minlength=nb)
        s[0] += np.bincount(k, d, minlength=nb)
        for r in range(replicates):
            x = draws(a.tie[i], b.tie[j], r, seed)
            w[r + 1] += np.bincount(k, x, minlength=nb)
            s[r + 1] += np.bincount(k, x * d, minlength=nb)
    r, k = np.nonzero(w)
    return pd.DataFrame({"bin": k, "replicate": r - 1, "w": w[r, k], "s": s[r, k]})


class LongCurves:
    """The groups of ``rows`` (keys, t, tie, f, e2) with more than ``limit`` rows, cut into stored pieces."""

    def __init__(self, rows: DataFrame, keys: list[str], limit: int):
        self.keys = keys
        sized = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
        self.groups = materialize(sized.withColumn(G, F.monotonically_increasing_id()))
        own = same_keys(rows, self.groups, keys, "inner").select(G, "t", "tie", "f", "e2")
        cut = ordered(own, [G], ["t", "tie"], rank="__r").withColumn("piece", F.floor((F.col("__r") - 1) / PIECE_ROWS).cast("int"))
        packed = cut.groupBy(G, "piece").agg(F.array_sort(F.collect_list(F.struct("t", "tie", "f", "e2"))).alias("p"))
        self.pieces = materialize(packed.select(G, "piece", *[F.col("p")[c].alias(c) for c in ("t", "tie", "f", "e2")]))
        ends = self.pieces.select(G, "piece", F.col("t")[0].alias("t0"), F.element_at("t", -1).alias("t1"))
        last = self.groups.select(G, F.floor((F.col("__n") - 1) / PIECE_ROWS).cast("int").alias("last"))
        left = ends.join(last, G).select(G, F.col("piece").alias("a"), F.col("t0").alias("a0"), F.col("t1").alias("a1"), F.explode(F.sequence("piece", "last")).alias("b"))
        links = left.join(ends.withColumnsRenamed({"piece": "b", "t0": "b0", "t1": "b1"}), [G, "b"])
        lo = F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.greatest(F.lit(0.0), F.col("b0") - F.col("a1")))
        self.links = links.select(G, "a", "b", lo.alias("from"), (F.col("b1") - F.col("a0")).alias("to")).where("to > 0")
        blocks = self.groups.agg(F.sum(F.expr(f"ceil(__n / {PIECE_ROWS}) * (ceil(__n / {PIECE_ROWS}) + 1) / 2"))).first()[0] or 0
        self.tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(blocks * PIECE_ROWS**2 // TASK_PAIRS))

    def walk(self, links: DataFrame, fn, schema: str) -> DataFrame:
        """Rows (curve, ...) from ``fn(a, b, row)`` of each block; ``links`` may bring further columns for ``row``."""
        sides = [links.join(self.pieces.withColumnRenamed("piece", "a"), [G, "a"]).withColumn("side", F.lit(0))]
        sides.append(links.where("a < b").join(self.pieces.withColumnRenamed("piece", "b"), [G, "b"]).withColumn("side", F.lit(1)))
        names = [G, *[c.strip().split()[0] for c in schema.split(",")]]

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("side")
            row = pdf.iloc[0]
            a = Curve(row)
            out = fn(a, Curve(pdf.iloc[1]) if len(pdf) > 1 else a, row)
            return out.assign(**{G: row[G]})[names] if out is not None else pd.DataFrame(columns=names)

        rows = sides[0].unionByName(sides[1]).repartition(self.tasks, G, "a", "b")
        return rows.groupBy(G, "a", "b").applyInPandas(run, f"{G} long, {schema}")

    def ranks(self, digits, bins: DataFrame, wanted, narrow: bool) -> DataFrame:
        """(curve, bin, rank, value, below) of wanted 0-based ranks.

        ``bins`` has (curve, bin) and what ``digits`` needs from its row;
        ``wanted`` maps the pair counts (curve, bin, total) to rows (curve, bin, rank).
        ``narrow`` leaves out blocks without a lag in a wanted interval.
        """
        extra = [c for c in bins.columns if c not in (G, "bin")]
        known = bins.withColumns({"prefix": F.lit(0).cast("long")})
        state = None
        for before, after in zip(SHIFTS, SHIFTS[1:]):
            # at most one interval per wanted rank of a curve
            arrays = {"r_bin": F.collect_list("bin"), "r_prefix": F.collect_list("prefix")}
            if narrow and state is not None:
                known = known.withColumns({"v0": from_bits(F.col("prefix") * (1 << before)), "v1": from_bits((F.col("prefix") + 1) * (1 << before) - 1)})
                arrays["reach"] = F.collect_list(F.struct("v0", "v1"))
            per = known.groupBy(G, *extra).agg(*[e.alias(c) for c, e in arrays.items()])
            links = self.links.join(per, G)
            if "reach" in arrays:
                links = links.where(F.exists("reach", lambda r: (r["v1"] >= F.col("from")) & (r["v0"] <= F.col("to")))).drop("reach")
            found = self.walk(links, _with_shifts(digits, before, after), "bin int, prefix long, digit int, n long")
            found = materialize(found.groupBy(G, "bin", "prefix", "digit").agg(F.sum("n").alias("n")))
            if state is None:
                totals = found.groupBy(G, "bin").agg(F.sum("n").alias("total"))
                state = wanted(totals).withColumns({"prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long")})
            # at most 2048 digits per interval
            upto = F.sum("n").over(W.partitionBy(G, "bin", "prefix").orderBy("digit"))
            rest = F.col("rank") - F.col("below")
            state = state.join(found.withColumn("upto", upto), [G, "bin", "prefix"]).where((rest >= F.col("upto") - F.col("n")) & (rest < F.col("upto")))
            state = materialize(state.select(G, "bin", "rank", (F.col("prefix") * (1 << (before - after)) + F.col("digit")).alias("prefix"), (F.col("below") + F.col("upto") - F.col("n")).alias("below")))
            known = state.select(G, "bin", "prefix").distinct()
            if extra:
                known = known.join(bins, [G, "bin"])
        return state.select(G, "bin", "rank", from_bits(F.col("prefix")).alias("value"), "below")

    def named(self, out: DataFrame, fields: list[str]) -> DataFrame:
        """Curve numbers back to the keys."""
        return out.join(self.groups, G).select(*self.keys, *fields)

    def equal_count(self, nbins: int) -> DataFrame:
        """As ``pairs.equal_count``: keys, bin, SF, N, tau_median."""
        per = F.floor(F.col("total") / nbins)
        # bins of a curve with fewer pairs than bins: the last takes all
        number = F.sequence(F.lit(0), F.when(per > 0, nbins - 1).otherwise(0))
        start = F.col("k") * F.col("per")
        size = F.when(F.col("k") == F.when(F.col("per") > 0, nbins - 1).otherwise(0), F.col("total") - start).otherwise(F.col("per"))
        seen = {}

        def wanted(totals):
            plan = totals.select(G, "total", per.alias("per"), F.explode(number).alias("k")).withColumns({"start": start, "n": size})
            seen["plan"] = plan = materialize(plan.where("n > 0"))
            half = F.array("start", F.col("start") + F.floor((F.col("n") - 1) / 2), F.col("start") + F.floor(F.col("n") / 2))
            return plan.select(G, F.lit(0).alias("bin"), F.explode(half).alias("rank")).distinct()

        at = materialize(self.ranks(lag_digits, self.groups.select(G, F.lit(0).alias("bin")), wanted, narrow=True))
        plan = seen["plan"]
        value = at.select(G, "rank", "value")
        mids = plan.select(G, "k", F.explode(F.array(F.col("start") + F.floor((F.col("n") - 1) / 2), F.col("start") + F.floor(F.col("n") / 2))).alias("rank"))
        tau = mids.join(value, [G, "rank"]).groupBy(G, "k").agg(F.avg("value").alias("tau_median"))

        first = plan.where("k > 0").select(G, F.col("start").alias("rank")).join(at, [G, "rank"])
        edges = plan.select(G).distinct().join(first.groupBy(G).agg(F.array_sort(F.collect_list("value")).alias("edges")), G, "left")
        edges = edges.withColumn("edges", F.coalesce("edges", F.array().cast("array<double>")))
        parts = materialize(self.walk(self.links.join(edges, G), bin_sums, "bin int, edge double, tie long, n long, s double"))
        inner = parts.where("edge IS NULL").select(G, F.col("bin").alias("k"), "s")

        # ties at an edge by the earlier row: ranks from the pairs below the edge and a running count
        ties = parts.where("edge IS NOT NULL").groupBy(G, "edge", "tie").agg(F.sum("n").cast("long").alias("n"), F.sum("s").alias("s"))
        ties = ordered(ties, [G, "edge"], ["tie"], sums={"upto": F.col("n")})
        ends = first.select(G, F.col("value").alias("edge"), "below").distinct().join(plan.select(G, "per").distinct(), G)
        ties = ties.join(ends, [G, "edge"]).withColumn("r0", F.col("below") + F.col("upto") - F.col("n"))
        bin_at = lambda r: F.least(F.floor(r / F.col("per")), F.lit(nbins - 1)).cast("int")
        ties = materialize(ties.withColumns({"k": bin_at(F.col("r0")), "k1": bin_at(F.col("r0") + F.col("n") - 1)}))
        whole = ties.where("k = k1").select(G, "k", "s")
        # at most nbins - 1 rows of a curve are cut
        cut = ties.where("k < k1")
        listed_at = cut.groupBy(G).agg(F.collect_list(F.struct("edge", "tie")).alias("c")).select(G, F.col("c.edge").alias("c_edge"), F.col("c.tie").alias("c_tie"))
        single = materialize(self.walk(self.links.join(listed_at, G), cut_ties, "edge double, tie long, tie2 long, s double"))
        single = ordered(single, [G, "edge", "tie"], ["tie2"], rank="__r").join(cut.select(G, "edge", "tie", "r0", "per"), [G, "edge", "tie"])
        single = single.select(G, bin_at(F.col("r0") + F.col("__r") - 1).alias("k"), "s")

        sums = inner.unionByName(whole).unionByName(single).groupBy(G, "k").agg(F.sum("s").alias("s"))
        out = plan.join(sums, [G, "k"]).join(tau, [G, "k"])
        name = F.when(F.col("per") > 0, F.col("k")).otherwise(nbins - 1).cast("int")
        return self.named(out.select(G, name.alias("bin"), F.sqrt(F.col("s") / F.col("n")).alias("SF"), F.col("n").cast("long").alias("N"), "tau_median"), ["bin", "SF", "N", "tau_median"])

    def log_median(self, nbins: int) -> DataFrame:
        """As ``pairs.log_median``: keys, bin, tau, SF."""
        inside = F.expr("array_min(filter(transform(slice(t, 2, size(t)), (x, i) -> x - t[i]), d -> d > 0))")
        ends = self.pieces.select(G, "piece", F.col("t")[0].alias("t0"), F.element_at("t", -1).alias("t1"), inside.alias("gap"))
        # one row per piece
        step = F.col("t0") - F.lag("t1").over(W.partitionBy(G).orderBy("piece"))
        ends = ends.withColumn("gap", F.least("gap", F.when(step > 0, step)))
        span = ends.groupBy(G).agg(F.min("gap").alias("lo"), (F.max("t1") - F.min("t0")).alias("hi")).where("lo < hi")
        span = materialize(span.withColumn("nbins", F.lit(nbins)))
        bins = span.select("*", F.explode(F.sequence(F.lit(0), F.lit(nbins - 1))).alias("bin"))
        half = F.array(F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2))
        at = self.ranks(difference_digits, bins, lambda totals: totals.select(G, "bin", F.explode(half).alias("rank")).distinct(), narrow=False)
        out = at.groupBy(G, "bin").agg(F.sqrt(F.avg("value")).alias("SF")).join(span, G)
        width = (F.log10("hi") - F.log10("lo")) / nbins
        return self.named(out.withColumn("tau", F.pow(F.lit(10.0), F.log10("lo") + (F.col("bin") + 0.5) * width)), ["bin", "tau", "SF"])

    def bootstrap(self, edges: list[float], replicates: int, seed: int) -> DataFrame:
        """As ``pairs.bootstrap``: keys, bin, n, sf2, lower, upper."""
        parts = self.walk(self.links.where(F.col("from") < edges[-1]), lambda a, b, row: resampled(a, b, edges, replicates, seed), "bin int, replicate int, w double, s double")
        s = parts.groupBy(G, "bin", "replicate").agg(F.sum("w").alias("w"), F.sum("s").alias("s")).withColumn("x", F.col("s") / F.col("w"))
        drawn = F.col("replicate") >= 0
        # one value per replicate
        spread = F.percentile(F.when(drawn, F.col("x")), F.array(F.lit(0.16), F.lit(0.84)))
        out = s.groupBy(G, "bin").agg(F.max(F.when(~drawn, F.col("w"))).cast("long").alias("n"), F.max(F.when(~drawn, F.col("x"))).alias("sf2"), spread.alias("q"))
        out = out.where("q IS NOT NULL").select(G, "bin", "n", "sf2", F.col("q")[0].alias("lower"), F.col("q")[1].alias("upper"))
        return self.named(out, ["bin", "n", "sf2", "lower", "upper"])


def _with_shifts(fn, before: int, after: int):
    return lambda a, b, row: fn(a, b, row, before, after)
