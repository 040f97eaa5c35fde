"""Coverage maps as sets of index ranges, and their algebra.

A map is a DataFrame of tiles (order, pixel) of mixed orders or of half-open
ranges (lo, hi) of the order-29 index; overlaps are allowed.  Set operations are a
sweep over the ends of the ranges: running counts say which maps hold the piece
that begins there.  Ranges are first cut at the pixels of one coarse order, so the
sweep runs cell by cell, each a window of its own, and a map may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions import healpix

# Order of the cells of a sweep: 3072 of them, and a range of the whole sky is cut into as many pieces.
CELL_ORDER = 4

_KEEP = {
    "union": lambda a, b: a | b,
    "intersection": lambda a, b: a & b,
    "difference": lambda a, b: a & ~b,
    "symmetric_difference": lambda a, b: a != b,
}


def to_ranges(coverage: DataFrame) -> DataFrame:
    """Rows (lo, hi) of a map given as (order, pixel) or already as (lo, hi)."""
    if "lo" in coverage.columns:
        return coverage.select("lo", "hi").where("lo < hi")
    at = [F.expr(f"shiftleft(cast(pixel AS bigint) + {k}, cast(2 * ({healpix.MAX_ORDER} - order) AS int))") for k in (0, 1)]
    return coverage.select(at[0].alias("lo"), at[1].alias("hi"))


def in_cells(ranges: DataFrame, cell_order: int = CELL_ORDER) -> DataFrame:
    """Rows (cell, lo, hi, ...): ranges cut at the pixels of ``cell_order``."""
    shift = 2 * (healpix.MAX_ORDER - cell_order)
    cut = ranges.withColumn("cell", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))))
    first, after = F.shiftleft("cell", shift), F.shiftleft(F.col("cell") + 1, shift)
    return cut.withColumns({"lo": F.greatest("lo", first), "hi": F.least("hi", after)})


def combine(a: DataFrame, b: DataFrame, how: str, cell_order: int = CELL_ORDER) -> DataFrame:
    """Union, intersection, difference or symmetric difference of two maps, as disjoint ranges (lo, hi).

    Ranges are as long as possible within a cell of ``cell_order``.  Equal ends
    are added up before the sweep, so repeated tiles cost one row.
    """
    if how not in _KEEP:
        raise ValueError(f"unknown operation {how}")
    ends = None
    for side, df in enumerate((a, b)):
        cut = in_cells(to_ranges(df), cell_order)
        step = lambda n, own: F.lit(n if own else 0).cast("long")
        for col, n in (("lo", 1), ("hi", -1)):
            part = cut.select("cell", F.col(col).alias("at"), step(n, side == 0).alias("da"), step(n, side == 1).alias("db"))
            ends = part if ends is None else ends.unionByName(part)
    ends = ends.groupBy("cell", "at").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    along = W.partitionBy("cell").orderBy("at")
    pieces = ends.select(
        "cell", F.col("at").alias("lo"), F.lead("at").over(along).alias("hi"), (F.sum("da").over(along) > 0).alias("in_a"), (F.sum("db").over(along) > 0).alias("in_b")
    )
    pieces = pieces.where(F.col("hi").isNotNull() & _KEEP[how](F.col("in_a"), F.col("in_b")))
    return joined(pieces.select("cell", "lo", "hi"))


def joined(pieces: DataFrame) -> DataFrame:
    """Ranges (lo, hi) from disjoint pieces (cell, lo, hi), those that touch made one."""
    along = W.partitionBy("cell").orderBy("lo")
    gap = F.coalesce(F.lag("hi").over(along) != F.col("lo"), F.lit(True)).cast("long")
    runs = pieces.withColumn("__gap", gap).withColumn("__run", F.sum("__gap").over(along))
    return runs.groupBy("cell", "__run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("lo", "hi")


def normalize(coverage: DataFrame, cell_order: int = CELL_ORDER) -> DataFrame:
    """Disjoint ranges of a map."""
    return combine(coverage, coverage, "union", cell_order)


def area_deg2(coverage: DataFrame) -> DataFrame:
    """One row: the map's area, overlaps counted once."""
    unit = healpix.tile_area_deg2(healpix.MAX_ORDER)
    return normalize(coverage).agg((F.coalesce(F.sum(F.col("hi") - F.col("lo")), F.lit(0)).cast("double") * unit).alias("area_deg2"))


def to_tiles(ranges: DataFrame, max_order: int = healpix.MAX_ORDER) -> DataFrame:
    """Tiles (order, pixel) that make up disjoint ranges, coarse where possible, none finer than ``max_order``.

    At each order the aligned middle of a range becomes pixels and its two ends go on to
    the next order.  Ends inside a pixel of ``max_order`` take the whole pixel,
    so the result then covers a little more; a pixel so reached twice is one row.
    """
    rest, out = ranges.select("lo", "hi"), None
    for order in range(max_order + 1):
        shift = 2 * (healpix.MAX_ORDER - order)
        last = order == max_order
        one = (1 << shift) - 1
        first = F.shiftright("lo", shift) if last else F.shiftright(F.col("lo") + one, shift)
        stop = F.shiftright(F.col("hi") + one, shift) if last else F.shiftright("hi", shift)
        cut = rest.select("lo", "hi", first.alias("first"), stop.alias("stop"))
        tiles = cut.where("first < stop").select(F.lit(order).alias("order"), F.explode(F.sequence(F.col("first"), F.col("stop") - 1)).alias("pixel"))
        out = tiles if out is None else out.unionByName(tiles.distinct() if last else tiles)
        if not last:
            ends = F.when(
                F.col("first") < F.col("stop"),
                F.array(F.struct(F.col("lo"), F.shiftleft("first", shift).alias("hi")), F.struct(F.shiftleft("stop", shift).alias("lo"), F.col("hi"))),
            ).otherwise(F.array(F.struct("lo", "hi")))
            rest = cut.select(F.inline(ends)).where("lo < hi")
    return out


def tiles_within(tiles: DataFrame, coverage: DataFrame, order: str = "Norder", pixel: str = "Npix") -> DataFrame:
    """The tiles of a catalog that overlap a map, for instance the tiles of another catalog; trees of any orders."""
    own = tiles.withColumns({
        f"__{n}": F.expr(f"shiftleft(cast({pixel} AS bigint) + {k}, cast(2 * ({healpix.MAX_ORDER} - {order}) AS int))") for k, n in enumerate(("lo", "hi"))
    })
    cut = own.withColumns({"lo": F.col("__lo"), "hi": F.col("__hi")})
    cut = in_cells(cut).select(*tiles.columns, "cell", "lo", "hi")
    there = in_cells(normalize(coverage)).select(F.col("cell").alias("t_cell"), F.col("lo").alias("t_lo"), F.col("hi").alias("t_hi"))
    meets: Column = (F.col("cell") == F.col("t_cell")) & (F.col("lo") < F.col("t_hi")) & (F.col("hi") > F.col("t_lo"))
    return cut.join(there, meets, "left_semi").select(*tiles.columns).distinct()
