"""NESTED equal-area pixel numbers (Gorski et al. 2005) as Column arithmetic.

Order ``o`` has 12 * 4^o pixels; a pixel's ancestor at a coarser order is a
right shift by two bits per level, so one order-29 BIGINT serves all orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ORDER = 29


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ancestor(pixel, order: int, from_order: int = MAX_ORDER) -> Column:
    return F.shiftright(_c(pixel), 2 * (from_order - order))


def pixel_range(pixel, order: int, at: int = MAX_ORDER):
    """Half-open range of order-``at`` pixels inside a pixel; plain numbers or Columns."""
    if isinstance(pixel, int):
        return pixel << (2 * (at - order)), (pixel + 1) << (2 * (at - order))
    return F.shiftleft(_c(pixel), 2 * (at - order)), F.shiftleft(_c(pixel) + 1, 2 * (at - order))


def _spread_bits(x: Column) -> Column:
    """Put a zero between all bits: the binary digits read in base 4.

    One reference to the input, so the expression does not grow when inlined
    (shift-and-mask steps double it five times).
    """
    return F.conv(F.bin(x), 4, 10).cast("long")


def with_healpix(df: DataFrame, ra, dec, order: int = MAX_ORDER, name: str = "healpix29") -> DataFrame:
    """Add the pixel number of each position.

    The steps are named columns because several use their input twice; the
    optimizer inlines them where it pushes filters down, so every step keeps its
    references few.
    """
    ns = 1 << order
    a, d = _c(ra), F.radians(_c(dec))
    out = df.withColumns({"__z": F.sin(d), "__cd": F.cos(d), "__tt": F.pmod(a, F.lit(360.0)) / 90.0})
    z, tt = F.col("__z"), F.col("__tt")
    quad = F.least(F.lit(3), F.floor(tt).cast("int"))
    polar_r = F.col("__cd") / F.sqrt((1.0 + F.abs(z)) / 3.0) * float(ns)
    out = out.withColumns({
        "__eq": F.abs(z) <= F.lit(2.0 / 3.0),
        "__q": quad.cast("long"),
        "__a": float(ns) * (0.5 + tt),
        "__b": float(ns) * z * 0.75,
        "__pr": polar_r,
        "__tp": tt - quad,
    })
    eq = F.col("__eq")
    cap = F.lit(ns - 1).cast("long")
    out = out.withColumns({
        "__jp": F.when(eq, F.floor(F.col("__a") - F.col("__b"))).otherwise(F.least(cap, F.floor(F.col("__tp") * F.col("__pr")))),
        "__jm": F.when(eq, F.floor(F.col("__a") + F.col("__b"))).otherwise(F.least(cap, F.floor((1.0 - F.col("__tp")) * F.col("__pr")))),
    })
    jp, jm = F.col("__jp"), F.col("__jm")
    fp, fm = F.shiftright(jp, order), F.shiftright(jm, order)
    north = z >= 0
    mask = F.lit(ns - 1).cast("long")
    out = out.withColumns({
        "__face": F.when(eq, F.when(fp == fm, fp.bitwiseOR(F.lit(4).cast("long"))).when(fp < fm, fp).otherwise(fm + 8))
        .otherwise(F.when(north, F.col("__q")).otherwise(F.col("__q") + 8)),
        "__ix": F.when(eq, jm.bitwiseAND(mask)).otherwise(F.when(north, ns - jm - 1).otherwise(jp)),
        "__iy": F.when(eq, ns - jp.bitwiseAND(mask) - 1).otherwise(F.when(north, ns - jp - 1).otherwise(jm)),
    })
    pix = F.shiftleft(F.col("__face"), 2 * order) + _spread_bits(F.col("__ix")) + F.shiftleft(_spread_bits(F.col("__iy")), 1)
    return out.withColumn(name, pix).drop(
        "__z", "__cd", "__tt", "__eq", "__q", "__a", "__b", "__pr", "__tp", "__jp", "__jm", "__face", "__ix", "__iy"
    )


def tile_area_deg2(order: int) -> float:
    """Area of one pixel in square degrees."""
    import math

    return 4 * math.pi / 12 / 4**order * math.degrees(1) ** 2
