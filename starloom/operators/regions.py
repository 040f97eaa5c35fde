"""Region searches.

A search is a small driver-side object.  On a table it becomes one predicate.
Cones and polygons test the bounding box of positions first, pixels test ranges
of the order-29 index; both are plain comparisons that reach the Parquet scan
and prune files and row groups.  The exact test follows.  On a stored catalog
cones and polygons choose tiles by their pixel cover.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import geometry, healpix
from starloom.functions.sphere import inside_convex, separation_arcsec


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def dec_band(dec, lo: float, hi: float) -> Column:
    d = F.col(dec) if isinstance(dec, str) else dec
    return d.between(lo, hi)


def merged_ranges(pixels) -> list[tuple[int, int]]:
    """Half-open index ranges of (order, pixel) tiles in ascending order, those that touch made one."""
    out: list[list[int]] = []
    for lo, hi in sorted(healpix.pixel_range(p, o) for o, p in pixels):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(r) for r in out]


@dataclass(frozen=True)
class ConeSearch:
    """Positions within ``radius_arcsec`` of a point.

    ``fine=False`` is the coarse search: on a stored catalog whole tiles that the
    cone meets, on a plain table the bounding box.
    """

    ra: float
    dec: float
    radius_arcsec: float
    fine: bool = True

    def box(self) -> BoxSearch:
        r = self.radius_arcsec / 3600.0
        lo, hi = max(-90.0, self.dec - r), min(90.0, self.dec + r)
        if abs(self.dec) + r >= 90.0:
            return BoxSearch((0.0, 360.0), (lo, hi))
        w = math.degrees(math.asin(min(1.0, math.sin(math.radians(r)) / math.cos(math.radians(self.dec))))) * (1 + 1e-9) + 1e-12
        return BoxSearch((self.ra - w, self.ra + w), (lo, hi))

    def boxes(self) -> list[BoxSearch]:
        return [self.box()]

    def ranges(self) -> list[tuple[int, int]]:
        """Index ranges that hold every point of the cone."""
        return merged_ranges(geometry.cone_cover(self.ra, self.dec, self.radius_arcsec))

    def tiles(self, order: int) -> list[int]:
        """Pixels of one order that the cone meets, rows or not."""
        return geometry.cone_tiles(self.ra, self.dec, self.radius_arcsec, order)

    def predicate(self, ra: str, dec: str) -> Column:
        coarse = self.box().predicate(ra, dec)
        if not self.fine:
            return coarse
        return coarse & (separation_arcsec(ra, dec, self.ra, self.dec) <= self.radius_arcsec)


@dataclass(frozen=True)
class BoxSearch:
    """Right ascension and declination ranges; the first may cross 0 = 360."""

    ra: tuple[float, float] = (0.0, 360.0)
    dec: tuple[float, float] = (-90.0, 90.0)

    def boxes(self) -> list[BoxSearch]:
        return [self]

    def overlaps(self, ra_min: str, ra_max: str, dec_min: str, dec_max: str) -> Column:
        """Whether bounds may meet the box; true too often rather than too seldom."""
        out = (F.col(dec_max) >= self.dec[0]) & (F.col(dec_min) <= self.dec[1])
        if self.ra[1] - self.ra[0] >= 360.0:
            return out
        lo, hi = self.ra[0] % 360.0, self.ra[1] % 360.0
        right, left = F.col(ra_max) >= lo, F.col(ra_min) <= hi
        return out & ((right & left) if lo <= hi else (right | left))

    def predicate(self, ra: str, dec: str) -> Column:
        band = dec_band(dec, *self.dec)
        if self.ra[1] - self.ra[0] >= 360.0:
            return band
        lo, hi = self.ra[0] % 360.0, self.ra[1] % 360.0
        col = F.col(ra)
        if lo <= hi:
            return band & col.between(lo, hi)
        return band & ((col >= lo) | (col <= hi))


@dataclass(frozen=True)
class PolygonSearch:
    """Inside a convex polygon of (ra, dec) vertices."""

    vertices: tuple[tuple[float, float], ...]

    def ranges(self) -> list[tuple[int, int]]:
        """Index ranges that hold every point of the polygon."""
        return merged_ranges(geometry.polygon_cover(list(self.vertices)))

    def boxes(self) -> list[BoxSearch]:
        """The box of a cone around all vertices; a convex polygon smaller than half the sky lies inside."""
        xyz = [
            (math.cos(math.radians(d)) * math.cos(math.radians(r)), math.cos(math.radians(d)) * math.sin(math.radians(r)), math.sin(math.radians(d)))
            for r, d in self.vertices
        ]
        mid = [sum(c) for c in zip(*xyz)]
        size = math.hypot(*mid)
        if size < 1e-6 * len(xyz):
            return []
        mid = [c / size for c in mid]
        radius = max(math.degrees(math.acos(max(-1.0, min(1.0, sum(a * b for a, b in zip(mid, v)))))) for v in xyz) * (1 + 1e-9) + 1e-9
        if radius >= 90.0:
            return []
        ra, dec = math.degrees(math.atan2(mid[1], mid[0])) % 360.0, math.degrees(math.asin(max(-1.0, min(1.0, mid[2]))))
        return [ConeSearch(ra, dec, radius * 3600.0).box()]

    def predicate(self, ra: str, dec: str) -> Column:
        # the box first: plain comparisons reach the scan
        exact = inside_convex(ra, dec, list(self.vertices))
        return reduce(lambda a, b: a & b, [b.predicate(ra, dec) for b in self.boxes()] + [exact])


@dataclass(frozen=True)
class PixelSearch:
    """Inside any of the (order, pixel) tiles; works on the index column alone."""

    pixels: tuple[tuple[int, int], ...]
    index: str = "healpix29"

    def boxes(self) -> list[BoxSearch]:
        return []

    def ranges(self) -> list[tuple[int, int]]:
        """Merged half-open index ranges in ascending order."""
        return merged_ranges(self.pixels)

    def predicate(self, ra: str | None = None, dec: str | None = None) -> Column:
        c = F.col(self.index)
        return _any([(c >= lo) & (c < hi) for lo, hi in self.ranges()])


@dataclass(frozen=True)
class StackedSearch:
    """All of several searches."""

    parts: tuple = field(default_factory=tuple)

    def boxes(self) -> list[BoxSearch]:
        return [b for p in self.parts for b in p.boxes()]

    def predicate(self, ra: str, dec: str) -> Column:
        return reduce(lambda a, b: a & b, [p.predicate(ra, dec) for p in self.parts])


def search(df: DataFrame, region, ra: str = "ra", dec: str = "dec") -> DataFrame:
    return df.where(region.predicate(ra, dec))


def search_tiles(df: DataFrame, region: ConeSearch, order: int, index: str = "healpix29") -> DataFrame:
    """Coarse search: every row of each tile of ``order`` that the region meets, whether or not the tile holds a row of the region.

    The tiles become ranges of the index, plain comparisons that reach the scan.
    """
    return df.where(PixelSearch(tuple((order, p) for p in region.tiles(order)), index).predicate())


def coverage_filter(df: DataFrame, coverage: DataFrame, index: str = "healpix29") -> DataFrame:
    """Keep rows inside a coverage map, a DataFrame of (order, pixel) tiles of mixed orders.

    One semi join: tiles become index ranges keyed by an ancestor of one order,
    a little finer than the coarsest tile; the range test does the rest.  The map
    may be larger than a broadcast, and a row under two tiles is kept once.
    """
    coarsest = coverage.agg(F.min("order")).first()[0]
    if coarsest is None:
        return df.limit(0)
    at = min(coarsest + 4, healpix.MAX_ORDER)
    up = F.col("order") - at
    # a coarser tile is split into its descendants, at most 4 ** 4; a finer one has one ancestor
    first = F.expr(f"shiftright(pixel, cast(2 * greatest(0, order - {at}) AS int))")
    cells = coverage.select(
        F.expr(f"shiftleft(pixel, cast(2 * ({healpix.MAX_ORDER} - order) AS int))").alias("__lo"), F.expr(f"shiftleft(pixel + 1, cast(2 * ({healpix.MAX_ORDER} - order) AS int))").alias("__hi"),
        F.when(up > 0, F.array(first)).otherwise(F.expr(f"sequence(shiftleft(pixel, cast(2 * greatest(0, {at} - order) AS int)), shiftleft(pixel + 1, cast(2 * greatest(0, {at} - order) AS int)) - 1)")).alias("c"),
    ).select("__lo", "__hi", F.explode("c").alias("__cell"))
    inside = (healpix.ancestor(index, at) == F.col("__cell")) & (F.col(index) >= F.col("__lo")) & (F.col(index) < F.col("__hi"))
    return df.join(cells, inside, "left_semi")
