"""Adaptive sky tiles, tile assignment and coverage summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.healpix import ancestor, tile_area_deg2


def pixel_counts(df: DataFrame, order: int, index: str = "healpix29") -> DataFrame:
    """Rows per occupied pixel; combined before the shuffle, at most 12 * 4^order rows."""
    return df.groupBy(ancestor(index, order).alias("pixel")).agg(F.count(F.lit(1)).alias("n"))


def adaptive_tiles(counts: DataFrame, threshold: int, max_order: int) -> DataFrame:
    """Coarsest tiles with at most ``threshold`` rows, none finer than ``max_order``.

    Works on the per-pixel counts only.  A pixel at ``max_order`` stays a tile
    even when it holds more rows.
    """
    levels = counts.select(
        "n",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(max_order)), lambda o: F.struct(
            o.alias("order"), F.call_function("shiftright", F.col("pixel"), (F.lit(max_order) - o) * 2).alias("pixel")))).alias("t"),
    ).groupBy("t.order", "t.pixel").agg(F.sum("n").alias("n"))
    fits = (F.col("n") <= threshold) | (F.col("order") == max_order)
    parent = levels.where((F.col("n") > threshold) & (F.col("order") < max_order)).select((F.col("order") + 1).alias("order"), F.col("pixel").alias("up"))
    child = levels.where(fits & (F.col("order") > 0)).withColumn("up", F.shiftright("pixel", 2))
    deep = child.join(parent, ["order", "up"], "left_semi").select("order", "pixel", "n")
    top = levels.where(fits & (F.col("order") == 0)).select("order", "pixel", "n")
    return top.unionByName(deep)


def tile_of_pixels(counts: DataFrame, tiles: DataFrame, max_order: int) -> DataFrame:
    """Map each occupied ``max_order`` pixel to its tile (Norder, Npix)."""
    cand = counts.select(
        F.col("pixel").alias("fine"),
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(max_order)), lambda o: F.struct(
            o.alias("order"), F.call_function("shiftright", F.col("pixel"), (F.lit(max_order) - o) * 2).alias("pixel")))).alias("t"),
    ).select("fine", "t.order", "t.pixel")
    return cand.join(tiles.select("order", "pixel"), ["order", "pixel"]).select("fine", F.col("order").alias("Norder"), F.col("pixel").alias("Npix"))


def assign_tiles(df: DataFrame, threshold: int, max_order: int, index: str = "healpix29", counts: DataFrame | None = None) -> DataFrame:
    """Add Norder, Dir and Npix to each row; ``counts`` are its pixel counts if already stored.

    The map has one row per occupied pixel.  No broadcast is forced: the join
    is by size, and a crowded pixel is split by the skew join.
    """
    counts = pixel_counts(df, max_order, index) if counts is None else counts
    tiles = adaptive_tiles(counts, threshold, max_order)
    where = tile_of_pixels(counts, tiles, max_order)
    keyed = df.withColumn("fine", ancestor(index, max_order))
    out = keyed.join(where, "fine", "inner").drop("fine")
    return out.withColumn("Dir", (F.floor(F.col("Npix") / 10000) * 10000).cast("long"))


def coverage_summary(tiles: DataFrame) -> DataFrame:
    """Tiles, rows and covered area per order."""
    area = F.lit(tile_area_deg2(0)) / F.pow(F.lit(4.0), F.col("order"))
    return tiles.groupBy("order").agg(
        F.count(F.lit(1)).alias("tiles"),
        F.sum("n").alias("rows"),
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
        (F.count(F.lit(1)) * F.first(area)).alias("area_deg2"),
    ).withColumn("sky_share", F.col("tiles") / (F.lit(12.0) * F.pow(F.lit(4.0), F.col("order"))))


def pixel_map_join(df: DataFrame, pixel_map: DataFrame, order: int, index: str = "healpix29") -> DataFrame:
    """Join each row with the map row of its ancestor pixel; the map has (pixel, ...)."""
    return df.withColumn("pixel", ancestor(index, order)).join(pixel_map, "pixel", "inner")


