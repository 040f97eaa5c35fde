"""Tiled catalogs on disk: leaves, metadata, collections.

Layout: ``Norder=/Dir=/Npix=`` Parquet leaves sorted by the order-29 index.
Metadata are small JSON-lines tables next to them, written by Spark so that any
Hadoop file system works.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import healpix
from starloom.functions.geometry import margin_order, outer_border
from starloom.functions.healpix import with_healpix
from starloom.operators.tiling import assign_tiles, pixel_counts
from starloom.session import materialize
from starloom.sources.readers import project

INDEX = "healpix29"


@dataclass
class CatalogInfo:
    name: str
    catalog_type: str = "object"
    ra_column: str = "ra"
    dec_column: str = "dec"
    id_column: str | None = None
    default_columns: list[str] = field(default_factory=list)
    threshold: int = 1_000_000
    max_order: int = 10
    total_rows: int = 0
    builder: str = "starloom"


def _put_json(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _get_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def from_dataframe(df: DataFrame, ra: str = "ra", dec: str = "dec", threshold: int = 1_000_000, highest_order: int = 10) -> DataFrame:
    """Add the order-29 index and the tile columns to any frame of positions."""
    return assign_tiles(with_healpix(df, ra, dec, name=INDEX), threshold, highest_order, INDEX)


def write_catalog(df: DataFrame, path: str, info: CatalogInfo, max_records_per_file: int = 5_000_000, rows_per_task: int = 2_000_000) -> CatalogInfo:
    """Write a tiled catalog.

    Range partitioning on (tile, index) puts neighbouring rows together, gives
    each task about equal bytes and lets a crowded tile span several files.
    """
    spark = df.sparkSession
    base = df.drop("Norder", "Dir", "Npix")
    if INDEX not in base.columns:
        base = with_healpix(base, info.ra_column, info.dec_column, name=INDEX)
    # one counting pass; its small result is stored and serves the tiles, the map and the task count
    counts = materialize(pixel_counts(base, info.max_order, INDEX))
    total = counts.agg(F.sum("n")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // rows_per_task))
    tiled = assign_tiles(base, info.threshold, info.max_order, INDEX, counts)
    (
        tiled.repartitionByRange(tasks, "Norder", "Npix", INDEX)
        .sortWithinPartitions("Norder", "Npix", INDEX)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "zstd")
        .partitionBy("Norder", "Dir", "Npix")
        .parquet(f"{path}/dataset")
    )
    return refresh_metadata(spark, path, info)


def refresh_metadata(spark: SparkSession, path: str, info: CatalogInfo) -> CatalogInfo:
    """Rewrite partition list and properties from the leaves; one counting job."""
    part = partition_info(spark.read.parquet(f"{path}/dataset"), info.ra_column, info.dec_column)
    # the aggregate keeps its tasks; only its rows, one per tile, meet in one file
    part.repartition(1).write.mode("overwrite").parquet(f"{path}/partition_info")
    total = spark.read.parquet(f"{path}/partition_info").agg(F.sum("rows")).first()[0] or 0
    info.total_rows = int(total)
    _put_json(spark, asdict(info), f"{path}/properties")
    return info


def partition_info(df: DataFrame, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Rows and position bounds of each tile."""
    bounds = [f(c).alias(f"{n}_{s}") for c, n in ((ra, "ra"), (dec, "dec")) for f, s in ((F.min, "min"), (F.max, "max"))]
    return df.groupBy("Norder", "Dir", "Npix").agg(F.count(F.lit(1)).alias("rows"), *bounds)


def region_tiles(spark: SparkSession, path: str, region, max_tiles: int = 1000) -> list[tuple[int, int]] | None:
    """Tiles that may hold rows of the region, as a literal list for partition pruning.

    Cones, polygons and pixels meet a tile if their pixel cover does; the bounds
    of a tile's rows exclude some more.  The coarse cone search names exactly the
    tiles that the cone meets.  None when the region knows neither cover nor box or
    meets more than ``max_tiles``; then the region's own comparisons prune files
    and row groups by their statistics.
    """
    t = spark.read.parquet(f"{path}/partition_info")
    if coarse(region):
        return tiles_of_cone(t, region)
    boxes, pixels = region.boxes(), getattr(region, "ranges", None)
    if not boxes and pixels is None:
        return None
    if pixels is not None:
        lo, hi = (f"shiftleft(cast(Npix AS bigint) + {k}, cast(2 * (29 - Norder) AS int))" for k in (0, 1))
        cover = ", ".join(f"struct({start}L AS lo, {stop}L AS hi)" for start, stop in pixels())
        # a literal list: a cover of a few hundred ranges would be too long as comparisons
        t = t.where(F.expr(f"exists(array({cover}), r -> {lo} < r.hi AND {hi} > r.lo)")) if cover else t.limit(0)
    for b in boxes:
        t = t.where(b.overlaps("ra_min", "ra_max", "dec_min", "dec_max"))
    rows = t.select("Norder", "Npix").limit(max_tiles + 1).collect()
    return None if len(rows) > max_tiles else [(r[0], r[1]) for r in rows]


def coarse(region) -> bool:
    """Whether a region asks for whole tiles."""
    return getattr(region, "fine", True) is False


def tiles_of_cone(tiles: DataFrame, region) -> list[tuple[int, int]]:
    """Stored tiles that a cone meets; tiles of a cover, so their number follows the cone and not the catalog's rows."""
    orders = [r[0] for r in tiles.select("Norder").distinct().collect()]
    met = [(o, p) for o in orders for p in region.tiles(o)]
    wanted = tiles.sparkSession.createDataFrame(met, "Norder int, Npix long")
    return [(r[0], r[1]) for r in tiles.select("Norder", "Npix").join(wanted, ["Norder", "Npix"], "left_semi").collect()]


def _in_tiles(tiles: list[tuple[int, int]]) -> Column:
    """Partition filter for a list of tiles, grouped by order."""
    cond = F.lit(False)
    for order in sorted({o for o, _ in tiles}):
        cond = cond | ((F.col("Norder") == order) & F.col("Npix").isin([p for o, p in tiles if o == order]))
    return cond


def catalog_info(spark: SparkSession, path: str) -> CatalogInfo:
    return CatalogInfo(**_get_json(spark, f"{path}/properties"))


def open_catalog(spark: SparkSession, path: str, columns=None, filters=None, region=None) -> DataFrame:
    """Lazy table; filters and the region reach the scan before the projection."""
    return open_part(spark, path, "dataset", columns, filters, region)


def open_part(spark: SparkSession, path: str, part: str, columns=None, filters=None, region=None) -> DataFrame:
    """The main table or the margin, both under the tiles of the main table and pruned alike."""
    from starloom.sources.readers import filters_to_column

    info = catalog_info(spark, path)
    df = spark.read.parquet(f"{path}/{part}")
    if filters:
        df = df.where(filters_to_column(filters))
    if region is not None:
        tiles = region_tiles(spark, path, region)
        if tiles is not None:
            df = df.where(_in_tiles(tiles))
        if not coarse(region):
            df = df.where(region.predicate(info.ra_column, info.dec_column))
    return project(df, columns, info.default_columns or None)


def margin_pixels(tiles: DataFrame, at: int) -> DataFrame:
    """Rows (margin_pixel, Norder, Npix): the pixels of order ``at`` that touch each tile from outside.

    Tiles are worked on in parallel; a tile of order o gives some 4 * 2 ** (at - o) pixels.
    """

    def border(batches):
        for b in batches:
            for order, pixel in zip(b.column("Norder").to_pylist(), b.column("Npix").to_pylist()):
                found = outer_border(order, pixel, at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array([order] * len(found), pa.int32()), pa.array([pixel] * len(found), pa.int64())], ["margin_pixel", "Norder", "Npix"]
                )

    slim = tiles.select(F.col("Norder").cast("int").alias("Norder"), F.col("Npix").cast("long").alias("Npix"))
    return slim.mapInArrow(border, "margin_pixel long, Norder int, Npix long")


def tile_margins(df: DataFrame, tiles: DataFrame, threshold_arcsec: float, index: str = INDEX, at: int | None = None) -> DataFrame:
    """The rows of ``df`` that belong to the margin of each tile, under that tile's Norder, Dir and Npix.

    ``df`` has the order-29 index.  A tile's margin are the rows of the pixels of
    one fine order that touch it from outside.  The order is the finest at which no pixel
    is narrower than the threshold, so everything within the threshold of a
    tile lies in the tile or its margin; ``at`` may name a coarser one.  One join on the fine pixel;
    crowded pixels are split by the skew join.
    """
    at = margin_order(threshold_arcsec) if at is None else min(at, margin_order(threshold_arcsec))
    finest = tiles.agg(F.max("Norder")).first()[0]
    if finest is not None and finest > at:
        raise ValueError(f"a margin of {threshold_arcsec} arcsec is wider than tiles of order {finest}")
    pixels = margin_pixels(tiles, at)
    rows = df.drop("Norder", "Dir", "Npix").withColumn("margin_pixel", healpix.ancestor(index, at))
    rows = rows.join(pixels, "margin_pixel").drop("margin_pixel")
    return rows.withColumn("Dir", (F.floor(F.col("Npix") / 10000) * 10000).cast("long"))


def write_margin(spark: SparkSession, path: str, threshold_arcsec: float, at: int | None = None, rows_per_task: int = 2_000_000) -> None:
    """Margin table of a written catalog, in leaves of the same Norder, Dir and Npix as the main table's."""
    tiles = spark.read.parquet(f"{path}/partition_info")
    # by default pixels at most four levels finer than the finest tile: few pixels a tile, some more rows
    finest = tiles.agg(F.max("Norder")).first()[0] or 0
    rows = tile_margins(spark.read.parquet(f"{path}/dataset"), tiles, threshold_arcsec, at=finest + 4 if at is None else at)
    rows = materialize(rows)
    tasks = max(1, min(spark.sparkContext.defaultParallelism * 64, -(-rows.count() // rows_per_task)))
    (
        rows.repartitionByRange(tasks, "Norder", "Npix", INDEX)
        .sortWithinPartitions("Norder", "Npix", INDEX)
        .write.mode("overwrite").option("compression", "zstd").partitionBy("Norder", "Dir", "Npix").parquet(f"{path}/margin")
    )


def write_id_index(spark: SparkSession, path: str, id_column: str) -> None:
    """Secondary index id -> tile, range-sorted by id so a lookup reads few row groups."""
    idx = spark.read.parquet(f"{path}/dataset").select(id_column, "Norder", "Dir", "Npix").distinct()
    idx.repartitionByRange(id_column).sortWithinPartitions(id_column).write.mode("overwrite").parquet(f"{path}/index_{id_column}")


def id_search(spark: SparkSession, path: str, id_column: str, values: list | DataFrame, max_tiles: int = 1000) -> DataFrame:
    """Rows with the given ids, a list or a DataFrame with the id column; only the tiles the index names are opened.

    Up to ``max_tiles`` tiles go into the plan as a literal partition filter.
    More of them stay a table: the index rows found are joined on tile and id.
    """
    wanted = values.select(id_column).distinct() if isinstance(values, DataFrame) else None
    index = spark.read.parquet(f"{path}/index_{id_column}")
    found = index.join(wanted, id_column, "left_semi") if wanted is not None else index.where(F.col(id_column).isin(values))
    tiles = found.select("Norder", "Npix").distinct().limit(max_tiles + 1).collect()
    df = spark.read.parquet(f"{path}/dataset")
    if not tiles:
        return df.limit(0)
    if len(tiles) <= max_tiles:
        df = df.where(_in_tiles([(t["Norder"], t["Npix"]) for t in tiles]))
        return df.join(wanted, id_column, "left_semi") if wanted is not None else df.where(F.col(id_column).isin(values))
    return df.join(found.select(id_column, "Norder", "Npix"), [id_column, "Norder", "Npix"], "left_semi")


@dataclass
class Collection:
    main: DataFrame
    margin: DataFrame | None
    index: DataFrame | None
    info: CatalogInfo


def write_collection(df: DataFrame, path: str, info: CatalogInfo, margin_arcsec: float = 5.0, margin_at: int | None = None) -> None:
    """Main table, margin and id index under one manifest."""
    spark = df.sparkSession
    write_catalog(df, path, info)
    write_margin(spark, path, margin_arcsec, margin_at)
    if info.id_column:
        write_id_index(spark, path, info.id_column)
    manifest = {"main": "dataset", "margin": "margin", "margin_arcsec": margin_arcsec, "index": f"index_{info.id_column}" if info.id_column else None}
    _put_json(spark, manifest, f"{path}/collection")


def open_collection(spark: SparkSession, path: str, columns=None, filters=None, region=None) -> Collection:
    """Main table, margin and index; columns, filters and region apply to main table and margin alike."""
    m = _get_json(spark, f"{path}/collection")
    read = lambda part: open_part(spark, path, m[part], columns, filters, region) if m.get(part) else None
    index = spark.read.parquet(f"{path}/{m['index']}") if m.get("index") else None
    return Collection(read("main"), read("margin"), index, catalog_info(spark, path))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files under a path and their lengths; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    )


def publication_record(df: DataFrame, label: str, size_bytes: DataFrame, n_columns: int) -> DataFrame:
    """One JSON document: rows, columns, partitions, bytes on disk, builder.

    ``df`` is the partition_info table, ``size_bytes`` a one-row frame (bytes).
    """
    agg = df.agg(F.sum("rows").alias("numRows"), F.count(F.lit(1)).alias("numPartitions"))
    # both sides are single-row aggregates
    both = agg.withColumn("one", F.lit(1)).join(size_bytes.withColumn("one", F.lit(1)), "one").drop("one")
    meta = F.struct("numRows", F.lit(n_columns).alias("numColumns"), "numPartitions", F.col("bytes").alias("sizeOnDisk"), F.lit("starloom").alias("builder"))
    return both.select(F.lit(label).alias("label"), F.to_json(F.struct(F.lit(label).alias("label"), meta.alias("metadata"))).alias("record"))
