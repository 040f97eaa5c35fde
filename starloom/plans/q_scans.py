"""Scans, sources and sinks.

Queries that need files of another layout first write the given table with
Spark into the shared scratch folder, then read it with the reader under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.healpix import with_healpix
from starloom.operators import nested
from starloom.operators.match import matched_ids
from starloom.operators.regions import BoxSearch, ConeSearch, StackedSearch
from starloom.operators.stats import column_statistics
from starloom.plans.registry import query, rnd, scatter_sql
from starloom.session import scratch_path
from starloom.streaming.chunks import consume_until, read_chunks
from starloom.sources import catalogs, increments, previews, readers, storage

OBJ_INFO = dict(name="objects", ra_column="ra", dec_column="dec", id_column="objectId", threshold=40, max_order=5)


def _tiled_sql(body: str) -> str:
    """Oracle of order-5 pixels and adaptive tiles over sky_object."""
    return HEALPIX_CTES.format(order=5, ns=32, mask=31) + ", " + TILE_CTES.format(max=5, thr=40) + " " + body


HEALPIX_CTES = """WITH hp0 AS (SELECT objectId, ra, dec, sin(radians(dec)) AS z, cos(radians(dec)) AS cd, ra / 90e0 AS tt FROM sky_object),
 hp1 AS (SELECT *, abs(z) <= 2e0 / 3e0 AS eq, CAST(least(3, floor(tt)) AS BIGINT) AS q, {ns} * (0.5e0 + tt) AS a, {ns} * z * 0.75e0 AS b,
   {ns} * cd / sqrt((1 + abs(z)) / 3) AS pr, tt - floor(tt) AS tp FROM hp0),
 hp2 AS (SELECT *, CAST(CASE WHEN eq THEN floor(a - b) ELSE least({mask}, floor(tp * pr)) END AS BIGINT) AS jp,
   CAST(CASE WHEN eq THEN floor(a + b) ELSE least({mask}, floor((1 - tp) * pr)) END AS BIGINT) AS jm FROM hp1),
 hp3 AS (SELECT *, CASE WHEN eq THEN CASE WHEN (jp >> {order}) = (jm >> {order}) THEN (jp >> {order}) | 4 WHEN (jp >> {order}) < (jm >> {order}) THEN jp >> {order} ELSE (jm >> {order}) + 8 END
   WHEN z >= 0 THEN q ELSE q + 8 END AS face,
   CASE WHEN eq THEN jm & {mask} WHEN z >= 0 THEN {ns} - jm - 1 ELSE jp END AS ix, CASE WHEN eq THEN {ns} - (jp & {mask}) - 1 WHEN z >= 0 THEN {ns} - jp - 1 ELSE jm END AS iy FROM hp2),
 hp AS (SELECT objectId, ra, dec, face * ({ns}::BIGINT * {ns}) + CAST(list_sum(list_transform(range({order}), lambda i: (((ix >> i) & 1) << (2 * i)) + (((iy >> i) & 1) << (2 * i + 1)))) AS BIGINT) AS pixel FROM hp3)"""

TILE_CTES = """lv AS (SELECT o AS ord, pixel >> CAST(2 * ({max} - o) AS BIGINT) AS pix, count(*) AS n FROM hp, range({max} + 1) r(o) GROUP BY 1, 2),
 tiles AS (SELECT c.ord, c.pix, c.n FROM lv c LEFT JOIN lv p ON p.ord = c.ord - 1 AND p.pix = (c.pix >> 2) WHERE (c.n <= {thr} OR c.ord = {max}) AND (c.ord = 0 OR p.n > {thr}))"""


@query("scan_project", "SELECT l_orderkey, l_suppkey, R6(l_extendedprice) AS l_extendedprice FROM lineitem")
def scan_project(t):
    df = readers.scan(t.spark, t.path("lineitem"), columns=["l_orderkey", "l_suppkey", "l_extendedprice"])
    return df.withColumn("l_extendedprice", rnd("l_extendedprice"))


@query("default_columns", "SELECT objectId, count(*) AS n, R4(sum(psfFlux)) AS flux FROM forced_source GROUP BY objectId")
def default_columns(t):
    packed = nested.pack(t("forced_source"), ["objectId"], ["psfFlux", "band", "psfFluxErr"], ["mjd", "visit"])
    df = readers.project(packed, None, default=["objectId", "segment", "lc.mjd", "lc.psfFlux", "absent", "lc.absent"])
    flat = nested.flatten(df, "lc")
    return flat.groupBy("objectId").agg(F.count("mjd").alias("n"), rnd(F.sum("psfFlux"), 4).alias("flux"))


@query("scan_filters", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 10 AND l_returnflag = 'R' AND l_linenumber IN (1, 2)")
def scan_filters(t):
    f = [("l_quantity", "<", 10.0), ("l_returnflag", "==", "R"), ("l_linenumber", "in", [1, 2])]
    return readers.scan(t.spark, t.path("lineitem"), ["l_orderkey", "l_linenumber"], f)


@query(
    "scan_region",
    """SELECT objectId, R6(ra) AS ra, R6(dec) AS dec FROM sky_object WHERE degrees(2 * asin(least(1e0, sqrt(power(sin(radians(dec + 26) / 2), 2)
       + cos(radians(dec)) * cos(radians(-26e0)) * power(sin(radians(ra - 350) / 2), 2))))) <= 25 AND (ra >= 350 OR ra <= 45)""",
)
def scan_region(t):
    path = scratch_path(t.spark, "region")
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**OBJ_INFO))
    region = StackedSearch((ConeSearch(350.0, -26.0, 25 * 3600.0), BoxSearch((350.0, 45.0))))
    df = catalogs.open_catalog(t.spark, path, ["objectId", "ra", "dec"], region=region)
    return df.select("objectId", rnd("ra").alias("ra"), rnd("dec").alias("dec"))


@query(
    "manifest_scan",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END::BIGINT AS tract, CASE o_orderstatus WHEN 'F' THEN 7 ELSE 8 END::BIGINT AS patch FROM orders""",
)
def manifest_scan(t):
    path = scratch_path(t.spark, "manifest")
    for status, sub in (("F", "a"), ("O", "b"), ("P", "c"), ("none", "empty")):
        t("orders").where(F.col("o_orderstatus") == status).select("o_orderkey", "o_totalprice").write.parquet(f"{path}/{sub}")
    files = catalogs.file_sizes(t.spark, path).select("path")
    tract = F.when(F.col("path").contains("/a/"), 1).when(F.col("path").contains("/b/"), 2).when(F.col("path").contains("/c/"), 3).otherwise(9).cast("long")
    m = files.select("path", tract.alias("tract")).withColumn("patch", F.when(F.col("tract") == 1, 7).otherwise(8).cast("long"))
    return readers.manifest_scan(t.spark, m, ["o_orderkey"])


@query("pinned_schema", "SELECT o_orderkey, R6(o_totalprice) AS o_totalprice, CAST(NULL AS BIGINT) AS visit FROM orders")
def pinned(t):
    path = scratch_path(t.spark, "pinned")
    o = t("orders")
    o.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_custkey").write.parquet(f"{path}/a")
    o.where("o_orderstatus <> 'F'").select("o_custkey", "o_totalprice", "o_orderkey").write.parquet(f"{path}/b")
    schema = readers.pinned_schema(t.spark, f"{path}/a", ["o_totalprice", "o_orderkey"], ["visit"])
    df = t.spark.read.schema(schema).parquet(f"{path}/a", f"{path}/b")
    return df.withColumn("o_totalprice", rnd("o_totalprice"))


@query("csv_source", "SELECT s_suppkey AS masterid, R6(s_acctbal) AS mag, s_name AS name, 'survey' AS origin FROM supplier")
def csv_source(t):
    path = scratch_path(t.spark, "csv")
    t("supplier").select(F.col("s_suppkey").alias("MasterID"), F.col("s_acctbal").alias("Mag"), F.col("s_name").alias("Name")).write.csv(path, header=True)
    df = readers.read_csv(t.spark, path, "MasterID bigint, Mag double, Name string", {"origin": "survey"})
    return df.withColumn("mag", rnd("mag"))


@query("fixed_width_source", "SELECT CAST(p_partkey AS INT) AS id, R6(round(p_retailprice, 2)) AS price, p_brand AS brand FROM part")
def fixed_width_source(t):
    path = scratch_path(t.spark, "fwf")
    lines = t("part").select(F.format_string("%10d %12.2f %-10s", "p_partkey", "p_retailprice", "p_brand").alias("value"))
    head = t("part").limit(1).select(F.explode(F.array(F.lit("# comment"), F.lit("        id        price brand"), F.lit("---------- ------------ ----------"), F.lit("  "))).alias("value"))
    head.unionByName(lines).write.text(path)
    df = readers.read_fixed_width(t.spark, path, [("id", 1, 10, "int"), ("price", 12, 12, "double"), ("brand", 25, 10, "string")])
    return df.withColumn("price", rnd("price"))


@query("json_source", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, R6(value) AS value FROM events")
def json_source(t):
    path = scratch_path(t.spark, "json")
    # one JSON array per file of bounded length
    rows = t("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "value")
    docs = rows.groupBy(F.floor(F.col("event_id") / 1000).alias("g")).agg(F.to_json(F.collect_list(F.struct("event_id", "k", "value"))).alias("value"))
    docs.repartition("g").select("value").write.option("maxRecordsPerFile", 1).text(path)
    df = readers.read_json_array(t.spark, path, "event_id bigint, k bigint, value double")
    return df.select("event_id", "k", rnd("value").alias("value"))


@query("from_dataframe", _tiled_sql("SELECT hp.objectId, CAST(tiles.ord AS INT) AS Norder, tiles.pix AS Npix FROM hp JOIN tiles ON tiles.pix = (hp.pixel >> CAST(2 * (5 - tiles.ord) AS BIGINT))"))
def from_dataframe(t):
    return catalogs.from_dataframe(t("sky_object"), threshold=40, highest_order=5).select("objectId", "Norder", "Npix")


@query("catalog_write_roundtrip", _tiled_sql("SELECT hp.objectId, R6(ra) AS ra, tiles.pix AS Npix FROM hp JOIN tiles ON tiles.pix = (hp.pixel >> CAST(2 * (5 - tiles.ord) AS BIGINT))"))
def catalog_write_roundtrip(t):
    path = scratch_path(t.spark, "catalog")
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**OBJ_INFO))
    return catalogs.open_catalog(t.spark, path).select("objectId", rnd("ra").alias("ra"), F.col("Npix").cast("long").alias("Npix"))


@query("partition_info", _tiled_sql("SELECT CAST(ord AS INT) AS Norder, CAST(0 AS INT) AS Dir, CAST(pix AS INT) AS Npix, n AS rows FROM tiles"))
def partition_info(t):
    path = scratch_path(t.spark, "catalog")
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**OBJ_INFO))
    return t.spark.read.parquet(f"{path}/partition_info").select("Norder", "Dir", "Npix", "rows")


_STAT_COLS = ["psfFlux", "psfFluxErr", "mjd"]


@query(
    "column_statistics",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, R6(min({c})) AS min_value, R6(max({c})) AS max_value, CAST(count(*) - count({c}) AS BIGINT) AS null_count, count(*) AS row_count FROM forced_source"
        for c in _STAT_COLS
    ),
)
def col_statistics(t):
    s = column_statistics(t("forced_source"), _STAT_COLS)
    return s.withColumns({"min_value": rnd("min_value"), "max_value": rnd("max_value")})


@query(
    "pixel_statistics",
    _tiled_sql("SELECT pixel >> 6 AS pixel, R6(min(dec)) AS min_value, R6(max(dec)) AS max_value, CAST(0 AS BIGINT) AS null_count, count(*) AS row_count, 'dec' AS name FROM hp GROUP BY 1"),
)
def pixel_statistics(t):
    df = with_healpix(t("sky_object"), "ra", "dec", 2, "pixel")
    s = column_statistics(df, ["dec"], ["pixel"])
    return s.withColumns({"min_value": rnd("min_value"), "max_value": rnd("max_value")})


@query(
    "collection_open",
    "SELECT objectId, R6(r_psfFlux) AS r_psfFlux FROM sky_object WHERE dec > 0",
)
def collection_open(t):
    path = scratch_path(t.spark, "collection")
    info = catalogs.CatalogInfo(**OBJ_INFO, default_columns=["objectId", "dec", "r_psfFlux"])
    catalogs.write_collection(t("sky_object"), path, info, margin_arcsec=600.0)
    col = catalogs.open_collection(t.spark, path, filters=[("dec", ">", 0)])
    ids = col.index.select("objectId")
    return col.main.join(ids, "objectId", "left_semi").select("objectId", rnd("r_psfFlux").alias("r_psfFlux"))


@query("import_batches", _tiled_sql("SELECT hp.objectId, R6(ra) AS ra, CAST(tiles.ord AS INT) AS Norder, tiles.pix AS Npix FROM hp JOIN tiles ON tiles.pix = (hp.pixel >> CAST(2 * (5 - tiles.ord) AS BIGINT))"))
def import_batches(t):
    """Three batches into one tiled table give the tiles of a single import."""
    sky = t("sky_object")
    table = increments.TiledTable(t.spark, scratch_path(t.spark, "batches"), catalogs.CatalogInfo(**OBJ_INFO), sky.schema)
    for k in range(3):
        table.import_batch(sky.where(F.col("objectId") % 3 == k), k)
    return table.open().select("objectId", rnd("ra").alias("ra"), "Norder", "Npix")


_PLACED = """placed AS (SELECT *, row_number() OVER (ORDER BY pix << CAST(2 * (29 - ord) AS BIGINT)) - 1 AS i FROM tiles),
 member AS (SELECT hp.objectId, hp.ra, placed.i, {hash} AS h FROM hp JOIN placed ON placed.pix = (hp.pixel >> CAST(2 * (5 - placed.ord) AS BIGINT)))""".format(hash=scatter_sql("objectId", 11))


def _sampled(t):
    path = scratch_path(t.spark, "sampled")
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**OBJ_INFO))
    previews.write_samples(t.spark, path, F.expr(scatter_sql("objectId", 11)), k=30, tie=["objectId"])
    return path


@query("preview_tail", HEALPIX_CTES.format(order=29, ns=1 << 29, mask=(1 << 29) - 1) + " SELECT objectId, R6(ra) AS ra FROM hp ORDER BY pixel DESC, objectId DESC LIMIT 100")
def preview_tail(t):
    path = scratch_path(t.spark, "catalog")
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**OBJ_INFO))
    return previews.tail(t.spark, path, 100, ["objectId"]).select("objectId", rnd("ra").alias("ra"))


@query("partition_pick", _tiled_sql("").rstrip() + f", {_PLACED} SELECT objectId, R6(ra) AS ra FROM member WHERE i = 3")
def partition_pick(t):
    path = scratch_path(t.spark, "catalog")
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**OBJ_INFO))
    return previews.partition(t.spark, path, 3).select("objectId", rnd("ra").alias("ra"))


@query("sample_partition", _tiled_sql("").rstrip() + f", {_PLACED} SELECT objectId, R6(ra) AS ra FROM member WHERE i = 3 ORDER BY h, objectId LIMIT 5")
def sample_partition(t):
    return previews.sample(t.spark, _sampled(t), 3, 5).select("objectId", rnd("ra").alias("ra"))


@query("sample_random", _tiled_sql("").rstrip() + f", {_PLACED} SELECT objectId, R6(ra) AS ra FROM member ORDER BY h, objectId LIMIT 25")
def sample_random(t):
    return previews.random_sample(t.spark, _sampled(t), 25).select("objectId", rnd("ra").alias("ra"))


@query("publication_json", _tiled_sql("SELECT 'objects' AS label, CAST((SELECT sum(n) FROM tiles) AS BIGINT) AS num_rows, (SELECT count(*) FROM tiles) AS num_partitions, 6 AS num_columns"))
def publication_json(t):
    path = scratch_path(t.spark, "catalog")
    catalogs.write_catalog(t("sky_object"), path, catalogs.CatalogInfo(**OBJ_INFO))
    size = catalogs.file_sizes(t.spark, f"{path}/dataset").agg(F.sum("length").alias("bytes"))
    rec = catalogs.publication_record(t.spark.read.parquet(f"{path}/partition_info"), "objects", size, 6)
    j = F.from_json("record", "metadata struct<numRows: bigint, numColumns: int, numPartitions: bigint, sizeOnDisk: bigint, builder: string>")
    return rec.withColumn("j", j).select("label", F.col("j.metadata.numRows").alias("num_rows"), F.col("j.metadata.numPartitions").alias("num_partitions"), F.col("j.metadata.numColumns").alias("num_columns"))


_PAIR = """degrees(2 * asin(least(1e0, sqrt(power(sin(radians(b.dec - a.dec) / 2), 2) + cos(radians(a.dec)) * cos(radians(b.dec)) * power(sin(radians(b.ra - a.ra) / 2), 2))))) * 3600"""


@query(
    "association_table",
    f"""WITH p AS (SELECT a.objectId, b.otherId, {_PAIR} AS d, a.refBand, b.meanFlux FROM sky_object a JOIN sky_other b ON abs(a.dec - b.dec) < 0.001e0 AND {_PAIR} <= 1e0),
       k AS (SELECT *, row_number() OVER (PARTITION BY objectId ORDER BY d, otherId) AS rn FROM p)
       SELECT objectId, otherId, R6(d) AS dist_arcsec, refBand, R6(meanFlux) AS meanFlux FROM k WHERE rn = 1""",
)
def association_table(t):
    path = scratch_path(t.spark, "association")
    ids = matched_ids(t("sky_object"), t("sky_other"), ("objectId", "ra", "dec"), ("otherId", "ra", "dec"), 1.0)
    ids.select(F.col("lid").alias("objectId"), F.col("rid").alias("otherId"), F.col("_dist_arcsec").alias("dist_arcsec")).write.parquet(path)
    a = t.spark.read.parquet(path).join(t("sky_object").select("objectId", "refBand"), "objectId").join(t("sky_other").select("otherId", "meanFlux"), "otherId")
    return a.select("objectId", "otherId", rnd("dist_arcsec").alias("dist_arcsec"), "refBand", rnd("meanFlux").alias("meanFlux"))


@query("recompress_report", "SELECT codec, true AS smaller, (SELECT count(*) FROM lineitem) AS rows FROM (VALUES ('snappy'), ('zstd'), ('zstd:12'), ('gzip')) v(codec)")
def recompress_report(t):
    """Bytes per codec against the uncompressed table; sizes and seconds differ by machine, what must hold does not."""
    path = scratch_path(t.spark, "codec")
    r = storage.recompress(t("lineitem"), path, ["uncompressed", "snappy", "zstd", "zstd:12", "gzip"])
    plain = r.where("codec = 'uncompressed'").select(F.lit(1).alias("one"), F.col("bytes").alias("plain"))
    rows = None
    for codec in ("snappy", "zstd", "zstd:12", "gzip"):
        n = t.spark.read.parquet(f"{path}/{codec.replace(':', '-')}").agg(F.count(F.lit(1)).alias("rows")).withColumn("codec", F.lit(codec))
        rows = n if rows is None else rows.unionByName(n)
    r = r.where("codec <> 'uncompressed'").withColumn("one", F.lit(1)).join(F.broadcast(plain), "one")  # one row
    return r.join(rows, "codec").select("codec", (F.col("bytes") < F.col("plain")).alias("smaller"), "rows")


@query(
    "column_storage",
    """WITH c AS (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS name, (SELECT count(*) FROM orders) AS n)
      SELECT name, n AS "values", true AS has_size, true AS parts_sum FROM c""",
)
def column_storage(t):
    """Bytes and values per column; the bytes are the writer's, so the checked columns say what must hold."""
    a = storage.column_storage(t.spark, catalogs.file_sizes(t.spark, t.path("orders")))
    total = a.agg(F.round(F.sum("percent"), 3).alias("all")).withColumn("one", F.lit(1))
    known = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return a.where(F.col("name").isin(known)).withColumn("one", F.lit(1)).join(F.broadcast(total), "one").select("name", "values", ((F.col("size") > 0) & (F.col("bytes_per_value") > 0)).alias("has_size"), (F.col("all") == 100.0).alias("parts_sum"))


@query(
    "column_storage_merged",
    """SELECT name, true AS in_orders, false AS in_lineitem FROM (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS name)
      UNION ALL SELECT name, false, true FROM (SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_returnflag', 'l_linestatus', 'l_shipdate']) AS name)""",
)
def column_storage_merged(t):
    """Two reports side by side; a column that one table lacks stays null there."""
    a = storage.column_storage(t.spark, catalogs.file_sizes(t.spark, t.path("orders")))
    b = storage.column_storage(t.spark, catalogs.file_sizes(t.spark, t.path("lineitem")))
    both = storage.merge_reports({"orders": a, "lineitem": b})
    return both.select("name", (F.coalesce("percent_orders", F.lit(0.0)) > 0).alias("in_orders"), (F.coalesce("size_lineitem", F.lit(0)) > 0).alias("in_lineitem"))


@query("tile_threshold", "WITH s AS (SELECT sum(n_chars) AS bytes, count(*) AS rows FROM documents) SELECT CAST(bytes AS BIGINT) AS bytes, rows, CAST(floor(300 * 1048576 / (bytes / rows)) AS BIGINT) AS rows_300mib, CAST(floor(1073741824 / (bytes / rows)) AS BIGINT) AS rows_1gib FROM s")
def tile_threshold(t):
    return storage.tile_threshold(t("documents").select(F.col("n_chars").alias("bytes"), F.lit(1).alias("rows")))


@query(
    "file_bounds",
    """SELECT CAST(objectId % 3 AS INT) AS part, R6(min(CASE WHEN objectId % 3 < 2 THEN ra END)) AS ra_min, R6(max(CASE WHEN objectId % 3 < 2 THEN ra END)) AS ra_max, R6(min(dec)) AS dec_min, R6(max(dec)) AS dec_max,
       count(CASE WHEN objectId % 3 = 2 THEN 1 END) AS null_positions, objectId % 3 < 2 AS usable FROM sky_object GROUP BY objectId % 3""",
)
def file_bounds(t):
    path = scratch_path(t.spark, "bounds")
    df = t("sky_object").withColumn("part", F.col("objectId") % 3).withColumn("ra", F.when(F.col("part") < 2, F.col("ra")))
    df.repartition("part").write.partitionBy("part").parquet(path)
    b = storage.file_bounds(t.spark.read.parquet(path), "ra", "dec")
    # files of one part are joined again, so the result does not depend on how many Spark wrote
    b = b.groupBy(F.regexp_extract("file", r"part=(\d)", 1).cast("int").alias("part")).agg(
        F.min("ra_min").alias("ra_min"), F.max("ra_max").alias("ra_max"), F.min("dec_min").alias("dec_min"), F.max("dec_max").alias("dec_max"),
        F.sum("null_positions").alias("null_positions"), F.bool_and("usable").alias("usable"))
    return b.withColumns({c: rnd(c) for c in ("ra_min", "ra_max", "dec_min", "dec_max")})


@query(
    "chunk_until_n",
    """WITH c AS (SELECT l_orderkey % 8 AS chunk, count(*) AS n FROM lineitem WHERE l_quantity < 10 GROUP BY 1)
      SELECT sum(n) >= 500 AS enough, true AS only_the_cut, true AS whole_chunks, true AS no_chunk_too_many FROM c""",
)
def chunk_until_n(t):
    """Chunks of rows that satisfy a cut, taken until there are enough; the summary says what must hold whichever come first."""
    src = scratch_path(t.spark, "chunks")
    rows = t("lineitem").where("l_quantity < 10").select("l_orderkey", "l_linenumber", "l_quantity", F.expr("l_orderkey % 8 AS chunk"))
    # one folder per chunk, each a single file
    rows.repartition(8, "chunk").write.partitionBy("chunk").parquet(src)
    want = t.spark.read.parquet(src).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    stream = read_chunks(t.spark, f"{src}/*", rows.drop("chunk").schema)
    got = consume_until(stream, 500).withColumn("chunk", F.expr("l_orderkey % 8"))
    have = got.groupBy("chunk").agg(F.count(F.lit(1)).alias("m"), F.max("l_quantity").alias("top"))
    both = want.join(have, "chunk", "left")
    s = both.agg(F.sum("m").alias("m"), F.max("top").alias("top"), F.count_if(F.col("m") != F.col("n")).alias("cut"), F.max("m").alias("largest"))
    return s.select((F.col("m") >= 500).alias("enough"), (F.col("top") < 10).alias("only_the_cut"), (F.col("cut") == 0).alias("whole_chunks"), (F.col("m") - F.col("largest") < 500).alias("no_chunk_too_many"))


