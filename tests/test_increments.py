"""Batches into tiles equal one import and rewrite only what they touch."""

import glob
import os

from pyspark.sql import functions as F

from starloom.sources import catalogs, increments


def placed(df):
    return sorted((r.objectId, r.Norder, r.Npix) for r in df.select("objectId", "Norder", "Npix").collect())


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/leaves/**/*.parquet", recursive=True)}


def test_batches_equal_one_import(spark, tables, tmp_path, monkeypatch):
    sky = tables("sky_object")
    info = catalogs.CatalogInfo("o", threshold=12, max_order=4)
    table = increments.TiledTable(spark, str(tmp_path / "t"), info, sky.schema)
    assert table.open().count() == 0
    north = F.col("dec") > 20
    batches = [sky.where(~north & (F.col("objectId") % 2 == 0)), sky.limit(0), sky.where(~north & (F.col("objectId") % 2 == 1)), sky.where(north)]
    seen = {}
    for k, b in enumerate(batches):
        table.import_batch(b, k)
        now = files(table.path)
        assert all(now[f] == m for f, m in seen.items())
        seen = now
        so_far = batches[0]
        for x in batches[1 : k + 1]:
            so_far = so_far.unionByName(x)
        assert placed(table.open()) == placed(catalogs.from_dataframe(so_far, threshold=12, highest_order=4))
    live = {(r.Norder, r.Npix): r for r in table.live(3).collect()}
    assert sum(r.rows for r in live.values()) == sky.count() and {r.batch for r in live.values()} >= {2, 3}
    # tiles without a northern row keep their leaves of the earlier batch
    kept = {(r.Norder, r.Npix) for r in table.live(2).collect()} & {k for k, r in live.items() if r.batch < 3}
    assert kept
    # a repeated batch, and leaves as a join
    table.import_batch(batches[3], 3)
    monkeypatch.setattr(increments, "MAX_LITERAL", 2)
    assert placed(table.open(filters=[("dec", ">", 0)])) == placed(catalogs.from_dataframe(sky, threshold=12, highest_order=4).where("dec > 0"))


def test_a_batch_counts_once_committed(spark, tables, tmp_path, monkeypatch):
    sky = tables("sky_object")
    table = increments.TiledTable(spark, str(tmp_path / "t"), catalogs.CatalogInfo("o", threshold=20, max_order=4), sky.schema)
    table.import_batch(sky.where("objectId % 2 = 0"), 1)
    before = placed(table.open())
    store = table._store

    def fail(df, path):
        if path.endswith("/tiles"):
            raise RuntimeError("lost")
        return store(df, path)

    monkeypatch.setattr(table, "_store", fail)
    try:
        table.import_batch(sky.where("objectId % 2 = 1"), 2)
    except RuntimeError:
        pass
    assert table.committed() == 1 and placed(table.open()) == before
    monkeypatch.undo()
    table.import_batch(sky.where("objectId % 2 = 1"), 2)
    assert len(placed(table.open())) == sky.count()
