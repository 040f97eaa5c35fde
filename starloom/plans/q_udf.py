"""User functions and streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from starloom.functions.healpix import with_healpix
from starloom.operators import nested, udf
from starloom.plans.q_sky import hp
from starloom.plans.q_stats import rounded
from starloom.plans.registry import query
from starloom.session import scratch_path
from starloom.streaming import chunks, versions


@query("udf_map_partitions", hp(3) + " SELECT objectId, pixel, R6(ra - dec) AS diff FROM hp WHERE dec > 10")
def udf_map_partitions(t):
    df = with_healpix(t("sky_object"), "ra", "dec", 3, "pixel").select("objectId", "ra", "dec", "pixel")

    def fn(pdf, *, limit):
        pdf = pdf[pdf["dec"] > limit]
        return pd.DataFrame({"objectId": pdf["objectId"], "pixel": pdf["pixel"], "diff": pdf["ra"] - pdf["dec"]})

    return rounded(udf.map_partitions(df, fn, "objectId bigint, pixel bigint, diff double", limit=10.0))


@query("udf_row_reduce", "SELECT objectId, count(*) FILTER (band = 'r') AS n_r, R6(max(psfFlux) FILTER (band = 'r') - min(psfFlux) FILTER (band = 'r')) AS range_r FROM forced_source GROUP BY 1")
def udf_row_reduce(t):
    p = nested.pack(t("forced_source"), ["objectId"], ["band", "psfFlux"], ["mjd", "visit"])

    def fn(band, flux, *, which):
        flux = np.asarray(flux)[np.asarray(band) == which]
        return {"n": len(flux), "lo": flux.min() if len(flux) else None, "hi": flux.max() if len(flux) else None}

    r = udf.reduce_rows(p, fn, "lc.band", "lc.psfFlux", schema="n bigint, lo double, hi double", append_columns=True, which="r")
    g = r.groupBy("objectId").agg(F.sum("n").alias("n_r"), (F.max("hi") - F.min("lo")).alias("range_r"))
    return rounded(g)


@query("udf_map_rows", "SELECT objectId, R6(sqrt(ra * ra + dec * dec)) AS norm, ra > 180 AS west FROM sky_object")
def udf_map_rows(t):
    def fn(row, *, limit):
        return float(np.hypot(row["ra"], row["dec"])), bool(row["ra"] > limit)

    r = udf.map_rows(t("sky_object").select("objectId", "ra", "dec"), fn, ["ra", "dec"], "norm double, west boolean", row_container="dict", append_columns=True, output_names=["norm", "west"], limit=180.0)
    return rounded(r.select("objectId", "norm", "west"))


@query("udtf_explode", "SELECT vec_id, CAST(i AS INT) AS step, R4(CAST(embedding[i + 1] AS DOUBLE) - CAST(embedding[i] AS DOUBLE)) AS diff FROM embeddings, range(1, 4) r(i)")
def udtf_explode(t):
    def steps(values, *, n):
        for i in range(1, n + 1):
            yield i, float(values[i] - values[i - 1])

    e = t("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return rounded(udf.explode_rows(e, steps, ["embedding"], "step int, diff double", ["vec_id"], n=3), 4)


@query("udaf_grouped", "SELECT band, count(*) AS n, R6(exp(avg(ln(psfFlux)))) AS geometric_mean, R6(max(psfFlux)) AS top FROM forced_source GROUP BY 1")
def udaf_grouped(t):
    def partial(pdf):
        g = pdf.assign(s=np.log(pdf["psfFlux"])).groupby("band")
        return g.agg(n=("s", "size"), s=("s", "sum"), top=("psfFlux", "max")).reset_index()

    a = udf.aggregate(t("forced_source").select("band", "psfFlux"), ["band"], partial, "n bigint, s double, top double", {"top": "max"})
    return rounded(a.select("band", "n", F.exp(F.col("s") / F.col("n")).alias("geometric_mean"), "top"))


@query("stream_chunks", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_quantity < 5")
def stream_chunks(t):
    """A file stream over the table in chunks; the same rows as the batch filter."""
    s = chunks.read_chunks(t.spark, t.path("lineitem"), t("lineitem").schema)
    return chunks.run_available(s, lambda df: df.where("l_quantity < 5").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("stream_latest_version", "SELECT diaObjectId, versionId, validityStart, R6(psfFluxMean) AS psfFluxMean FROM (SELECT *, row_number() OVER (PARTITION BY diaObjectId ORDER BY validityStart DESC, versionId DESC) AS rn FROM object_version) WHERE rn = 1")
def stream_latest_version(t):
    """Versions arrive in files of mixed dates; later files may hold older versions."""
    src = scratch_path(t.spark, "arrivals")
    v = t("object_version")
    v.repartition(3, F.xxhash64("versionId")).write.parquet(src)
    s = chunks.read_chunks(t.spark, src, v.schema)
    out = versions.import_versions(s, "diaObjectId", ["validityStart", "versionId"], buckets=8)
    return rounded(out)
