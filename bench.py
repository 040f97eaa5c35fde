"""Time the headline queries on one machine; prints one JSON line.

BENCH_SF_DIR   folder of Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 4)
BENCH_KEYS     comma-separated keys, or "all" (default: the headline list)
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scan_filters", "filter_query", "latest_version", "group_agg", "band_stats", "column_statistics", "null_profile",
    "healpix_index", "adaptive_tiles", "cone_search", "crossmatch_1nn", "crossmatch_knn", "crossmatch_nested", "catalog_write_roundtrip",
    "join_nested", "nested_filter", "count_nested_by", "visit_time_lookup", "pair_self_join", "nearest_time_join",
    "consecutive_diff", "percentiles_by_bin", "sigma_clip", "whitened_residuals", "detector_rel_diff",
    "ls_best_period", "ls_multiband_joint", "bls", "bazin_grid_fit", "periodic_candidates",
    "sf_log_bins", "sf_fixed_bins", "sf2_basic", "lc_features_range", "lc_anderson_darling", "lc_feature_table",
    "udf_row_reduce", "udaf_grouped", "stream_latest_version",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    keys = os.environ.get("BENCH_KEYS", "")
    from starloom.plans.catalogue import QUERIES
    from starloom.plans.views import Tables
    from starloom.session import clear_scratch, get_spark

    names = list(QUERIES) if keys == "all" else [k for k in keys.split(",") if k] or HEADLINE
    spark = get_spark("bench", f"local[{cpus}]", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    # start the JVM code paths and the Python workers before the clock
    QUERIES["group_agg"].run(tables).write.format("noop").mode("overwrite").save()
    QUERIES["udaf_grouped"].run(tables).write.format("noop").mode("overwrite").save()
    times = {}
    for k in names:
        t0 = time.time()
        QUERIES[k].run(tables).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t0, 3)
        clear_scratch(spark)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
