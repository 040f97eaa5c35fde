"""A cross-section of registered queries against DuckDB; all of them run with check_oracle.py."""

import pytest

from check_oracle import compare, connect
from starloom.plans.catalogue import QUERIES

KEYS = [
    "filter_query", "project_assign", "heliocentric_mjd", "manifest_scan", "fixed_width_source", "catalog_write_roundtrip", "healpix_index", "adaptive_tiles",
    "moc_filter", "crossmatch_1nn", "crossmatch_nested", "margin_halo", "id_search", "epoch_propagation", "join_nested", "nested_dropna", "count_nested_by",
    "pair_self_join", "nearest_time_join", "latest_version", "null_profile", "field_band_stats", "histogram", "percentiles_by_bin", "sigma_clip", "baseline_subtract",
    "whitened_residuals", "ls_best_period", "ls_multiband_joint", "bls", "periodic_candidates", "sf_log_bins", "sf_fixed_bins", "sf2_basic", "lc_otsu", "lc_feature_table",
    "udf_row_reduce", "udaf_grouped", "stream_chunks", "stream_latest_version",
]


@pytest.fixture(scope="module")
def duck():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(key, spark, tables, duck):
    message, good = compare(spark, duck, QUERIES[key], tables)
    assert good or message.startswith("ok 0 rows"), message


def test_every_query_has_a_plan_and_oracles_are_text():
    assert len(QUERIES) >= 179
    without = sorted(k for k, q in QUERIES.items() if not q.sql)
    assert without == []
