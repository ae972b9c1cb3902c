"""Queries against their SQL on the smallest tables; the driver compares all of them."""

import pytest

from ledgerline.plans import registry
from tests.conftest import SMALL
from tests.oracle import same

CHOSEN = (
    "bundle_entry", "resolve_prev", "revision_merge", "as_published_vintage", "streak_delta", "streak_level", "trailing_median_12", "panel_assemble", "scan_series",
    "gate_seasonal_z", "gate_yoy_base", "gate_ytd_arith", "audit_prev", "audit_api_sample", "headline_sentence", "level_sentence", "fn_periods", "extract_table_rows", "ingest_stream",
    "fn_period_steps", "fn_release_windows", "fn_titles", "fn_number_tests", "fn_number_text", "fn_ticks", "fn_text_signs", "fn_provenance", "audit_determinism", "audit_derived", "audit_archive_sample",
    "smoke_sample_compare", "stage_identity_replay", "gate_break_link", "page_label_value_search", "dataset_fingerprint", "link_select",
    "gate_schema_lines", "gate_release_identity", "gate_catalog", "audit_headline_numbers", "audit_derived_rules", "section_bundle", "city_rows",
    "pages_for_src", "break_windows_swept", "break_rows_within", "merkle_diff", "merkle_ranges", "sampling_strata", "sample_smallest", "extract_prose_stats", "nearest_marker_caliber", "city_table_extract",
    "write_bundles", "write_series_canonical", "gate_break_no_yoy", "gate_release_window", "audit_freshness",
)


@pytest.mark.parametrize("name", CHOSEN)
def test_same_as_sql(spark, name):
    same(spark, registry.queries()[name], registry.oracle_sql()[name], SMALL)


def test_names():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert len(registry.queries()) > 180
