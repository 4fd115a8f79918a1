"""Shapes of physical plans that matter at scale."""

import os
import re

import pytest

import webloom.plans as plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")

SAMPLE = [
    "url_domain", "expand_urls", "route_url", "new_links", "missing_items", "attempt_status", "batch_progress", "mean_cost_of_others", "proxy_score",
    "insert_new", "upsert_by_id", "update_nested", "latest_page", "map_name", "attach_rank", "link_entity", "alias_or_name_lookup", "join_answers",
    "compare_sources", "containment_pairs", "tier_entities", "lexicon_core_diff", "merge_index_files", "domain_stats", "snapshot_delta", "coverage",
    "duplicate_report", "search_completeness", "checksum_diff", "classification_report", "pick_question", "merge_pages", "entity_tiering",
    "top_share_per_group", "latest_report_block", "rate_in_last_minute", "min_over_samples", "page_links", "normalise_headers", "detect_groups",
    "mention_entities", "eav_rows", "alias_map", "attribute_mapping", "merge_aliases", "price_records_rows", "series_meta", "record_search",
    "related_names", "candidate_companies", "hospital_overlap", "guess_province", "seed_stats", "clean_song", "album_songs", "price_pipeline",
]


def plan(spark, name):
    return plans.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SAMPLE)
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", SAMPLE)
def test_windows_are_partitioned(spark, name):
    """A window without keys may only run over one row per chunk or part."""
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", plan(spark, name)):
        first = spec.split(",")[0]
        if first.startswith("_part#"):  # the offsets of a distributed index: one row per part
            continue
        assert "ASC" not in first and "DESC" not in first, spec


def test_top_k_is_pruned_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "recommended_first")


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "insert_new")
    assert "PushedFilters: [IsNotNull(o_orderdate)" in text or "GreaterThanOrEqual(o_orderdate" in text
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert scans and all("o_orderpriority" not in s for s in scans)
    words = plan(spark, "mention_entities")
    assert "n_chars" not in "".join(re.findall(r"ReadSchema: (struct<[^>]*>)", words))
