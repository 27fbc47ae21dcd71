"""What the plans must have: pushed filters, pruned columns, partial work before a shuffle."""

import pytest

from lectern.plans import core


def plan(spark, data, name):
    return core.QUERIES[name](spark, data)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["scan_project", "duration_floor", "duration_strict", "status_filter", "quality_filter", "needs_license"])
def test_filters_reach_the_scan(spark, data, name):
    text = plan(spark, data, name)
    assert "PushedFilters: []" not in text and "PushedFilters: [" in text
    assert "transcript" not in text.split("ReadSchema")[-1]


@pytest.mark.parametrize("name", ["dist_status", "topn_per_group", "cc_channels", "claim_batch", "related_pairs", "seed_sample"])
def test_texts_are_not_read_for_counts(spark, data, name):
    assert all("transcript" not in part.split(">", 1)[0] for part in plan(spark, data, name).split("ReadSchema: struct<")[1:])


def test_top_of_a_group_is_cut_before_the_shuffle(spark, data):
    text = plan(spark, data, "topn_per_group").split("Physical Plan")[-1]
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_a_sample_is_a_top_k(spark, data):
    assert "TakeOrderedAndProject" in plan(spark, data, "claim_fallback")


@pytest.mark.parametrize("name", ["priority_tier", "admit_related", "license_scan", "insert_new", "export_queue", "channel_verdict"])
def test_no_python_and_no_cross_join(spark, data, name):
    text = plan(spark, data, name).split("Physical Plan")[-1]
    assert not any(word in text for word in ("Python", "InArrow", "InPandas", "Cartesian", "NestedLoop"))


def test_text_is_parsed_once(spark, data):
    text = plan(spark, data, "ndjson_parse").split("Physical Plan")[-1]
    assert text.count("from_json") == 1
