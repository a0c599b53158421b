"""Plan shapes that decide whether a query holds at scale."""

import re

import pytest

from gridlake.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_cross_joins_and_no_row_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text
    assert ("ArrowEvalPython" in text) == (name in ("pearson_test", "welch_test", "merged_pearson", "merged_welch"))


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "status_projection")
    assert "EqualTo(o_orderstatus,F)" in text and "o_custkey" not in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan(spark, "gold_monthly")


@pytest.mark.parametrize("name", ["page_links", "link_filter", "page_meta", "flatten_blocks", "zip_arrays", "records_to_rows"])
def test_row_local_work_does_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_season_correlations_are_one_aggregation(spark):
    text = plan(spark, "season_correlations")
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_payload_is_parsed_once(spark):
    assert plan(spark, "flatten_blocks").count("from_json") == 1


def test_first_row_per_key_is_pruned_before_the_shuffle(spark):
    text = plan(spark, "dedupe_first")
    assert re.search(r"WindowGroupLimit .*Final", text) and re.search(r"WindowGroupLimit .*Partial", text)


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_peaks")
