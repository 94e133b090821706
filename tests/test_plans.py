"""Plans that are wanted: pruned scans, pushed filters, no Python where functions do, no window over all rows of a large table."""

import re

import pytest

from formloom.plans import queries

PYTHON = {"grid_assign", "page_json", "grid_greedy", "stub_grid", "router_rows"}
#: These run a stream or count before their result, which then is read back.
READ_BACK = {"labels_latest_stream", "events_by_hour", "export_stream"}


def plan(spark, sf, name):
    return queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - READ_BACK))
def test_python_only_where_needed(spark, sf, name):
    found = re.search("Python|Pandas|Arrow", plan(spark, sf, name))
    assert bool(found) == (name in PYTHON)


def test_scans_are_pruned(spark, sf):
    text = plan(spark, sf, "time_three_way")
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>", text)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,25.0)" in plan(spark, sf, "missing_images")


def test_few_shuffles(spark, sf):
    assert plan(spark, sf, "labels_latest").count("Exchange hashpartitioning") == 1
    assert plan(spark, sf, "time_three_way").count("Exchange") == 0
    assert plan(spark, sf, "nbest_rescore").count("Exchange hashpartitioning") == 1
    assert plan(spark, sf, "yolo_lines").count("Exchange hashpartitioning") == 0


@pytest.mark.parametrize("name", ["time_three_way", "failure_texts", "label_import", "export_time_summary", "dataset_lint", "nbest_rescore", "amount_sanitize", "minutes_worked", "eval_per_column"])
def test_methods_are_small_enough_to_compile(spark, sf, name):
    """The JVM compiles methods of up to 8000 bytes; longer ones stay interpreted."""
    own = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        code = queries.QUERIES[name](spark, sf)._jdf.queryExecution().debug().codegenToSeq()
        sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", own)
    assert sizes and max(sizes) < 8000, sizes


def test_wide_rows_are_joined_once(spark, sf):
    """Columns are taken apart after the join: no row is shuffled once a column."""
    text = plan(spark, sf, "eval_per_column")
    assert text.count("Exchange hashpartitioning(o_orderkey") + text.count("BroadcastExchange") == 2 or text.count("BroadcastExchange") == 1
    assert "Generate inline" in text.split("Join")[0]
