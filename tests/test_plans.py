"""The physical plans: scans, shuffles, pruning, and no Python where built-ins do."""

import re

import pytest

from daywise.bindings import row_queries
from daywise.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    """The plan as first made, before adaptive execution rewrites it."""
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return len(re.findall(r"FileScan ", text))


def shuffles(text):
    return len(re.findall(r"(?<!Reused)Exchange (hash|range|Round|Single)", text))


ROW_WISE = sorted(
    name for name, f in QUERIES.items() if f.__module__ == row_queries.__name__ and name != "head_rows"
)


@pytest.mark.parametrize("name", ROW_WISE)
def test_row_work_needs_no_shuffle_and_no_python(spark, name):
    text = plan(spark, name)
    assert scans(text) == 1 and shuffles(text) == 0
    assert "Python" not in text


@pytest.mark.parametrize(
    "name, n_scans, n_shuffles",
    [
        ("daily_usage_a", 1, 1),
        ("daily_condition_table", 1, 1),
        ("report_rain", 1, 2),
        ("join_modes", 2, 2),
        ("avg_by_category", 2, 3),
        ("station_profile", 1, 2),
    ],
)
def test_scans_and_shuffles(spark, name, n_scans, n_shuffles):
    text = plan(spark, name)
    assert (scans(text), shuffles(text)) == (n_scans, n_shuffles)


def test_median_reuses_the_daily_sums(spark):
    frame = QUERIES["report_temp_sensitivity"](spark, SF)
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in text
    assert text.count("ReusedExchange") >= 2


def test_joins_use_the_partitioning_of_the_sums(spark):
    text = plan(spark, "join_modes")
    join = text.index("Join")
    between = text[join : text.index("HashAggregate")]
    assert "Exchange" not in between


def test_only_needed_columns_are_read(spark):
    for name, columns in {
        "daily_usage_a": ["l_linenumber", "l_quantity", "l_shipdate"],
        "month_key": ["o_orderkey", "o_orderdate"],
    }.items():
        read = re.search(r"FileScan parquet \[(.*?)\]", plan(spark, name)).group(1)
        assert [c.partition("#")[0] for c in read.split(",")] == columns


@pytest.mark.parametrize("name", ["box_stats", "box_stats_raw"])
def test_box_statistics_read_counts_of_values_only(spark, name):
    text = plan(spark, name)
    assert "lineitem" not in text and "percentile" not in text and "_count" in text


def test_first_rows_are_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "head_rows")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_of_tables(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
