"""Physical plans that the design relies on."""

import os
import re

import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def plan(spark, name):
    return contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    "name",
    [
        "campaign_performance", "campaign_returns", "attribution_summary", "attribution_movement",
        "revenue_by_tier", "attendance_by_event", "tier_matrix", "order_live_campaigns",
        "campaign_window_reach", "check_ticket_integrity", "pass_utilization", "revenue_by_sku",
    ],
)
def test_no_nested_loops_and_no_forced_broadcast(spark, no_broadcast, name):
    text = plan(spark, name)
    assert not count(r"CartesianProduct|BroadcastNestedLoopJoin|BroadcastExchange", text)
    assert not count(r"Python|Pandas|ArrowEval", text)


def test_repeated_scans_are_cut_before_the_shuffle(spark):
    text = plan(spark, "first_scan_per_ticket")
    assert count("WindowGroupLimit", text) == 2 and count("Exchange hash", text) == 1
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hash")


@pytest.mark.parametrize("name", ["daily_sales", "monthly_sales", "daily_pacing", "code_forms"])
def test_one_aggregation_shuffle(spark, name):
    assert count("Exchange hash", plan(spark, name)) == 1


def test_orders_are_summed_before_they_are_joined(spark, no_broadcast):
    # Three joins build the orders out of customers and nations; campaigns come after the sums.
    text = plan(spark, "campaign_returns")
    assert text.index("HashAggregate") < text.index("o_orderkey")
    assert count(r"Scan parquet [^\n]*o_orderkey", text) == 1


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "mrr_by_month")
    assert count(r"ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>", text) == 1


def test_day_ranges_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    for name in ("daily_sales", "daily_sales_one_day"):
        filters = re.findall(r"PushedFilters: \[([^\]]*o_orderdate[^\]]*)\]", plan(spark, name))
        assert filters and "GreaterThanOrEqual(o_orderdate" in filters[0]
        assert "LessThan(o_orderdate" in filters[0]


def test_a_hot_order_is_split(spark, frames):
    """Half of all scans carry one order id: its join partition is split at run time."""
    from pyspark.sql import functions as F

    from stagedoor.operators.relational import with_known_key

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        number = F.col("id")
        order = F.when(number % 2 == 0, F.lit("hot")).otherwise(number.cast("string"))
        scans = spark.range(0, 80000, 1, 8).select(order.alias("order_id"), F.sha2(number.cast("string"), 256))
        orders = spark.range(80000).select(number.cast("string").alias("order_id"))
        orders = orders.unionByName(spark.range(1).select(F.lit("hot").alias("order_id")))
        kept = with_known_key(scans, orders, "order_id")
        assert kept.count() == 80000
        kept.collect()
        text = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in text
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
