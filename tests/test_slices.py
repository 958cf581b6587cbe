import datetime as dt

import pytest
from frames import rows
from pyspark.sql import functions as F

from stagedoor.operators.staging import stg_orders
from stagedoor.plans import slices
from stagedoor.schemas import DAILY_SALES
from stagedoor.session import fresh_path
from stagedoor.sinks.tables import missing_slices, read_slices, replace_slices, slice_keys


def order(n, day, tier="GA", qty=1):
    return (f"O{n}", "E1", f"{day} 12:00:00", tier, qty, 10.0, None, "completed")


@pytest.fixture(scope="module")
def orders(frames):
    return stg_orders(
        frames.raw_orders(
            order(1, "2025-06-20"), order(2, "2025-06-20", qty=2), order(3, "2025-06-20", "VIP"),
            order(4, "2025-06-21"), order(5, "2025-07-09"), order(6, "2025-06-19"),
        )
    )


def test_calendar_excludes_its_end(spark):
    days = rows(slices.calendar(spark))
    assert len(days) == 19 and days[0][0] == dt.date(2025, 6, 20) and days[-1][0] == dt.date(2025, 7, 8)


def test_daily_sales_range_and_single_slice(orders):
    day = dt.datetime(2025, 6, 20)
    assert rows(slices.daily_sales(orders)) == [
        (day, "GA", 2, 3, 30.0), (day, "VIP", 1, 1, 10.0), (dt.datetime(2025, 6, 21), "GA", 1, 1, 10.0),
    ]
    one = slices.day_slice(orders, "2025-06-20")
    assert one.columns[0] == "order_date" and one.count() == 2
    empty = slices.day_slice(orders, "2025-07-08")
    assert empty.count() == 0 and empty.schema == one.schema
    summary = rows(slices.slice_summary(slices.daily_sales(orders)))
    assert summary == [(day, 2, 40.0), (dt.datetime(2025, 6, 21), 1, 10.0)]


def test_rebuild_replaces_only_requested_days(spark, orders):
    path = fresh_path(spark, "daily")
    slices.rebuild_days(orders, path, "2025-06-20", "2025-06-22")
    # The 20th is rebuilt without its orders, so its old rows must go; the 21st was not asked for.
    later = orders.filter("order_date <> '2025-06-20'").withColumn("qty", F.col("qty") * 100)
    table = slices.rebuild_days(later, path, "2025-06-20", "2025-06-21")
    assert rows(table) == [(dt.datetime(2025, 6, 21), "GA", 1, 1, 10.0)]
    assert rows(slice_keys(spark, path, "order_date"), "slice") == [("2025-06-21",)]
    again = slices.rebuild_days(orders, path, "2025-06-20", "2025-06-22")
    assert again.count() == 3
    present = again.select(F.to_date("order_date").alias("order_date"))
    missing = missing_slices(slices.calendar(spark, "2025-06-19", "2025-06-23"), present, "order_date")
    assert [r[0].day for r in sorted(missing.collect())] == [19, 22]


def test_all_empty_first_write_makes_no_slices(spark, orders):
    path = fresh_path(spark, "daily")
    rows_ = slices.daily_sales(orders.filter("false")).withColumn("order_date", F.to_date("order_date"))
    replace_slices(rows_, path, "order_date", slices.calendar(spark))
    assert slice_keys(spark, path, "order_date").count() == 0
    assert slice_keys(spark, f"{path}-nowhere", "order_date") is None


def test_venue_slices(spark, orders):
    path = fresh_path(spark, "venues")
    from stagedoor.operators.sales import sales_measures

    orders = orders.withColumn("venue_id", F.when(F.col("tier") == "VIP", "north").otherwise("south"))
    sold = slices.sales_by(sales_measures(orders, "venue_id"), F.col("venue_id"), "venue_id")
    venues = spark.createDataFrame([("south",)], "venue_id string")
    replace_slices(sold, path, "venue_id", venues)
    assert rows(read_slices(spark, path, sold.schema, "venue_id"), "venue_id", "tier") == [("south", "GA")]
    assert [f.name for f in DAILY_SALES][0] == "order_date"


def test_slice_names_may_need_escaping(spark):
    path = fresh_path(spark, "venues")
    table = spark.createDataFrame([("a/b: c+d%", 1), ("007", 1), ("plain", 2)], "venue_id string, n int")
    replace_slices(table, path, "venue_id", table.select("venue_id"))
    replace_slices(table.filter("false"), path, "venue_id", table.filter("n = 1").select("venue_id"))
    assert rows(read_slices(spark, path, table.schema, "venue_id")) == [("plain", 2)]


def test_monthly_sales(orders):
    assert rows(slices.monthly_sales(orders), "order_month", "tier", "tickets") == [
        (dt.date(2025, 6, 1), "GA", 5), (dt.date(2025, 6, 1), "VIP", 1), (dt.date(2025, 7, 1), "GA", 1),
    ]


def test_many_stale_slices_are_emptied_in_as_many_jobs_as_few(spark, tmp_path):
    from pyspark.sql import functions as F

    def jobs(stale):
        path = str(tmp_path / f"slices{stale}")
        rows = spark.range(stale + 2).select(F.col("id").alias("key"), F.lit(1).alias("n"))
        replace_slices(rows, path, "key", rows.select("key"))
        spark.sparkContext.setJobGroup(path, path)
        replace_slices(rows.filter("key = 0").withColumn("n", F.lit(2)), path, "key", rows.filter(f"key <= {stale}").select("key"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        left = {tuple(r) for r in spark.read.parquet(path).select("key", "n").collect()}
        assert left == {(0, 2), (stale + 1, 1)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(path))

    assert jobs(200) <= jobs(3) + 2
