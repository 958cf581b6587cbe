"""Sales by slice: days of a bounded calendar, months, venues."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.functions.dates import within
from stagedoor.functions.numbers import money_total, total
from stagedoor.operators.sales import sales_measures
from stagedoor.schemas import DAILY_SALES
from stagedoor.session import settle
from stagedoor.sinks.tables import read_slices, replace_slices

# The calendar of the season, end exclusive.
FIRST_DAY, END_DAY = "2025-06-20", "2025-07-09"


def calendar(spark: SparkSession, first: str = FIRST_DAY, end: str = END_DAY) -> DataFrame:
    """One row per day of the range; the end is excluded."""
    days = F.sequence(
        F.lit(first).cast("date"), F.date_sub(F.lit(end).cast("date"), 1), F.expr("INTERVAL 1 DAY")
    )
    return spark.range(1).select(F.explode(days).alias("order_date"))


def sales_by(orders: DataFrame, key: Column, name: str) -> DataFrame:
    """Orders, tickets and net per slice and tier."""
    return (
        sales_measures(orders)
        .filter(key.isNotNull() & F.col("tier").isNotNull())
        .groupBy(key.alias(name), "tier")
        .agg(
            total("orders").alias("orders"),
            total("tickets").alias("tickets"),
            money_total("net").alias("net_revenue"),
        )
    )


def _time_column(orders: DataFrame) -> str:
    """The recorded time where there is one, as scans can filter on it; a roll-up has the day."""
    return "ordered_at" if "ordered_at" in orders.columns else "order_date"


def daily_sales(orders: DataFrame, first: str = FIRST_DAY, end: str = END_DAY) -> DataFrame:
    """All day slices of the range in one aggregation; other days have no slice."""
    inside = orders.filter(within(orders, _time_column(orders), first, end))
    return sales_by(inside, F.col("order_date"), "order_date").select(
        F.col("order_date").cast("timestamp").alias("order_date"),
        "tier",
        "orders",
        "tickets",
        "net_revenue",
    )


def day_slice(orders: DataFrame, day: str) -> DataFrame:
    """One slice, its day as the first column."""
    next_day = str(date.fromisoformat(day) + timedelta(days=1))
    inside = orders.filter(within(orders, _time_column(orders), day, next_day))
    rows = sales_by(inside, F.col("order_date"), "order_date")
    return rows.select(
        F.lit(day).cast("timestamp").alias("order_date"), "tier", "orders", "tickets", "net_revenue"
    )


def monthly_sales(orders: DataFrame) -> DataFrame:
    month = F.trunc(F.col("order_date").cast("date"), "month")
    return sales_by(orders, month, "order_month")


def slice_summary(slices: DataFrame, key: str = "order_date") -> DataFrame:
    """Rows and net revenue per slice."""
    return slices.groupBy(key).agg(
        F.count("*").alias("row_count"), money_total("net_revenue").alias("slice_net_revenue")
    )


def slice_metrics(rows: DataFrame, requested: DataFrame, key: str) -> DataFrame:
    """Rows and net revenue of every requested slice, zeros where it is empty."""
    found = slice_summary(rows, key).withColumnRenamed(key, "_slice")
    return requested.join(found, requested[key] == F.col("_slice"), "left").select(
        requested[key].cast("string").alias("slice"),
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce("slice_net_revenue", F.lit(0.0)).alias("slice_net_revenue"),
    )


def record_slices(metrics: DataFrame, path: str) -> None:
    """Add what a rebuild wrote to the table's metrics, a row for each slice and rebuild."""
    metrics.withColumn("run_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}_metrics")


def rebuild_days(orders: DataFrame, path: str, first: str, end: str) -> DataFrame:
    """Rebuild the stored slices of a day range, empty ones included, and return the table.

    Rows and net revenue of each slice are recorded beside it.
    """
    spark = orders.sparkSession
    rows = settle(daily_sales(orders, first, end).withColumn("order_date", F.to_date("order_date")), "days")
    days = calendar(spark, first, end)
    replace_slices(rows, path, "order_date", days)
    record_slices(slice_metrics(rows, days, "order_date"), path)
    return read_slices(spark, path, DAILY_SALES, "order_date")
