"""Who came: sold tickets against scanned ones."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagedoor.functions.numbers import total
from stagedoor.operators.sales import sales_measures


def show_rate_by(
    roster: DataFrame,
    promised: DataFrame,
    appeared: DataFrame,
    key: str,
    names: tuple[str, str, str],
) -> DataFrame:
    """Promised against appeared per key: both counts, their ratio and the difference.

    Keys nobody appeared for have no row. Nothing promised makes the ratio NULL.
    """
    promised_name, appeared_name, rate_name = names
    made, came = F.col(promised_name), F.col(appeared_name)
    return (
        roster.join(promised, key, "left")
        .join(appeared, key, "inner")
        .withColumn(promised_name, F.coalesce(made, F.lit(0)).cast("bigint"))
        .withColumn(rate_name, F.try_divide(came.cast("double"), made))
        .withColumn("no_shows", made - came)
    )


def attendance_by_event(
    scans: DataFrame, orders: DataFrame, events: DataFrame, one_row_per_ticket: bool = False
) -> DataFrame:
    """Completed tickets sold, distinct tickets scanned, show-up rate and no-shows per event.

    Staged scans hold each ticket once; saying so with ``one_row_per_ticket`` turns the distinct
    count into a plain one and saves its shuffle.
    """
    distinct = F.count("ticket_id") if one_row_per_ticket else F.count_distinct("ticket_id")
    sales = sales_measures(orders)
    sold = sales.groupBy("event_id").agg(total("completed_tickets").alias("tickets_sold"))
    scanned = scans.groupBy("event_id").agg(distinct.alias("tickets_scanned"))
    return show_rate_by(
        events.select("event_id", "event_name", "event_date"),
        sold,
        scanned,
        "event_id",
        ("tickets_sold", "tickets_scanned", "show_up_rate"),
    )


def attendance_totals(attendance: DataFrame) -> DataFrame:
    """One row: tickets kept, scanned and missing over all events, and the overall rate."""
    kept, scanned = total("tickets_sold"), total("tickets_scanned")
    return attendance.agg(
        kept.alias("attendance_kept"),
        scanned.alias("scanned"),
        total("no_shows").alias("no_shows"),
        F.try_divide(scanned.cast("double"), kept).alias("overall_rate"),
    )
