"""The executive one-pager: eight KPIs and a short summary over the three marts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.functions.numbers import money_total, total
from stagedoor.functions.text import dollars, joined_or_none, percent, thousands
from stagedoor.operators.attribution import real_campaigns, top_campaigns
from stagedoor.operators.relational import first_row_by, side_by_side
from stagedoor.operators.numbering import numbered
from stagedoor.plans.settings import VENUE_CAPACITY
from stagedoor.session import settle


def headline_numbers(
    performance: DataFrame,
    revenue: DataFrame,
    attendance: DataFrame,
    capacity: int | Column = VENUE_CAPACITY,
) -> DataFrame:
    """One row with the unformatted KPIs. Ties go to the name or id that sorts first."""
    tiers = revenue.filter(F.col("event_name") != "TOTAL")
    by_tier = tiers.groupBy("tier").agg(money_total("net_revenue").alias("net"))
    sold_out = (
        tiers.groupBy("event_name")
        .agg(F.sum("tickets_sold").alias("sold"))
        .filter(F.col("sold") >= capacity)
    )
    earned, returned = F.col("attributed_revenue"), F.col("revenue_per_dollar")
    rate = F.col("show_up_rate")
    worst = F.struct(F.col("event_name").alias("name"), rate.alias("rate"))
    return side_by_side(
        tiers.agg(
            money_total("net_revenue").alias("total_net"),
            total("tickets_sold").alias("tickets_sold"),
        ),
        by_tier.agg(first_row_by(F.col("tier"), -F.col("net"), F.col("tier")).alias("top_tier")),
        sold_out.agg(joined_or_none(F.collect_list("event_name")).alias("sellouts")),
        real_campaigns(performance).agg(
            first_row_by(F.col("name"), -earned, F.col("campaign_id")).alias("best_by_revenue"),
            first_row_by(
                F.col("name"), -returned, F.col("campaign_id"), where=F.col("spend_usd") > 0
            ).alias("best_per_dollar"),
        ),
        attendance.agg(
            F.try_divide(
                F.sum("tickets_scanned").cast("double"), F.sum("tickets_sold")
            ).alias("overall_rate"),
            first_row_by(worst, rate, F.col("event_id")).alias("worst_night"),
        ),
    )


def box_office_report(
    performance: DataFrame,
    revenue: DataFrame,
    attendance: DataFrame,
    capacity: int | Column = VENUE_CAPACITY,
) -> DataFrame:
    """Eight rows: metric and its value as shown."""
    numbers = headline_numbers(performance, revenue, attendance, capacity)
    worst = F.concat(
        F.col("worst_night.name"), F.lit(" ("), percent(F.col("worst_night.rate")), F.lit(" show-up)")
    )
    # The metric names, in report order.
    shown = {
        "total_net_revenue": dollars(F.col("total_net")),
        "tickets_sold": thousands(F.col("tickets_sold")),
        "overall_show_up_rate": percent(F.col("overall_rate")),
        "best_campaign_by_revenue": F.col("best_by_revenue"),
        "best_campaign_per_dollar": F.col("best_per_dollar"),
        "top_tier_by_revenue": F.col("top_tier"),
        "sellout_events": F.col("sellouts"),
        "worst_no_show_event": worst,
    }
    rows = [F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in shown.items()]
    return numbers.select(F.inline(F.array(*rows)))


def summary_tables(performance: DataFrame, attendance: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two tables below the summary sentence: leading campaigns, and show-up by event."""
    leaders = top_campaigns(performance).select(
        "name", "channel", "attributed_orders", "attributed_revenue", "revenue_per_dollar"
    )
    shown = attendance.orderBy("event_id").select(
        "event_name", "tickets_sold", "tickets_scanned", "show_up_rate"
    )
    return leaders, shown


def executive_summary(
    performance: DataFrame,
    revenue: DataFrame,
    attendance: DataFrame,
    title: str,
    capacity: int | Column = VENUE_CAPACITY,
) -> DataFrame:
    """One row: the opening sentence of the one-pager."""
    text = F.concat(
        F.lit(f"{title}: "),
        thousands(F.col("tickets_sold")),
        F.lit(" tickets brought in "),
        dollars(F.col("total_net")),
        F.lit(" after refunds, and "),
        percent(F.col("overall_rate"), 0),
        F.lit(" of them were used. Most was earned through "),
        F.col("best_by_revenue"),
        F.lit(", most for each dollar spent through "),
        F.col("best_per_dollar"),
        F.lit("."),
    )
    return headline_numbers(performance, revenue, attendance, capacity).select(text.alias("summary"))


def summary_page(summary: DataFrame, leaders: DataFrame, shown: DataFrame) -> DataFrame:
    """(part, place, text): the one-pager line by line, the sentence and below it both tables with their headings.

    ``leaders`` come by revenue, the leading row first, ``shown`` by event. Lines of the second table are numbered
    by range, so its length doesn't matter. A missing figure shows as a dash.
    """

    def line(*cells: Column) -> Column:
        return F.concat_ws(" | ", *(F.coalesce(c.cast("string"), F.lit("-")) for c in cells))

    def heading(part: int, text: str) -> DataFrame:
        return summary.sparkSession.range(1).select(F.lit(part).alias("part"), F.lit(0).cast("bigint").alias("place"), F.lit(text).alias("text"))

    campaign = line(
        F.col("name"), F.col("channel"), thousands(F.col("attributed_orders")), dollars(F.col("attributed_revenue")),
        F.format_number("revenue_per_dollar", 2),
    )
    night = line(F.col("event_name"), thousands(F.col("tickets_sold")), thousands(F.col("tickets_scanned")), percent(F.col("show_up_rate")))
    tables = (
        (1, leaders.select("attributed_revenue", "name", campaign.alias("text")), [F.desc("attributed_revenue"), F.col("name")]),
        (2, shown.select("event_name", night.alias("text")), [F.col("event_name")]),
    )
    page = summary.select(F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("place"), F.col("summary").alias("text"))
    page = page.union(heading(1, "Leading campaigns | channel | orders | net | net per dollar"))
    page = page.union(heading(2, "Show-up | sold | scanned | rate"))
    for part, table, order in tables:
        placed = numbered(settle(table, "summary-table"), order)
        page = page.union(placed.select(F.lit(part).alias("part"), (F.col("place") + 1).alias("place"), "text"))
    return page


def write_page(page: DataFrame, path: str) -> None:
    """The page as text files whose names sort as its lines do."""
    page.repartitionByRange("part", "place").sortWithinPartitions("part", "place").select("text").write.mode("overwrite").text(path)
