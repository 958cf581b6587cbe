"""Sales measures and the tables grouped from them.

Every sales question is a sum of the same few measures, by event and tier, by promo code, or by day.
``sales_measures`` gives the measures per order; ``sales_rollup`` sums them by all three in one pass,
in as many rows as there are groups. Every function here takes either one, or the staged orders: a single
question reads the orders directly, a whole report scans them once and goes on from the roll-up.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagedoor.functions.numbers import money_sum, money_total, total, zero_if
from stagedoor.operators.relational import side_by_side, with_grand_total

COUNTS = ["orders", "order_rows", "tickets", "refunded_tickets", "completed_tickets"]
AMOUNTS = ["gross", "net"]
KEYS = ["event_id", "tier", "promo_code", "order_date"]
# The groupings of the roll-up, and the bits by which Spark numbers them: one for each key left out.
GROUPINGS = {"event": KEYS[:2], "code": KEYS[2:3], "day": KEYS[3:]}
_NUMBERS = {
    name: sum(1 << i for i, k in enumerate(reversed(KEYS)) if k not in keys)
    for name, keys in GROUPINGS.items()
}
GROUPING = "grouping"


def sales_measures(orders: DataFrame, *keep: str, by: str = "event") -> DataFrame:
    """Additive measures per order row, or those of one grouping of a roll-up.

    A table that has measures but no groupings passes unchanged.
    """
    if GROUPING in orders.columns:
        return orders.filter(F.col(GROUPING) == by)
    if "order_rows" in orders.columns:
        return orders
    refunded = F.col("status").eqNullSafe("refunded")
    completed = F.col("status").eqNullSafe("completed")
    one = F.lit(1).cast("bigint")
    return orders.select(
        *KEYS,
        *keep,
        zero_if(F.col("order_id").isNull(), one).alias("orders"),
        one.alias("order_rows"),
        F.col("qty").cast("bigint").alias("tickets"),
        zero_if(~refunded, F.col("qty").cast("bigint")).alias("refunded_tickets"),
        zero_if(~completed, F.col("qty").cast("bigint")).alias("completed_tickets"),
        F.col("gross_revenue").alias("gross"),
        F.col("net_revenue").alias("net"),
    )


def sales_rollup(orders: DataFrame) -> DataFrame:
    """Measures by event and tier, by code, and by day, told apart by the column ``grouping``.

    Sums of amounts stay decimals, as they are summed again.
    """
    groups = [[F.col(k) for k in keys] for keys in GROUPINGS.values()]
    names = F.create_map(*(F.lit(x) for name, number in _NUMBERS.items() for x in (number, name)))
    sums = [total(c).alias(c) for c in COUNTS] + [money_sum(F.col(c)).alias(c) for c in AMOUNTS]
    grouped = sales_measures(orders).groupingSets(groups, *KEYS).agg(F.grouping_id().alias("_id"), *sums)
    return grouped.select(names[F.col("_id").cast("int")].alias(GROUPING), *KEYS, *COUNTS, *AMOUNTS)


def revenue_by(sales: DataFrame, names: DataFrame, key: str, name: str, tier: str = "tier") -> DataFrame:
    """Tickets and revenue per name and tier, with a grand total row.

    Sales are summed by key before the names join on. Sales with an unknown key or no tier
    have no row and no part in the total; two keys with one name share their rows.
    """
    per_key = (
        sales_measures(sales)
        .groupBy(key, tier)
        .agg(
            total("tickets").alias("tickets_sold"),
            money_sum("gross").alias("gross_revenue"),
            total("refunded_tickets").alias("refunded_tickets"),
            money_sum("net").alias("net_revenue"),
        )
    )
    measures = ["tickets_sold", "gross_revenue", "refunded_tickets", "net_revenue"]
    named = per_key.join(names.select(key, name), key, "left")
    return with_grand_total(named, [name, tier], measures)


def revenue_by_tier(orders: DataFrame, events: DataFrame) -> DataFrame:
    return revenue_by(orders, events, "event_id", "event_name")


def total_row_reconciles(revenue: DataFrame, name: str = "event_name") -> DataFrame:
    """One row: is there exactly one TOTAL row, and does it equal the sum of the others?"""
    is_total = F.col(name) == "TOTAL"

    def both(column):
        whole = F.sum(F.when(is_total, F.col(column)))
        parts = F.coalesce(F.sum(F.when(~is_total, F.col(column))), F.lit(0))
        return whole, parts

    net, parts_net = both("net_revenue")
    sold, parts_sold = both("tickets_sold")
    return revenue.agg(
        F.count_if(is_total).alias("total_rows"),
        sold.alias("total_tickets"),
        parts_sold.alias("sum_of_tickets"),
        F.coalesce(
            (F.count_if(is_total) == 1) & (sold == parts_sold) & (F.abs(net - parts_net) < 0.005),
            F.lit(False),
        ).alias("passed"),
    )


def daily_pacing(orders: DataFrame) -> DataFrame:
    """Net revenue and tickets per order day."""
    return (
        sales_measures(orders, by="day")
        .filter(F.col("order_date").isNotNull())
        .groupBy(F.col("order_date").alias("date"))
        .agg(money_total("net").alias("net"), total("tickets").alias("tickets"))
    )


def launch_window(pacing: DataFrame, days: int = 4) -> DataFrame:
    """One row: net of the first day and of the first days together, last day, net of all days."""
    opening = pacing.orderBy("date").limit(days)
    return side_by_side(
        opening.agg(
            F.coalesce(F.min_by("net", "date"), F.lit(0.0)).alias("day_net"),
            money_total("net").alias("first4_net"),
        ),
        pacing.agg(
            F.max("date").alias("last_order_date"), money_total("net").alias("paced_net")
        ),
    )


def sales_totals(orders: DataFrame) -> DataFrame:
    """One row: net, gross and tickets over all orders."""
    counts = [total(c).alias(c) for c in ("tickets", "refunded_tickets")]
    return (
        sales_measures(orders)
        .agg(*counts, *(money_sum(F.col(c)).alias(c) for c in AMOUNTS))
        .select(
            F.col("net").cast("double").alias("net"),
            F.col("gross").cast("double").alias("gross"),
            F.col("tickets").alias("tickets_sold"),
            "refunded_tickets",
            (F.col("tickets") - F.col("refunded_tickets")).alias("tickets_kept"),
            (F.col("gross") - F.col("net")).cast("double").alias("refunded_rev"),
        )
    )
