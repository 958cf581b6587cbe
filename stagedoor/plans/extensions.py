"""The same questions for neighbouring businesses: venues, programs, memberships, webinars, merch."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.functions.numbers import money_total, ratio_or_zero, total
from stagedoor.functions.text import ticket_number
from stagedoor.operators.attendance import show_rate_by
from stagedoor.operators.relational import keep_first, with_grand_total
from stagedoor.operators.sales import sales_measures

SETTLEMENT = ["tickets_sold", "gross_revenue", "refunded_tickets", "net_revenue"]


def settlement_by_venue(orders: DataFrame, venue: str = "venue_id") -> DataFrame:
    """Gross, refunds and net per venue and tier, with a grand total; orders carry their venue."""
    per_venue = (
        sales_measures(orders, venue)
        .groupBy(venue, "tier")
        .agg(
            total("tickets").alias("tickets_sold"),
            money_total("gross").alias("gross_revenue"),
            total("refunded_tickets").alias("refunded_tickets"),
            money_total("net").alias("net_revenue"),
        )
    )
    return with_grand_total(per_venue, [venue, "tier"], SETTLEMENT)


def yield_by_program(programs: DataFrame, offers: DataFrame, enrollments: DataFrame) -> DataFrame:
    """Offers made against distinct enrolled offers per program."""
    made = offers.groupBy("program_id").agg(F.count("offer_id").alias("offers_made"))
    enrolled = enrollments.groupBy("program_id").agg(
        F.count_distinct("offer_id").alias("enrolled")
    )
    names = ("offers_made", "enrolled", "yield_rate")
    return show_rate_by(programs, made, enrolled, "program_id", names).withColumnRenamed(
        "no_shows", "declined"
    )


def mrr_by_month(payments: DataFrame, paid_at: Column, amount: Column, customer: Column) -> DataFrame:
    """Revenue, payments and paying customers per month."""
    return payments.groupBy(F.trunc(paid_at, "month").alias("month")).agg(
        F.count("*").alias("payments"),
        F.count_distinct(customer).alias("customers"),
        money_total(amount).alias("mrr"),
    )


def churn_by_month(payments: DataFrame, paid_at: Column, customer: Column) -> DataFrame:
    """Customers of each month and how many of them do not pay in the next one.

    A payment marks its own month as active and the month before as followed. Both marks meet in one
    aggregate by customer and month, so the largest customer shrinks to its months before the
    shuffle. The last month has no next one: its churn is NULL.
    """
    month = F.trunc(paid_at, "month")
    marks = F.array(
        F.struct(month.alias("month"), F.lit(1).alias("active"), F.lit(0).alias("followed")),
        F.struct(
            F.add_months(month, -1).alias("month"), F.lit(0).alias("active"), F.lit(1).alias("followed")
        ),
    )
    counted = (
        payments.filter(customer.isNotNull())
        .select(customer.alias("customer"), F.inline(marks))
        .groupBy("customer", "month")
        .agg(F.max("active").alias("active"), F.max("followed").alias("followed"))
        .filter("active = 1")
        .groupBy("month")
        .agg(F.count("*").alias("customers"), F.count_if(F.col("followed") == 0).alias("gone"))
    )
    last = payments.agg(F.max(F.trunc(paid_at, "month")).alias("last")).scalar()
    has_next = F.col("month") < last
    return counted.select(
        "month",
        "customers",
        F.when(has_next, F.col("gone")).alias("churned"),
        F.when(has_next, ratio_or_zero(F.col("gone"), F.col("customers"))).alias("churn_rate"),
    )


def ticket_fanout(orders: DataFrame) -> DataFrame:
    """One row per ticket: an order of n tickets owns ``<order>-T1`` to ``<order>-Tn``."""
    numbers = F.sequence(F.lit(1).cast("bigint"), F.col("qty").cast("bigint"))
    return (
        orders.filter(F.col("qty") > 0)
        .select("order_id", "event_id", F.explode(numbers).alias("ticket_number"))
        .select(
            F.concat("order_id", F.lit("-T"), F.col("ticket_number").cast("string")).alias("ticket_id"),
            "order_id",
            "event_id",
            "ticket_number",
        )
    )


def pass_utilization(orders: DataFrame, scans: DataFrame) -> DataFrame:
    """Entitlements owned and used per event of the order.

    A ticket counts as used once, and only if its order owns it; owned ones need no fan-out, the
    quantity already counts them.
    """
    owned = orders.groupBy("event_id").agg(total("qty").alias("owned"))
    tickets = scans.select(
        "order_id", ticket_number(F.col("ticket_id")).alias("number")
    ).distinct()
    used = (
        tickets.join(orders.select("order_id", "event_id", "qty"), "order_id")
        .filter(F.col("number").between(F.lit(1), F.col("qty")))
        .groupBy("event_id")
        .agg(F.count("*").alias("used"))
    )
    zero = F.lit(0).cast("bigint")
    return owned.join(used, "event_id", "left").select(
        "event_id",
        "owned",
        F.coalesce("used", zero).alias("used"),
        ratio_or_zero(F.coalesce("used", zero), F.col("owned")).alias("utilization"),
    )


def campaign_quality(joins: DataFrame, registrations: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaigns credited for people who came: registered tickets, attendees, and their ratio.

    A person joining a session again counts once; joins without a registration do not count.
    """
    first = keep_first(joins, ["ticket_id", "event_id"], ["scanned_at", "scan_id"])
    came = first.groupBy("order_id").agg(F.count("*").alias("attendees"))
    registered = registrations.select("order_id", "promo_code", "qty")
    per_code = (
        registered.join(came, "order_id", "left")
        .groupBy("promo_code")
        .agg(
            total("qty").alias("registered"),
            total("attendees").alias("attendees"),
        )
    )
    zero = F.lit(0).cast("bigint")
    registered_count, came_count = F.coalesce("registered", zero), F.coalesce("attendees", zero)
    return campaigns.join(per_code, "promo_code", "left").select(
        "campaign_id",
        "name",
        registered_count.alias("registered"),
        came_count.alias("attendees"),
        ratio_or_zero(came_count, registered_count).alias("attendance_rate"),
    )


def revenue_by_sku(merch: DataFrame) -> DataFrame:
    """Units and revenue per event and article, with a grand total."""
    per_sku = merch.groupBy("event_id", "sku").agg(
        total("units").alias("units"), money_total("revenue").alias("revenue")
    )
    return with_grand_total(per_sku, ["event_id", "sku"], ["units", "revenue"])


def merch_per_attendee(merch: DataFrame, attendance: DataFrame) -> DataFrame:
    """Merch revenue and units per person who came."""
    per_event = merch.groupBy("event_id").agg(
        total("units").alias("units"), money_total("revenue").alias("revenue")
    )
    came = F.col("tickets_scanned")
    return attendance.join(per_event, "event_id", "left").select(
        "event_id",
        "event_name",
        "tickets_scanned",
        F.coalesce("revenue", F.lit(0.0)).alias("merch_revenue"),
        F.try_divide(F.coalesce("revenue", F.lit(0.0)), came).alias("revenue_per_attendee"),
        F.try_divide(F.coalesce("units", F.lit(0)).cast("double"), came).alias("attach_rate"),
    )
