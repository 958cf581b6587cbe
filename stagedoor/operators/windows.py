"""Windows of days met with what happens on days, without a row for every day of a window.

A window is two rows: one where it opens and one where it is over. Laid into one order with the days, running
sums tell how many windows are open on a day (plus one at the opening, minus one after the end), or what the
days inside a window add up to (the sum up to its end less the sum before its opening).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.functions.numbers import money_sum, total
from stagedoor.operators.numbering import running_totals
from stagedoor.operators.sales import sales_measures


def coded_windows(campaigns: DataFrame) -> DataFrame:
    """(campaign_id, spend_usd, first, last): coded campaigns with a window of a day or more, both ends in it."""
    dated = campaigns.filter(F.col("promo_code").isNotNull()).select(
        "campaign_id", "spend_usd", F.to_date("starts_on").alias("first"), F.to_date("ends_on").alias("last")
    )
    return dated.filter("first <= last")


def open_on(days: DataFrame, windows: DataFrame, amount: Column) -> DataFrame:
    """(day, open, amount): windows open on each of ``days`` (one column ``day``), and their amounts together.

    Days without an open window have zeros; a null day has none open.
    """
    opens = windows.select(F.col("first").alias("day"), F.lit(1).cast("bigint").alias("n"), amount.cast("decimal(38,4)").alias("a"))
    over = windows.select(F.date_add("last", 1).alias("day"), F.lit(-1).cast("bigint").alias("n"), (-amount).cast("decimal(38,4)").alias("a"))
    changes = opens.union(over).groupBy("day").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))
    asked = days.select("day").distinct().select("day", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("decimal(38,4)").alias("a"))
    # A day's changes come before the question about it.
    rows = changes.select("day", "n", F.col("a").cast("decimal(38,4)").alias("a"), F.lit(False).alias("asked"))
    rows = rows.union(asked.withColumn("asked", F.lit(True)))
    ran = running_totals(rows, [F.col("day").asc_nulls_first(), F.col("asked")], {"open": F.col("n"), "amount": F.col("a")})
    return ran.filter("asked").select("day", "open", F.col("amount").cast("double").alias("amount"))


def sums_inside(windows: DataFrame, per_day: DataFrame, measures: list[str], key: str) -> DataFrame:
    """(key, each of ``measures``): what ``per_day`` (column ``day``) adds up to from first to last day of each window.

    A window without a day has zeros. ``key`` names a window.
    """
    kinds = {m: per_day.schema[m].dataType for m in measures}
    nothing = [F.lit(None).cast(kinds[m]).alias(m) for m in measures]
    marks = [
        windows.select(F.col(end).alias("day"), F.lit(turn).alias("turn"), F.col(key).alias("key"), *nothing)
        for end, turn in (("first", 0), ("last", 2))
    ]
    days = per_day.filter(F.col("day").isNotNull()).select(
        "day", F.lit(1).alias("turn"), F.lit(None).cast(windows.schema[key].dataType).alias("key"), *measures
    )
    names = {f"sum_{m}": F.col(m) for m in measures}
    ran = running_totals(marks[0].union(days).union(marks[1]), [F.col("day"), F.col("turn")], names)
    # The later mark less the earlier one.
    signed = [F.sum(F.when(F.col("turn") == 2, F.col(n)).otherwise(-F.col(n))).alias(m) for m, n in zip(measures, names, strict=True)]
    return ran.filter("turn <> 1").groupBy(F.col("key").alias(key)).agg(*signed)


def live_campaigns(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """(day, live_campaigns, live_spend) for every day with orders."""
    days = orders.select(F.to_date("ordered_at").alias("day"))
    found = open_on(days, coded_windows(campaigns), F.col("spend_usd"))
    return found.select("day", F.col("open").alias("live_campaigns"), F.col("amount").alias("live_spend"))


def window_sums(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Orders, tickets and net placed while each coded campaign was live."""
    per_day = (
        sales_measures(orders, by="day")
        .groupBy(F.col("order_date").cast("date").alias("day"))
        .agg(total("order_rows").alias("order_rows"), total("tickets").alias("tickets"), money_sum(F.col("net")).alias("net"))
    )
    found = sums_inside(coded_windows(campaigns), per_day, ["order_rows", "tickets", "net"], "campaign_id")
    return found.select(
        "campaign_id", F.col("order_rows").alias("orders_while_live"), F.col("tickets").alias("tickets_while_live"),
        F.col("net").cast("double").alias("net_while_live"),
    )
