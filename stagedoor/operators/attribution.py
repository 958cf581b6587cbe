"""Which campaign sold what.

Orders are summed per promo code first. Matching, cleaning and labelling then work on one row per
code as typed, so the orders are neither joined nor broadcast to, and a code that holds a large
share of all orders is combined before the shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.functions.numbers import money_total, ratio_or_null, total
from stagedoor.functions.text import normalize_code, quoted
from stagedoor.operators.relational import side_by_side
from stagedoor.operators.sales import sales_measures
from stagedoor.session import settle

UNATTRIBUTED, ORGANIC = "(unattributed)", "(organic)"
CAMPAIGN_PREFIX = "CMP-"


def code_totals(orders: DataFrame, *keep: str) -> DataFrame:
    """Sales per promo code as typed; the NULL code collects the organic orders."""
    return (
        sales_measures(orders, *keep, by="code")
        .groupBy("promo_code", *keep)
        .agg(*[total(c).alias(c) for c in ("orders", "order_rows", "tickets")],
             money_total("net").alias("net"))
    )


def known_codes(campaigns: DataFrame, clean: bool = False) -> DataFrame:
    code = F.col("promo_code")
    return (
        campaigns.filter(code.isNotNull())
        .select((normalize_code(code) if clean else code).alias("known_code"))
        .distinct()
    )


def order_bucket(promo_code: Column, known: Column) -> Column:
    """matched, unattributed or organic."""
    return (
        F.when(promo_code.isNull(), F.lit("organic"))
        .when(known, F.lit("matched"))
        .otherwise(F.lit("unattributed"))
    )


def code_buckets(orders: DataFrame, campaigns: DataFrame, clean: bool = False) -> DataFrame:
    """Sales per code with its bucket, by the codes as recorded or as cleaned."""
    codes = code_totals(orders)
    code = normalize_code(F.col("promo_code")) if clean else F.col("promo_code")
    known = known_codes(campaigns, clean)
    return codes.join(known, code == F.col("known_code"), "left").select(
        *codes.columns,
        order_bucket(F.col("promo_code"), F.col("known_code").isNotNull()).alias("bucket"),
    )


def campaign_performance(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Sales and returns per campaign, codes as they stand, plus the unattributed and organic rows.

    One full outer join of codes and campaigns: a matched pair credits the campaign (two campaigns
    with one code are both credited), a lone campaign sold nothing, a lone code is unattributed,
    the NULL code is organic.
    """
    columns = ["campaign_id", "name", "channel", "spend_usd"]
    roster = campaigns.groupBy(*columns, "promo_code").agg(F.count("*").alias("copies"))
    codes = code_totals(orders).withColumnRenamed("promo_code", "sold_code")
    paired = roster.join(codes, roster.promo_code == codes.sold_code, "full_outer")
    is_campaign = F.col("copies").isNotNull()
    label = (
        F.when(is_campaign, F.col("campaign_id"))
        .when(F.col("sold_code").isNull(), F.lit(ORGANIC))
        .otherwise(F.lit(UNATTRIBUTED))
    )
    rows = paired.select(
        label.alias("campaign_id"),
        F.when(is_campaign, F.col("name")).otherwise(label).alias("name"),
        F.when(is_campaign, F.col("channel")).otherwise(F.lit("-")).alias("channel"),
        F.when(is_campaign, F.col("spend_usd")).otherwise(F.lit(0.0)).alias("spend_usd"),
        F.when(is_campaign, F.col("promo_code")).alias("promo_code"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.when(is_campaign, F.col("orders")).otherwise(F.col("order_rows")).alias("orders"),
        "tickets",
        "net",
    )
    always = campaigns.sparkSession.range(2).select(
        F.when(F.col("id") == 0, F.lit(UNATTRIBUTED)).otherwise(F.lit(ORGANIC)).alias("campaign_id")
    )
    always = always.select(
        "campaign_id",
        F.col("campaign_id").alias("name"),
        F.lit("-").alias("channel"),
        F.lit(0.0).alias("spend_usd"),
        F.lit(None).cast("string").alias("promo_code"),
        F.lit(1).cast("bigint").alias("copies"),
        F.lit(0).cast("bigint").alias("orders"),
        F.lit(0).cast("bigint").alias("tickets"),
        F.lit(0.0).alias("net"),
    )
    summed = (
        rows.unionByName(always)
        .groupBy(*columns, "promo_code", "copies")
        .agg(
            total("orders").alias("attributed_orders"),
            total("tickets").alias("tickets_sold"),
            money_total("net").alias("attributed_revenue"),
        )
    )
    sold, revenue, spend = F.col("tickets_sold"), F.col("attributed_revenue"), F.col("spend_usd")
    return (
        summed.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(
            *columns,
            "attributed_orders",
            "tickets_sold",
            "attributed_revenue",
            ratio_or_null(spend, sold).alias("cost_per_ticket"),
            ratio_or_null(revenue, spend).alias("revenue_per_dollar"),
        )
        .orderBy(F.desc("attributed_revenue"), "campaign_id")
    )


def real_campaigns(performance: DataFrame) -> DataFrame:
    return performance.filter(F.col("campaign_id").startswith(CAMPAIGN_PREFIX))


def top_campaigns(performance: DataFrame, rows: int = 5) -> DataFrame:
    """The head of the leaderboard; the unattributed and organic rows may be in it."""
    return performance.orderBy(F.desc("attributed_revenue"), "campaign_id").limit(rows)


def campaign_returns(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Per campaign: sales by cleaned codes, return per dollar, and net by the codes as recorded.

    Each code contributes under its recorded and its cleaned form, so one aggregate serves both
    views. Campaign codes are matched as they stand.
    """
    code, zero = F.col("promo_code"), F.lit(0).cast("bigint")

    def form(code, orders, tickets, net, recorded):
        return F.struct(
            code.alias("code"),
            orders.alias("clean_orders"),
            tickets.alias("clean_tickets"),
            net.alias("clean_net"),
            recorded.alias("recorded_net"),
        )

    sold = F.col("orders"), F.col("tickets"), F.col("net")
    forms = F.array(
        form(code, zero, zero, F.lit(0.0), F.col("net")),
        form(normalize_code(code), *sold, F.lit(0.0)),
    )
    per_code = (
        code_totals(orders)
        .filter(code.isNotNull())
        .select(F.inline(forms))
        .groupBy("code")
        .agg(
            total("clean_orders").alias("orders"),
            total("clean_tickets").alias("tickets"),
            money_total("clean_net").alias("net"),
            money_total("recorded_net").alias("net_dirty"),
        )
    )
    spend, net = F.col("spend_usd"), F.coalesce("net", F.lit(0.0))
    return (
        campaigns.join(per_code, campaigns.promo_code == per_code.code, "left")
        .select(
            F.col("campaign_id").alias("id"),
            "name",
            "channel",
            code.isNotNull().alias("has_code"),
            spend.alias("spend"),
            F.coalesce("orders", zero).alias("orders"),
            F.coalesce("tickets", zero).alias("tickets"),
            net.alias("net"),
            F.coalesce(ratio_or_null(net, spend), F.lit(0.0)).alias("rpd"),
            F.coalesce("net_dirty", F.lit(0.0)).alias("net_dirty"),
        )
        .orderBy(F.desc("rpd"), "id")
    )


def attribution_summary(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row: unattributed by recorded codes, still unattributed once both sides are cleaned, organic."""
    code = F.col("promo_code")
    recorded = known_codes(campaigns).withColumnRenamed("known_code", "recorded_code")
    cleaned = known_codes(campaigns, clean=True).withColumnRenamed("known_code", "cleaned_code")
    codes = (
        code_totals(orders)
        .join(recorded, code == F.col("recorded_code"), "left")
        .join(cleaned, normalize_code(code) == F.col("cleaned_code"), "left")
    )
    organic = code.isNull()
    dirty = ~organic & F.col("recorded_code").isNull()
    lost = ~organic & F.col("cleaned_code").isNull()

    def net_where(condition):
        return money_total(F.when(condition, F.col("net")))

    return codes.agg(
        net_where(dirty).alias("unattributed_dirty_net"),
        total(F.when(dirty, F.col("order_rows"))).alias("unattributed_dirty_orders"),
        net_where(lost).alias("still_unattributed_net"),
        net_where(organic).alias("organic_net"),
        total(F.when(organic, F.col("order_rows"))).alias("organic_orders"),
        total(F.when(organic, F.col("tickets"))).alias("organic_tickets"),
    )


def unknown_codes(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Codes as typed that match no campaign, with their orders, net and when they first appeared."""
    per_code = (
        orders.filter(F.col("promo_code").isNotNull())
        .groupBy("promo_code")
        .agg(
            F.count("*").alias("order_rows"),
            money_total("net_revenue").alias("net"),
            F.min("ordered_at").alias("first_seen"),
        )
    )
    known = known_codes(campaigns).withColumnRenamed("known_code", "promo_code")
    return per_code.join(known, "promo_code", "left_anti")


def code_samples(unknown: DataFrame, rows: int = 10) -> DataFrame:
    """One row: the first codes seen, each in quotes so that stray spaces show.

    Codes first seen at the same moment come in text order.
    """
    first = unknown.orderBy("first_seen", "promo_code").limit(rows)
    listed = F.array_sort(F.collect_list(F.struct("first_seen", "promo_code")))
    return first.agg(
        F.array_join(F.transform(listed, lambda c: quoted(c["promo_code"])), ", ").alias(
            "sample_bad_codes"
        )
    )


def dirty_code_count(orders: DataFrame) -> DataFrame:
    """One row: orders whose code is not in canonical form."""
    code = F.col("promo_code")
    return code_totals(orders).agg(
        total(F.when(code != normalize_code(code), F.col("order_rows"))).alias("dirty_code_orders")
    )


def attribution_movement(
    returns: DataFrame, summary: DataFrame, smallest_move: float = 300.0, rows: int = 4
) -> DataFrame:
    """The campaigns that cleaning moves most, by net, then the unattributed row.

    With nothing unattributed to begin with there is nothing to show: a single message row.
    """
    move = F.abs(F.col("net") - F.col("net_dirty"))
    dirty_net = F.col("unattributed_dirty_net")
    moved = (
        returns.filter(move >= smallest_move)
        .orderBy(move.desc(), F.desc("rpd"), "id")
        .limit(rows)
        .select(
            F.lit(0).alias("part"),
            F.col("name").alias("label"),
            F.col("net_dirty").alias("before"),
            F.col("net").alias("after"),
            move.alias("_move"),
            F.col("rpd").alias("_rpd"),
            F.col("id").alias("_id"),
        )
    )
    lost = summary.select(
        F.lit(1).alias("part"),
        F.when(dirty_net < 1, F.lit("codes are already clean")).otherwise(F.lit(UNATTRIBUTED)).alias("label"),
        F.when(dirty_net >= 1, dirty_net).alias("before"),
        F.when(dirty_net >= 1, F.col("still_unattributed_net")).alias("after"),
        F.lit(None).cast("double").alias("_move"),
        F.lit(None).cast("double").alias("_rpd"),
        F.lit(None).cast("string").alias("_id"),
    )
    is_clean = summary.select((dirty_net < 1).alias("clean")).scalar()
    return (
        moved.filter(~is_clean)
        .unionByName(lost)
        .orderBy("part", F.desc("after"), F.desc("_move"), F.desc("_rpd"), "_id")
        .select("part", "label", "before", "after")
    )


def live_days(campaigns: DataFrame) -> DataFrame:
    """One row per campaign and day of its window, both ends included."""
    first, last = F.to_date("starts_on"), F.to_date("ends_on")
    return (
        campaigns.filter((first <= last) & F.col("promo_code").isNotNull())
        .select("campaign_id", "promo_code", "spend_usd", F.explode(F.sequence(first, last)).alias("day"))
    )


def order_live_campaigns(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Per order: how many coded campaigns were live on its day and what they cost together."""
    per_day = (
        live_days(campaigns)
        .groupBy("day")
        .agg(F.count("*").alias("live_campaigns"), money_total("spend_usd").alias("live_spend"))
    )
    return (
        orders.select("order_id", F.to_date("ordered_at").alias("day"))
        .join(per_day, "day", "left")
        .select(
            "order_id",
            F.coalesce("live_campaigns", F.lit(0)).cast("bigint").alias("live_campaigns"),
            F.coalesce("live_spend", F.lit(0.0)).alias("live_spend"),
        )
    )


def campaign_window_reach(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Orders, tickets and net placed while each coded campaign was live.

    Orders are summed per day before they meet the windows, so no order-campaign pair exists.
    """
    per_day = (
        sales_measures(orders, by="day")
        .groupBy(F.col("order_date").cast("date").alias("day"))
        .agg(
            total("order_rows").alias("order_rows"),
            total("tickets").alias("tickets"),
            money_total("net").alias("net"),
        )
    )
    return (
        live_days(campaigns)
        .join(per_day, "day", "left")
        .groupBy("campaign_id")
        .agg(
            total("order_rows").alias("orders_while_live"),
            total("tickets").alias("tickets_while_live"),
            money_total("net").alias("net_while_live"),
        )
    )


def campaign_credit(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The attribution join by itself: sales of recorded codes per matching campaign."""
    codes = code_totals(orders)
    return codes.join(
        campaigns.filter(F.col("promo_code").isNotNull()).select("campaign_id", "promo_code"),
        "promo_code",
    ).select("campaign_id", "orders", "tickets", "net")


def fallback_attribution(orders: DataFrame, campaigns: DataFrame, second_key: str) -> DataFrame:
    """Credit by promo code, else by a second key that names the campaign; the rest unattributed.

    Works on sums per code and second key.
    """
    sums = code_totals(orders, second_key)
    by_code = campaigns.filter(F.col("promo_code").isNotNull()).select(
        F.col("campaign_id").alias("code_campaign"), "promo_code"
    )
    by_key = campaigns.select(F.col("campaign_id").alias("key_campaign")).distinct()
    credited = sums.join(by_code, "promo_code", "left").join(
        by_key, F.col(second_key) == F.col("key_campaign"), "left"
    )
    matched_by = (
        F.when(F.col("code_campaign").isNotNull(), F.lit("code"))
        .when(F.col("key_campaign").isNotNull(), F.lit(second_key))
        .otherwise(F.lit("none"))
    )
    return credited.groupBy(
        F.coalesce("code_campaign", "key_campaign", F.lit(UNATTRIBUTED)).alias("campaign_id"),
        matched_by.alias("matched_by"),
    ).agg(
        total("order_rows").alias("orders"),
        total("tickets").alias("tickets_sold"),
        money_total("net").alias("net"),
    )


def without_code_summary(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Order rows, tickets and net per bucket, by recorded codes."""
    return (
        code_buckets(orders, campaigns)
        .groupBy("bucket")
        .agg(
            total("order_rows").alias("order_rows"),
            total("tickets").alias("tickets"),
            money_total("net").alias("net"),
        )
    )


def attribution_check_counts(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row: unattributed orders, their net and sample codes."""
    unknown = settle(unknown_codes(orders, campaigns), "unknown-codes")
    return side_by_side(
        unknown.agg(
            total("order_rows").alias("unattributed_orders"),
            money_total("net").alias("unattributed_revenue"),
        ),
        code_samples(unknown),
    )
