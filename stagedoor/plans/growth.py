"""Per-event results, the four growth levers and the scalars derived from them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.functions.dates import day_text, season_label
from stagedoor.functions.numbers import (
    at_least_zero,
    money_total,
    ratio_or_zero,
    to_hundreds,
    total,
)
from stagedoor.operators import selection
from stagedoor.operators.attendance import attendance_totals
from stagedoor.operators.relational import first_row_by, side_by_side
from stagedoor.operators.sales import launch_window, sales_measures, sales_totals
from stagedoor.plans.settings import PlanSettings
from stagedoor.session import settle


_ATTENDANCE = "struct<kept: bigint, scanned: bigint, show_up: double, no_shows: bigint>"


def event_results(
    events: DataFrame, orders: DataFrame, attendance: DataFrame | None, settings: PlanSettings
) -> DataFrame:
    """One row per event: sales, a map of every tier with its cap, attendance where there are scans.

    Without an attendance table, for results that do not ask who came, all nights lack scans.
    Each tier of the settings gets its own pair of conditional sums, so one aggregate gives the
    event and its tiers, and a tier without sales shows as zero.
    """
    tiers = list(settings.tier_caps)
    sales = sales_measures(orders)

    def of_tier(tier, column):
        return F.when(F.col("tier") == tier, F.col(column))

    sold = sales.groupBy("event_id").agg(
        total("tickets").alias("sold"),
        money_total("gross").alias("gross"),
        money_total("net").alias("net"),
        total("refunded_tickets").alias("refunded_tickets"),
        *[total(of_tier(t, "tickets")).alias(f"sold_{i}") for i, t in enumerate(tiers)],
        *[money_total(of_tier(t, "net")).alias(f"net_{i}") for i, t in enumerate(tiers)],
    )
    joined = events.join(sold, "event_id", "left")
    if attendance is None:
        joined = joined.withColumn("attendance", F.lit(None).cast(_ATTENDANCE))
    else:
        came = F.struct(
            F.col("tickets_sold").alias("kept"),
            F.col("tickets_scanned").alias("scanned"),
            F.col("show_up_rate").alias("show_up"),
            "no_shows",
        )
        joined = joined.join(
            attendance.select("event_id", came.alias("attendance")), "event_id", "left"
        )
    no_count, no_money = F.lit(0).cast("bigint"), F.lit(0.0)
    entries = []
    for i, (tier, cap) in enumerate(settings.tier_caps.items()):
        cap = cap if isinstance(cap, Column) else F.lit(cap)
        entries += [
            F.lit(tier),
            F.struct(
                F.coalesce(f"sold_{i}", no_count).alias("sold"),
                cap.cast("bigint").alias("cap"),
                F.coalesce(f"net_{i}", no_money).alias("net"),
            ),
        ]
    tickets = F.coalesce("sold", no_count)
    gross, net = F.coalesce("gross", no_money), F.coalesce("net", no_money)
    return joined.select(
        F.col("event_id").alias("id"),
        F.col("event_name").alias("name"),
        "genre",
        day_text(F.col("event_date")).alias("date"),
        "capacity",
        tickets.alias("sold"),
        F.try_divide(tickets.cast("double"), F.col("capacity")).alias("sell_through"),
        gross.alias("gross"),
        net.alias("net"),
        (gross - net).alias("refunded_rev"),
        F.coalesce("refunded_tickets", no_count).alias("refunded_tickets"),
        F.create_map(*entries).alias("tiers"),
        "attendance",
    )


def tier_matrix(results: DataFrame) -> DataFrame:
    """Every event with every tier: sold, cap and net, zero where nothing was sold."""
    return results.select("id", F.explode("tiers").alias("tier", "figures")).select(
        "id", "tier", "figures.*"
    )


def events_by_net(results: DataFrame) -> DataFrame:
    return results.orderBy(F.desc("net"), "id")


def season_totals(orders: DataFrame, results: DataFrame, returns: DataFrame) -> DataFrame:
    """One row: sales, seats, attendance, marketing and the ratios between them.

    Sales are those of all orders, also of unknown events; seats and attendance come from the
    event results, marketing from the campaign returns.
    """
    attendance = results.select("attendance.*").select(
        F.col("kept").alias("tickets_sold"), F.col("scanned").alias("tickets_scanned"), "no_shows"
    )
    sums = side_by_side(
        sales_totals(orders),
        results.agg(total("capacity").alias("seats_total")),
        attendance_totals(attendance),
        returns.agg(
            money_total("spend").alias("marketing_spend"),
            money_total("net").alias("attributed_net_clean"),
        ),
    )

    def rate(top, bottom):
        return ratio_or_zero(F.col(top), F.col(bottom))

    return sums.select(
        "net",
        "gross",
        "tickets_sold",
        "tickets_kept",
        "refunded_tickets",
        "refunded_rev",
        rate("refunded_rev", "gross").alias("refund_share_of_gross"),
        "seats_total",
        rate("tickets_sold", "seats_total").alias("seat_sell_through"),
        rate("net", "tickets_kept").alias("net_per_kept_ticket"),
        rate("scanned", "attendance_kept").alias("show_up_rate"),
        "scanned",
        "marketing_spend",
        "attributed_net_clean",
        rate("attributed_net_clean", "marketing_spend").alias("rpd_blended"),
        "no_shows",
    )


def season(results: DataFrame, pacing: DataFrame) -> DataFrame:
    """One row: the label and dates of the season, and how many nights have scans."""
    scanned = F.col("attendance").isNotNull()
    span = side_by_side(
        results.agg(
            F.min_by("date", "id").alias("first_show"),
            F.max_by("date", "id").alias("last_show"),
            F.max_by("date", F.when(scanned, F.col("id"))).alias("scans_through"),
            F.count_if(scanned).alias("nights_scanned"),
        ),
        pacing.agg(F.max("date").alias("last_order_date")),
    )
    first, last = F.to_date("first_show"), F.to_date("last_show")
    return span.select(
        season_label(first, last).alias("label"),
        "first_show",
        "last_show",
        "last_order_date",
        "scans_through",
        "nights_scanned",
    )


def goal(totals: DataFrame, settings: PlanSettings) -> DataFrame:
    target = F.col("net") * (1 + settings.goal_pct)
    return totals.select(
        F.lit(settings.goal_pct).alias("pct"),
        target.alias("target_net"),
        (target - F.col("net")).alias("gap"),
    )


def _weakest_event() -> Column:
    """Aggregate over event results: the event with the lowest sell-through."""
    whole = F.struct("id", "name", "capacity", "sold", "net", "sell_through")
    return first_row_by(whole, F.col("sell_through"), F.col("id"))


def lever_soft_night(results: DataFrame, settings: PlanSettings) -> DataFrame:
    """Fill the weakest night up to the target share of its house."""
    weakest = results.agg(_weakest_event().alias("e")).select("e.*")
    wanted = (F.col("capacity") * settings.soft_night_target).cast("bigint")
    add = at_least_zero(wanted - F.col("sold"))
    per_ticket = ratio_or_zero(F.col("net"), F.col("sold"))
    return weakest.select(
        F.lit("soft_night").alias("key"),
        F.lit("Rescue the soft night").alias("label"),  # fixed value
        to_hundreds(add * per_ticket).alias("amount"),
        F.struct(
            F.col("name").alias("event"),
            "sell_through",
            F.lit(settings.soft_night_target).alias("target_sell_through"),
            add.alias("add_tickets"),
            per_ticket.alias("avg_net_per_ticket"),
            (F.col("capacity") - F.col("sold")).alias("unsold_seats"),
        ).alias("detail"),
    )


def _at_cap(tier: str) -> Column:
    figures = F.col("tiers")[tier]
    return figures["sold"] >= figures["cap"]


def lever_vip(results: DataFrame, settings: PlanSettings) -> DataFrame:
    """Raise the premium price on the nights that sold every premium seat."""
    tier = settings.premium_tier
    sums = results.agg(
        F.count_if(_at_cap(tier)).alias("sellout_nights"),
        F.count("*").alias("nights"),
        money_total(F.when(_at_cap(tier), F.col("tiers")[tier]["net"])).alias("vip_net_on_sellouts"),
    )
    lift = F.lit(settings.vip_price_lift)
    return sums.select(
        F.lit("vip").alias("key"),
        F.lit("Reprice / expand VIP").alias("label"),  # fixed value
        to_hundreds(lift * F.col("vip_net_on_sellouts")).alias("amount"),
        F.struct(
            "sellout_nights", "nights", "vip_net_on_sellouts", lift.alias("price_lift")
        ).alias("detail"),
    )


def tracked_campaigns(returns: DataFrame) -> DataFrame:
    return returns.filter(F.col("has_code") & (F.col("spend") > 0))


def median_return(returns: DataFrame) -> DataFrame:
    """One row: the median return per dollar of the tracked campaigns, exact for any number of them."""
    settled = settle(tracked_campaigns(returns).select("rpd"), "returns")
    found = F.lit(selection.median(settled, F.col("rpd"))).cast("double")
    return returns.sparkSession.range(1).select(found.alias("median_rpd"))


def _weighted_return() -> Column:
    spend = money_total("spend")
    return F.when(spend > 0, money_total("net") / spend).otherwise(F.lit(0.0))


def weakest_campaigns(returns: DataFrame, rows: int = 2) -> DataFrame:
    return tracked_campaigns(returns).orderBy("rpd", "id").limit(rows)


def lever_realloc(returns: DataFrame, settings: PlanSettings) -> DataFrame:
    """Move budget from the two weakest campaigns to those above the median."""
    median = F.lit(median_return(returns).first().median_rpd).cast("double")
    strong = tracked_campaigns(returns).filter(F.col("rpd") > median)
    ends = side_by_side(
        strong.agg(_weighted_return().alias("target_rpd")),
        weakest_campaigns(returns).agg(_weighted_return().alias("source_rpd")),
    )
    gain = F.greatest(F.lit(0.0), F.col("target_rpd") - F.col("source_rpd"))
    budget, kept = F.lit(settings.realloc_budget), F.lit(settings.realloc_incrementality)
    return ends.select(
        F.lit("realloc").alias("key"),
        F.lit("Reallocate ad spend").alias("label"),  # fixed value
        to_hundreds(budget * gain * kept).alias("amount"),
        F.struct(
            budget.alias("budget_moved"), "source_rpd", "target_rpd", kept.alias("incrementality")
        ).alias("detail"),
    )


def lever_refunds(totals: DataFrame, settings: PlanSettings) -> DataFrame:
    """Keep part of the refunded revenue as exchange credit."""
    rate = F.lit(settings.refund_convert_rate)
    return totals.select(
        F.lit("refunds").alias("key"),
        F.lit("Refunds → exchange credits").alias("label"),  # fixed value
        to_hundreds(rate * F.col("refunded_rev")).alias("amount"),
        F.struct("refunded_rev", rate.alias("convert_rate")).alias("detail"),
    )


def growth_levers(
    results: DataFrame, returns: DataFrame, totals: DataFrame, settings: PlanSettings
) -> dict[str, DataFrame]:
    """The four levers, in plan order; one row each, their details differ."""
    return {
        "soft_night": lever_soft_night(results, settings),
        "vip": lever_vip(results, settings),
        "realloc": lever_realloc(returns, settings),
        "refunds": lever_refunds(totals, settings),
    }


def lever_amounts(levers: dict[str, DataFrame]) -> DataFrame:
    """One row per lever: its key, label and amount."""
    frames = [lever.select("key", "label", "amount") for lever in levers.values()]
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    return rows


def derived_events(results: DataFrame, settings: PlanSettings) -> DataFrame:
    """One row: best and weakest event, sold-out nights per tier, tier totals, show-up extremes."""
    rate = F.col("attendance")["show_up"]
    night = F.struct(
        F.col("name").alias("name"), rate.alias("rate"), F.col("attendance.no_shows").alias("no_shows")
    )
    tiers = list(settings.tier_caps)
    tier_sums = []
    for tier in tiers:
        figures = F.col("tiers")[tier]
        tier_sums += [
            F.lit(tier),
            F.struct(
                total(figures["sold"]).alias("sold"), money_total(figures["net"]).alias("net")
            ),
        ]
    return results.agg(
        first_row_by(F.struct("name", "net"), -F.col("net"), F.col("id")).alias("best_event"),
        _weakest_event().alias("weakest"),
        F.count_if(_at_cap(settings.premium_tier)).alias("vip_sellout_nights"),
        F.count_if(_at_cap(settings.balcony_tier)).alias("balcony_sellout_nights"),
        F.create_map(*tier_sums).alias("tier_totals"),
        first_row_by(night, -rate, F.col("id")).alias("best_night"),
        first_row_by(night, rate, F.col("id")).alias("worst_night"),
    )


def derived_campaigns(returns: DataFrame) -> DataFrame:
    """One row: best, worst tracked and first code-less campaign, and the revenue leaders."""
    whole = F.struct(
        "id", "name", "channel", "has_code", "spend", "orders", "tickets", "net", "rpd", "net_dirty"
    )
    rpd, id_ = F.col("rpd"), F.col("id")
    tracked = F.col("has_code") & (F.col("spend") > 0)
    return returns.agg(
        first_row_by(whole, -rpd, id_).alias("best_campaign"),
        first_row_by(whole, rpd, id_, where=tracked).alias("worst_tracked_campaign"),
        first_row_by(whole, -rpd, id_, where=~F.col("has_code")).alias("untracked_campaign"),
        first_row_by(F.col("name"), -F.col("net_dirty"), -rpd, id_).alias("best_by_revenue_dirty"),
        first_row_by(F.col("name"), -F.col("net"), -rpd, id_).alias("best_by_revenue_clean"),
    )


def derived_scalars(
    results: DataFrame,
    returns: DataFrame,
    pacing: DataFrame,
    totals: DataFrame,
    settings: PlanSettings,
) -> DataFrame:
    """One row: everything the pages quote in prose."""
    parts = side_by_side(
        derived_events(results, settings),
        derived_campaigns(returns),
        launch_window(pacing, settings.launch_days),
        totals.select("show_up_rate", F.col("net").alias("season_net"), "no_shows"),
    )
    best, weak = F.col("best_event"), F.col("weakest")
    top, low = F.col("best_campaign"), F.col("worst_tracked_campaign")
    worst = F.col("worst_night")
    return parts.select(
        "best_event",
        F.struct(
            weak["name"].alias("name"),
            weak["net"].alias("net"),
            weak["sold"].alias("sold"),
            weak["sell_through"].alias("sell_through"),
            (weak["capacity"] - weak["sold"]).alias("unsold_seats"),
        ).alias("worst_event"),
        ratio_or_zero(best["net"], weak["net"]).alias("best_worst_ratio"),
        "vip_sellout_nights",
        "balcony_sellout_nights",
        "tier_totals",
        "best_campaign",
        "worst_tracked_campaign",
        "untracked_campaign",
        ratio_or_zero(top["rpd"], low["rpd"]).alias("rpd_spread"),
        "best_by_revenue_dirty",
        "best_by_revenue_clean",
        F.struct(
            "day_net",
            "first4_net",
            ratio_or_zero(F.col("first4_net"), F.col("season_net")).alias("first4_share"),
        ).alias("launch"),
        F.struct(
            F.col("show_up_rate").alias("avg_rate"),
            "no_shows",
            F.struct(F.col("best_night.name"), F.col("best_night.rate")).alias("best"),
            F.struct(
                worst["name"].alias("name"),
                worst["rate"].alias("rate"),
                worst["no_shows"].alias("no_shows"),
                ((F.col("show_up_rate") - worst["rate"]) * 100).alias("delta_pts"),
            ).alias("worst"),
        ).alias("attendance"),
    )
