"""Every registered query over the star schema tables of a folder.

Each takes a session and a folder and runs over the whole tables.
"""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor import schemas
from stagedoor.functions.text import normalize_code, ticket_number
from stagedoor.operators import attendance, attribution, checks, distinct, numbering, relational, sales, selection, staging, windows
from stagedoor.plans import extensions, growth, payload, report, slices
from stagedoor.session import fresh_path, settle
from stagedoor.sinks import fragments, tables
from stagedoor.sources import files
from stagedoor.sources.star_schema import END_DAY, FIRST_DAY, StarSchema, plan_settings
from stagedoor.streaming import drops

Query = Callable[[SparkSession, str], DataFrame]


class Season:
    """The staged tables and marts over one folder, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.source = StarSchema(spark, folder)
        self.settings = plan_settings()

    @cached_property
    def campaigns(self) -> DataFrame:
        return staging.stg_campaigns(self.source.raw_campaigns())

    @cached_property
    def events(self) -> DataFrame:
        return staging.stg_events(self.source.raw_events())

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(self.source.raw_orders())

    @cached_property
    def clean_orders(self) -> DataFrame:
        return staging.stg_orders(self.source.raw_orders(), normalize=True)

    @cached_property
    def scans(self) -> DataFrame:
        return staging.stg_ticket_scans(self.source.raw_scans(), self.orders)

    @cached_property
    def sales(self) -> DataFrame:
        """The written roll-up, for queries that ask more than one thing of the orders."""
        return settle(sales.sales_rollup(self.orders), "sales")

    @cached_property
    def attendance(self) -> DataFrame:
        return attendance.attendance_by_event(
            self.scans, self.orders, self.events, one_row_per_ticket=True
        )

    def attendance_from(self, rollup: DataFrame) -> DataFrame:
        return attendance.attendance_by_event(
            self.scans, rollup, self.events, one_row_per_ticket=True
        )

    @cached_property
    def capacity(self) -> Column:
        """The size of the house, a report setting; here it follows the number of orders."""
        return self.events.agg(F.max("capacity")).scalar()

    def marts(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Campaigns, revenue and attendance, all from one scan of the orders.

        The reports read revenue by three groupings, so that one is written too.
        """
        return (
            attribution.campaign_performance(self.sales, self.campaigns),
            settle(sales.revenue_by_tier(self.sales, self.events), "revenue"),
            self.attendance_from(self.sales),
        )

    def results(self) -> DataFrame:
        return growth.event_results(self.events, self.orders, None, self.settings)

    @cached_property
    def returns(self) -> DataFrame:
        return settle(attribution.campaign_returns(self.orders, self.campaigns), "returns")

    @cached_property
    def parts(self) -> payload.PayloadParts:
        return payload.PayloadParts(
            self.orders, self.events, self.campaigns, self.attendance_from, self.settings
        )

    @cached_property
    def spread_parts(self) -> payload.PayloadParts:
        """The same for exports that never gather a list."""
        return payload.PayloadParts(
            self.orders, self.events, self.campaigns, self.attendance_from, self.settings, spread=True
        )


_QUERIES: dict[str, Query] = {}


def query(build: Callable[[Season], DataFrame]) -> Callable[[Season], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Season(spark, folder))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    from stagedoor.catalog import delivered  # noqa: F401  registers its queries

    return dict(_QUERIES)


# ---- staging ---------------------------------------------------------------------------------


@query
def stg_campaigns(s: Season) -> DataFrame:
    return s.campaigns


@query
def stg_events(s: Season) -> DataFrame:
    return s.events


@query
def stg_orders(s: Season) -> DataFrame:
    return s.orders


@query
def stg_orders_normalized(s: Season) -> DataFrame:
    return s.clean_orders


@query
def stg_ticket_scans(s: Season) -> DataFrame:
    return s.scans


@query
def first_scan_per_ticket(s: Season) -> DataFrame:
    return staging.scan_stages(s.source.raw_scans(), s.orders).first_per_ticket


@query
def scan_drop_counts(s: Season) -> DataFrame:
    return staging.scan_drop_counts(s.source.raw_scans(), s.orders)


@query
def orphan_scans(s: Season) -> DataFrame:
    per_order = s.source.raw_scans().groupBy("order_id").agg(F.count("*").alias("scans"))
    return relational.with_unknown_key(per_order, s.orders, "order_id")


@query
def unknown_order_ids(s: Season) -> DataFrame:
    return relational.key_difference(s.source.raw_scans(), s.orders, "order_id")


@query
def code_forms(s: Season) -> DataFrame:
    codes = attribution.code_totals(s.orders).filter(F.col("promo_code").isNotNull())
    return codes.select(
        "promo_code", normalize_code(F.col("promo_code")).alias("clean_code"), "order_rows"
    )


@query
def ticket_numbers(s: Season) -> DataFrame:
    number = ticket_number(F.col("ticket_id")).alias("ticket_number")
    return s.source.raw_scans().groupBy(number).agg(F.count("*").alias("scans"))


# ---- marts -----------------------------------------------------------------------------------


@query
def campaign_performance(s: Season) -> DataFrame:
    return attribution.campaign_performance(s.orders, s.campaigns)


@query
def campaign_performance_normalized(s: Season) -> DataFrame:
    return attribution.campaign_performance(s.clean_orders, s.campaigns)


@query
def revenue_by_tier(s: Season) -> DataFrame:
    return sales.revenue_by_tier(s.orders, s.events)


@query
def attendance_by_event(s: Season) -> DataFrame:
    return s.attendance.orderBy("event_id")


@query
def attendance_by_event_distinct(s: Season) -> DataFrame:
    """The mart over scans that may repeat a ticket: an exact distinct count."""
    known = relational.with_known_key(s.source.raw_scans(), s.orders, "order_id")
    first = relational.keep_first(known, ["ticket_id"], ["scanned_at", "scan_id"])
    return attendance.attendance_by_event(first, s.orders, s.events)


@query
def campaign_credit(s: Season) -> DataFrame:
    return attribution.campaign_credit(s.orders, s.campaigns)


@query
def order_buckets(s: Season) -> DataFrame:
    return attribution.without_code_summary(s.orders, s.campaigns)


# ---- reporting -------------------------------------------------------------------------------


@query
def headline_numbers(s: Season) -> DataFrame:
    numbers = report.headline_numbers(*s.marts(), s.capacity)
    return numbers.select(
        "total_net",
        "tickets_sold",
        "top_tier",
        "sellouts",
        "best_by_revenue",
        "best_per_dollar",
        "overall_rate",
        F.col("worst_night.name").alias("worst_name"),
        F.col("worst_night.rate").alias("worst_rate"),
    )


@query
def box_office_report(s: Season) -> DataFrame:
    return report.box_office_report(*s.marts(), s.capacity)


@query
def executive_summary(s: Season) -> DataFrame:
    return report.executive_summary(*s.marts(), "Summer stand", s.capacity)


@query
def summary_top_campaigns(s: Season) -> DataFrame:
    performance = attribution.campaign_performance(s.orders, s.campaigns)
    return report.summary_tables(performance, s.attendance)[0]


@query
def summary_show_up(s: Season) -> DataFrame:
    performance = attribution.campaign_performance(s.orders, s.campaigns)
    return report.summary_tables(performance, s.attendance)[1]


@query
def published_summary(s: Season) -> DataFrame:
    """The one-pager as published, line by line: the sentence and both tables."""
    marts = s.marts()
    summary = report.executive_summary(*marts, "Summer stand", s.capacity)
    page = settle(report.summary_page(summary, *report.summary_tables(marts[0], marts[2])), "page")
    path = fresh_path(s.spark, "summary")
    report.write_page(page, path)
    written = s.spark.read.text(path).withColumnRenamed("value", "text")
    return page.withColumn("written", F.lit(not relational.has_changed(page.select("text"), written)))


# ---- slices ----------------------------------------------------------------------------------


@query
def daily_sales(s: Season) -> DataFrame:
    return slices.daily_sales(s.orders, FIRST_DAY, END_DAY)


@query
def daily_sales_one_day(s: Season) -> DataFrame:
    return slices.day_slice(s.orders, "1996-03-04")


@query
def monthly_sales_rebuilt(s: Season) -> DataFrame:
    """Slices as stored: an outdated first build, then all of them rebuilt over it."""
    path = fresh_path(s.spark, "monthly_sales")
    rows = settle(slices.monthly_sales(s.orders), "months")
    outdated = rows.filter(F.col("order_month") < "1996-01-01").withColumn("orders", -F.col("orders"))
    for build in (outdated, rows):
        tables.replace_slices(build, path, "order_month", build.select("order_month").distinct())
    return tables.read_slices(s.spark, path, rows.schema, "order_month")


@query
def slice_summary(s: Season) -> DataFrame:
    return slices.slice_summary(slices.daily_sales(s.orders, FIRST_DAY, END_DAY))


@query
def missing_slices(s: Season) -> DataFrame:
    days = s.orders.select(F.to_date("order_date").alias("order_date"))
    return tables.missing_slices(
        slices.calendar(s.spark, "1994-12-25", "2001-08-11"), days, "order_date"
    )


@query
def monthly_sales(s: Season) -> DataFrame:
    return slices.monthly_sales(s.orders)


# ---- document parts --------------------------------------------------------------------------


@query
def event_results(s: Season) -> DataFrame:
    return s.results().drop("tiers", "attendance")


@query
def event_attendance(s: Season) -> DataFrame:
    results = growth.event_results(s.events, s.orders, s.attendance, s.settings)
    return results.filter(F.col("attendance").isNotNull()).select("id", "attendance.*")


@query
def events_by_net(s: Season) -> DataFrame:
    return growth.events_by_net(s.results()).select("id", "name", "net")


@query
def tier_matrix(s: Season) -> DataFrame:
    return growth.tier_matrix(s.results())


@query
def tier_totals(s: Season) -> DataFrame:
    derived = growth.derived_events(s.results(), s.settings)
    return derived.select(F.explode("tier_totals").alias("tier", "figures")).select(
        "tier", "figures.*"
    )


@query
def daily_pacing(s: Season) -> DataFrame:
    return sales.daily_pacing(s.orders).orderBy("date")


@query
def launch_window(s: Season) -> DataFrame:
    return sales.launch_window(settle(sales.daily_pacing(s.orders), "pacing"))


@query
def campaign_returns(s: Season) -> DataFrame:
    return attribution.campaign_returns(s.orders, s.campaigns)


@query
def attribution_summary(s: Season) -> DataFrame:
    return attribution.attribution_summary(s.orders, s.campaigns)


@query
def lever_soft_night(s: Season) -> DataFrame:
    return growth.lever_soft_night(s.results(), s.settings).select("amount", "detail.*")


@query
def lever_vip(s: Season) -> DataFrame:
    return growth.lever_vip(s.results(), s.settings).select("amount", "detail.*")


@query
def lever_realloc(s: Season) -> DataFrame:
    return growth.lever_realloc(s.returns, s.settings).select("amount", "detail.*")


@query
def lever_refunds(s: Season) -> DataFrame:
    totals = sales.sales_totals(s.orders)
    return growth.lever_refunds(totals, s.settings).select("amount", "detail.*")


@query
def goal_and_levers(s: Season) -> DataFrame:
    return relational.side_by_side(
        s.parts.goal,
        growth.lever_amounts(s.parts.levers).agg(F.sum("amount").alias("levers_total")),
    )


@query
def median_return(s: Season) -> DataFrame:
    return growth.median_return(attribution.campaign_returns(s.orders, s.campaigns))


@query
def weakest_campaigns(s: Season) -> DataFrame:
    returns = attribution.campaign_returns(s.orders, s.campaigns)
    return growth.weakest_campaigns(returns).select("id", "spend", "net", "rpd")


@query
def derived_scalars(s: Season) -> DataFrame:
    return s.parts.derived.select(
        F.col("best_event.name").alias("best_event"),
        F.col("best_event.net").alias("best_event_net"),
        F.col("worst_event.name").alias("worst_event"),
        F.col("worst_event.net").alias("worst_event_net"),
        F.col("worst_event.sold").alias("worst_event_sold"),
        F.col("worst_event.sell_through").alias("worst_event_sell_through"),
        F.col("worst_event.unsold_seats").alias("worst_event_unsold_seats"),
        "best_worst_ratio",
        "vip_sellout_nights",
        "balcony_sellout_nights",
        F.col("best_campaign.id").alias("best_campaign"),
        F.col("worst_tracked_campaign.id").alias("worst_tracked_campaign"),
        F.col("untracked_campaign.id").alias("untracked_campaign"),
        "rpd_spread",
        "best_by_revenue_dirty",
        "best_by_revenue_clean",
        F.col("launch.day_net").alias("launch_day_net"),
        F.col("launch.first4_net").alias("launch_first4_net"),
        F.col("launch.first4_share").alias("launch_first4_share"),
        F.col("attendance.avg_rate").alias("avg_rate"),
        F.col("attendance.no_shows").alias("no_shows"),
        F.col("attendance.best.name").alias("best_night"),
        F.col("attendance.worst.name").alias("worst_night"),
        F.col("attendance.worst.no_shows").alias("worst_night_no_shows"),
        F.col("attendance.worst.delta_pts").alias("delta_pts"),
    )


@query
def season(s: Season) -> DataFrame:
    return s.parts.season


@query
def season_totals(s: Season) -> DataFrame:
    return s.parts.totals


@query
def payload_document(s: Season) -> DataFrame:
    """The document as JSON text, read back: figures from each of its sections."""
    row = payload.payload_row(s.parts)
    text = payload.payload_json(row)
    read = text.select(F.from_json("document", row.schema).alias("d")).select("d.*")

    def added(array, field):
        steps = F.transform(array, lambda item: F.rint(item[field] * 10000))
        return F.aggregate(steps, F.lit(0.0), lambda a, b: a + b) / 10000

    return read.select(
        "totals.net",
        "totals.gross",
        "totals.tickets_sold",
        "totals.scanned",
        "season.label",
        "season.nights_scanned",
        "goal.gap",
        "attribution.unattributed_dirty_orders",
        "attribution.organic_tickets",
        F.col("derived.worst_event.name").alias("worst_event"),
        F.size("events").cast("bigint").alias("events"),
        F.size("daily").cast("bigint").alias("days"),
        F.size("campaigns").cast("bigint").alias("campaigns"),
        added("events", "net").alias("events_net"),
        added("daily", "net").alias("days_net"),
        added("campaigns", "net").alias("campaigns_net"),
        F.aggregate(
            "events",
            F.lit(0).cast("bigint"),
            lambda a, e: a + e["tiers"][s.settings.premium_tier]["sold"],
        ).alias("premium_sold"),
        F.col("campaigns")[0]["id"].alias("first_campaign"),
        F.col("daily")[0]["date"].alias("first_day"),
        "levers_total",
    )


@query
def attribution_movement(s: Season) -> DataFrame:
    returns = attribution.campaign_returns(s.sales, s.campaigns)
    summary = attribution.attribution_summary(s.sales, s.campaigns)
    return attribution.attribution_movement(returns, summary)


@query
def page_scalars(s: Season) -> DataFrame:
    return payload.page_scalars(s.parts)


# ---- checks ----------------------------------------------------------------------------------


@query
def check_order_amounts(s: Season) -> DataFrame:
    return checks.order_amounts_valid(s.orders)


@query
def check_raw_order_amounts(s: Season) -> DataFrame:
    """The same check on orders that staging has not filtered, where it fails."""
    gross = F.col("qty") * F.col("unit_price_usd")
    refunded = F.col("status") == "refunded"
    net = F.when(refunded, F.lit(0.0)).otherwise(gross)
    return checks.order_amounts_valid(s.source.raw_orders().withColumn("net_revenue", net))


@query
def check_known_events(s: Season) -> DataFrame:
    return checks.orders_reference_known_events(s.orders, s.events)


@query
def check_promo_attributed(s: Season) -> DataFrame:
    return checks.all_promo_orders_attributed(s.orders, s.campaigns)


@query
def check_show_up_rate(s: Season) -> DataFrame:
    return checks.show_up_rate_in_bounds(s.attendance)


@query
def check_ticket_integrity(s: Season) -> DataFrame:
    return checks.ticket_integrity(s.source.raw_scans(), s.orders)


@query
def check_codes_canonical(s: Season) -> DataFrame:
    return checks.promo_codes_canonical(s.orders)


@query
def check_total_reconciles(s: Season) -> DataFrame:
    return sales.total_row_reconciles(sales.revenue_by_tier(s.orders, s.events))


@query
def check_plan_covers_gap(s: Season) -> DataFrame:
    return checks.plan_covers_gap(growth.lever_amounts(s.parts.levers), s.parts.goal)


# ---- campaign windows ------------------------------------------------------------------------


@query
def campaign_window_reach(s: Season) -> DataFrame:
    return attribution.campaign_window_reach(s.orders, s.campaigns)


@query
def order_live_campaigns(s: Season) -> DataFrame:
    return attribution.order_live_campaigns(s.orders, s.campaigns)


@query
def window_sums(s: Season) -> DataFrame:
    """Reach of campaign windows by running sums: two rows a campaign, however long its window."""
    return windows.window_sums(s.orders, s.campaigns)


@query
def live_campaigns_by_day(s: Season) -> DataFrame:
    """Campaigns live on each day with orders, by a difference array over the calendar."""
    return windows.live_campaigns(s.orders, s.campaigns)


# ---- orders of any size ------------------------------------------------------------------------


@query
def median_order_value(s: Season) -> DataFrame:
    """Exact median and ninth decile of the gross value of all orders, by narrowing a histogram."""
    values = settle(s.orders.select("gross_revenue"), "values")
    shares = {"median_value": 0.5, "ninth_decile": 0.9}
    found = {n: F.lit(selection.quantile(values, F.col("gross_revenue"), q)).cast("double") for n, q in shares.items()}
    return s.spark.range(1).select(*(F.round(v, 4).alias(n) for n, v in found.items()))


@query
def pacing_to_date(s: Season) -> DataFrame:
    """Each order day with its place, and tickets and net up to it."""
    pacing = settle(sales.daily_pacing(s.orders).withColumn("net", F.col("net").cast("decimal(38,4)")), "pacing")
    day = [F.col("date")]
    placed = numbering.numbered(pacing, day)
    ran = numbering.running_totals(placed, day, {"tickets_to_date": F.col("tickets"), "net_to_date": F.col("net")})
    return ran.select("date", "place", "tickets_to_date", F.col("net_to_date").cast("double").alias("net_to_date"))


@query
def leaderboard_places(s: Season) -> DataFrame:
    """The leaderboard with the place of every row."""
    board = settle(attribution.campaign_performance(s.orders, s.campaigns), "leaderboard")
    placed = numbering.numbered(board, [F.desc("attributed_revenue"), F.col("campaign_id")])
    return placed.select("campaign_id", "attributed_revenue", "place")


@query
def event_places(s: Season) -> DataFrame:
    """Events by net, with their place among all and within their genre."""
    named = s.events.select(F.col("event_id").alias("id"), "genre")
    events = settle(s.parts.events.select("id", "net").join(named, "id"), "events-by-net")
    by_net = [F.desc("net"), F.col("id")]
    return numbering.numbered(numbering.numbered(events, by_net), by_net, ["genre"], "place_in_genre")


@query
def order_places_in_event(s: Season) -> DataFrame:
    """Every order's place in time within its event, whichever event has most of the orders."""
    orders = s.orders.select("order_id", "event_id", "ordered_at")
    order = [F.col("ordered_at"), F.col("order_id")]
    return numbering.numbered(orders, order, ["event_id"]).select("order_id", "event_id", "place")


@query
def customers_by_year(s: Season) -> DataFrame:
    """Distinct customers per month, per year and in all, years and total from the months' bitmaps."""
    placed = s.source.table("orders").select(F.trunc(F.to_date("o_orderdate"), "month").alias("month"), "o_custkey")
    months = settle(distinct.distinct_slices(placed, ["month"], F.col("o_custkey")), "customer-bitmaps")
    by_year = months.withColumn("year", F.year("month"))
    label = F.date_format("month", "yyyy-MM").alias("period")
    return (
        distinct.distinct_counts(months, ["month"], "customers").select(label, "customers")
        .union(distinct.distinct_counts(by_year, ["year"], "customers").select(F.col("year").cast("string"), "customers"))
        .union(distinct.distinct_counts(months, [], "customers").select(F.lit("all"), "customers"))
    )


@query
def tickets_by_gate(s: Season) -> DataFrame:
    """Distinct tickets scanned per event and gate, per gate and in all, the latter two from bitmaps of numbered tickets."""
    scans = settle(distinct.with_dense_ids(s.source.raw_scans().select("ticket_id", "event_id", "gate"), "ticket_id"), "numbered-tickets")
    fine = settle(distinct.distinct_slices(scans, ["event_id", "gate"], F.col("dense_id")), "ticket-bitmaps")
    none = F.lit(None).cast("string")
    return (
        distinct.distinct_counts(fine, ["event_id", "gate"], "tickets").select("event_id", "gate", "tickets")
        .union(distinct.distinct_counts(fine, ["gate"], "tickets").select(none, "gate", "tickets"))
        .union(distinct.distinct_counts(fine, [], "tickets").select(none, none, "tickets"))
    )


# ---- sources and sinks -----------------------------------------------------------------------


@query
def adhoc_sql(s: Season) -> DataFrame:
    sales.daily_pacing(s.orders).createOrReplaceTempView("daily_pacing")
    result = files.adhoc_sql(
        s.spark,
        """
        SELECT date AS order_date, SUM(net) AS net
        FROM daily_pacing WHERE date >= '1995-07-08' GROUP BY 1 ORDER BY 1;
        """,
    )
    s.spark.catalog.dropTempView("daily_pacing")
    return result


@query
def rows_per_file(s: Season) -> DataFrame:
    return files.rows_per_file(s.source.table("events"))


@query
def preview(s: Season) -> DataFrame:
    first = files.preview(s.source.raw_orders(), "ordered_at", "order_id")
    return first.select("order_id", "event_id", "tier", "qty")


@query
def csv_round_trip(s: Season) -> DataFrame:
    """Raw orders delivered as CSV and read back verbatim."""
    path = fresh_path(s.spark, "orders-csv")
    tables.write_csv(s.source.raw_orders(), path)
    return files.csv_table(s.spark, path, schemas.RAW_ORDERS).withColumn(
        "ordered_at", F.to_timestamp("ordered_at")
    )


@query
def changed_rows(s: Season) -> DataFrame:
    """What cleaning the promo codes changes in the staged orders."""
    columns = ["order_id", "promo_code"]
    return relational.changed_rows(s.orders.select(*columns), s.clean_orders.select(*columns))


@query
def payload_headline(s: Season) -> DataFrame:
    """The headline of an exported document, which all tasks write and none reads whole."""
    out = fresh_path(s.spark, "document")
    fragments.export_fragments(s.spread_parts, out)
    return fragments.headline(s.spark, out)


@query
def stream_file_drops(s: Season) -> DataFrame:
    """The scan table as a dropped file: a stream notices it and refreshes attendance."""
    state, out = fresh_path(s.spark, "drops"), fresh_path(s.spark, "attendance")
    drops.start_from_nothing(s.spark, state)

    def refresh(_names: DataFrame) -> None:
        s.attendance.write.mode("overwrite").parquet(out)

    drops.process_drops(s.spark, s.source.folder, state, refresh, pattern="events.parquet")
    return s.spark.read.parquet(out)


# ---- neighbouring businesses -----------------------------------------------------------------


@query
def fallback_attribution(s: Season) -> DataFrame:
    """A second key, known for a third of the orders, names the campaign directly."""
    campaign = F.concat(F.lit("CMP-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    second = F.when(F.col("o_orderkey") % 3 == 0, campaign).alias("utm_campaign")
    orders = staging.stg_orders(s.source.raw_orders(second))
    return attribution.fallback_attribution(orders, s.campaigns, "utm_campaign")


def _orders_with_venue(s: Season) -> DataFrame:
    region = s.source.table("region").withColumnRenamed("r_name", "venue_id")
    orders = staging.stg_orders(s.source.raw_orders(F.col("n_regionkey")))
    return orders.join(region, F.col("n_regionkey") == F.col("r_regionkey"))


@query
def settlement_by_venue(s: Season) -> DataFrame:
    return extensions.settlement_by_venue(_orders_with_venue(s))


@query
def settlement_slices(s: Season) -> DataFrame:
    """Sales stored as one slice per venue."""
    path = fresh_path(s.spark, "venues")
    venues = s.source.table("region").select(F.col("r_name").alias("venue_id"))
    measured = sales.sales_measures(_orders_with_venue(s), "venue_id")
    rows = slices.sales_by(measured, F.col("venue_id"), "venue_id")
    tables.replace_slices(rows, path, "venue_id", venues)
    return tables.read_slices(s.spark, path, rows.schema, "venue_id")


def _programs(s: Season) -> tuple[DataFrame, DataFrame, DataFrame]:
    offers = s.source.placed_orders().select(
        F.col("n_name").alias("program_id"),
        F.col("o_orderkey").alias("offer_id"),
        F.col("o_orderstatus").alias("answer"),
    )
    programs = s.source.table("nation").select(F.col("n_name").alias("program_id"))
    return programs, offers, offers.filter(F.col("answer") == "F")


@query
def yield_by_program(s: Season) -> DataFrame:
    return extensions.yield_by_program(*_programs(s))


@query
def check_yield_rate(s: Season) -> DataFrame:
    names = ("offers_made", "enrolled", "yield_rate")
    table = extensions.yield_by_program(*_programs(s))
    return checks.rate_in_bounds(table, names, 0.0, 1.0, "yield_rate_in_bounds")


@query
def mrr_by_month(s: Season) -> DataFrame:
    payments = s.source.table("orders")
    return extensions.mrr_by_month(
        payments, F.col("o_orderdate"), F.col("o_totalprice"), F.col("o_custkey")
    )


@query
def churn_by_month(s: Season) -> DataFrame:
    payments = s.source.table("orders")
    return extensions.churn_by_month(payments, F.col("o_orderdate"), F.col("o_custkey"))


@query
def ticket_fanout(s: Season) -> DataFrame:
    return extensions.ticket_fanout(s.orders)


@query
def pass_utilization(s: Season) -> DataFrame:
    return extensions.pass_utilization(s.orders, s.source.raw_scans())


@query
def campaign_quality(s: Season) -> DataFrame:
    return extensions.campaign_quality(s.source.raw_scans(), s.orders, s.campaigns)


@query
def revenue_by_sku(s: Season) -> DataFrame:
    return extensions.revenue_by_sku(s.source.merch_sales())


@query
def merch_per_attendee(s: Season) -> DataFrame:
    return extensions.merch_per_attendee(s.source.merch_sales(), s.attendance)


@query
def table_row_counts(s: Season) -> DataFrame:
    """Row counts taken while the tables are written, without a second pass."""
    house = fresh_path(s.spark, "warehouse")
    performance, revenue, attended = s.marts()
    written = {
        "stg_campaigns": s.campaigns,
        "stg_events": s.events,
        "stg_orders": s.orders,
        "stg_ticket_scans": s.scans,
        "campaign_performance": performance,
        "revenue_by_tier": revenue,
        "attendance_by_event": attended,
    }
    counts = [(name, tables.write_observed(df, house, name)[1]["row_count"]) for name, df in written.items()]
    return s.spark.createDataFrame(counts, "table_name string, row_count bigint")
