"""Full and partial refresh: files in, tables and document out.

Every table is written once and read back by what follows. The marts and the document share one
written sales roll-up, so the staged orders are scanned once for all of them.
"""

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor import schemas
from stagedoor.operators import checks as quality
from stagedoor.operators.attendance import attendance_by_event, attendance_totals
from stagedoor.operators.attribution import campaign_performance, real_campaigns
from stagedoor.operators.sales import revenue_by_tier, sales_rollup
from stagedoor.operators.staging import observed_scans, stg_campaigns, stg_events, stg_orders
from stagedoor.plans.growth import lever_amounts
from stagedoor.plans.payload import PayloadParts
from stagedoor.plans.report import box_office_report, executive_summary, summary_tables
from stagedoor.plans.settings import VENUE_CAPACITY, PlanSettings
from stagedoor.sinks.documents import export_document
from stagedoor.sinks.tables import write_observed, write_table
from stagedoor.sources.files import (
    csv_directory,
    csv_plus_increments,
    csv_table,
    ingest_manifest,
    table_input,
)

ROLLUP = "sales_rollup"


@dataclass(frozen=True)
class Sources:
    raw_dir: str
    scans_dir: str
    nights_dir: str


@dataclass(frozen=True)
class Targets:
    warehouse: str
    report_dir: str | None = None
    capacity: int = VENUE_CAPACITY
    settings: PlanSettings = field(default_factory=PlanSettings)
    normalize_codes: bool = False
    title: str = "Season to date"


@dataclass
class Refresh:
    """What a run wrote: metrics per table and the outcome of its checks."""

    metrics: dict[str, dict[str, float | str]] = field(default_factory=dict)
    checks: list[quality.CheckResult] = field(default_factory=list)

    def write(self, df: DataFrame, warehouse: str, name: str, **metrics: Column) -> DataFrame:
        table, seen = write_observed(df, warehouse, name, **metrics)
        self.note(name, **seen)
        return table

    def pass_gate(self, *checks: DataFrame) -> None:
        """Keep the outcome of all checks; raise if a blocking one failed."""
        results = [quality.evaluate(check) for check in checks]
        self.checks += results
        quality.raise_if_blocked(results)

    def note(self, table: str, **values) -> None:
        self.metrics.setdefault(table, {}).update(values)


def refresh_all(spark: SparkSession, sources: Sources, targets: Targets) -> Refresh:
    """Rebuild everything. A failed blocking check stops the run after the table it looked at.

    Metrics and outcomes of checks are stored, also those of a run that stops.
    """
    run = Refresh()
    try:
        _everything(spark, run, sources, targets)
    finally:
        _store(spark, run, targets.warehouse)
    return run


def _everything(spark: SparkSession, run: Refresh, sources: Sources, targets: Targets) -> None:
    house = targets.warehouse
    raw = f"{sources.raw_dir}/"
    raw_campaigns = run.write(
        csv_table(spark, raw + "campaigns.csv", schemas.RAW_CAMPAIGNS), house, "raw_campaigns"
    )
    raw_events = run.write(
        csv_plus_increments(
            spark, raw + "events.csv", sources.nights_dir, "events.csv", schemas.RAW_EVENTS
        ),
        house,
        "raw_events",
    )
    raw_orders = run.write(
        csv_plus_increments(
            spark, raw + "orders.csv", sources.nights_dir, "orders.csv", schemas.RAW_ORDERS
        ),
        house,
        "raw_orders",
    )
    campaigns = run.write(stg_campaigns(raw_campaigns), house, "stg_campaigns")
    events = run.write(stg_events(raw_events), house, "stg_events")
    orders = run.write(
        stg_orders(raw_orders, targets.normalize_codes),
        house,
        "stg_orders",
        refunded_orders=F.count_if(F.col("status").eqNullSafe("refunded")),
    )
    run.pass_gate(
        quality.order_amounts_valid(orders), quality.orders_reference_known_events(orders, events)
    )
    sales = write_table(sales_rollup(orders), house, ROLLUP)
    performance = run.write(campaign_performance(sales, campaigns), house, "campaign_performance")
    leader = real_campaigns(performance).orderBy(F.desc("attributed_revenue"), "campaign_id").first()
    run.note("campaign_performance", top_campaign=leader.name if leader else "")
    revenue = run.write(revenue_by_tier(sales, events), house, "revenue_by_tier")
    whole = revenue.filter(F.col("event_name") == "TOTAL").first()
    run.note("revenue_by_tier", total_net_revenue=whole.net_revenue)
    run.pass_gate(quality.all_promo_orders_attributed(orders, campaigns))
    _admissions(spark, run, sources, targets)


def refresh_admissions(spark: SparkSession, sources: Sources, targets: Targets) -> Refresh:
    """Scans and everything downstream of them; orders and marts come from an earlier full run."""
    run = Refresh()
    try:
        _admissions(spark, run, sources, targets)
    finally:
        _store(spark, run, targets.warehouse)
    return run


def _admissions(spark: SparkSession, run: Refresh, sources: Sources, targets: Targets) -> None:
    house = targets.warehouse

    def stored(name):
        return table_input(spark, house, name)

    orders, events, sales = stored("stg_orders"), stored("stg_events"), stored(ROLLUP)
    manifest = run.write(ingest_manifest(spark, sources.scans_dir), house, "ingest_manifest")
    latest = manifest.agg(F.max("file_name").alias("name")).first().name
    run.note("raw_ticket_scans", files_ingested=run.metrics["ingest_manifest"]["row_count"], latest_file=latest or "")
    raw_scans = run.write(
        csv_directory(spark, sources.scans_dir, schemas.RAW_SCANS), house, "raw_ticket_scans"
    )
    staged, marks = observed_scans(raw_scans, orders)
    scans = write_table(staged, house, "stg_ticket_scans")
    read, first, kept = (
        marks[name].get["rows"] for name in ("scans_read", "scans_first", "scans_kept")
    )
    run.note(
        "stg_ticket_scans",
        row_count=kept,
        duplicate_scans_dropped=read - first,
        orphan_scans_dropped=first - kept,
    )
    attendance = run.write(
        attendance_by_event(scans, sales, events, one_row_per_ticket=True).orderBy("event_id"),
        house,
        "attendance_by_event",
    )
    overall = attendance_totals(attendance).first().overall_rate
    run.note("attendance_by_event", overall_show_up_rate=overall)
    run.pass_gate(quality.show_up_rate_in_bounds(attendance))
    marts = stored("campaign_performance"), stored("revenue_by_tier"), attendance
    run.write(box_office_report(*marts, targets.capacity), house, "box_office_report")
    summary = executive_summary(*marts, targets.title, targets.capacity)
    run.write(summary, house, "executive_summary")
    leaders, shown = summary_tables(marts[0], attendance)
    run.write(leaders, house, "summary_top_campaigns")
    run.write(shown, house, "summary_show_up")
    if targets.report_dir:
        parts = PayloadParts(
            sales, events, stored("stg_campaigns"), lambda _sales: attendance, targets.settings
        )
        changed = export_document(parts, targets.report_dir)
        totals, goal, attribution = (getattr(parts, n).first() for n in ("totals", "goal", "attribution"))
        levers = lever_amounts(parts.levers).agg(F.sum("amount").alias("total")).first()
        run.note(
            "document",
            changed_files=len(changed),
            events=parts.events.count(),
            campaigns=parts.campaigns.count(),
            net_revenue=totals.net,
            target_net=goal.target_net,
            levers_total=levers.total,
            unattributed_net=attribution.unattributed_dirty_net,
        )


def _store(spark: SparkSession, run: Refresh, warehouse: str) -> None:
    """One row per table and metric, and one per check, so that runs can be compared over time.

    Numbers are stored as numbers, texts in a column of their own.
    """

    def columns(value):
        return (None, value) if isinstance(value, str) else (None if value is None else float(value), None)

    metrics = [
        (table, key, *columns(value))
        for table, values in run.metrics.items()
        for key, value in values.items()
    ]
    checks = [
        (c.check_name, c.passed, c.severity, c.blocking, json.dumps(c.metrics, default=str))
        for c in run.checks
    ]
    layouts = {
        "refresh_metrics": "table_name string, metric string, value double, text string",
        "check_results": "check_name string, passed boolean, severity string, blocking boolean, counts string",
    }
    for name, rows in (("refresh_metrics", metrics), ("check_results", checks)):
        log = spark.createDataFrame(rows, layouts[name]).withColumn("run_at", F.current_timestamp())
        log.coalesce(1).write.mode("append").parquet(f"{warehouse}/{name}")
