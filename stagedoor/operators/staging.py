"""Typed, cleaned tables from the raw ones."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stagedoor.functions.dates import day_text, parsed
from stagedoor.functions.text import blank_to_null, normalize_code
from stagedoor.operators.relational import keep_first, side_by_side, with_known_key

SHOW_STARTS = "INTERVAL 20 HOURS"


def stg_campaigns(raw_campaigns: DataFrame) -> DataFrame:
    return raw_campaigns.withColumns(
        {
            "starts_on": parsed(raw_campaigns, "starts_on"),
            "ends_on": parsed(raw_campaigns, "ends_on"),
            "spend_usd": F.col("spend_usd").cast("double"),
            "promo_code": blank_to_null(F.col("promo_code")),
        }
    )


def stg_events(raw_events: DataFrame) -> DataFrame:
    date = parsed(raw_events, "event_date")
    return raw_events.withColumns(
        {
            "event_date": date,
            "capacity": F.col("capacity").cast("bigint"),
            "show_ts": date + F.expr(SHOW_STARTS),
        }
    )


def stg_orders(raw_orders: DataFrame, normalize: bool = False) -> DataFrame:
    """Orders with revenue; rows without a positive quantity and price are dropped.

    Promo codes stay as recorded unless ``normalize`` is set. A refunded order keeps its gross
    revenue and has no net revenue; an order without a status counts as not refunded.
    """
    gross = F.col("qty") * F.col("unit_price_usd")
    refunded = F.col("status").eqNullSafe("refunded")
    code = F.col("promo_code")
    ordered_at = parsed(raw_orders, "ordered_at")
    return raw_orders.filter((F.col("qty") > 0) & (F.col("unit_price_usd") > 0)).withColumns(
        {
            "ordered_at": ordered_at,
            "promo_code": normalize_code(code) if normalize else code,
            "order_date": day_text(ordered_at),
            "gross_revenue": gross,
            "net_revenue": F.when(refunded, F.lit(0.0)).otherwise(gross),
        }
    )


@dataclass(frozen=True)
class ScanStages:
    """The steps from raw scans to the staged table; an order is known if staging kept it."""

    typed: DataFrame
    first_per_ticket: DataFrame
    staged: DataFrame


def scan_stages(
    raw_scans: DataFrame, orders: DataFrame, person_keys: tuple[str, ...] = ("ticket_id",)
) -> ScanStages:
    typed = raw_scans.withColumn("scanned_at", parsed(raw_scans, "scanned_at"))
    first = keep_first(typed, list(person_keys), ["scanned_at", "scan_id"])
    return ScanStages(typed, first, with_known_key(first, orders, "order_id"))


def stg_ticket_scans(
    raw_scans: DataFrame, orders: DataFrame, person_keys: tuple[str, ...] = ("ticket_id",)
) -> DataFrame:
    """The earliest scan of each ticket, then without scans of unknown orders.

    ``person_keys`` widens what counts as a repeat, e.g. to ticket and session.
    """
    return scan_stages(raw_scans, orders, person_keys).staged


def scan_drop_counts(raw_scans: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: scans read, dropped as repeats, dropped as orphans, kept."""
    stages = scan_stages(raw_scans, orders)
    known = orders.select("order_id").distinct().withColumn("_known", F.lit(True))
    flagged = stages.first_per_ticket.join(known, "order_id", "left")
    counts = side_by_side(
        stages.typed.agg(F.count("*").alias("scans_read")),
        flagged.agg(F.count("*").alias("_tickets"), F.count("_known").alias("row_count")),
    )
    return counts.select(
        "scans_read",
        (F.col("scans_read") - F.col("_tickets")).alias("duplicate_scans_dropped"),
        (F.col("_tickets") - F.col("row_count")).alias("orphan_scans_dropped"),
        "row_count",
    )


def observed_scans(raw_scans: DataFrame, orders: DataFrame) -> tuple[DataFrame, dict[str, Observation]]:
    """The staged scans, with row counts taken at every step while they are written."""
    marks = {name: Observation(name) for name in ("scans_read", "scans_first", "scans_kept")}
    count = F.count(F.lit(1)).alias("rows")
    typed = raw_scans.withColumn("scanned_at", parsed(raw_scans, "scanned_at")).observe(
        marks["scans_read"], count
    )
    first = keep_first(typed, ["ticket_id"], ["scanned_at", "scan_id"]).observe(
        marks["scans_first"], count
    )
    kept = with_known_key(first, orders, "order_id").observe(marks["scans_kept"], count)
    return kept, marks
