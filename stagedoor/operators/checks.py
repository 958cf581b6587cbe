"""Data-quality checks. Each gives one row: its name, verdict, severity, gate and counts."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.functions.numbers import total
from stagedoor.functions.text import ticket_number
from stagedoor.operators.attribution import attribution_check_counts, dirty_code_count
from stagedoor.operators.relational import side_by_side, with_unknown_key

ERROR, WARN = "ERROR", "WARN"
_HEAD = ["check_name", "passed", "severity", "blocking"]


def _verdict(
    counts: DataFrame, name: str, passed: Column, severity: str = ERROR, blocking: bool = False
) -> DataFrame:
    return counts.select(
        F.lit(name).alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(severity).alias("severity"),
        F.lit(blocking).alias("blocking"),
        *counts.columns,
    )


def order_amounts_valid(orders: DataFrame) -> DataFrame:
    """Blocking: quantities, prices and revenue in range, order ids unique (two NULLs repeat too)."""
    order_id = F.col("order_id")
    distinct = F.count_distinct(order_id) + F.max(F.coalesce(order_id.isNull().cast("int"), F.lit(0)))
    counts = orders.agg(
        F.count_if(F.col("qty") < 1).alias("bad_qty_rows"),
        F.count_if(F.col("unit_price_usd") <= 0).alias("bad_price_rows"),
        F.count_if(F.col("net_revenue") < 0).alias("negative_net_revenue_rows"),
        F.coalesce(F.count("*") - distinct, F.lit(0)).cast("bigint").alias("duplicate_order_ids"),
    )
    clean = F.lit(True)
    for name in counts.columns:
        clean = clean & (F.col(name) == 0)
    return _verdict(counts, "order_amounts_valid", clean, blocking=True)


def orders_reference_known_events(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Every order belongs to an event of the roster. Orders are counted per event before the join."""
    per_event = orders.groupBy("event_id").agg(F.count("*").alias("rows"))
    counts = with_unknown_key(per_event, events, "event_id").agg(
        total("rows").alias("orders_with_unknown_event")
    )
    return _verdict(
        counts, "orders_reference_known_events", F.col("orders_with_unknown_event") == 0
    )


def few_rows_rejected(read: DataFrame, rejects: DataFrame, at_most: float = 0.01) -> DataFrame:
    """Blocking: of all delivered rows, no larger share than ``at_most`` was rejected. No row at all is none rejected."""
    counts = side_by_side(
        read.agg(F.count("*").alias("accepted_rows")),
        rejects.agg(F.count("*").alias("rejected_rows"), F.count_distinct("file_name").alias("files_with_rejects")),
    )
    share = F.coalesce(F.try_divide(F.col("rejected_rows").cast("double"), F.col("accepted_rows") + F.col("rejected_rows")), F.lit(0.0))
    return _verdict(counts, "few_rows_rejected", share <= at_most, blocking=True)


def all_promo_orders_attributed(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Every coded order matches a campaign; says how to repair it if not."""
    counts = attribution_check_counts(orders, campaigns).withColumn(
        "hint", F.lit("stage the orders with normalize=True to match codes in canonical form")
    )
    return _verdict(counts, "all_promo_orders_attributed", F.col("unattributed_orders") == 0)


def show_up_rate_in_bounds(attendance: DataFrame, low: float = 0.5, high: float = 1.0) -> DataFrame:
    """Warning: rates within [0, 1], never more scans than tickets, overall rate within bounds."""
    return rate_in_bounds(
        attendance, ("tickets_sold", "tickets_scanned", "show_up_rate"), low, high,
        "show_up_rate_in_bounds",
    )


def rate_in_bounds(
    table: DataFrame, names: tuple[str, str, str], low: float, high: float, check_name: str
) -> DataFrame:
    promised, appeared, rate = (F.col(name) for name in names)
    overall = F.try_divide(F.sum(appeared).cast("double"), F.sum(promised))
    counts = table.agg(
        overall.alias("overall_rate"),
        F.count_if(~F.coalesce(rate.between(0, 1), F.lit(False))).alias("rates_out_of_bounds"),
        F.count_if(appeared > promised).alias("more_scans_than_tickets"),
    )
    passed = (
        (F.col("rates_out_of_bounds") == 0)
        & (F.col("more_scans_than_tickets") == 0)
        & F.col("overall_rate").between(low, high)
    )
    return _verdict(counts, check_name, passed, WARN)


def ticket_integrity(scans: DataFrame, orders: DataFrame) -> DataFrame:
    """Scans of known orders carry the order's event and one of its tickets, and it is completed."""
    owner = orders.select(
        "order_id",
        F.col("event_id").alias("order_event"),
        "qty",
        "status",
        F.lit(True).alias("known"),
    )
    linked = scans.select("order_id", "event_id", "ticket_id").join(owner, "order_id", "left")
    known = F.col("known").isNotNull()
    suffix = ticket_number(F.col("ticket_id"))
    in_range = F.coalesce(suffix.between(F.lit(1), F.col("qty")), F.lit(False))
    counts = linked.agg(
        F.count_if(~known).alias("orphan_scans"),
        F.count_if(known & ~F.col("event_id").eqNullSafe(F.col("order_event"))).alias("event_mismatches"),
        F.count_if(known & ~in_range).alias("tickets_out_of_range"),
        F.count_if(known & ~F.col("status").eqNullSafe("completed")).alias("scans_of_open_orders"),
    )
    passed = (
        (F.col("event_mismatches") == 0)
        & (F.col("tickets_out_of_range") == 0)
        & (F.col("scans_of_open_orders") == 0)
    )
    return _verdict(counts, "ticket_integrity", passed)


def promo_codes_canonical(orders: DataFrame) -> DataFrame:
    return _verdict(
        dirty_code_count(orders), "promo_codes_canonical", F.col("dirty_code_orders") == 0, WARN
    )


def plan_covers_gap(levers: DataFrame, goal: DataFrame) -> DataFrame:
    """The levers together reach the gap to the goal, and each of them adds something."""
    counts = levers.agg(
        F.sum("amount").alias("levers_total"), F.count_if(F.col("amount") <= 0).alias("idle_levers")
    ).select("levers_total", "idle_levers", goal.select("gap").scalar().alias("gap"))
    passed = (F.col("levers_total") >= F.col("gap")) & (F.col("idle_levers") == 0)
    return _verdict(counts, "plan_covers_gap", passed, WARN)


@dataclass(frozen=True)
class CheckResult:
    check_name: str
    passed: bool
    severity: str
    blocking: bool
    metrics: dict = field(default_factory=dict)


class BlockedByCheck(Exception):
    """A blocking check failed; nothing downstream may be built."""

    def __init__(self, result: CheckResult):
        super().__init__(f"{result.check_name} failed: {result.metrics}")
        self.result = result


def evaluate(check: DataFrame) -> CheckResult:
    """Run a check: it is one row by construction, which comes to the driver."""
    row = check.first().asDict()
    head = {name: row.pop(name) for name in _HEAD}
    return CheckResult(**head, metrics=row)


def gate(*checks: DataFrame) -> list[CheckResult]:
    """Evaluate the checks; raise once all have run if a blocking one failed."""
    results = [evaluate(check) for check in checks]
    raise_if_blocked(results)
    return results


def raise_if_blocked(results: list[CheckResult]) -> None:
    for result in results:
        if result.blocking and not result.passed:
            raise BlockedByCheck(result)
