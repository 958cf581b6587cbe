"""Registered queries over the tables delivered as files: increments, folders, refreshes, gate, drops."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagedoor import schemas
from stagedoor.catalog.queries import Season, query
from stagedoor.functions.text import file_date
from stagedoor.operators import checks, relational, staging
from stagedoor.plans import slices
from stagedoor.plans.refresh import Refresh, Sources, Targets, refresh_admissions, refresh_all
from stagedoor.session import fresh_path, list_names, move, settle, write_text
from stagedoor.sinks import fragments, snapshots, tables
from stagedoor.sources import files
from stagedoor.streaming import admissions, drops, first_scans

DAYS = ["2025-07-01", "2025-07-02", "2025-07-03"]


def deliver_scans(s: Season, folder: str, day: int) -> None:
    """A third of the scans as files of one day, in as many files as the scans have partitions."""
    made = fresh_path(s.spark, "scan-files")
    mine = F.pmod(F.col("scan_id").cast("bigint"), F.lit(len(DAYS))) == day
    tables.write_csv(s.source.raw_scans().filter(mine), made)
    parts = [n for n in list_names(s.spark, made) if n.startswith("part-")]
    for i, name in enumerate(parts):
        move(s.spark, f"{made}/{name}", f"{folder}/ticket_scans_{DAYS[day]}_{i:05d}.csv")


def _day(name) -> F.Column:
    return F.substring(file_date(name), 1, 10)


def _orders_in_two_parts(s: Season, raw: str, nights: str) -> None:
    late = F.col("order_id").cast("bigint") % 3 == 0
    orders = s.source.raw_orders()
    tables.write_csv(orders.filter(~late), f"{raw}/orders.csv")
    tables.write_csv(orders.filter(late), f"{nights}/{DAYS[1]}/orders.csv")


@query
def csv_increments(s: Season) -> DataFrame:
    """Orders delivered as a base file and a later increment, read back as one table."""
    raw, nights = fresh_path(s.spark, "raw"), fresh_path(s.spark, "nights")
    _orders_in_two_parts(s, raw, nights)
    whole = files.csv_plus_increments(
        s.spark, f"{raw}/orders.csv", nights, "orders.csv", schemas.RAW_ORDERS
    )
    return whole.withColumn("ordered_at", F.to_timestamp("ordered_at"))


@query
def csv_folder_manifest(s: Season) -> DataFrame:
    """Days of delivered scan files with their rows; one day's file has a header only."""
    folder = fresh_path(s.spark, "scans")
    for day in range(len(DAYS)):
        deliver_scans(s, folder, day)
    header = ",".join(schemas.RAW_SCANS.fieldNames())
    write_text(s.spark, f"{folder}/ticket_scans_2025-07-04.csv", f"{header}\n")
    scans = files.csv_directory(s.spark, folder, schemas.RAW_SCANS)
    manifest = files.ingest_manifest(s.spark, folder)
    counted = manifest.join(files.rows_per_file(scans), "file_name", "left")
    return counted.groupBy(_day(F.col("file_name")).alias("file_date")).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        (F.min("bytes") > 0).alias("has_header"),
    )


@query
def empty_slice_rebuild(s: Season) -> DataFrame:
    """Months rebuilt after their orders of June were withdrawn: those slices vanish, others stay."""
    path = fresh_path(s.spark, "monthly_sales")
    rows = settle(slices.monthly_sales(s.orders), "months")
    months = rows.select("order_month").distinct()
    tables.replace_slices(rows, path, "order_month", months)
    requested = months.filter(F.year("order_month") <= 1996)
    left = rows.filter(F.month("order_month") != 6)
    tables.replace_slices(left, path, "order_month", requested)
    return tables.read_slices(s.spark, path, rows.schema, "order_month")


@query
def stream_baseline_and_late_file(s: Season) -> DataFrame:
    """Scan files dropped in steps: there before the first run, newer, and late."""
    folder, state = fresh_path(s.spark, "scans"), fresh_path(s.spark, "drops")
    seen = fresh_path(s.spark, "seen")

    def refresh(names: DataFrame) -> None:
        names.write.mode("append").parquet(seen)

    for day in (1, 2, 0):
        deliver_scans(s, folder, day)
        drops.process_drops(s.spark, folder, state, refresh)
    triggered = s.spark.read.parquet(seen).select(_day(F.col("file_name")).alias("day")).distinct()
    scans = files.csv_directory(s.spark, folder, schemas.RAW_SCANS)
    counted = files.rows_per_file(scans).groupBy(_day(F.col("file_name")).alias("file_date"))
    return counted.agg(F.sum("row_count").alias("row_count")).join(
        triggered, F.col("file_date") == F.col("day"), "left"
    ).select("file_date", "row_count", F.col("day").isNotNull().alias("triggered"))


@query
def blocking_gate(s: Season) -> DataFrame:
    """Checks of orders of which some are repeated and some are of unknown events, and what the gate does."""
    key = F.col("order_id").cast("bigint")
    orders = s.orders.union(s.orders.filter(key % 64 == 0))
    orders = orders.withColumn("event_id", F.when(key % 100 == 1, F.lit("NOWHERE")).otherwise(F.col("event_id")))
    amounts = checks.order_amounts_valid(orders)
    known = checks.orders_reference_known_events(orders, s.events)
    try:
        checks.gate(known, amounts)
        stopped = ""
    except checks.BlockedByCheck as blocked:
        stopped = blocked.result.check_name
    both = [
        c.select("check_name", "passed", F.col(n).alias("failing_rows"))
        for c, n in ((amounts, "duplicate_order_ids"), (known, "orders_with_unknown_event"))
    ]
    return both[0].union(both[1]).withColumn("stops_the_run", F.col("check_name") == stopped)


def refreshed(s: Season, days: int = len(DAYS)) -> tuple[Sources, Targets, Refresh]:
    """A full refresh from delivered files, with the scans of the first ``days``."""
    home = fresh_path(s.spark, "delivery")
    sources = Sources(f"{home}/raw", f"{home}/scans", f"{home}/nights")
    tables.write_csv(s.source.raw_campaigns(), f"{sources.raw_dir}/campaigns.csv")
    tables.write_csv(s.source.raw_events(), f"{sources.raw_dir}/events.csv")
    _orders_in_two_parts(s, sources.raw_dir, sources.nights_dir)
    for day in range(days):
        deliver_scans(s, sources.scans_dir, day)
    capacity = s.events.agg(F.max("capacity")).first()[0]
    targets = Targets(f"{home}/house", f"{home}/report", capacity, s.settings)
    return sources, targets, refresh_all(s.spark, sources, targets)


@query
def refresh_metrics(s: Season) -> DataFrame:
    """Numbers that a full refresh stores, read back."""
    _, targets, _ = refreshed(s)
    stored = files.table_input(s.spark, targets.warehouse, "refresh_metrics")
    # How many files there are depends on how the tables were partitioned.
    kept = stored.filter("value is not null and metric <> 'files_ingested' and table_name <> 'ingest_manifest'")
    return kept.select("table_name", "metric", F.round("value", 4).alias("value"))


@query
def check_results(s: Season) -> DataFrame:
    """Outcomes of checks that a full refresh stores, read back."""
    _, targets, _ = refreshed(s)
    stored = files.table_input(s.spark, targets.warehouse, "check_results")
    return stored.select("check_name", "passed", "severity", "blocking")


@query
def admissions_refresh(s: Season) -> DataFrame:
    """Attendance after the last day's scans came in and a partial refresh ran."""
    sources, targets, _ = refreshed(s, days=2)
    deliver_scans(s, sources.scans_dir, 2)
    refresh_admissions(s.spark, sources, targets)
    return files.table_input(s.spark, targets.warehouse, "attendance_by_event")


class Crash(Exception):
    """Stands for a lost driver."""


def _crash() -> None:
    raise Crash


def followed(s: Season) -> admissions.Admissions:
    """Attendance state after scan files came in steps: one, one more, whose batch crashes once, and a late one."""
    folder, home = fresh_path(s.spark, "scans"), fresh_path(s.spark, "admissions")
    state = admissions.Admissions(s.spark, folder, f"{home}/state", slices=8)
    orders = settle(s.orders.select("order_id"), "known-orders")

    def follow(before_commit=lambda: None) -> None:
        admissions.process_new_files(state, f"{home}/stream", orders, before_commit)

    deliver_scans(s, folder, 1)
    follow()
    deliver_scans(s, folder, 2)
    try:
        follow(_crash)
    except StreamingQueryException:
        pass
    follow()
    follow()
    deliver_scans(s, folder, 0)
    follow()  # late: triggers nothing
    header = ",".join(schemas.RAW_SCANS.fieldNames())
    write_text(s.spark, f"{folder}/ticket_scans_2025-07-04.csv", f"{header}\n")
    follow()
    return state


@query
def incremental_admissions(s: Season) -> DataFrame:
    """Attendance from state that read every scan file once."""
    return admissions.attendance_from(followed(s).counts(), s.sales, s.events)


@query
def incremental_batches(s: Season) -> DataFrame:
    """Committed batches with the scans that each read, and what all of them dropped."""
    state = followed(s)
    read = [(b, int(state.ledger.entry(b).facts["scans_read"])) for b in state.ledger.batches()]
    counts = state.drop_counts()
    dropped = [F.lit(counts[k]).cast("bigint").alias(k) for k in ("duplicate_scans_dropped", "orphan_scans_dropped", "row_count")]
    return s.spark.createDataFrame(read, "batch bigint, scans_read bigint").select("*", *dropped)


@query
def stream_first_arrivals(s: Season) -> DataFrame:
    """Tickets with the scan that a stream kept and the one scanned first; some re-scans arrive before their scan."""
    folder, kept, state = (fresh_path(s.spark, n) for n in ("scans", "kept", "stream"))
    # A scan may come late by as much as all scans span.
    at = F.to_timestamp("scanned_at")
    span = s.source.raw_scans().agg(F.timestamp_diff("SECOND", F.min(at), F.max(at))).first()[0]
    for day in range(len(DAYS)):
        deliver_scans(s, folder, day)
        first_scans.keep_first_arrivals(s.spark, folder, kept, state, f"{span + 60} seconds")
    scans = s.source.raw_scans().withColumn("scanned_at", at)
    return first_scans.agreement(s.spark.read.parquet(kept), scans)


EVENT_LAYOUT = (
    "id string, sold bigint, net double, tiers map<string, struct<sold: bigint, cap: bigint, net: double>>, "
    "attendance struct<kept: bigint, scanned: bigint, show_up: double, no_shows: bigint>"
)


@query
def exported_document(s: Season) -> DataFrame:
    """Events of a document that all tasks wrote as fragments, in order, after an export with nothing new and a second one."""
    out, other = fresh_path(s.spark, "report"), fresh_path(s.spark, "report")
    parts = s.spread_parts
    wrote = [fragments.export_fragments(parts, out), fragments.export_fragments(parts, out), fragments.export_fragments(parts, other)]
    texts = [s.spark.read.text(f"{o}/data").select("section", F.xxhash64("value").alias("h")) for o in (out, other)]
    same = wrote == [True, False, True] and relational.changed_rows(*texts).isEmpty()
    listed = fragments.listed_files(s.spark, out)
    twin = listed["data.js"][1:-1] == listed["data.json"] == fragments.fragment_names(s.spark, out)
    found = fragments.read_section(s.spark, out, "events", EVENT_LAYOUT)
    premium = F.col("element.tiers")[s.settings.premium_tier]
    return found.select(
        "position", "element.id", "element.sold", "element.net", premium["sold"].alias("premium_sold"), premium["net"].alias("premium_net"),
        "element.attendance.scanned", F.lit(same).alias("export_repeats"), F.lit(twin).alias("twin_equals"),
    )


@query
def document_days(s: Season) -> DataFrame:
    """Days of the document, from its fragments."""
    out = fresh_path(s.spark, "report")
    fragments.export_fragments(s.spread_parts, out)
    return fragments.read_section(s.spark, out, "daily", "date string, net double, tickets bigint").select("position", "element.*")


@query
def document_campaigns(s: Season) -> DataFrame:
    """Campaigns of the document, from its fragments, best return first."""
    out = fresh_path(s.spark, "report")
    fragments.export_fragments(s.spread_parts, out)
    layout = "id string, name string, spend double, net double, rpd double"
    return fragments.read_section(s.spark, out, "campaigns", layout).select("position", "element.*")


@query
def document_tiers(s: Season) -> DataFrame:
    """Every tier of every event of the document, and whether the event has attendance, from its fragments."""
    out = fresh_path(s.spark, "report")
    fragments.export_fragments(s.spread_parts, out)
    found = fragments.read_section(s.spark, out, "events", EVENT_LAYOUT).select("element.*")
    came = F.col("attendance").isNotNull().alias("has_attendance")
    return found.select("id", came, F.explode("tiers").alias("tier", "figures")).select("id", "has_attendance", "tier", "figures.*")


@query
def document_levers(s: Season) -> DataFrame:
    """The levers of the document with all their details, from its fragments."""
    out = fresh_path(s.spark, "report")
    fragments.export_fragments(s.spread_parts, out)
    details = (
        "event string, sell_through double, target_sell_through double, add_tickets bigint, avg_net_per_ticket double, unsold_seats bigint, "
        "sellout_nights bigint, nights bigint, vip_net_on_sellouts double, price_lift double, budget_moved double, source_rpd double, "
        "target_rpd double, incrementality double, refunded_rev double, convert_rate double"
    )
    layout = f"key string, amount bigint, detail struct<{details.replace(' ', ':').replace(',:', ',')}>"
    return fragments.read_section(s.spark, out, "levers", layout).select("position", "element.key", "element.amount", "element.detail.*")


@query
def changed_by_digest(s: Season) -> DataFrame:
    """What cleaning the promo codes changes, found by comparing digests of two snapshots first."""
    before, after, again = (fresh_path(s.spark, "snapshot") for _ in range(3))
    for orders, path in ((s.orders, before), (s.clean_orders, after), (s.orders, again)):
        snapshots.write_snapshot(orders.select("order_id", "promo_code"), ["order_id"], path)
    unchanged = snapshots.differing_slots(s.spark, before, again).count()
    return snapshots.changed_since(s.spark, before, after).withColumn("slots_of_a_repeat", F.lit(unchanged))


@query
def rejected_rows(s: Season) -> DataFrame:
    """Delivered orders of which some have a field too many or a quantity in words: rejects by reason, and the gate."""
    folder, sorted_out = fresh_path(s.spark, "orders-csv"), fresh_path(s.spark, "sorted-out")
    key = F.col("order_id").cast("bigint")
    odd = s.source.raw_orders().withColumns({
        "status": F.when(key % 50 == 7, F.concat("status", F.lit(",extra"))).otherwise(F.col("status")),
        "qty": F.when(key % 50 == 9, F.lit("many")).otherwise(F.col("qty").cast("string")),
    })
    plain = odd.select(*tables.csv_fields(odd))
    # Without quotes, the added comma makes a field.
    plain.write.option("header", True).option("quote", "\u0000").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    good, bad = files.csv_with_rejects(s.spark, folder, schemas.RAW_ORDERS, sorted_out)
    check = checks.evaluate(checks.few_rows_rejected(good, bad))
    counted = files.reject_counts(bad).groupBy("reason").agg(F.sum("rows").alias("rows"))
    accepted = good.agg(F.lit("accepted").alias("reason"), F.count("*").alias("rows"))
    return accepted.union(counted).withColumn("passed", F.lit(check.passed))


@query
def slice_metrics(s: Season) -> DataFrame:
    """Rows and net recorded for day slices of a range that was rebuilt, days without orders included."""
    path = fresh_path(s.spark, "daily_sales")
    slices.rebuild_days(s.orders, path, "1994-12-25", "1995-03-01")
    return s.spark.read.parquet(f"{path}_metrics").drop("run_at")


@query
def refresh_texts(s: Season) -> DataFrame:
    """Texts that a full refresh stores beside its numbers."""
    _, targets, _ = refreshed(s)
    stored = files.table_input(s.spark, targets.warehouse, "refresh_metrics").filter("text is not null")
    # A file's number within its day depends on how the scans were partitioned.
    return stored.select("table_name", "metric", F.regexp_replace("text", "_[0-9]{5}[.]csv$", ".csv").alias("text"))


@query
def dated_files(s: Season) -> DataFrame:
    """Scans as staged from a folder of dated files, with the date of each row's file."""
    folder = fresh_path(s.spark, "scans")
    for day in range(len(DAYS)):
        deliver_scans(s, folder, day)
    scans = files.csv_directory(s.spark, folder, schemas.RAW_SCANS)
    dated = scans.select("scan_id", _day(F.col("_metadata.file_name")).alias("file_date"))
    staged = staging.stg_ticket_scans(scans, s.orders).select("scan_id")
    return dated.join(staged, "scan_id")


@query
def written_tables_read_back(s: Season) -> DataFrame:
    """Staged orders written as a table and read by name."""
    house = fresh_path(s.spark, "warehouse")
    tables.write_table(s.orders, house, "stg_orders")
    stored = files.table_input(s.spark, house, "stg_orders")
    return stored.select("order_id", "event_id", "tier", "promo_code", "gross_revenue", "net_revenue")
