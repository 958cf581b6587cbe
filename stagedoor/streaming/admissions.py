"""Attendance kept up to date from new scan files alone.

State is the first scan of every ticket so far, and scanned tickets per event, both in slices by the hash
of the ticket. A batch reads its new files, brings the slices that its tickets fall into together with them, and
writes these slices anew: first scans merge, as the first of some firsts is the first of all. Counts of a slice follow
from its tickets. Everything of a batch becomes visible at once, see :mod:`stagedoor.streaming.ledger`.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor import schemas
from stagedoor.functions.dates import parsed
from stagedoor.functions.numbers import total
from stagedoor.operators.attendance import show_rate_by
from stagedoor.operators.relational import keep_first, with_known_key
from stagedoor.operators.sales import sales_measures
from stagedoor.session import list_names
from stagedoor.sources.files import SCAN_FILES, csv_table, ingest_manifest
from stagedoor.streaming.drops import file_drops
from stagedoor.streaming.ledger import Ledger

TICKETS, COUNTS, FILES = "tickets", "counts", "files"
SLICE = "slice"
SLICES = 64
_TICKET = "scan_id string, ticket_id string, order_id string, event_id string, gate string, scanned_at timestamp"
_COUNT = "event_id string, tickets bigint, known_tickets bigint"
_FILE = "file_name string"


def slice_of(ticket: str, slices: int) -> Column:
    """The slice of a ticket; null is a ticket too."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(ticket), F.lit(""))), F.lit(slices)).cast("int")


class Admissions:
    """State below ``root`` for the scan files of ``directory``; ``slices`` stays as it was first chosen."""

    def __init__(self, spark: SparkSession, directory: str, root: str, slices: int = SLICES, pattern: str = SCAN_FILES):
        self.spark, self.directory, self.pattern, self.slices = spark, directory.rstrip("/"), pattern, slices
        self.ledger = Ledger(spark, root)

    def tickets(self, only: list[str] | None = None) -> DataFrame:
        """The first scan of every ticket."""
        return self.ledger.read(TICKETS, _TICKET, SLICE, only)

    def counts(self) -> DataFrame:
        """(event_id, tickets, known_tickets): distinct tickets scanned, and those of known orders."""
        held = self.ledger.read(COUNTS, _COUNT, SLICE)
        return held.groupBy("event_id").agg(total("tickets").alias("tickets"), total("known_tickets").alias("known_tickets"))

    def handled(self) -> DataFrame:
        """Names of files that are in the state: those of committed batches."""
        last, root = self.ledger.last().batch, f"{self.ledger.root}/{FILES}"
        if not any(n.startswith("batch=") for n in list_names(self.spark, root)):
            return self.spark.createDataFrame([], _FILE)
        listed = self.spark.read.schema(f"{_FILE}, batch bigint").parquet(root)
        return listed.filter(F.col("batch") <= last).select("file_name")

    def pending(self) -> DataFrame:
        """Names of files in the folder that are not in the state: new ones, and late ones."""
        there = ingest_manifest(self.spark, self.directory, self.pattern).select("file_name")
        return there.join(self.handled(), "file_name", "left_anti")

    def newest(self) -> str:
        return self.ledger.last().facts.get("newest") or ""

    def scans_so_far(self) -> int:
        return int(self.ledger.last().facts.get("scans_so_far") or 0)

    def apply(self, batch: int, orders: DataFrame, before_commit: Callable[[], None] = lambda: None) -> bool:
        """Bring all pending files into the state as ``batch``; False if it is there already or nothing is pending.

        ``before_commit`` runs when everything is written and nothing is visible.
        """
        if batch <= self.ledger.last().batch:
            return False
        # File names only: Spark itself holds the list of files that it reads.
        names = sorted(r.file_name for r in self.pending().collect())
        if not names:
            return False
        paths = [f"{self.directory}/{name}" for name in names]
        raw = csv_table(self.spark, paths, schemas.RAW_SCANS)
        typed = raw.withColumn("scanned_at", parsed(raw, "scanned_at")).select(*schema_names(_TICKET))
        arrived = self.ledger.folder("arrived", batch)
        typed.withColumn(SLICE, slice_of("ticket_id", self.slices)).write.mode("overwrite").partitionBy(SLICE).parquet(arrived)
        new = self.spark.read.schema(f"{_TICKET}, {SLICE} int").parquet(arrived)
        read = new.count()
        touched = sorted(str(r[0]) for r in new.select(SLICE).distinct().collect())

        merged = self._with_slice(self.tickets(touched)).unionByName(new)
        first = keep_first(merged, ["ticket_id"], ["scanned_at", "scan_id"])
        firsts = self.ledger.folder(TICKETS, batch)
        first.hint("rebalance", F.col(SLICE)).write.mode("overwrite").partitionBy(SLICE).parquet(firsts)
        written = self.spark.read.schema(f"{_TICKET}, {SLICE} int").parquet(firsts)
        self._count(written, orders).write.mode("overwrite").partitionBy(SLICE).parquet(self.ledger.folder(COUNTS, batch))
        done = self.spark.createDataFrame([(n,) for n in names], _FILE)
        done.coalesce(1).write.mode("overwrite").parquet(self.ledger.folder(FILES, batch))
        before_commit()
        facts = {"scans_read": read, "scans_so_far": self.scans_so_far() + read, "files": len(names), "newest": max([*names, self.newest()])}
        self.ledger.commit(batch, {TICKETS: touched, COUNTS: touched}, facts)
        return True

    def recount(self, batch: int, orders: DataFrame) -> None:
        """Count all tickets again, after orders came in; no scan is read."""
        whole = self._with_slice(self.tickets())
        self._count(whole, orders).write.mode("overwrite").partitionBy(SLICE).parquet(self.ledger.folder(COUNTS, batch))
        slices = list(self.ledger.last().slices.get(TICKETS, {}))
        facts = {"scans_read": 0, "scans_so_far": self.scans_so_far(), "files": 0, "newest": self.newest()}
        self.ledger.commit(batch, {COUNTS: slices}, facts)

    def drop_counts(self) -> dict[str, int]:
        """Scans read, dropped as repeats, dropped as orphans, and kept, over all batches."""
        read = self.scans_so_far()
        row = self.counts().agg(total("tickets").alias("first"), total("known_tickets").alias("kept")).first()
        return {
            "scans_read": read, "duplicate_scans_dropped": read - row.first, "orphan_scans_dropped": row.first - row.kept, "row_count": row.kept,
        }

    def _with_slice(self, tickets: DataFrame) -> DataFrame:
        return tickets.withColumn(SLICE, slice_of("ticket_id", self.slices))

    def _count(self, tickets: DataFrame, orders: DataFrame) -> DataFrame:
        """Counts by slice and event; a slice without tickets has no row."""
        known = with_known_key(tickets.select(SLICE, "event_id", "order_id"), orders, "order_id")
        every = tickets.groupBy(SLICE, "event_id").agg(F.count("*").alias("tickets"))
        some = known.groupBy(SLICE, "event_id").agg(F.count("*").alias("known_tickets"))
        same = (F.col("e.slice") == F.col("s.slice")) & F.col("e.event_id").eqNullSafe(F.col("s.event_id"))
        return every.alias("e").join(some.alias("s"), same, "left").select(
            "e.slice", "e.event_id", "e.tickets", F.coalesce("s.known_tickets", F.lit(0).cast("bigint")).alias("known_tickets")
        )


def schema_names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def attendance_from(counts: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    """Attendance by event from counts of known tickets; equal to that of all staged scans."""
    sold = sales_measures(orders).groupBy("event_id").agg(total("completed_tickets").alias("tickets_sold"))
    scanned = counts.filter("known_tickets > 0").select("event_id", F.col("known_tickets").alias("tickets_scanned"))
    return show_rate_by(
        events.select("event_id", "event_name", "event_date"), sold, scanned, "event_id", ("tickets_sold", "tickets_scanned", "show_up_rate")
    )


def process_new_files(admissions: Admissions, state_dir: str, orders: DataFrame, before_commit: Callable[[], None] = lambda: None) -> None:
    """Bring the files that came since the last run into the state, then stop.

    A batch that brings a name beyond the newest in the state triggers; late files come along with it. As the
    ledger decides what is done, the stream may lose or repeat its own record of a batch and nothing is lost or
    counted twice. Without any state, every file that is there is new.
    """

    def handle(batch: DataFrame, _: int) -> None:
        newest = admissions.newest()
        if batch.filter(F.col("file_name") > newest).isEmpty():
            return
        admissions.apply(admissions.ledger.last().batch + 1, orders, before_commit)

    query = (
        file_drops(admissions.spark, admissions.directory, admissions.pattern)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{state_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
