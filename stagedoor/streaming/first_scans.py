"""The first scan of a ticket, kept while scans stream in.

State holds the tickets of the last ``delay`` of event time, and no longer: a scan is dropped as a repeat if its ticket
was seen within that time, and dropped as too late if it is older than the newest scan of earlier batches by more.
What is kept is the scan that arrived first. Where a re-scan arrives before the scan that it
repeats, that is not the one scanned first; :func:`agreement` tells the two apart. The batch rule, the earliest scan of
each ticket, stays authoritative.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor import schemas
from stagedoor.operators.relational import keep_first
from stagedoor.sources.files import SCAN_FILES


def scan_stream(spark: SparkSession, directory: str, pattern: str = SCAN_FILES) -> DataFrame:
    """Scans of the files that appear in a folder, typed."""
    rows = (
        spark.readStream.schema(schemas.RAW_SCANS)
        .option("header", True)
        .option("escape", '"')
        .option("pathGlobFilter", pattern)
        .csv(directory)
    )
    return rows.withColumn("scanned_at", F.to_timestamp("scanned_at"))


def first_arrivals(scans: DataFrame, delay: str, keys: tuple[str, ...] = ("ticket_id",)) -> DataFrame:
    """A stream of the scans whose keys were not seen within ``delay`` before."""
    return scans.withWatermark("scanned_at", delay).dropDuplicatesWithinWatermark(list(keys))


def keep_first_arrivals(
    spark: SparkSession, directory: str, path: str, state_dir: str, delay: str, pattern: str = SCAN_FILES
) -> None:
    """Append what :func:`first_arrivals` lets pass of the files that came since the last run, then stop."""
    query = (
        first_arrivals(scan_stream(spark, directory, pattern), delay)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{state_dir}/first-arrivals")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def agreement(kept: DataFrame, scans: DataFrame) -> DataFrame:
    """(ticket_id, kept_scan, first_scan): what the stream kept beside what was scanned first; null where it kept nothing."""
    first = keep_first(scans, ["ticket_id"], ["scanned_at", "scan_id"])
    left = first.select("ticket_id", F.col("scan_id").alias("first_scan")).alias("f")
    right = kept.select("ticket_id", F.col("scan_id").alias("kept_scan")).alias("k")
    same = F.col("f.ticket_id").eqNullSafe(F.col("k.ticket_id"))
    return left.join(right, same, "left").select("f.ticket_id", "kept_scan", "first_scan")
