"""Files dropped into a folder, as a stream that triggers a refresh.

The stream sees file entries, not their content, so noticing a file costs the same whatever its
size, and a file with only a header is noticed too. The drop log, one folder per micro-batch, is
both the record of handled files and the cursor: the greatest name logged by earlier batches.
As a date in a name is written from year to day, sorting names sorts days.
"""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.sources.files import SCAN_FILES, ingest_manifest

_FILE_ENTRY = "path string, modificationTime timestamp, length bigint, content binary"
_LOG = "file_name string, batch_id bigint"
_BASELINE = -1


def file_drops(spark: SparkSession, directory: str, pattern: str = SCAN_FILES) -> DataFrame:
    """A stream with one row per file that appears in the folder."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE_ENTRY)
        .option("pathGlobFilter", pattern)
        .load(directory)
        .select(F.col("_metadata.file_name").alias("file_name"))
    )


def drop_log(spark: SparkSession, state_dir: str) -> DataFrame | None:
    """Handled files with their batch; the baseline has batch -1. None before the first run."""
    try:
        return spark.read.schema(_LOG).parquet(f"{state_dir}/drops")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def cursor(spark: SparkSession, state_dir: str, before_batch: int | None = None) -> str:
    log = drop_log(spark, state_dir)
    if before_batch is not None:
        log = log.filter(F.col("batch_id") < before_batch)
    return log.agg(F.coalesce(F.max("file_name"), F.lit("")).alias("name")).first().name


def newer_files(names: DataFrame, after: str) -> DataFrame:
    return names.filter(F.col("file_name") > after).select("file_name").distinct()


def _log(names: DataFrame, state_dir: str, batch_id: int) -> None:
    names.select("file_name").write.mode("overwrite").parquet(
        f"{state_dir}/drops/batch_id={batch_id}"
    )


def record_baseline(
    spark: SparkSession, directory: str, state_dir: str, pattern: str = SCAN_FILES
) -> None:
    """First run: note the greatest name already there, so that only later ones trigger."""
    there = ingest_manifest(spark, directory, pattern)
    newest = there.agg(F.coalesce(F.max("file_name"), F.lit("")).alias("file_name"))
    _log(newest, state_dir, _BASELINE)


def start_from_nothing(spark: SparkSession, state_dir: str) -> None:
    """First run, the other way: every file already there counts as new."""
    _log(spark.range(1).select(F.lit("").alias("file_name")), state_dir, _BASELINE)


def process_drops(
    spark: SparkSession,
    directory: str,
    state_dir: str,
    refresh: Callable[[DataFrame], None],
    pattern: str = SCAN_FILES,
) -> None:
    """Handle the files that came since the last run, then stop.

    ``refresh`` runs once per micro-batch that brings names beyond the cursor, with those names.
    The checkpoint hands out each file once; a batch replayed after a failure computes the same
    names, because its cursor comes from earlier batches only, and overwrites its own log entry, so
    ``refresh`` must replace what it writes. A late file, named before the cursor, triggers
    nothing but is there for the next refresh that reads the folder.
    """
    if drop_log(spark, state_dir) is None:
        record_baseline(spark, directory, state_dir, pattern)

    def handle(batch: DataFrame, batch_id: int) -> None:
        names = newer_files(batch, cursor(batch.sparkSession, state_dir, batch_id))
        if names.isEmpty():
            return
        refresh(names)
        _log(names, state_dir, batch_id)

    query = (
        file_drops(spark, directory, pattern)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{state_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
