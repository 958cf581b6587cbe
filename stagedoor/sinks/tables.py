"""Writing tables: whole, by slice, as CSV."""

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from stagedoor.session import delete_folders, settle


def write_table(df: DataFrame, warehouse: str, name: str) -> DataFrame:
    """Replace the table and return it as read back."""
    path = f"{warehouse}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(
    df: DataFrame, warehouse: str, name: str, **metrics: Column
) -> tuple[DataFrame, dict[str, int]]:
    """Write the table, and count its rows and whatever else is asked for in the same pass."""
    seen = Observation(f"{name}_rows")
    counts = [F.count(F.lit(1)).alias("row_count"), *(m.alias(k) for k, m in metrics.items())]
    table = write_table(df.observe(seen, *counts), warehouse, name)
    return table, dict(seen.get)


def replace_slices(df: DataFrame, path: str, key: str, requested: DataFrame) -> None:
    """Replace the slices named in ``requested`` (column ``key``) with the rows of ``df``.

    Other slices stay. Rows are computed and written once, in one dynamic overwrite, which leaves a slice
    alone for which no row comes: a requested slice that still holds the file it held before is stale, and all
    stale slices are deleted together. Their number is that of the requested slices, a calendar range or
    a list of venues. Rows are gathered by slice so that a slice gets few files; one far larger than the
    others is split.
    """
    spark = df.sparkSession
    before = slice_keys(spark, path, key)
    if before is not None:
        before = settle(before, "slice-keys")
    (
        df.join(requested.select(key), key, "left_semi")
        .hint("rebalance", F.col(key))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )
    if before is None:
        return
    wanted = requested.select(F.col(key).cast("string").alias("slice")).distinct()
    after = slice_keys(spark, path, key).select("slice", "folder", "file")
    stale = before.join(wanted, "slice", "left_semi").join(after, ["slice", "folder", "file"])
    delete_folders(spark, [unquote(row.folder) for row in stale.select("folder").collect()])


def read_slices(spark: SparkSession, path: str, layout: StructType, key: str) -> DataFrame:
    """The sliced table, its key as a timestamp again where the layout says so."""
    stored = [
        StructField(f.name, DateType(), True)
        if f.name == key and isinstance(f.dataType, TimestampType)
        else f
        for f in layout.fields
    ]
    table = spark.read.schema(StructType(stored)).parquet(path)
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.fields])


def slice_keys(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """The keys of slices that hold rows, as text, with folder and first file; None where no table exists yet."""
    as_text = StructType([StructField(key, StringType(), True)])
    try:
        table = spark.read.schema(as_text).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    parts = [F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/([^/]*)$", i) for i in (1, 2)]
    first = F.min(F.struct(parts[0].alias("folder"), parts[1].alias("file"))).alias("first")
    return table.groupBy(F.col(key).cast("string").alias("slice")).agg(first).select("slice", "first.*")


def missing_slices(calendar: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Calendar keys no row of the table has."""
    return calendar.select(key).join(present.select(key).distinct(), key, "left_anti")


def csv_fields(df: DataFrame) -> list[Column]:
    """Text as the delivered files carry it: two decimals, ISO days, seconds only where there are any."""

    def field(spec):
        value = F.col(spec.name)
        if isinstance(spec.dataType, DoubleType):
            return F.format_string("%.2f", value)
        if isinstance(spec.dataType, DateType):
            return F.date_format(value, "yyyy-MM-dd")
        if spec.dataType.typeName().startswith("timestamp"):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return value.cast("string")

    return [
        F.when(F.col(f.name).isNotNull(), field(f)).alias(f.name) for f in df.schema.fields
    ]


def write_csv(df: DataFrame, path: str) -> None:
    """Headered UTF-8 CSV in column order, spaces kept, quotes doubled."""
    (
        df.select(*csv_fields(df))
        .write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("lineSep", "\n")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
