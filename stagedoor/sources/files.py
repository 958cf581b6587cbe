"""Reading the delivered files: single CSVs, increments, folders of dated files."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stagedoor.functions.text import file_date

SCAN_FILES = "ticket_scans_*.csv"

# The words a CSV field may hold for "missing".
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def csv_table(
    spark: SparkSession,
    path: str,
    layout: StructType,
    pattern: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Headered CSV below ``path``, columns taken by header name and cast to ``layout``.

    Fields are otherwise verbatim: surrounding spaces stay, columns the layout does not know come
    last as text. Within a folder every file must carry the same header; Spark raises if one
    differs. A row with more fields than its header raises when it is read; in a shorter row the last
    columns are NULL. With ``multi_line`` a quoted field may hold line breaks, and a file is read by one task.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("columnPruning", False)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    names = reader.csv(path).columns
    odd = "_odd_row"
    strings = [StructField(n, StringType()) for n in [*names, odd]]
    text = reader.schema(StructType(strings)).option("columnNameOfCorruptRecord", odd).csv(path)
    known = set(layout.fieldNames())
    # Fields of a row that doesn't fit: commas outside of quotes, and one.
    unquoted = F.regexp_replace(odd, r'"(?:[^"]|"")*"', "")
    too_many = F.regexp_count(unquoted, F.lit(",")) + 1 > len(names)
    error = F.raise_error(F.concat(F.lit("a row with more fields than the header: "), F.col(odd)))

    def present(name):
        column = F.col(f"`{name}`")
        value = F.when(~column.isin(MISSING_WORDS), column)
        return F.when(too_many, error.cast("string")).otherwise(value)

    typed = [present(f.name).cast(f.dataType).alias(f.name) for f in layout.fields]
    extra = [present(name).alias(name) for name in names if name not in known]
    return text.select(*typed, *extra)


# Columns of rejected rows.
REJECTED = ["file_name", "reason", "row"]


def csv_with_rejects(
    spark: SparkSession, path: str | list[str], layout: StructType, out_dir: str, pattern: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of headered CSV that fit ``layout``, and those that don't with file name, reason and text.

    Files are read once: rows are sorted out as they are written below ``out_dir``, both kinds in one pass. A row
    with more fields than the header is rejected, and one with a field that is no value of its column's type;
    the first reason found is given. Columns the layout does not know are left out. A shorter row lacks its last columns.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').option("columnPruning", False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    names = reader.csv(path).columns
    odd = "_odd_row"
    strings = StructType([StructField(n, StringType()) for n in [*names, odd]])
    text = reader.schema(strings).option("columnNameOfCorruptRecord", odd).csv(path)
    unquoted = F.regexp_replace(odd, r'"(?:[^"]|"")*"', "")
    reason = F.when(F.regexp_count(unquoted, F.lit(",")) + 1 > len(names), F.lit("too many fields"))
    values = []
    for f in layout.fields:
        given = F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast("string")
        field = F.when(~given.isin(MISSING_WORDS), given)
        value = field.try_cast(f.dataType)
        reason = reason.when(field.isNotNull() & value.isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
        values.append(value.alias(f.name))
    whole = F.coalesce(F.col(odd), F.concat_ws(",", *(F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names)))
    sorted_out = text.select(
        F.struct(*values).alias("good"), F.struct(F.col("_metadata.file_name").alias("file_name"), reason.alias("reason"), whole.alias("row")).alias("bad")
    ).withColumn("rejected", F.col("bad.reason").isNotNull())
    empty = F.lit(None)
    sorted_out.select(
        F.when(~F.col("rejected"), F.col("good")).otherwise(empty).alias("good"),
        F.when(F.col("rejected"), F.col("bad")).otherwise(empty).alias("bad"), "rejected",
    ).write.mode("overwrite").partitionBy("rejected").parquet(out_dir)
    ddl = f"good {layout.simpleString()}, bad struct<file_name: string, reason: string, row: string>, rejected boolean"
    stored = spark.read.schema(ddl).parquet(out_dir)
    return stored.filter(~F.col("rejected")).select("good.*"), stored.filter("rejected").select("bad.*")


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(file_name, reason, rows) of rejected rows."""
    return rejects.groupBy("file_name", "reason").agg(F.count("*").alias("rows"))


def csv_plus_increments(
    spark: SparkSession, base_path: str, increments_dir: str, file_name: str, layout: StructType
) -> DataFrame:
    """The base file and every ``<increments_dir>/*/<file_name>``; the base alone if there is none."""
    base = csv_table(spark, base_path, layout)
    try:
        extra = csv_table(spark, f"{increments_dir}/*/{file_name}", layout)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return base
        raise
    return base.unionByName(extra, allowMissingColumns=True)


def csv_directory(
    spark: SparkSession, directory: str, layout: StructType, pattern: str = SCAN_FILES
) -> DataFrame:
    """All files of the folder that match ``pattern``, as one table."""
    return csv_table(spark, directory, layout, pattern)


def ingest_manifest(spark: SparkSession, directory: str, pattern: str = SCAN_FILES) -> DataFrame:
    """One row per delivered file, with the date its name carries.

    Lists file entries without reading their content, so files with a header only show up too.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(directory)
        .select(
            F.col("_metadata.file_name").alias("file_name"),
            file_date(F.col("_metadata.file_name")).alias("file_date"),
            F.col("length").alias("bytes"),
        )
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows read from each source file of a file-backed table."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count("*").alias("row_count")
    )


def preview(df: DataFrame, *order, rows: int = 10) -> DataFrame:
    """The first rows, in the given order if there is one."""
    return (df.orderBy(*order) if order else df).limit(rows)


def table_input(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A table written earlier, by name."""
    return spark.read.parquet(f"{warehouse}/{name}")


def register_tables(spark: SparkSession, warehouse: str, names: list[str]) -> None:
    for name in names:
        table_input(spark, warehouse, name).createOrReplaceTempView(name)


def adhoc_sql(spark: SparkSession, text: str) -> DataFrame:
    """A read-only query over the registered tables.

    The text runs as a subquery, where only queries are legal: statements that create, change or
    drop something do not parse.
    """
    query = text.strip().rstrip(";").strip()
    if not query:
        raise ValueError("no SQL given")
    return spark.sql(f"SELECT * FROM (\n{query}\n)")


def headline_of(spark: SparkSession, path: str) -> DataFrame:
    """One row: an exported document's net revenue and the nights with scans."""
    layout = "totals struct<net: double>, season struct<nights_scanned: bigint>"
    document = spark.read.schema(layout).option("multiLine", True).json(path)
    return document.select(
        F.concat(
            F.lit("$"),
            F.format_number("totals.net", 0),
            F.lit(" net, "),
            F.col("season.nights_scanned").cast(StringType()),
            F.lit(" nights of scans"),
        ).alias("headline")
    )


def payload_headline(spark: SparkSession, path: str, fallback: str = "refreshed data") -> str:
    """The headline of an exported document, or ``fallback`` where there is none to read."""
    try:
        row = headline_of(spark, path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback
    return (row and row.headline) or fallback
