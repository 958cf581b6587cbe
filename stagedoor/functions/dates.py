"""Date columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SEASON_PREFIX = "Summer season"  # fixed value


def day_text(moment: Column) -> Column:
    """The day as ``yyyy-MM-dd``."""
    return moment.cast("date").cast("string")


def parsed(df: DataFrame, name: str) -> Column:
    """A time column: text is parsed, a column that is a time already stays as it is.

    Leaving it bare lets comparisons with it reach the file scan.
    """
    column = F.col(name)
    return F.to_timestamp(column) if isinstance(df.schema[name].dataType, StringType) else column


def within(df: DataFrame, name: str, first: str, end: str) -> Column:
    """From the day ``first`` on, before the day ``end``, compared in the column's own type."""
    kind, column = df.schema[name].dataType, F.col(name)
    return (column >= F.lit(first).cast(kind)) & (column < F.lit(end).cast(kind))


def season_label(first: Column, last: Column) -> Column:
    """The span of shows in words, shorter when it stays within one month."""
    dash = F.lit("–")
    one_month = F.concat(
        F.date_format(first, "MMMM d"), dash, F.date_format(last, "d yyyy")
    )
    across = F.concat(
        F.date_format(first, "MMM d"), F.lit(" "), dash, F.lit(" "), F.date_format(last, "MMM d yyyy")
    )
    span = F.when(F.trunc(first, "month") == F.trunc(last, "month"), one_month).otherwise(across)
    return F.when(first.isNull(), F.lit(SEASON_PREFIX)).otherwise(
        F.concat(F.lit(f"{SEASON_PREFIX}, "), span)
    )
