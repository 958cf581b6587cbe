"""Exact order statistics of columns of any size, by narrowing a histogram.

Each round counts a value range in bins, with partial sums in every task, and goes on with the bin that the wanted
rank falls into. What reaches the driver is one row a bin; no task sees the rows of another one's bin, and nothing is sorted
but the last few values.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
# A bin of so many different values or fewer is listed.
LISTED = 4096


@dataclass(frozen=True)
class Range:
    """Values of ``low`` to ``high``, before which ``below`` values lie, ``count`` of them."""

    low: float
    high: float
    below: int
    count: int


def _bin(value: Column, r: Range, bins: int) -> Column:
    # Halves keep the width of the widest range finite.
    share = (value / 2 - r.low / 2) / (r.high / 2 - r.low / 2)
    return F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(share * bins))).cast("int")


def _narrowed(values: DataFrame, r: Range, rank: int, bins: int) -> Range:
    value = F.col("value")
    inside = values.filter(value.between(F.lit(r.low), F.lit(r.high)))
    counted = inside.groupBy(_bin(value, r, bins).alias("bin")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n")
    )
    below = r.below
    for row in sorted(counted.collect(), key=lambda x: x["bin"]):
        if rank < below + row.n:
            return Range(row.low, row.high, below, row.n)
        below += row.n
    raise AssertionError("a rank lies within its range")


def value_at(values: DataFrame, whole: Range, rank: int, *, bins: int = BINS, listed: int = LISTED) -> float:
    """The value with ``rank`` values before it, of a column ``value`` of doubles without nulls and NaN."""
    r = whole
    while r.low < r.high:
        if r.count <= listed:
            few = values.filter(F.col("value").between(F.lit(r.low), F.lit(r.high)))
            return sorted(row.value for row in few.collect())[rank - r.below]
        r = _narrowed(values, r, rank, bins)
    return r.low


def quantile(df: DataFrame, column: Column, share: float = 0.5, *, bins: int = BINS, listed: int = LISTED) -> float | None:
    """The exact quantile, between two values by linear interpolation; None if there is no value.

    Nulls don't count; NaN comes after all numbers. ``df`` is read once a round, at most some ten
    times for values spread over a few orders of magnitude, so a costly one should be written first.
    """
    every = df.select(column.cast("double").alias("value")).filter("value is not null")
    numbers = every.filter(~F.isnan("value"))
    infinite = float("inf")
    row = every.agg(
        F.count("*").alias("n"),
        F.count_if(F.isnan("value")).alias("nan"),
        F.count_if(F.col("value") == F.lit(-infinite)).alias("least"),
        F.count_if(F.col("value") == F.lit(infinite)).alias("most"),
        F.min(F.when(F.abs("value") < F.lit(infinite), F.col("value"))).alias("low"),
        F.max(F.when(F.abs("value") < F.lit(infinite), F.col("value"))).alias("high"),
    ).first()
    if not row.n:
        return None
    finite = row.n - row.nan - row.least - row.most
    numbers = numbers.filter(F.abs("value") < F.lit(infinite))

    def at(rank: int) -> float:
        if rank < row.least:
            return -infinite
        if rank < row.least + finite:
            return value_at(numbers, Range(row.low, row.high, row.least, finite), rank, bins=bins, listed=listed)
        return infinite if rank < row.n - row.nan else float("nan")

    place = share * (row.n - 1)
    lower = int(place)
    one = at(lower)
    if place == lower:
        return one
    other = at(lower + 1)
    return one if one == other else one + (place - lower) * (other - one)


def median(df: DataFrame, column: Column, **options) -> float | None:
    return quantile(df, column, 0.5, **options)
