"""Guarded arithmetic. Division never raises and never yields infinity or NaN."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """The quotient where the denominator is positive, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """The quotient, or 0.0 where the denominator is zero or missing."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))


def zero_if(condition: Column, value: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.when(condition, zero).otherwise(value)


def total(value: Column | str) -> Column:
    """A count-like sum that is 0, not NULL, over no rows. A string is a SQL expression."""
    if isinstance(value, str):
        return F.expr(f"CAST(COALESCE(SUM({value}), 0) AS BIGINT)")
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


# Amounts are added as decimals of four places, up to 1e24, so no sum depends on the order of its rows.
_MONEY = "DECIMAL(28,4)"


def money_sum(value: Column | str) -> Column:
    """The exact sum of amounts as a decimal, 0 over no rows; for sums that are summed again.

    A string is a SQL expression.
    """
    amount = F.expr(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(amount.cast(_MONEY)), F.lit(0)).cast(_MONEY)


def money_total(value: Column | str) -> Column:
    """The sum of amounts as a double, 0.0 over no rows: the exact sum, rounded to a double once."""
    return money_sum(value).cast("double")


def to_hundreds(amount: Column) -> Column:
    """Rounded to the nearest 100, ties to the even hundred."""
    return (F.rint(amount / 100) * 100).cast("bigint")


def at_least_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast("bigint"))
