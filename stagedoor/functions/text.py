"""Text columns: code cleaning, identifiers, display strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as surrounding whitespace (tabs, line ends, control
# separators and every Unicode space), wider than the plain space that SQL trim() removes.
_SPACE = r"[\s\p{Z}\x1c-\x1f\x85]+"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_SPACE}|{_SPACE}$", "")


def normalize_code(code: Column) -> Column:
    """Canonical promo code: no surrounding whitespace, upper case; NULL stays NULL."""
    return F.upper(strip(code))


def blank_to_null(text: Column) -> Column:
    """Only the empty string becomes NULL; a string of blanks stays."""
    return F.nullif(text, F.lit(""))


def ticket_number(ticket_id: Column) -> Column:
    """The n of a ``<order>-T<n>`` ticket id, NULL for any other id."""
    digits = F.regexp_extract(ticket_id, r"-T(\d+)$", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def file_date(file_name: Column) -> Column:
    """The date part of a ``ticket_scans_<date>.csv`` file name."""
    return F.regexp_extract(file_name, r"ticket_scans_(.+)\.csv$", 1)


def quoted(text: Column) -> Column:
    """Quotes around a value, with tabs and line ends made visible."""
    shown = text
    for character, escape in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        shown = F.replace(shown, F.lit(character), F.lit(escape))
    return F.concat(F.lit("'"), shown, F.lit("'"))


def joined_or_none(names: Column) -> Column:
    """An array of names as one sorted, comma-separated string; ``none`` if empty."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(names), ", "), F.lit("")), F.lit("none"))


def dollars(amount: Column, decimals: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, decimals))


def thousands(count: Column) -> Column:
    return F.format_number(count, 0)


def percent(rate: Column, decimals: int = 1) -> Column:
    return F.format_string(f"%.{decimals}f%%", rate * 100)
