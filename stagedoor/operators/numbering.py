"""Places in a total order, counted by all tasks together."""

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stagedoor.session import settle

# Fixed value: monotonically_increasing_id holds the partition above 33 bits of row number.
_ROW_BITS = 33


def unused_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


@dataclass(frozen=True)
class _Dealt:
    """Rows dealt by range and written in order: ``mark`` ascends with the order, ``part`` is the partition."""

    rows: DataFrame
    mark: str
    part: str
    keys: list[str]

    def place_of_starts(self) -> Column:
        """Rows meet the ``starts`` of their partition and group."""
        same = F.col(f"rows.{self.part}") == F.col(f"starts.{self.part}")
        for k in self.keys:
            same = same & F.col(f"rows.{k}").eqNullSafe(F.col(f"starts.{k}"))
        return same

    def with_earlier(self, sums: DataFrame, names: list[str]) -> DataFrame:
        """``sums``, a row for a partition and group, with each of ``names`` summed over earlier partitions instead."""
        zero = {n: F.lit(0).cast(sums.schema[n].dataType) for n in names}
        if self.keys:
            # A group has at most a row for each partition here.
            earlier = Window.partitionBy(*self.keys).orderBy(self.part).rowsBetween(Window.unboundedPreceding, -1)
            return sums.withColumns({n: F.coalesce(F.sum(n).over(earlier).cast(sums.schema[n].dataType), zero[n]) for n in names})
        so_far, out = dict.fromkeys(names, 0), []
        for row in sums.orderBy(self.part).collect():  # one row a partition
            out.append(tuple(so_far[c] if c in so_far else row[c] for c in sums.columns))
            for n in names:
                so_far[n] += row[n] or 0
        as_is = [tuple(Decimal(v) if isinstance(f.dataType, DecimalType) else v for v, f in zip(r, sums.schema, strict=True)) for r in out]
        return sums.sparkSession.createDataFrame(as_is, sums.schema)


def _deal(df: DataFrame, order: Sequence[Column], within: Sequence[str]) -> _Dealt:
    tie, mark, part = unused_names(df, "tie", "mark", "part")
    keys = [f"`{c}`" for c in within]
    sort = [*(F.col(k).asc_nulls_first() for k in keys), *order, F.col(tie)]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*sort)
    sorted_rows = dealt.sortWithinPartitions(*sort).withColumn(mark, F.monotonically_increasing_id())
    rows = settle(sorted_rows.drop(tie).withColumn(part, F.shiftright(mark, _ROW_BITS)), "numbered")
    return _Dealt(rows, mark, part, keys)


def numbered(
    df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "place"
) -> DataFrame:
    """``df`` with ``name``: how many rows come before a row, in ``order``, in its group of ``within``.

    Rows are dealt by range and sorted where they are; then the counts of earlier partitions are added.
    What meets is one count a partition, or a partition and group, never the rows, so neither
    a large table nor a group that holds most of it lands in one task.

    - Rows that ``order`` doesn't tell apart get different places, in an arbitrary but lasting order.
    - Nulls of ``within`` form a group. An empty table stays empty.
    """
    dealt = _deal(df, order, within)
    counts = dealt.rows.groupBy(dealt.part, *dealt.keys).agg(F.min(dealt.mark).alias("first"), F.count("*").alias("before"))
    starts = dealt.with_earlier(settle(counts, "counts"), ["before"]).alias("starts")
    placed = dealt.rows.alias("rows").join(starts, dealt.place_of_starts())
    own = [F.col(f"rows.`{c}`") for c in df.columns]
    place = F.col(f"rows.{dealt.mark}") - F.col("starts.first") + F.col("starts.before")
    return placed.select(*own, place.alias(name))


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: dict[str, Column], within: Sequence[str] = ()
) -> DataFrame:
    """``df`` with, for each name of ``sums``, the sum of its column over all rows up to and including a row.

    Rows are dealt as by :func:`numbered`: sums run within a partition, and those of the earlier partitions are
    added. Nulls add nothing. Rows that ``order`` doesn't tell apart follow each other in a lasting order.
    """
    names = list(sums)
    dealt = _deal(df.withColumns(sums), order, within)
    whole = dealt.rows.groupBy(dealt.part, *dealt.keys).agg(*(F.sum(n).alias(n) for n in names))
    starts = dealt.with_earlier(settle(whole, "sums"), names).alias("starts")
    here = Window.partitionBy(dealt.part, *dealt.keys).orderBy(dealt.mark).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    ran = dealt.rows.withColumns({n: F.coalesce(F.sum(n).over(here), zero.cast(dealt.rows.schema[n].dataType)) for n in names})
    placed = ran.alias("rows").join(starts, dealt.place_of_starts())
    own = [F.col(f"rows.`{c}`") for c in df.columns if c not in sums]
    return placed.select(*own, *((F.col(f"rows.{n}") + F.coalesce(F.col(f"starts.{n}"), zero)).alias(n) for n in names))
