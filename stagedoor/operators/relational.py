"""Relational building blocks shared by the marts."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from stagedoor.functions.numbers import money_total, total


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in the given order.

    The remaining columns break ties, so the survivor does not depend on partitioning. Spark cuts
    each key to one row per map task before the shuffle (window group limit), so a key that holds
    most of the rows does not land in one task.
    """
    rest = [name for name in df.columns if name not in {*keys, *order}]
    by = [F.col(name).asc_nulls_last() for name in [*order, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def with_known_key(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key exists in the parent; a NULL key does not."""
    return child.join(parent.select(key), key, "left_semi")


def with_unknown_key(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is NULL or missing in the parent."""
    return child.join(parent.select(key), key, "left_anti")


def key_difference(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys that the parent lacks."""
    return with_unknown_key(child.select(key).distinct(), parent, key)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames.

    A union of single rows folded by one aggregate, which needs no cross join.
    """
    stacked = union_by_name(*one_row_frames)
    return stacked.agg(*[F.first(name, ignorenulls=True).alias(name) for name in stacked.columns])


def with_grand_total(
    df: DataFrame, labels: list[str], measures: list[str], word: str = "TOTAL"
) -> DataFrame:
    """The rows of a grouped table plus one row with the sums over all of them.

    Runs on the grouped table, not on its source, so the doubling done by grouping sets is cheap.
    The total row exists even over no rows: a seed row of zeros, removed again at detail level,
    makes sure of it. Real rows never have a NULL label. Decimal measures are summed exactly and become doubles.
    """
    spark = df.sparkSession
    seed = spark.range(1).select(
        *[F.lit(None).cast(df.schema[name].dataType).alias(name) for name in labels],
        *[F.lit(0).cast(df.schema[name].dataType).alias(name) for name in measures],
    )
    rows = df.filter(" AND ".join(f"`{name}` IS NOT NULL" for name in labels))
    grouped = (
        rows.select(*labels, *measures)
        .unionByName(seed)
        .groupingSets([[F.col(name) for name in labels], []], *labels)
        .agg(
            F.grouping_id().alias("_level"),
            *[
                (money_total if isinstance(df.schema[name].dataType, (DoubleType, DecimalType)) else total)(
                    F.col(name)
                ).alias(name)
                for name in measures
            ],
        )
    )
    is_total = F.col("_level") > 0
    return grouped.filter(is_total | F.col(labels[0]).isNotNull()).select(
        *[
            F.when(is_total, F.lit(word)).otherwise(F.col(name).cast("string")).alias(name)
            for name in labels
        ],
        *measures,
    )


def first_row_by(value: Column, *order: Column, where: Column | None = None) -> Column:
    """Aggregate: ``value`` of the row that comes first in ``order``; rows failing ``where`` do not count.

    Pass ``-column`` for a descending key. A row whose first key is NULL never wins.
    """
    usable = order[0].isNotNull() if where is None else where & order[0].isNotNull()
    return F.min_by(value, F.when(usable, F.struct(*order)))


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with that difference; empty if nothing changed.

    One shuffle over both snapshots, duplicates combined before it.
    """
    names = before.columns
    tagged = before.withColumn("_copies", F.lit(-1)).unionByName(
        after.select(*names).withColumn("_copies", F.lit(1))
    )
    counted = tagged.groupBy(*names).agg(F.sum("_copies").alias("copies_added"))
    return counted.filter("copies_added <> 0")


def has_changed(before: DataFrame, after: DataFrame) -> bool:
    return not changed_rows(before, after).isEmpty()
