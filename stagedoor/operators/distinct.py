"""Exact distinct counts that add up: bitmaps per slice.

Counts of distinct things don't add up, sets of them do. A slice holds its set as bitmaps over whole-number ids, 4 KiB
for each 32,768 ids that occur near each other; larger units are the bitmaps of their slices
or-ed together, so months give years and venues give a total without going back to the rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.operators.numbering import numbered, unused_names


def distinct_slices(df: DataFrame, keys: list[str], id: Column) -> DataFrame:
    """(keys, bucket, bitmap) of non-negative whole-number ids; rows without an id are left out.

    A slice with many ids has many buckets, so no row grows beyond a bitmap.
    """
    number = id.cast("bigint")
    rows = df.select(*keys, number.alias("_id")).filter("_id is not null")
    return rows.groupBy(*keys, F.expr("bitmap_bucket_number(_id)").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bitmap")
    )


def distinct_counts(slices: DataFrame, keys: list[str], name: str = "distinct_count") -> DataFrame:
    """(keys, count) for any keys of slices, or one row for none."""
    merged = slices.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias(name))


def with_dense_ids(df: DataFrame, column: str, name: str = "dense_id") -> DataFrame:
    """``df`` with a whole number for every distinct value of ``column``, from 0 without gaps; null has none.

    Dense numbers keep bitmaps full. Values are counted off by range, see :mod:`stagedoor.operators.numbering`.
    """
    (value,) = unused_names(df, "value")
    distinct = df.select(F.col(column).alias(value)).filter(F.col(value).isNotNull()).distinct()
    ids = numbered(distinct, [F.col(value)], name=name)
    return df.join(ids, F.col(column) == F.col(value), "left").drop(value)
