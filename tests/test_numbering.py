import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from stagedoor.operators.numbering import numbered, running_totals


def by_hand(data, key):
    out, seen = [], {}
    for row in sorted(data, key=key):
        place = seen.get(row[0], 0)
        seen[row[0]] = place + 1
        out.append((*row, place))
    return out


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_places_within_groups(spark, partitions):
    rng = random.Random(1)
    data = [(rng.choice(["a", "a", "a", "b", None, f"g{rng.randrange(99)}"]), i) for i in range(3_000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, v int").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = numbered(df, [F.col("v")], ["g"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = by_hand(data, lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_places_of_a_whole_table(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("v"), F.lit("x").alias("place"), F.lit(1).alias("tie"))
    found = numbered(df, [F.col("v").desc()], name="rank")
    assert rows(found, "v", "rank") == [(v, 4_999 - v) for v in range(5_000)]


def test_ties_get_places_of_their_own(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(None,)] * 3, "v int")
    found = numbered(df, [F.col("v").asc_nulls_last()])
    assert sorted(r.place for r in found.filter("v = 1").collect()) == list(range(50))
    assert sorted(r.place for r in found.filter("v is null").collect()) == [50, 51, 52]


def test_an_empty_table_stays_empty(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert numbered(df, [F.col("v")]).collect() == []
    assert numbered(df, [F.col("v")], ["g"]).collect() == []


@pytest.mark.parametrize("within", [[], ["g"]])
def test_running_totals(spark, within):
    rng = random.Random(4)
    data = [(rng.choice(["a", "a", "b", None]), i, rng.choice([None, 1, 2, -3])) for i in range(2_000)]
    df = spark.createDataFrame(data, "g string, v int, n bigint").repartition(5)
    found = running_totals(df, [F.col("v")], {"so_far": F.col("n"), "money": F.col("n").cast("decimal(20,2)")}, within)
    sums, expected = {}, []
    for g, v, n in data:
        key = g if within else None
        sums[key] = sums.get(key, 0) + (n or 0)
        expected.append((v, sums[key], sums[key]))
    assert sorted((r.v, r.so_far, int(r.money)) for r in found.collect()) == expected
    assert running_totals(df.limit(0), [F.col("v")], {"so_far": F.col("n")}, within).collect() == []
