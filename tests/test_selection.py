import math
import random

import pytest
from pyspark.sql import functions as F

from stagedoor.operators.selection import median, quantile


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


@pytest.mark.parametrize(
    "values",
    [
        [1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 9, [1e308, -1e308, 0.0], [float("nan"), 1.0, 2.0], [float("nan")],
        [float("inf"), 1.0, -float("inf"), 7.0], [0.1 * i for i in range(101)], [1e-300 * i for i in range(50)] + [1e300],
    ],
)
def test_equals_the_built_in_median(spark, values):
    df = frame(spark, [*values, None])
    expected = df.agg(F.median("v")).first()[0]
    found = median(df, F.col("v"), bins=4, listed=2)
    assert found == expected or math.isnan(found) and math.isnan(expected)


def test_no_values(spark):
    assert median(frame(spark, [None]), F.col("v")) is None
    assert median(frame(spark, []), F.col("v")) is None


@pytest.mark.parametrize("share", [0.0, 0.05, 0.25, 0.5, 0.9, 1.0])
def test_quantiles_of_skewed_values(spark, share):
    rng = random.Random(2)
    df = frame(spark, [rng.choice([7.0, 7.0, rng.paretovariate(0.7), -rng.random()]) for _ in range(5_001)])
    assert quantile(df, F.col("v"), share, bins=16, listed=10) == pytest.approx(df.agg(F.percentile("v", share)).first()[0], rel=1e-12)


def test_ten_million_rows(spark):
    """Heavy tail, a third of all rows equal; no task lists more than a few thousand values."""
    id = F.col("id")
    value = F.when(id % 3 == 0, F.lit(12.5)).otherwise(F.pow(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000.0, F.lit(2)))
    df = spark.range(10_000_000).select(value.alias("v"))
    assert median(df, F.col("v")) == df.agg(F.median("v")).first()[0]
