import datetime as dt
import random

from frames import rows
from pyspark.sql import functions as F

from stagedoor.operators.windows import open_on, sums_inside


def test_open_windows_and_sums_by_hand(spark):
    rng = random.Random(6)
    day0 = dt.date(2000, 1, 1)
    windows = []
    for i in range(60):
        first = day0 + dt.timedelta(rng.randrange(400))
        windows.append((f"W{i}", 10.5 * i, first, first + dt.timedelta(rng.choice([0, 1, 30, 11_000]))))
    days = [(day0 + dt.timedelta(rng.randrange(450)), rng.randrange(9), rng.randrange(999) / 4) for _ in range(200)]
    w = spark.createDataFrame(windows, "k string, spend double, first date, last date")
    d = spark.createDataFrame(days, "day date, n bigint, net double")
    per_day = d.groupBy("day").agg(F.sum("n").alias("n"), F.sum(F.col("net").cast("decimal(20,4)")).alias("net"))
    inside = [(k, sum(n for x, n, _ in days if a <= x <= b), sum(m for x, _, m in days if a <= x <= b)) for k, _, a, b in windows]
    assert [(k, n, float(m)) for k, n, m in rows(sums_inside(w, per_day, ["n", "net"], "k"))] == sorted(inside)
    expected = []
    for x in sorted({x for x, _, _ in days}):
        live = [s for _, s, a, b in windows if a <= x <= b]
        expected.append((x, len(live), sum(live)))
    assert rows(open_on(d, w, F.col("spend"))) == expected


def test_no_windows_and_no_days(spark):
    w = spark.createDataFrame([("W", 1.0, dt.date(2000, 1, 1), dt.date(2030, 1, 1))], "k string, spend double, first date, last date")
    d = spark.createDataFrame([(dt.date(1999, 1, 1), 5)], "day date, n bigint")
    assert rows(sums_inside(w, d, ["n"], "k")) == [("W", 0)]
    assert rows(open_on(d, w.limit(0), F.col("spend"))) == [(dt.date(1999, 1, 1), 0, 0.0)]
    assert sums_inside(w.limit(0), d, ["n"], "k").collect() == []
