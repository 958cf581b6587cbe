import datetime as dt

from frames import rows
from pyspark.sql import functions as F

from stagedoor.functions.text import (
    blank_to_null,
    file_date,
    joined_or_none,
    normalize_code,
    quoted,
    ticket_number,
)
from stagedoor.functions.numbers import money_total, ratio_or_null, ratio_or_zero, to_hundreds
from stagedoor.functions.dates import season_label
from stagedoor.operators.relational import changed_rows, has_changed, key_difference, side_by_side
from stagedoor.operators.staging import (
    observed_scans,
    scan_drop_counts,
    stg_campaigns,
    stg_events,
    stg_orders,
    stg_ticket_scans,
)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_normalize_code_strips_every_kind_of_space(spark):
    codes = [" SUMMER25", "summer25", "VIPNIGHT ", "Summer25", "\tSUMMER25\n", " x ", None]
    assert column(spark, codes, "string", normalize_code) == [
        "SUMMER25", "SUMMER25", "VIPNIGHT", "SUMMER25", "SUMMER25", "X", None,
    ]


def test_only_the_empty_string_is_blank(spark):
    assert column(spark, ["", " ", "A"], "string", blank_to_null) == [None, " ", "A"]


def test_ticket_number_and_file_date(spark):
    ids = ["ORD-1-T12", "ORD-1-T", "ORD-1", None]
    assert column(spark, ids, "string", ticket_number) == [12, None, None, None]
    assert column(spark, ["ticket_scans_2025-07-03.csv"], "string", file_date) == ["2025-07-03"]


def test_quoted_shows_hidden_characters(spark):
    assert column(spark, [" a\t"], "string", quoted) == ["' a\\t'"]


def test_rounding_to_hundreds_is_half_even(spark):
    values = [250.0, 350.0, 8329.78, -40.0]
    assert column(spark, values, "double", to_hundreds) == [200, 400, 8300, 0]


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 0.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = df.select(ratio_or_null(a, b), ratio_or_zero(a, b)).collect()
    assert [tuple(r) for r in got] == [(None, 0.0), (0.5, 0.5), (None, 0.0)]


def test_money_total_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1 * i,) for i in range(1000)], "v double")
    sums = {df.repartition(n).agg(money_total("v")).first()[0] for n in (1, 3, 8)}
    assert sums == {49950.0}
    assert df.filter("v < 0").agg(money_total("v")).first()[0] == 0.0


def test_season_label_forms(spark):
    def label(first, last):
        df = spark.createDataFrame([(first, last)], "a date, b date")
        return df.select(season_label(F.col("a"), F.col("b"))).first()[0]

    july = dt.date(2025, 7, 1)
    assert label(july, dt.date(2025, 7, 8)) == "Summer season, July 1–8 2025"
    assert label(july, dt.date(2025, 8, 2)) == "Summer season, Jul 1 – Aug 2 2025"
    assert label(None, None) == "Summer season"


def test_joined_or_none(spark):
    df = spark.createDataFrame([(["b", "a"],), ([],)], "v array<string>")
    assert [r[0] for r in df.select(joined_or_none(F.col("v"))).collect()] == ["a, b", "none"]


def test_orders_are_filtered_and_priced(frames):
    raw = frames.raw_orders(
        ("O1", "E1", "2025-07-01 10:00:00", "GA", 2, 10.0, " x", "completed"),
        ("O2", "E1", "2025-07-01 11:00:00", "GA", 3, 10.0, None, "refunded"),
        ("O3", "E1", "2025-07-02 11:00:00", "GA", 1, 10.0, "X", None),
        ("O4", "E1", "2025-07-02 11:00:00", "GA", 0, 10.0, "X", "completed"),
        ("O5", "E1", "2025-07-02 11:00:00", "GA", -1, 10.0, "X", "completed"),
        ("O6", "E1", "2025-07-02 11:00:00", "GA", 1, 0.0, "X", "completed"),
        ("O7", "E1", "2025-07-02 11:00:00", "GA", None, 5.0, "X", "completed"),
    )
    wanted = ["order_id", "order_date", "gross_revenue", "net_revenue"]
    assert rows(stg_orders(raw), *wanted) == [
        ("O1", "2025-07-01", 20.0, 20.0),
        ("O2", "2025-07-01", 30.0, 0.0),
        ("O3", "2025-07-02", 10.0, 10.0),
    ]
    assert rows(stg_orders(raw).filter("order_id = 'O1'"), "promo_code") == [(" x",)]
    assert rows(stg_orders(raw, normalize=True).filter("order_id = 'O1'"), "promo_code") == [("X",)]


def test_campaigns_and_events_are_typed(frames):
    campaign = stg_campaigns(frames.raw_campaigns(("CMP-04", "R", "fb", "", 950.0))).first()
    assert campaign.promo_code is None and campaign.starts_on == dt.datetime(2025, 6, 20)
    event = stg_events(frames.raw_events(("EV-01", "A", "2025-07-01", 1200))).first()
    assert event.show_ts == dt.datetime(2025, 7, 1, 20)


def scan_fixture(frames):
    orders = stg_orders(
        frames.raw_orders(
            ("O1", "E1", "2025-07-01", "GA", 2, 10.0, None, "completed"),
            ("O2", "E1", "2025-07-01", "GA", 2, 10.0, None, "refunded"),
            ("O3", "E1", "2025-07-01", "GA", 0, 10.0, None, "completed"),
        )
    )
    scans = frames.raw_scans(
        ("S5", "O1-T1", "O1", "E1", "2025-07-01 19:00:00"),
        ("S1", "O1-T1", "O1", "E1", "2025-07-01 19:02:00"),
        ("S4", "O1-T2", "O1", "E1", "2025-07-01 19:01:00"),
        ("S3", "O1-T2", "O1", "E1", "2025-07-01 19:01:00"),
        ("S6", "O2-T1", "O2", "E1", "2025-07-01 19:01:00"),
        ("S7", "O3-T1", "O3", "E1", "2025-07-01 19:01:00"),
        ("S8", "O9-T1", "O9", "E1", "2025-07-01 19:01:00"),
        ("S9", "O9-T1", "O9", "E1", "2025-07-01 19:03:00"),
        ("SA", None, None, "E1", "2025-07-01 19:03:00"),
        ("SB", None, None, "E1", "2025-07-01 19:04:00"),
    )
    return scans, orders


def test_first_scan_wins_then_orphans_go(frames):
    scans, orders = scan_fixture(frames)
    # An equal second is decided by the scan id; an order dropped by staging orphans its scans, a
    # refunded one does not.
    assert rows(stg_ticket_scans(scans, orders), "scan_id") == [("S3",), ("S5",), ("S6",)]


def test_drop_counters(frames):
    scans, orders = scan_fixture(frames)
    assert tuple(scan_drop_counts(scans, orders).first()) == (10, 4, 3, 3)
    staged, marks = observed_scans(scans, orders)
    assert staged.count() == 3
    assert [m.get["rows"] for m in marks.values()] == [10, 6, 3]


def test_rejoins_count_per_session(frames):
    scans = frames.raw_scans(
        ("S1", "O1-T1", "O1", "E1", "2025-07-01 19:00:00"),
        ("S2", "O1-T1", "O1", "E2", "2025-07-02 19:00:00"),
        ("S3", "O1-T1", "O1", "E2", "2025-07-02 19:05:00"),
    )
    _, orders = scan_fixture(frames)
    staged = stg_ticket_scans(scans, orders, person_keys=("ticket_id", "event_id"))
    assert rows(staged, "scan_id") == [("S1",), ("S2",)]


def test_a_hot_ticket_keeps_its_first_scan(spark):
    from stagedoor.operators.relational import keep_first

    many = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(20000) - F.col("id")).alias("at"),
        F.col("id"),
    )
    first = keep_first(many.repartition(8), ["k"], ["at"])
    assert first.count() == many.select("k").distinct().count()
    assert first.filter("k = 'hot'").first().id == 19998


def test_changed_rows_counts_copies(spark):
    before = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    after = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    assert rows(changed_rows(before, after)) == [("a", 1, -1), ("b", 3, 1)]
    assert not has_changed(before, before.repartition(3))


def test_key_difference_and_side_by_side(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert rows(key_difference(child, parent, "k")) == [("b",)]
    row = side_by_side(child.agg(F.count("*").alias("n")), parent.agg(F.max("k").alias("m"))).first()
    assert (row.n, row.m) == (3, "a")
