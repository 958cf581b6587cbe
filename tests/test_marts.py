import pytest
from frames import rows

from stagedoor.functions.numbers import money_total
from stagedoor.operators import attendance, attribution, sales
from stagedoor.operators.staging import stg_campaigns, stg_events, stg_orders
from stagedoor.plans import extensions, growth, report
from stagedoor.plans.settings import PlanSettings


def order(n, event="E1", tier="GA", qty=1, price=10.0, code=None, status="completed", day="01"):
    return (f"O{n}", event, f"2025-07-{day} 12:00:00", tier, qty, price, code, status)


@pytest.fixture(scope="module")
def campaigns(frames):
    return stg_campaigns(
        frames.raw_campaigns(
            ("CMP-01", "One", "mail", "AAA", 10.0),
            ("CMP-02", "Twin", "mail", "BBB", 20.0),
            ("CMP-03", "Twin too", "radio", "BBB", 0.0),
            ("CMP-04", "Codeless", "fb", "", 5.0),
            ("CMP-05", "Typed low", "fb", "low", 5.0),
        )
    )


@pytest.fixture(scope="module")
def orders(frames):
    return stg_orders(
        frames.raw_orders(
            order(1, code="AAA", qty=2),
            order(2, code="aaa", qty=1),
            order(3, code=" AAA", qty=1, status="refunded"),
            order(4, code="BBB", qty=4),
            order(5, code="WHO", qty=1),
            order(6, qty=3),
            order(7, code="low", qty=1),
        )
    )


def test_campaign_performance(orders, campaigns):
    table = attribution.campaign_performance(orders, campaigns)
    got = {r.campaign_id: r for r in table.collect()}
    assert len(got) == 7
    one, twin, other = got["CMP-01"], got["CMP-02"], got["CMP-03"]
    assert (one.attributed_orders, one.tickets_sold, one.attributed_revenue) == (1, 2, 20.0)
    assert (one.cost_per_ticket, one.revenue_per_dollar) == (5.0, 2.0)
    # Two campaigns with one code are both credited; no spend means no return per dollar.
    assert twin.attributed_revenue == other.attributed_revenue == 40.0
    assert other.cost_per_ticket == 0.0 and other.revenue_per_dollar is None
    codeless = got["CMP-04"]
    assert (codeless.attributed_orders, codeless.cost_per_ticket) == (0, None)
    lost, organic = got["(unattributed)"], got["(organic)"]
    assert (lost.attributed_orders, lost.tickets_sold, lost.attributed_revenue) == (3, 3, 20.0)
    assert (organic.attributed_orders, organic.tickets_sold) == (1, 3)
    assert lost.channel == "-" and lost.revenue_per_dollar is None


def test_special_rows_exist_without_orders(orders, campaigns):
    table = attribution.campaign_performance(orders.filter("false"), campaigns)
    assert {"(unattributed)", "(organic)"} <= {r.campaign_id for r in table.collect()}
    assert table.agg({"attributed_orders": "sum"}).first()[0] == 0


def test_identical_campaign_rows_stay_apart(orders, campaigns):
    doubled = campaigns.unionByName(campaigns.filter("campaign_id = 'CMP-01'"))
    table = attribution.campaign_performance(orders, doubled)
    assert rows(table.filter("campaign_id = 'CMP-01'"), "attributed_orders") == [(1,), (1,)]


def test_returns_clean_orders_but_not_campaigns(orders, campaigns):
    got = {r.id: r for r in attribution.campaign_returns(orders, campaigns).collect()}
    one = got["CMP-01"]
    assert (one.orders, one.tickets, one.net, one.net_dirty, one.rpd) == (3, 4, 30.0, 20.0, 3.0)
    # A campaign code that is not canonical itself matches as recorded only.
    assert (got["CMP-05"].net, got["CMP-05"].net_dirty) == (0.0, 10.0)
    assert got["CMP-04"].has_code is False and got["CMP-03"].rpd == 0.0
    order_ = [r.id for r in attribution.campaign_returns(orders, campaigns).collect()]
    assert order_ == ["CMP-01", "CMP-02", "CMP-03", "CMP-04", "CMP-05"]


def test_attribution_summary(orders, campaigns):
    row = attribution.attribution_summary(orders, campaigns).first()
    assert (row.unattributed_dirty_orders, row.unattributed_dirty_net) == (3, 20.0)
    assert row.still_unattributed_net == 10.0
    assert (row.organic_orders, row.organic_tickets, row.organic_net) == (1, 3, 30.0)


def test_rollup_answers_like_orders(orders, campaigns):
    rolled = sales.sales_rollup(orders)
    for question in (
        lambda o: attribution.campaign_performance(o, campaigns),
        lambda o: attribution.campaign_returns(o, campaigns),
        lambda o: attribution.attribution_summary(o, campaigns),
        sales.daily_pacing,
        sales.sales_totals,
    ):
        assert question(rolled).collect() == question(orders).collect()
    groups = [orders.select(*keys).distinct().count() for keys in sales.GROUPINGS.values()]
    assert rolled.count() == sum(groups)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_money_is_exact_beyond_what_doubles_add(spark, parts):
    """Cents over 1e13 in all, which doubles would add differently in each order."""
    from decimal import Decimal

    amounts = [987_654_321_987.13 + i * 1_234_567.89 for i in range(400)] + [0.01, 0.07] * 50
    df = spark.createDataFrame([(a,) for a in amounts], "v double").repartition(parts)
    exact = sum(Decimal(repr(a)).quantize(Decimal("0.0001")) for a in amounts)
    assert exact > 10**13
    assert df.agg(money_total("v").alias("v")).first().v == float(exact)
    assert df.limit(0).agg(money_total("v").alias("v")).first().v == 0.0


def test_movement(spark, frames):
    returns = spark.createDataFrame(
        [("A", "a", 1000.0, 100.0, 1.0), ("B", "b", 500.0, 300.0, 2.0), ("C", "c", 900.0, 500.0, 3.0)],
        "id string, name string, net double, net_dirty double, rpd double",
    )
    schema = "unattributed_dirty_net double, still_unattributed_net double"
    lost = spark.createDataFrame([(150.0, 5.0)], schema)
    moved = attribution.attribution_movement(returns, lost).collect()
    assert [tuple(r) for r in moved] == [
        (0, "a", 100.0, 1000.0), (0, "c", 500.0, 900.0), (1, "(unattributed)", 150.0, 5.0),
    ]
    clean = attribution.attribution_movement(returns, spark.createDataFrame([(0.0, 0.0)], schema))
    assert [tuple(r) for r in clean.collect()] == [(1, "codes are already clean", None, None)]


def test_window_join_includes_both_ends(frames):
    campaigns = stg_campaigns(frames.raw_campaigns(("C1", "n", "c", "X", 10.0), ("C2", "n", "c", "", 5.0)))
    orders = stg_orders(
        frames.raw_orders(
            ("O1", "E", "2025-06-20 00:00:00", "GA", 1, 10.0, None, "completed"),
            ("O2", "E", "2025-07-08 23:59:59", "GA", 2, 10.0, None, "completed"),
            ("O3", "E", "2025-07-09 00:00:00", "GA", 4, 10.0, None, "completed"),
            ("O4", "E", "2025-06-19 23:00:00", "GA", 8, 10.0, None, "completed"),
        )
    )
    assert rows(attribution.campaign_window_reach(orders, campaigns)) == [("C1", 2, 3, 30.0)]
    assert rows(attribution.order_live_campaigns(orders, campaigns)) == [
        ("O1", 1, 10.0), ("O2", 1, 10.0), ("O3", 0, 0.0), ("O4", 0, 0.0),
    ]


def test_revenue_by_tier(frames):
    events = stg_events(
        frames.raw_events(("E1", "Show", "2025-07-01", 10), ("E2", "Show", "2025-07-02", 10))
    )
    orders = stg_orders(
        frames.raw_orders(
            order(1, qty=2), order(2, event="E2", qty=3, status="refunded"), order(3, tier="VIP"),
            order(4, event="E9", qty=50), order(5, event=None, qty=50), order(6, tier=None, qty=50),
        )
    )
    table = sales.revenue_by_tier(orders, events)
    # Unknown events and missing tiers have no part in the total; one name merges two events.
    assert rows(table) == [
        ("Show", "GA", 5, 50.0, 3, 20.0), ("Show", "VIP", 1, 10.0, 0, 10.0),
        ("TOTAL", "TOTAL", 6, 60.0, 3, 30.0),
    ]
    assert sales.total_row_reconciles(table).first().passed is True
    empty = sales.revenue_by_tier(orders.filter("false"), events)
    assert rows(empty) == [("TOTAL", "TOTAL", 0, 0.0, 0, 0.0)]
    assert sales.total_row_reconciles(table.unionByName(empty)).first().passed is False


def test_attendance(frames, spark):
    events = stg_events(
        frames.raw_events(
            ("E1", "A", "2025-07-01", 10), ("E2", "B", "2025-07-02", 10), ("E3", "C", "2025-07-03", 10)
        )
    )
    orders = stg_orders(
        frames.raw_orders(
            order(1, qty=4), order(2, qty=2, status="refunded"), order(3, event="E2", qty=1),
            order(4, event="E3", status="refunded"), order(5, status=None, qty=7),
        )
    )
    scans = frames.raw_scans(
        ("S1", "O1-T1", "O1", "E1", "t"), ("S2", "O1-T1", "O1", "E1", "t"), ("S3", "O4-T1", "O4", "E3", "t")
    )
    table = attendance.attendance_by_event(scans, orders, events)
    columns = ["event_id", "tickets_sold", "tickets_scanned", "show_up_rate", "no_shows"]
    # No scans, no row; scans without completed orders have no rate.
    assert rows(table, *columns) == [("E1", 4, 1, 0.25, 3), ("E3", 0, 1, None, -1)]


def test_report(frames, campaigns, orders, spark):
    events = stg_events(frames.raw_events(("E1", "Show", "2025-07-01", 10)))
    performance = attribution.campaign_performance(orders, campaigns)
    revenue = sales.revenue_by_tier(orders, events)
    scans = frames.raw_scans(("S1", "O1-T1", "O1", "E1", "t"))
    attended = attendance.attendance_by_event(scans, orders, events)
    kpis = dict(rows(report.box_office_report(performance, revenue, attended, capacity=13)))
    assert kpis == {
        "total_net_revenue": "$120.00",
        "tickets_sold": "13",
        "overall_show_up_rate": "8.3%",
        "best_campaign_by_revenue": "Twin",
        "best_campaign_per_dollar": "One",
        "top_tier_by_revenue": "GA",
        "sellout_events": "Show",
        "worst_no_show_event": "Show (8.3% show-up)",
    }
    full_house = report.box_office_report(performance, revenue, attended)
    assert ("sellout_events", "none") in rows(full_house)
    empty = report.headline_numbers(
        performance.filter("false"), revenue.filter("false"), attended.filter("false")
    ).first()
    assert empty.best_by_revenue is None and empty.worst_night is None and empty.total_net == 0.0


def test_event_without_orders_or_scans(frames):
    events = stg_events(frames.raw_events(("E1", "A", "2025-07-01", 10), ("E2", "B", "2025-07-02", 10)))
    orders = stg_orders(frames.raw_orders(order(1, tier="VIP", qty=2), order(2, tier="odd", qty=1)))
    results = growth.event_results(events, orders, None, PlanSettings())
    matrix = rows(growth.tier_matrix(results))
    assert ("E2", "GA", 0, 800, 0.0) in matrix and ("E1", "VIP", 2, 100, 20.0) in matrix
    assert len(matrix) == 6
    by_id = {r.id: r for r in results.collect()}
    assert by_id["E1"].sold == 3 and by_id["E2"].sold == 0 and by_id["E2"].attendance is None


def test_ticket_fanout_and_utilization(frames):
    orders = stg_orders(frames.raw_orders(order(1, qty=3), order(2, event="E2")))
    tickets = rows(extensions.ticket_fanout(orders), "ticket_id")
    assert tickets == [("O1-T1",), ("O1-T2",), ("O1-T3",), ("O2-T1",)]
    scans = frames.raw_scans(
        ("S1", "O1-T1", "O1", "E1", "t"), ("S2", "O1-T1", "O1", "E1", "t"), ("S3", "O1-T9", "O1", "E1", "t")
    )
    assert rows(extensions.pass_utilization(orders, scans)) == [
        ("E1", 3, 1, pytest.approx(1 / 3)), ("E2", 1, 0, 0.0),
    ]
