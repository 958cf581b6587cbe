import pytest

from stagedoor.operators import checks
from stagedoor.operators.staging import stg_campaigns, stg_events, stg_orders


def order(n, code="AAA", event="E1", qty=2, price=10.0, status="completed"):
    return (n, event, f"2025-07-0{n[-1]} 12:00:00", "GA", qty, price, code, status)


@pytest.fixture(scope="module")
def orders(frames):
    return stg_orders(frames.raw_orders(order("O1"), order("O2", " aaa"), order("O3", "WHO\t")))


def test_amounts(frames, orders):
    assert checks.evaluate(checks.order_amounts_valid(orders)).passed
    doubled = checks.evaluate(checks.order_amounts_valid(orders.unionByName(orders.limit(1))))
    assert not doubled.passed and doubled.metrics["duplicate_order_ids"] == 1
    raw = frames.raw_orders(
        order("O1", qty=0), order("O2", price=-1.0), (None, "E", "2025-07-01", "GA", 1, 1.0, None, "x"),
        (None, "E", "2025-07-01", "GA", 1, 1.0, None, "x"),
    ).selectExpr("*", "qty * unit_price_usd AS net_revenue")
    bad = checks.evaluate(checks.order_amounts_valid(raw)).metrics
    assert bad == {
        "bad_qty_rows": 1, "bad_price_rows": 1, "negative_net_revenue_rows": 1, "duplicate_order_ids": 1,
    }
    assert checks.evaluate(checks.order_amounts_valid(orders.filter("false"))).passed


def test_known_events(frames, orders):
    events = stg_events(frames.raw_events(("E1", "A", "2025-07-01", 10)))
    assert checks.evaluate(checks.orders_reference_known_events(orders, events)).passed
    lost = stg_orders(frames.raw_orders(order("O1", event="E9"), order("O2", event=None)))
    result = checks.evaluate(checks.orders_reference_known_events(lost, events))
    assert not result.passed and result.metrics["orders_with_unknown_event"] == 2


def test_promo_codes(frames, orders):
    campaigns = stg_campaigns(frames.raw_campaigns(("CMP-01", "One", "mail", "AAA", 10.0)))
    result = checks.evaluate(checks.all_promo_orders_attributed(orders, campaigns))
    assert not result.passed and not result.blocking and result.severity == "ERROR"
    assert result.metrics["unattributed_orders"] == 2
    assert result.metrics["unattributed_revenue"] == 40.0
    assert result.metrics["sample_bad_codes"] == "' aaa', 'WHO\\t'"
    known = orders.filter("order_id = 'O1'")
    assert checks.evaluate(checks.all_promo_orders_attributed(known, campaigns)).passed
    assert checks.evaluate(checks.promo_codes_canonical(orders)).metrics["dirty_code_orders"] == 2


@pytest.mark.parametrize(
    "table, passed",
    [
        ([(10, 8, 0.8), (10, 6, 0.6)], True),
        ([(10, 2, 0.2)], False),
        ([(10, 8, 0.8), (0, 1, None)], False),
        ([], False),
    ],
)
def test_show_up_rate(spark, table, passed):
    df = spark.createDataFrame(
        table, "tickets_sold bigint, tickets_scanned bigint, show_up_rate double"
    )
    result = checks.evaluate(checks.show_up_rate_in_bounds(df))
    assert result.passed is passed and result.severity == "WARN"


def test_ticket_integrity(frames, orders):
    good = frames.raw_scans(("S1", "O1-T2", "O1", "E1", "t"), ("S2", "O9-T1", "O9", "E1", "t"))
    result = checks.evaluate(checks.ticket_integrity(good, orders))
    assert result.passed and result.metrics["orphan_scans"] == 1
    bad = frames.raw_scans(("S1", "O1-T3", "O1", "E2", "t"), ("S2", "O1", "O1", "E1", "t"))
    metrics = checks.evaluate(checks.ticket_integrity(bad, orders)).metrics
    assert (metrics["event_mismatches"], metrics["tickets_out_of_range"]) == (1, 2)
    refunded = stg_orders(frames.raw_orders(order("O1", status="refunded")))
    assert not checks.evaluate(checks.ticket_integrity(good, refunded)).passed


def test_gate(orders):
    fine = checks.order_amounts_valid(orders)
    warned = checks.promo_codes_canonical(orders)
    assert [r.passed for r in checks.gate(fine, warned)] == [True, False]
    with pytest.raises(checks.BlockedByCheck) as caught:
        checks.gate(checks.order_amounts_valid(orders.unionByName(orders)), warned)
    assert caught.value.result.metrics["duplicate_order_ids"] == 3
