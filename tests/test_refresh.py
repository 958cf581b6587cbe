import json

import pytest
from frames import rows

from stagedoor.operators.checks import BlockedByCheck
from stagedoor.plans.refresh import Sources, Targets, refresh_admissions, refresh_all
from stagedoor.sources.files import adhoc_sql, register_tables, table_input

CAMPAIGNS = """campaign_id,name,channel,promo_code,spend_usd,starts_on,ends_on
CMP-01,Kickoff,mail,SUMMER25,10.00,2025-06-18,2025-07-08
CMP-02,Radio,radio,ONAIR,20.00,2025-06-18,2025-07-08
CMP-03,Blitz,fb,,5.00,2025-06-18,2025-07-08
"""
EVENTS = """event_id,event_name,genre,event_date,capacity,doors_time,show_time
EV-01,First,jazz,2025-07-01,10,19:00,20:00
EV-02,Second,folk,2025-07-02,10,19:00,20:00
"""
ORDERS = """order_id,event_id,ordered_at,tier,qty,unit_price_usd,promo_code,status
ORD-1,EV-01,2025-06-20 10:00:00,GA,4,10.00,SUMMER25,completed
ORD-2,EV-01,2025-06-20 11:00:00,VIP,2,30.00, summer25,completed
ORD-3,EV-02,2025-06-21 11:00:00,GA,2,10.00,ONAIR,refunded
ORD-4,EV-02,2025-06-22 11:00:00,GA,3,10.00,,completed
ORD-5,EV-02,2025-06-22 11:00:00,GA,0,10.00,,completed
"""
NIGHT_1 = """scan_id,ticket_id,order_id,event_id,gate,scanned_at
SCN-1,ORD-1-T1,ORD-1,EV-01,MAIN-1,2025-07-01 19:00:00
SCN-2,ORD-1-T1,ORD-1,EV-01,MAIN-1,2025-07-01 19:01:00
SCN-3,ORD-1-T2,ORD-1,EV-01,MAIN-1,2025-07-01 19:02:00
SCN-4,ORD-2-T1,ORD-2,EV-01,MAIN-2,2025-07-01 19:02:00
SCN-5,ORD-9-T1,ORD-9,EV-01,MAIN-2,2025-07-01 19:02:00
"""
NIGHT_2 = """scan_id,ticket_id,order_id,event_id,gate,scanned_at
SCN-6,ORD-4-T1,ORD-4,EV-02,MAIN-1,2025-07-02 19:00:00
"""


@pytest.fixture
def delivered(tmp_path):
    def build(orders=ORDERS):
        for name, text in (("campaigns", CAMPAIGNS), ("events", EVENTS), ("orders", orders)):
            path = tmp_path / f"raw/{name}.csv"
            path.parent.mkdir(exist_ok=True)
            path.write_text(text)
        (tmp_path / "scans").mkdir()
        (tmp_path / "scans/ticket_scans_2025-07-01.csv").write_text(NIGHT_1)
        sources = Sources(str(tmp_path / "raw"), str(tmp_path / "scans"), str(tmp_path / "nights"))
        targets = Targets(str(tmp_path / "house"), str(tmp_path / "report"), capacity=6)
        return tmp_path, sources, targets

    return build


def test_full_and_partial_refresh(spark, delivered):
    root, sources, targets = delivered()
    run = refresh_all(spark, sources, targets)
    assert {c.check_name: c.passed for c in run.checks} == {
        "order_amounts_valid": True,
        "orders_reference_known_events": True,
        "all_promo_orders_attributed": False,
        "show_up_rate_in_bounds": True,
    }
    assert run.metrics["stg_orders"] == {"row_count": 4, "refunded_orders": 1}
    assert run.metrics["stg_ticket_scans"] == {
        "row_count": 3, "duplicate_scans_dropped": 1, "orphan_scans_dropped": 1,
    }
    assert run.metrics["campaign_performance"] == {"row_count": 5, "top_campaign": "Kickoff"}
    assert run.metrics["revenue_by_tier"]["total_net_revenue"] == 130.0
    assert run.metrics["raw_ticket_scans"] == {
        "files_ingested": 1, "latest_file": "ticket_scans_2025-07-01.csv", "row_count": 5,
    }
    assert run.metrics["attendance_by_event"]["overall_show_up_rate"] == 0.5
    house = targets.warehouse
    kpis = dict(rows(table_input(spark, house, "box_office_report")))
    assert kpis["sellout_events"] == "First" and kpis["best_campaign_by_revenue"] == "Kickoff"
    first = (root / "report/data.json").read_bytes()
    script = (root / "report/data.js").read_text()
    document = json.loads(first)
    assert script.startswith("//") and f"window.BOXOFFICE_DATA = {first.decode().strip()};" in script
    assert list(document) == [
        "season", "goal", "totals", "attribution", "derived", "events", "daily", "campaigns",
        "levers", "levers_total",
    ]
    assert document["events"][1]["attendance"] is None
    assert document["events"][0]["tiers"]["VIP"] == {"sold": 2, "cap": 100, "net": 60.0}
    assert [lever["key"] for lever in document["levers"]] == ["soft_night", "vip", "realloc", "refunds"]
    assert document["attribution"]["still_unattributed_net"] == 0.0

    assert run.metrics["document"]["changed_files"] == 2
    again = refresh_admissions(spark, sources, targets)
    assert again.metrics["document"]["changed_files"] == 0
    assert (root / "report/data.json").read_bytes() == first
    (root / "scans/ticket_scans_2025-07-02.csv").write_text(NIGHT_2)
    partial = refresh_admissions(spark, sources, targets)
    assert partial.metrics["attendance_by_event"]["row_count"] == 2
    assert "stg_orders" not in partial.metrics
    changed = json.loads((root / "report/data.json").read_text())
    assert changed["season"]["nights_scanned"] == 2
    register_tables(spark, house, ["refresh_metrics"])
    trend = adhoc_sql(spark, "SELECT value FROM refresh_metrics WHERE metric = 'overall_show_up_rate'")
    assert trend.count() == 3 and dict(trend.dtypes) == {"value": "double"}
    stored = {r.metric: r.value for r in table_input(spark, house, "refresh_metrics").filter("table_name = 'document'").collect()}
    assert stored["events"] == 2 and stored["campaigns"] == 3
    assert stored["levers_total"] == changed["levers_total"]
    assert stored["unattributed_net"] == changed["attribution"]["unattributed_dirty_net"]
    assert table_input(spark, house, "check_results").count() == 4 + 1 + 1
    assert table_input(spark, house, "ingest_manifest").count() == 2
    assert table_input(spark, house, "executive_summary").first().summary.startswith("Season to date: 11 tickets")
    assert table_input(spark, house, "summary_top_campaigns").count() == 5


def test_normalized_codes_pass_the_check(spark, delivered):
    _, sources, targets = delivered()
    fixed = Targets(targets.warehouse, capacity=6, normalize_codes=True)
    run = refresh_all(spark, sources, fixed)
    assert all(check.passed for check in run.checks)


def test_blocking_check_stops_after_its_table(spark, delivered):
    repeated = ORDERS + ORDERS.splitlines(keepends=True)[1]
    root, sources, targets = delivered(repeated)
    with pytest.raises(BlockedByCheck):
        refresh_all(spark, sources, targets)
    assert (root / "house/stg_orders").exists()
    assert not (root / "house/campaign_performance").exists()
    verdicts = dict(rows(table_input(spark, targets.warehouse, "check_results"), "check_name", "passed"))
    assert verdicts == {"order_amounts_valid": False, "orders_reference_known_events": True}
    assert table_input(spark, targets.warehouse, "refresh_metrics").count() > 0


def test_partial_refresh_needs_a_full_one(spark, delivered):
    _, sources, targets = delivered()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        refresh_admissions(spark, sources, targets)


def test_sections_are_an_explicit_choice(spark, delivered):
    from stagedoor.plans.payload import PayloadParts
    from stagedoor.sinks.documents import export_sections

    root, sources, targets = delivered()
    refresh_all(spark, sources, targets)
    orders, events, campaigns, attendance = (
        table_input(spark, targets.warehouse, n)
        for n in ("stg_orders", "stg_events", "stg_campaigns", "attendance_by_event")
    )
    export_sections(PayloadParts(orders, events, campaigns, lambda _: attendance), str(root / "sections"))
    assert rows(spark.read.json(str(root / "sections/events")), "id") == [("EV-01",), ("EV-02",)]
    assert (root / "report/data.json").exists()


def test_query_tool_prints_every_row(spark, tmp_path, capsys, monkeypatch):
    from stagedoor.sources import query_tool

    monkeypatch.setattr(query_tool, "build_session", lambda name: spark)
    assert query_tool.main([str(tmp_path / "none"), "SELECT 1"]) == 1
    spark.range(1_500).write.parquet(str(tmp_path / "house/numbers"))
    assert query_tool.main([str(tmp_path / "house"), "SELECT id FROM numbers ORDER BY id"]) == 0
    assert capsys.readouterr().out.split() == ["id", *map(str, range(1_500))]
    assert query_tool.main([str(tmp_path / "house"), "SELECT nothing FROM numbers"]) == 1
    assert query_tool.main([str(tmp_path / "house")]) == 2
