"""A known season: its figures per event, campaign and day, and the results that follow from them."""

import pytest
from frames import rows
from pyspark.sql import functions as F

from stagedoor.operators import attribution, checks, sales
from stagedoor.operators.staging import stg_campaigns, stg_events
from stagedoor.plans import growth
from stagedoor.plans.settings import PlanSettings

# Event, name, sold, gross, net, refunded tickets, (sold, net) per tier, (kept, scanned).
EVENTS = [
    ("EV-01", "The Midnight Standard", 44436, 40900, 78, (627, 20808), (257, 12272), (100, 7820), (906, 764)),
    ("EV-02", "Copper & Oak", 36062, 33113, 70, (544, 16192), (249, 10396), (96, 6525), (819, 681)),
    ("EV-03", "Glass Anthem", 20524, 18742, 43, (337, 9540), (146, 5632), (57, 3570), (497, 416)),
    ("EV-04", "Brasswork Riot", 54480, 50716, 71, (717, 26960), (300, 16016), (100, 7740), (1046, 911)),
    ("EV-05", "Neon Coyote", 60500, 56314, 87, (800, 30954), (300, 16240), (100, 9120), (1113, 958)),
    ("EV-06", "Laugh Track Live", 46310, 43708, 56, (645, 23218), (276, 13050), (100, 7440), (965, 866)),
    ("EV-07", "Static Bloom", 39326, 37412, 48, (575, 18428), (262, 12000), (100, 6984), (889, 635)),
    ("EV-08", "Riverlight Orchestra", 59165, 54261, 80, (657, 27765), (300, 16926), (100, 9570), None),
]

# Campaign, name, channel, code, spend, orders, tickets, net once cleaned, net as recorded.
CAMPAIGNS = [
    ("CMP-01", "Summer Kickoff", "instagram", "SUMMER25", 1800.0, 472, 1007, 43371.0, 35130.0),
    ("CMP-02", "VIP Love Letter", "email", "VIPNIGHT", 120.0, 41, 84, 3513.0, 843.0),
    ("CMP-03", "Radio Week", "radio", "ONAIR10", 2400.0, 454, 972, 42123.0, 41183.0),
    ("CMP-04", "Retarget Blitz", "facebook", "", 950.0, 0, 0, 0.0, 0.0),
    ("CMP-05", "Search Brand", "google_search", "FINDUS", 700.0, 180, 382, 15656.0, 15308.0),
    ("CMP-06", "Street Team Flyers", "street_team", "STREET15", 600.0, 91, 191, 8086.0, 7918.0),
    ("CMP-07", "Local Press Blast", "email", "PRESSPLAY", 200.0, 41, 78, 3242.0, 3242.0),
    ("CMP-08", "Genre Nights", "instagram", "GENREGEM", 850.0, 109, 235, 10345.0, 10085.0),
    ("CMP-09", "Last Call Push", "instagram", "LASTCALL", 1100.0, 89, 187, 8079.0, 7431.0),
    ("CMP-10", "Student Rush", "street_team", "STUDENT10", 300.0, 78, 157, 6623.0, 6623.0),
    ("CMP-11", "Encore Newsletter", "email", "ENCORE", 150.0, 36, 77, 3452.0, 3272.0),
    ("CMP-12", "Partner Playlist", "youtube", "PLAYLOUD", 500.0, 90, 203, 8809.0, 8561.0),
]

# Net per order day from June 20 on.
DAYS = [
    39430, 29161, 24708, 23499, 16930, 16434, 15901, 15779, 15867,
    16313, 20005, 18718, 17193, 21329, 18043, 11951, 8355, 5550,
]


@pytest.fixture(scope="module")
def season(spark, frames):
    roster = frames.raw_events(
        *[(e[0], e[1], f"2025-07-0{i + 1}", 1200) for i, e in enumerate(EVENTS)]
    )
    per_tier = []
    for event, _, gross, net, refunded, *tiers, _ in EVENTS:
        for tier, (sold, tier_net) in zip(("GA", "Balcony", "VIP"), tiers, strict=True):
            is_ga = tier == "GA"
            tier_gross = tier_net + (gross - net if is_ga else 0)
            per_tier.append(
                (event, tier, None, "2025-07-01", 1, sold, refunded if is_ga else 0,
                 float(tier_gross), float(tier_net))
            )
    attended = [
        (e[0], e[1], kept, scanned, scanned / kept, kept - scanned)
        for e in EVENTS
        for kept, scanned in [e[-1] or (0, 0)]
        if kept
    ]
    attendance = spark.createDataFrame(
        attended,
        "event_id string, event_name string, tickets_sold bigint, tickets_scanned bigint, "
        "show_up_rate double, no_shows bigint",
    )
    per_code = [(None, None, None, "2025-07-01", 1937, 4172, 0, 181867.0, 181867.0)]
    for _, _, _, code, _, orders, tickets, net, recorded in CAMPAIGNS:
        if code:
            typed = code.lower() + " "
            late = orders // 4
            per_code += [
                (None, None, code, "2025-07-01", orders - late, tickets - late, 0, recorded, recorded),
                (None, None, typed, "2025-07-01", late, late, 0, net - recorded, net - recorded),
            ]
    per_day = [
        (None, None, None, f"2025-{'06' if i < 11 else '07'}-{20 + i if i < 11 else i - 10:02d}", 1, 1, 0,
         float(net), float(net))
        for i, net in enumerate(DAYS)
    ]
    sold, coded, dated = frames.sales(*per_tier), frames.sales(*per_code), frames.sales(*per_day)
    campaigns = stg_campaigns(frames.raw_campaigns(*[c[:5] for c in CAMPAIGNS]))
    settings = PlanSettings()
    results = growth.event_results(stg_events(roster), sold, attendance, settings).cache()
    returns = attribution.campaign_returns(coded, campaigns).cache()
    totals = growth.season_totals(sold, results, returns).cache()
    return {
        "results": results,
        "returns": returns,
        "totals": totals,
        "pacing": sales.daily_pacing(dated),
        "attribution": attribution.attribution_summary(coded, campaigns),
        "levers": growth.growth_levers(results, returns, totals, settings),
        "goal": growth.goal(totals, settings),
        "settings": settings,
    }


def test_totals(season):
    t = season["totals"].first()
    assert (t.net, t.gross, t.tickets_sold, t.tickets_kept) == (335166.0, 360803.0, 7745, 7212)
    assert (t.refunded_tickets, t.refunded_rev) == (533, 25637.0)
    assert (t.seats_total, t.scanned, t.marketing_spend) == (9600, 5231, 9670.0)
    assert t.attributed_net_clean == 153299.0
    assert t.refund_share_of_gross == pytest.approx(0.07105539588085465, rel=1e-12)
    assert t.seat_sell_through == pytest.approx(0.8067708333333333, rel=1e-12)
    assert t.net_per_kept_ticket == pytest.approx(46.473377703826955, rel=1e-12)
    assert t.show_up_rate == pytest.approx(0.8389735364875701, rel=1e-12)
    assert t.rpd_blended == pytest.approx(15.853050672182006, rel=1e-12)


def test_goal_and_levers(season):
    goal = season["goal"].first()
    assert goal.target_net == pytest.approx(351924.3) and goal.gap == pytest.approx(16758.3)
    amounts = growth.lever_amounts(season["levers"])
    assert dict(amounts.select("key", "amount").collect()) == {
        "soft_night": 8300, "vip": 4900, "realloc": 7100, "refunds": 3800,
    }
    check = checks.evaluate(checks.plan_covers_gap(amounts, season["goal"]))
    assert check.passed and check.metrics["levers_total"] == 24100


def test_lever_details(season):
    soft, vip, realloc, refunds = (lever.first().detail for lever in season["levers"].values())
    assert (soft.event, soft.sell_through, soft.add_tickets, soft.unsold_seats) == ("Glass Anthem", 0.45, 240, 660)
    assert soft.avg_net_per_ticket == pytest.approx(34.70740740740741, rel=1e-12)
    assert (vip.sellout_nights, vip.nights, vip.vip_net_on_sellouts) == (6, 8, 48674.0)
    assert realloc.source_rpd == pytest.approx(9.448205128205128, rel=1e-12)
    assert realloc.target_rpd == pytest.approx(23.653094462540718, rel=1e-12)
    assert refunds.refunded_rev == 25637.0
    assert growth.median_return(season["returns"]).first()[0] == pytest.approx(17.618)


def test_derived(season):
    d = growth.derived_scalars(
        season["results"], season["returns"], season["pacing"], season["totals"], season["settings"]
    ).first()
    assert (d.best_event.name, d.best_event.net) == ("Neon Coyote", 56314.0)
    assert (d.worst_event.name, d.worst_event.sold, d.worst_event.unsold_seats) == ("Glass Anthem", 540, 660)
    assert d.best_worst_ratio == pytest.approx(3.004695336676982, rel=1e-12)
    assert (d.vip_sellout_nights, d.balcony_sellout_nights) == (6, 3)
    tiers = {tier: (v.sold, v.net) for tier, v in d.tier_totals.items()}
    assert tiers == {"GA": (4902, 173865.0), "Balcony": (2090, 102532.0), "VIP": (753, 58769.0)}
    assert (d.best_campaign.id, d.worst_tracked_campaign.id) == ("CMP-02", "CMP-09")
    assert d.untracked_campaign.id == "CMP-04"
    assert d.rpd_spread == pytest.approx(3.9859512315880674, rel=1e-12)
    assert (d.best_by_revenue_dirty, d.best_by_revenue_clean) == ("Radio Week", "Summer Kickoff")
    assert (d.launch.day_net, d.launch.first4_net) == (39430.0, 116798.0)
    assert d.launch.first4_share == pytest.approx(0.34847806758442085, rel=1e-12)
    a = d.attendance
    assert (a.no_shows, a.best.name, a.worst.name, a.worst.no_shows) == (1004, "Laugh Track Live", "Static Bloom", 254)
    assert a.worst.delta_pts == pytest.approx(12.468782220185581, rel=1e-12)


def test_season_and_pacing(season):
    s = growth.season(season["results"], season["pacing"]).first()
    assert s.label == "Summer season, July 1–8 2025"
    assert (s.first_show, s.last_show, s.last_order_date) == ("2025-07-01", "2025-07-08", "2025-07-07")
    assert (s.scans_through, s.nights_scanned) == ("2025-07-07", 7)
    assert sales.launch_window(season["pacing"]).first().paced_net == 335166.0


def test_campaigns(season):
    order = [r.id[-2:] for r in season["returns"].collect()]
    assert order == ["02", "01", "11", "05", "10", "12", "03", "07", "06", "08", "09", "04"]
    summary = season["attribution"].first()
    assert summary.unattributed_dirty_net == 13703.0 and summary.still_unattributed_net == 0.0
    assert (summary.organic_orders, summary.organic_tickets, summary.organic_net) == (1937, 4172, 181867.0)
    moved = attribution.attribution_movement(season["returns"], season["attribution"]).collect()
    assert [r.label for r in moved] == [
        "Summer Kickoff", "Radio Week", "Last Call Push", "VIP Love Letter", "(unattributed)",
    ]
    assert [r.label for r in moved if r.label == "(unattributed)" and r.before == 13703.0]


def test_tier_matrix_covers_every_event(season):
    matrix = growth.tier_matrix(season["results"])
    assert matrix.count() == 24
    full = matrix.filter(F.col("sold") >= F.col("cap")).filter("tier = 'VIP'")
    assert full.count() == 6
    assert rows(growth.events_by_net(season["results"]).limit(1), "name") == [("Neon Coyote",)]
