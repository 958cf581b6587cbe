"""The registered queries once more, as SQL for an independent engine.

All statements share one chain of common table expressions over the star schema tables; a
statement only evaluates those it names.
"""


def money(value: str) -> str:
    """An exact sum of amounts, as a double."""
    return f"CAST(COALESCE(SUM(CAST({value} AS DECIMAL(18,4))), 0) AS DOUBLE)"


def count(value: str) -> str:
    return f"CAST(COALESCE(SUM({value}), 0) AS BIGINT)"


def clean(code: str) -> str:
    return rf"upper(regexp_replace({code}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'))"


def hundreds(amount: str) -> str:
    return f"CAST(round_even(({amount}) / 100, 0) * 100 AS BIGINT)"


_TIERS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

CHAIN = f"""
WITH d_campaigns AS (
  SELECT 'CMP-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS campaign_id, n_name AS name,
         r_name AS channel, CASE WHEN n_nationkey % 12 = 3 THEN NULL ELSE n_name END AS promo_code,
         CAST(100.0 * (n_nationkey + 1) AS DOUBLE) AS spend_usd,
         CAST(TIMESTAMP '1995-01-01' + to_days(CAST(30 * n_nationkey AS INTEGER)) AS TIMESTAMP) AS starts_on,
         CAST(TIMESTAMP '1995-01-01' + to_days(CAST(30 * n_nationkey + 1825 AS INTEGER)) AS TIMESTAMP) AS ends_on
  FROM nation JOIN region ON n_regionkey = r_regionkey),
d_events AS (
  SELECT s AS event_id, s AS event_name, lower(s) AS genre,
         CAST(DATE '2001-08-01' + CAST(ascii(s) - 65 AS INTEGER) AS TIMESTAMP) AS event_date,
         (SELECT CAST(floor(0.6 * count(*)) AS BIGINT) FROM orders) AS capacity,
         '19:00' AS doors_time, '20:00' AS show_time
  FROM (SELECT DISTINCT c_mktsegment AS s FROM customer)),
d_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, c_mktsegment AS event_id, o_orderdate AS ordered_at,
         o_orderpriority AS tier, o_orderkey % 7 AS qty, o_totalprice AS unit_price_usd,
         CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN lower(n_name) WHEN 2 THEN ' ' || n_name
           WHEN 3 THEN n_name || ' ' WHEN 4 THEN 'Nation' || substr(n_name, 7) WHEN 5 THEN 'NOSUCH'
           ELSE n_name END AS promo_code,
         CASE WHEN o_orderstatus = 'P' THEN 'refunded' ELSE 'completed' END AS status,
         n_nationkey, n_regionkey, o_orderkey, o_custkey, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
d_orders AS (
  SELECT *, strftime(ordered_at, '%Y-%m-%d') AS order_date, qty * unit_price_usd AS gross_revenue,
         CASE WHEN status = 'refunded' THEN 0.0 ELSE qty * unit_price_usd END AS net_revenue
  FROM d_raw WHERE qty > 0 AND unit_price_usd > 0),
d_rawscans AS (
  SELECT CAST(event_id AS VARCHAR) AS scan_id,
         CAST((event_id - event_id % 2) * 2 AS VARCHAR) || '-T'
           || CASE WHEN event_id % 4 = 1 THEN '2' ELSE '1' END AS ticket_id,
         CAST((event_id - event_id % 2) * 2 AS VARCHAR) AS order_id,
         CASE event_id % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE'
           WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS event_id,
         event_type AS gate, ts AS scanned_at
  FROM events),
d_first AS (
  SELECT * FROM d_rawscans
  QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY scanned_at, scan_id) = 1),
d_scans AS (SELECT * FROM d_first WHERE order_id IN (SELECT order_id FROM d_orders)),
d_codes AS (
  SELECT promo_code, count(order_id) AS orders, count(*) AS order_rows, {count("qty")} AS tickets,
         {money("net_revenue")} AS net
  FROM d_orders GROUP BY promo_code),
d_clean AS (
  SELECT {clean("promo_code")} AS code, {count("orders")} AS orders, {count("tickets")} AS tickets,
         {money("net")} AS net
  FROM d_codes WHERE promo_code IS NOT NULL GROUP BY 1),
d_perf_rows AS (
  SELECT campaign_id, name, channel, spend_usd, COALESCE(orders, 0) AS attributed_orders,
         COALESCE(tickets, 0) AS tickets_sold, COALESCE(net, 0.0) AS attributed_revenue
  FROM d_campaigns c LEFT JOIN d_codes k ON c.promo_code = k.promo_code
  UNION ALL
  SELECT '(unattributed)', '(unattributed)', '-', 0.0, {count("order_rows")}, {count("tickets")}, {money("net")}
  FROM d_codes WHERE promo_code IS NOT NULL
    AND promo_code NOT IN (SELECT promo_code FROM d_campaigns WHERE promo_code IS NOT NULL)
  UNION ALL
  SELECT '(organic)', '(organic)', '-', 0.0, {count("order_rows")}, {count("tickets")}, {money("net")}
  FROM d_codes WHERE promo_code IS NULL),
d_perf AS (
  SELECT *, CASE WHEN tickets_sold > 0 THEN spend_usd / tickets_sold END AS cost_per_ticket,
         CASE WHEN spend_usd > 0 THEN attributed_revenue / spend_usd END AS revenue_per_dollar
  FROM d_perf_rows),
d_tiers AS (
  SELECT event_name, tier, {count("qty")} AS tickets_sold, {money("gross_revenue")} AS gross_revenue,
         {count("CASE WHEN status = 'refunded' THEN qty ELSE 0 END")} AS refunded_tickets,
         {money("net_revenue")} AS net_revenue
  FROM d_orders o JOIN d_events e ON o.event_id = e.event_id GROUP BY event_name, tier),
d_rev AS (
  SELECT * FROM d_tiers UNION ALL
  SELECT 'TOTAL', 'TOTAL', {count("tickets_sold")}, {money("gross_revenue")},
         {count("refunded_tickets")}, {money("net_revenue")} FROM d_tiers),
d_att AS (
  SELECT e.event_id, event_name, event_date, COALESCE(sold, 0) AS tickets_sold, tickets_scanned,
         CASE WHEN COALESCE(sold, 0) > 0 THEN CAST(tickets_scanned AS DOUBLE) / sold END AS show_up_rate,
         COALESCE(sold, 0) - tickets_scanned AS no_shows
  FROM d_events e
  JOIN (SELECT event_id, count(DISTINCT ticket_id) AS tickets_scanned FROM d_scans GROUP BY 1) s
    ON e.event_id = s.event_id
  LEFT JOIN (SELECT event_id, {count("qty")} AS sold FROM d_orders WHERE status = 'completed' GROUP BY 1) o
    ON e.event_id = o.event_id),
d_results AS (
  SELECT e.event_id AS id, event_name AS name, genre, strftime(event_date, '%Y-%m-%d') AS date,
         capacity, sold, CAST(sold AS DOUBLE) / capacity AS sell_through, gross, net,
         gross - net AS refunded_rev, refunded_tickets
  FROM d_events e JOIN (
    SELECT event_id, {count("qty")} AS sold, {money("gross_revenue")} AS gross, {money("net_revenue")} AS net,
           {count("CASE WHEN status = 'refunded' THEN qty ELSE 0 END")} AS refunded_tickets
    FROM d_orders GROUP BY event_id) s ON e.event_id = s.event_id),
d_matrix AS (
  SELECT e.event_id AS id, t.tier, COALESCE(sold, 0) AS sold, capacity // 5 AS cap, COALESCE(net, 0.0) AS net
  FROM d_events e CROSS JOIN (VALUES {", ".join(f"('{t}')" for t in _TIERS)}) t(tier)
  LEFT JOIN (SELECT event_id, tier, {count("qty")} AS sold, {money("net_revenue")} AS net
             FROM d_orders GROUP BY 1, 2) s ON s.event_id = e.event_id AND s.tier = t.tier),
d_pacing AS (
  SELECT order_date AS date, {money("net_revenue")} AS net, {count("qty")} AS tickets
  FROM d_orders GROUP BY 1),
d_returns AS (
  SELECT campaign_id AS id, name, channel, c.promo_code IS NOT NULL AS has_code, spend_usd AS spend,
         COALESCE(k.orders, 0) AS orders, COALESCE(k.tickets, 0) AS tickets, COALESCE(k.net, 0.0) AS net,
         CASE WHEN spend_usd > 0 THEN COALESCE(k.net, 0.0) / spend_usd ELSE 0.0 END AS rpd,
         COALESCE(r.net, 0.0) AS net_dirty
  FROM d_campaigns c LEFT JOIN d_clean k ON c.promo_code = k.code
  LEFT JOIN d_codes r ON c.promo_code = r.promo_code),
d_attr AS (
  SELECT (SELECT {money("net")} FROM d_codes WHERE promo_code NOT IN (SELECT promo_code FROM d_campaigns WHERE promo_code IS NOT NULL)) AS unattributed_dirty_net,
         (SELECT {count("order_rows")} FROM d_codes WHERE promo_code NOT IN (SELECT promo_code FROM d_campaigns WHERE promo_code IS NOT NULL)) AS unattributed_dirty_orders,
         (SELECT {money("net")} FROM d_codes WHERE {clean("promo_code")} NOT IN (SELECT {clean("promo_code")} FROM d_campaigns WHERE promo_code IS NOT NULL)) AS still_unattributed_net,
         (SELECT {money("net")} FROM d_codes WHERE promo_code IS NULL) AS organic_net,
         (SELECT {count("order_rows")} FROM d_codes WHERE promo_code IS NULL) AS organic_orders,
         (SELECT {count("tickets")} FROM d_codes WHERE promo_code IS NULL) AS organic_tickets),
d_sums AS (
  SELECT {money("net_revenue")} AS net, {money("gross_revenue")} AS gross, {count("qty")} AS tickets_sold,
         {count("CASE WHEN status = 'refunded' THEN qty ELSE 0 END")} AS refunded_tickets,
         (SELECT {count("capacity")} FROM d_events) AS seats_total,
         (SELECT {money("spend_usd")} FROM d_campaigns) AS marketing_spend,
         (SELECT {count("tickets_scanned")} FROM d_att) AS scanned,
         (SELECT {count("tickets_sold")} FROM d_att) AS kept,
         (SELECT {count("no_shows")} FROM d_att) AS no_shows,
         (SELECT {money("net")} FROM d_returns) AS attributed_net_clean
  FROM d_orders),
d_totals AS (
  SELECT net, gross, tickets_sold, tickets_sold - refunded_tickets AS tickets_kept, refunded_tickets,
         CAST(CAST(gross AS DECIMAL(28,4)) - CAST(net AS DECIMAL(28,4)) AS DOUBLE) AS refunded_rev,
         CASE WHEN gross <> 0 THEN CAST(CAST(gross AS DECIMAL(28,4)) - CAST(net AS DECIMAL(28,4)) AS DOUBLE) / gross ELSE 0.0 END AS refund_share_of_gross,
         seats_total, CASE WHEN seats_total <> 0 THEN CAST(tickets_sold AS DOUBLE) / seats_total ELSE 0.0 END AS seat_sell_through,
         CASE WHEN tickets_sold <> refunded_tickets THEN net / (tickets_sold - refunded_tickets) ELSE 0.0 END AS net_per_kept_ticket,
         CASE WHEN kept <> 0 THEN CAST(scanned AS DOUBLE) / kept ELSE 0.0 END AS show_up_rate, scanned,
         marketing_spend, attributed_net_clean,
         CASE WHEN marketing_spend <> 0 THEN attributed_net_clean / marketing_spend ELSE 0.0 END AS rpd_blended,
         no_shows
  FROM d_sums),
d_weak AS (SELECT * FROM d_results ORDER BY sell_through, id LIMIT 1),
d_soft AS (
  SELECT 'soft_night' AS key, name AS event, sell_through, 0.65::DOUBLE AS target_sell_through,
         greatest(0, CAST(trunc(capacity * 0.65::DOUBLE) AS BIGINT) - sold) AS add_tickets,
         CASE WHEN sold <> 0 THEN net / sold ELSE 0.0 END AS avg_net_per_ticket, capacity - sold AS unsold_seats
  FROM d_weak),
d_soft_amount AS (SELECT *, {hundreds("add_tickets * avg_net_per_ticket")} AS amount FROM d_soft),
d_vip AS (
  SELECT 'vip' AS key, {count("CASE WHEN sold >= cap THEN 1 ELSE 0 END")} AS sellout_nights, count(*) AS nights,
         {money("CASE WHEN sold >= cap THEN net END")} AS vip_net_on_sellouts
  FROM d_matrix WHERE tier = '1-URGENT'),
d_vip_amount AS (SELECT *, {hundreds("0.1::DOUBLE * vip_net_on_sellouts")} AS amount FROM d_vip),
d_tracked AS (SELECT * FROM d_returns WHERE has_code AND spend > 0),
d_ends AS (
  SELECT (SELECT CASE WHEN SUM(spend) > 0 THEN {money("net")} / {money("spend")} ELSE 0.0 END
          FROM d_tracked WHERE rpd > (SELECT median(rpd) FROM d_tracked)) AS target_rpd,
         (SELECT CASE WHEN SUM(spend) > 0 THEN {money("net")} / {money("spend")} ELSE 0.0 END
          FROM (SELECT * FROM d_tracked ORDER BY rpd, id LIMIT 2)) AS source_rpd),
d_realloc_amount AS (
  SELECT 'realloc' AS key, source_rpd, target_rpd,
         {hundreds("2000.0::DOUBLE * greatest(0.0, target_rpd - source_rpd) * 0.25::DOUBLE")} AS amount
  FROM d_ends),
d_refunds_amount AS (
  SELECT 'refunds' AS key, refunded_rev, {hundreds("0.15::DOUBLE * refunded_rev")} AS amount FROM d_totals),
d_levers AS (
  SELECT key, amount FROM d_soft_amount UNION ALL SELECT key, amount FROM d_vip_amount
  UNION ALL SELECT key, amount FROM d_realloc_amount UNION ALL SELECT key, amount FROM d_refunds_amount),
d_goal AS (
  SELECT 0.05::DOUBLE AS pct, net * 1.05::DOUBLE AS target_net, net * 1.05::DOUBLE - net AS gap FROM d_totals),
d_live AS (
  SELECT campaign_id, spend_usd, CAST(unnest(generate_series(starts_on, ends_on, INTERVAL 1 DAY)) AS DATE) AS day
  FROM d_campaigns WHERE promo_code IS NOT NULL),
d_merch AS (
  SELECT c_mktsegment AS event_id, p_brand AS sku, CAST(l_quantity AS BIGINT) AS units, l_extendedprice AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey)
"""

_PERF = "campaign_id, name, channel, spend_usd, attributed_orders, tickets_sold, attributed_revenue, cost_per_ticket, revenue_per_dollar"
_RETURNS = "id, name, channel, has_code, spend, orders, tickets, net, rpd, net_dirty"
_TOTALS = (
    "net, gross, tickets_sold, tickets_kept, refunded_tickets, refunded_rev, refund_share_of_gross, "
    "seats_total, seat_sell_through, net_per_kept_ticket, show_up_rate, scanned, marketing_spend, "
    "attributed_net_clean, rpd_blended"
)
_STG_ORDERS = (
    "order_id, event_id, ordered_at, tier, qty, unit_price_usd, {code} AS promo_code, status, "
    "order_date, gross_revenue, net_revenue"
)
_NOT_CAMPAIGN = "promo_code NOT IN (SELECT promo_code FROM d_campaigns WHERE promo_code IS NOT NULL)"
_REPORT = """
  (SELECT {money} FROM d_tiers) AS total_net, (SELECT {sold} FROM d_tiers) AS tickets_sold,
  (SELECT tier FROM d_tiers GROUP BY tier ORDER BY SUM(CAST(net_revenue AS DECIMAL(18,4))) DESC, tier LIMIT 1) AS top_tier,
  (SELECT COALESCE(string_agg(event_name, ', ' ORDER BY event_name), 'none') FROM
     (SELECT event_name FROM d_tiers GROUP BY event_name
      HAVING SUM(tickets_sold) >= (SELECT floor(0.6 * count(*)) FROM orders))) AS sellouts,
  (SELECT name FROM d_perf WHERE campaign_id LIKE 'CMP-%' ORDER BY attributed_revenue DESC, campaign_id LIMIT 1) AS best_by_revenue,
  (SELECT name FROM d_perf WHERE campaign_id LIKE 'CMP-%' AND spend_usd > 0 ORDER BY revenue_per_dollar DESC NULLS LAST, campaign_id LIMIT 1) AS best_per_dollar,
  (SELECT CAST(SUM(tickets_scanned) AS DOUBLE) / CAST(SUM(tickets_sold) AS DOUBLE) FROM d_att) AS overall_rate,
  (SELECT event_name FROM d_att ORDER BY show_up_rate NULLS LAST, event_id LIMIT 1) AS worst_name,
  (SELECT show_up_rate FROM d_att ORDER BY show_up_rate NULLS LAST, event_id LIMIT 1) AS worst_rate
""".format(money=money("net_revenue"), sold=count("tickets_sold"))

_DERIVED = """
  (SELECT name FROM d_results ORDER BY net DESC, id LIMIT 1) AS best_event,
  (SELECT net FROM d_results ORDER BY net DESC, id LIMIT 1) AS best_event_net,
  (SELECT name FROM d_weak) AS worst_event, (SELECT net FROM d_weak) AS worst_event_net,
  (SELECT sold FROM d_weak) AS worst_event_sold, (SELECT sell_through FROM d_weak) AS worst_event_sell_through,
  (SELECT capacity - sold FROM d_weak) AS worst_event_unsold_seats,
  (SELECT max(net) FROM d_results) / (SELECT net FROM d_weak) AS best_worst_ratio,
  (SELECT count(*) FROM d_matrix WHERE tier = '1-URGENT' AND sold >= cap) AS vip_sellout_nights,
  (SELECT count(*) FROM d_matrix WHERE tier = '2-HIGH' AND sold >= cap) AS balcony_sellout_nights,
  (SELECT id FROM d_returns ORDER BY rpd DESC, id LIMIT 1) AS best_campaign,
  (SELECT id FROM d_tracked ORDER BY rpd, id LIMIT 1) AS worst_tracked_campaign,
  (SELECT id FROM d_returns WHERE NOT has_code ORDER BY rpd DESC, id LIMIT 1) AS untracked_campaign,
  (SELECT max(rpd) FROM d_returns) / (SELECT min(rpd) FROM d_tracked) AS rpd_spread,
  (SELECT name FROM d_returns ORDER BY net_dirty DESC, rpd DESC, id LIMIT 1) AS best_by_revenue_dirty,
  (SELECT name FROM d_returns ORDER BY net DESC, rpd DESC, id LIMIT 1) AS best_by_revenue_clean,
  (SELECT net FROM d_pacing ORDER BY date LIMIT 1) AS launch_day_net,
  (SELECT {money} FROM (SELECT * FROM d_pacing ORDER BY date LIMIT 4)) AS launch_first4_net,
  (SELECT {money} FROM (SELECT * FROM d_pacing ORDER BY date LIMIT 4)) / (SELECT net FROM d_totals) AS launch_first4_share,
  (SELECT show_up_rate FROM d_totals) AS avg_rate, (SELECT no_shows FROM d_totals) AS no_shows,
  (SELECT event_name FROM d_att ORDER BY show_up_rate DESC NULLS LAST, event_id LIMIT 1) AS best_night,
  (SELECT event_name FROM d_att ORDER BY show_up_rate NULLS LAST, event_id LIMIT 1) AS worst_night,
  (SELECT no_shows FROM d_att ORDER BY show_up_rate NULLS LAST, event_id LIMIT 1) AS worst_night_no_shows,
  ((SELECT show_up_rate FROM d_totals) - (SELECT min(show_up_rate) FROM d_att)) * 100 AS delta_pts
""".format(money=money("net"))

_MESSAGE = "stage the orders with normalize=True to match codes in canonical form"


def _check(name: str, severity: str, blocking: bool, passed: str, columns: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, {passed} AS passed, '{severity}' AS severity, "
        f"{str(blocking).lower()} AS blocking, {columns} FROM ({source})"
    )


def _with_total(table: str, labels: tuple[str, str], counts: list[str], amounts: list[str]) -> str:
    sums = ", ".join([f"{count(c)} AS {c}" for c in counts] + [f"{money(a)} AS {a}" for a in amounts])
    names = ", ".join([*labels, *counts, *amounts])
    return (
        f"SELECT {names} FROM {table} UNION ALL SELECT 'TOTAL' AS {labels[0]}, 'TOTAL' AS {labels[1]}, {sums} FROM {table}"
    )


def _daily(where: str) -> str:
    return (
        f"SELECT CAST(order_date AS TIMESTAMP) AS order_date, tier, count(order_id) AS orders, "
        f"{count('qty')} AS tickets, {money('net_revenue')} AS net_revenue FROM d_orders "
        f"WHERE {where} GROUP BY order_date, tier"
    )


_MONTHLY = f"""
  SELECT CAST(date_trunc('month', ordered_at) AS DATE) AS order_month, tier, count(order_id) AS orders,
         {count('qty')} AS tickets, {money('net_revenue')} AS net_revenue
  FROM d_orders GROUP BY 1, 2"""
_SEASON_DAYS = "order_date >= '1995-01-01' AND order_date < '2001-08-02'"
_SEASON = """
  SELECT 'Summer season, ' || CASE WHEN strftime(f, '%Y-%m') = strftime(l, '%Y-%m')
      THEN strftime(f, '%B ') || day(f) || '–' || day(l) || ' ' || year(l)
      ELSE strftime(f, '%b ') || day(f) || ' – ' || strftime(l, '%b ') || day(l) || ' ' || year(l) END AS label,
    strftime(f, '%Y-%m-%d') AS first_show, strftime(l, '%Y-%m-%d') AS last_show,
    (SELECT max(date) FROM d_pacing) AS last_order_date,
    (SELECT strftime(event_date, '%Y-%m-%d') FROM d_att ORDER BY event_id DESC LIMIT 1) AS scans_through,
    (SELECT count(*) FROM d_att) AS nights_scanned
  FROM (SELECT arg_min(event_date, event_id) AS f, arg_max(event_date, event_id) AS l FROM d_events)
"""

_STATEMENTS = {
    # staging
    "stg_campaigns": "SELECT campaign_id, name, channel, promo_code, spend_usd, starts_on, ends_on FROM d_campaigns",
    "stg_events": "SELECT *, event_date + INTERVAL 20 HOUR AS show_ts FROM d_events",
    "stg_orders": f"SELECT {_STG_ORDERS.format(code='promo_code')} FROM d_orders",
    "stg_orders_normalized": f"SELECT {_STG_ORDERS.format(code=clean('promo_code'))} FROM d_orders",
    "stg_ticket_scans": "SELECT * FROM d_scans",
    "first_scan_per_ticket": "SELECT * FROM d_first",
    "scan_drop_counts": """
        SELECT scans_read, scans_read - tickets AS duplicate_scans_dropped,
               tickets - kept AS orphan_scans_dropped, kept AS row_count
        FROM (SELECT (SELECT count(*) FROM d_rawscans) AS scans_read,
                     (SELECT count(*) FROM d_first) AS tickets, (SELECT count(*) FROM d_scans) AS kept)""",
    "orphan_scans": """
        SELECT order_id, count(*) AS scans FROM d_rawscans
        WHERE order_id NOT IN (SELECT order_id FROM d_orders) GROUP BY order_id""",
    "unknown_order_ids": """
        SELECT order_id FROM d_rawscans EXCEPT SELECT order_id FROM d_orders""",
    "code_forms": f"""
        SELECT promo_code, {clean('promo_code')} AS clean_code, order_rows FROM d_codes WHERE promo_code IS NOT NULL""",
    "ticket_numbers": """
        SELECT CAST(regexp_extract(ticket_id, '-T(\\d+)$', 1) AS BIGINT) AS ticket_number, count(*) AS scans
        FROM d_rawscans GROUP BY 1""",
    # marts
    "campaign_performance": f"SELECT {_PERF} FROM d_perf",
    "campaign_performance_normalized": f"""
        SELECT campaign_id, name, channel, spend_usd, COALESCE(orders, 0) AS attributed_orders,
               COALESCE(tickets, 0) AS tickets_sold, COALESCE(net, 0.0) AS attributed_revenue,
               CASE WHEN tickets > 0 THEN spend_usd / tickets END AS cost_per_ticket,
               COALESCE(net, 0.0) / spend_usd AS revenue_per_dollar
        FROM d_campaigns c LEFT JOIN d_clean k ON c.promo_code = k.code
        UNION ALL
        SELECT n, n, '-', 0.0, COALESCE(o, 0), COALESCE(t, 0), COALESCE(r, 0.0),
               CASE WHEN t > 0 THEN 0.0 / t END, NULL
        FROM (SELECT '(unattributed)' AS n, CAST(SUM(orders) AS BIGINT) AS o, CAST(SUM(tickets) AS BIGINT) AS t,
                     {money('net')} AS r
              FROM d_clean WHERE code NOT IN (SELECT promo_code FROM d_campaigns WHERE promo_code IS NOT NULL)
              UNION ALL
              SELECT '(organic)', order_rows, tickets, net FROM d_codes WHERE promo_code IS NULL)""",
    "revenue_by_tier": "SELECT event_name, tier, tickets_sold, gross_revenue, refunded_tickets, net_revenue FROM d_rev",
    "attendance_by_event": "SELECT * FROM d_att",
    "attendance_by_event_distinct": "SELECT * FROM d_att",
    "campaign_credit": f"""
        SELECT c.campaign_id, k.orders, k.tickets, k.net FROM d_campaigns c JOIN d_codes k ON c.promo_code = k.promo_code""",
    "order_buckets": f"""
        SELECT CASE WHEN promo_code IS NULL THEN 'organic' WHEN {_NOT_CAMPAIGN} THEN 'unattributed' ELSE 'matched' END AS bucket,
               {count('order_rows')} AS order_rows, {count('tickets')} AS tickets, {money('net')} AS net
        FROM d_codes GROUP BY 1""",
    # reporting
    "headline_numbers": f"SELECT {_REPORT}",
    "box_office_report": f"""
        WITH k AS (SELECT {_REPORT})
        SELECT 'total_net_revenue' AS metric, '$' || format('{{:,.2f}}', total_net) AS value FROM k
        UNION ALL SELECT 'tickets_sold', format('{{:,}}', tickets_sold) FROM k
        UNION ALL SELECT 'overall_show_up_rate', format('{{:.1f}}%', 100 * overall_rate) FROM k
        UNION ALL SELECT 'best_campaign_by_revenue', best_by_revenue FROM k
        UNION ALL SELECT 'best_campaign_per_dollar', best_per_dollar FROM k
        UNION ALL SELECT 'top_tier_by_revenue', top_tier FROM k
        UNION ALL SELECT 'sellout_events', sellouts FROM k
        UNION ALL SELECT 'worst_no_show_event', worst_name || ' (' || format('{{:.1f}}%', 100 * worst_rate) || ' show-up)' FROM k""",
    "executive_summary": f"""
        WITH k AS (SELECT {_REPORT})
        SELECT 'Summer stand: ' || format('{{:,}}', tickets_sold) || ' tickets brought in $' || format('{{:,.2f}}', total_net)
          || ' after refunds, and ' || format('{{:.0f}}%', 100 * overall_rate) || ' of them were used. Most was earned through '
          || best_by_revenue || ', most for each dollar spent through ' || best_per_dollar || '.' AS summary FROM k""",
    "summary_top_campaigns": """
        SELECT name, channel, attributed_orders, attributed_revenue, revenue_per_dollar FROM d_perf
        ORDER BY attributed_revenue DESC, campaign_id LIMIT 5""",
    "summary_show_up": "SELECT event_name, tickets_sold, tickets_scanned, show_up_rate FROM d_att",
    "published_summary": f"""
        WITH k AS (SELECT {_REPORT}),
        s AS (SELECT 'Summer stand: ' || format('{{:,}}', tickets_sold) || ' tickets brought in $' || format('{{:,.2f}}', total_net)
          || ' after refunds, and ' || format('{{:.0f}}%', 100 * overall_rate) || ' of them were used. Most was earned through '
          || best_by_revenue || ', most for each dollar spent through ' || best_per_dollar || '.' AS text FROM k),
        c AS (SELECT * FROM d_perf ORDER BY attributed_revenue DESC, campaign_id LIMIT 5)
        SELECT 0 AS part, 0 AS place, text, true AS written FROM s
        UNION ALL SELECT 1, 0, 'Leading campaigns | channel | orders | net | net per dollar', true
        UNION ALL SELECT 2, 0, 'Show-up | sold | scanned | rate', true
        UNION ALL SELECT 1, row_number() OVER (ORDER BY attributed_revenue DESC, name),
          concat_ws(' | ', COALESCE(name, '-'), COALESCE(channel, '-'), format('{{:,}}', attributed_orders), '$' || format('{{:,.2f}}', attributed_revenue),
                    COALESCE(format('{{:,.2f}}', revenue_per_dollar), '-')), true FROM c
        UNION ALL SELECT 2, row_number() OVER (ORDER BY event_name),
          concat_ws(' | ', event_name, format('{{:,}}', tickets_sold), format('{{:,}}', tickets_scanned), COALESCE(format('{{:.1f}}%', 100 * show_up_rate), '-')), true
        FROM d_att""",
    # slices
    "daily_sales": _daily(_SEASON_DAYS),
    "daily_sales_one_day": _daily("order_date = '1996-03-04'"),
    "slice_summary": f"""
        SELECT order_date, count(*) AS row_count, {money('net_revenue')} AS slice_net_revenue
        FROM ({_daily(_SEASON_DAYS)}) GROUP BY order_date""",
    "missing_slices": f"""
        SELECT CAST(unnest(generate_series(TIMESTAMP '1994-12-25', TIMESTAMP '2001-08-10', INTERVAL 1 DAY)) AS DATE) AS order_date
        EXCEPT SELECT CAST(order_date AS DATE) FROM d_orders""",
    "monthly_sales": _MONTHLY,
    "monthly_sales_rebuilt": _MONTHLY,
    # document parts
    "event_results": "SELECT * FROM d_results",
    "event_attendance": "SELECT event_id AS id, tickets_sold AS kept, tickets_scanned AS scanned, show_up_rate AS show_up, no_shows FROM d_att",
    "events_by_net": "SELECT id, name, net FROM d_results ORDER BY net DESC, id",
    "tier_matrix": "SELECT id, tier, sold, cap, net FROM d_matrix",
    "tier_totals": f"SELECT tier, {count('sold')} AS sold, {money('net')} AS net FROM d_matrix GROUP BY tier",
    "daily_pacing": "SELECT * FROM d_pacing",
    "launch_window": f"""
        SELECT (SELECT net FROM d_pacing ORDER BY date LIMIT 1) AS day_net,
               (SELECT {money('net')} FROM (SELECT * FROM d_pacing ORDER BY date LIMIT 4)) AS first4_net,
               max(date) AS last_order_date, {money('net')} AS paced_net FROM d_pacing""",
    "campaign_returns": f"SELECT {_RETURNS} FROM d_returns",
    "attribution_summary": "SELECT * FROM d_attr",
    "lever_soft_night": "SELECT amount, event, sell_through, target_sell_through, add_tickets, avg_net_per_ticket, unsold_seats FROM d_soft_amount",
    "lever_vip": "SELECT amount, sellout_nights, nights, vip_net_on_sellouts, 0.1::DOUBLE AS price_lift FROM d_vip_amount",
    "lever_realloc": "SELECT amount, 2000.0::DOUBLE AS budget_moved, source_rpd, target_rpd, 0.25::DOUBLE AS incrementality FROM d_realloc_amount",
    "lever_refunds": "SELECT amount, refunded_rev, 0.15::DOUBLE AS convert_rate FROM d_refunds_amount",
    "goal_and_levers": "SELECT pct, target_net, gap, (SELECT CAST(SUM(amount) AS BIGINT) FROM d_levers) AS levers_total FROM d_goal",
    "median_return": "SELECT median(rpd) AS median_rpd FROM d_tracked",
    "weakest_campaigns": "SELECT id, spend, net, rpd FROM d_tracked ORDER BY rpd, id LIMIT 2",
    "derived_scalars": f"SELECT {_DERIVED}",
    "season": _SEASON,
    "season_totals": f"SELECT {_TOTALS} FROM d_totals",
    "payload_document": f"""
        SELECT t.net, t.gross, t.tickets_sold, t.scanned, s.label, s.nights_scanned, g.gap,
               a.unattributed_dirty_orders, a.organic_tickets,
               (SELECT name FROM d_weak) AS worst_event,
               (SELECT count(*) FROM d_results) AS events, (SELECT count(*) FROM d_pacing) AS days,
               (SELECT count(*) FROM d_returns) AS campaigns,
               (SELECT {money('net')} FROM d_results) AS events_net, (SELECT {money('net')} FROM d_pacing) AS days_net,
               (SELECT {money('net')} FROM d_returns) AS campaigns_net,
               (SELECT {count('sold')} FROM d_matrix WHERE tier = '1-URGENT') AS premium_sold,
               (SELECT id FROM d_returns ORDER BY rpd DESC, id LIMIT 1) AS first_campaign,
               (SELECT min(date) FROM d_pacing) AS first_day,
               (SELECT CAST(SUM(amount) AS BIGINT) FROM d_levers) AS levers_total
        FROM d_totals t, ({_SEASON}) s, d_goal g, d_attr a""",
    "attribution_movement": """
        SELECT CAST(0 AS INTEGER) AS part, name AS label, net_dirty AS before, net AS after
        FROM (SELECT * FROM d_returns WHERE abs(net - net_dirty) >= 300 ORDER BY abs(net - net_dirty) DESC, rpd DESC, id LIMIT 4)
        WHERE (SELECT unattributed_dirty_net FROM d_attr) >= 1
        UNION ALL
        SELECT 1, CASE WHEN unattributed_dirty_net >= 1 THEN '(unattributed)' ELSE 'codes are already clean' END,
               CASE WHEN unattributed_dirty_net >= 1 THEN unattributed_dirty_net END,
               CASE WHEN unattributed_dirty_net >= 1 THEN still_unattributed_net END FROM d_attr""",
    "page_scalars": """
        SELECT (SELECT CAST(SUM(amount) AS DOUBLE) FROM d_levers) / gap - 1 AS buffer_pct,
               ((SELECT max(net) FROM d_results) - (SELECT net FROM d_weak)) / gap AS spread_vs_gap,
               (SELECT CAST(SUM(amount) AS BIGINT) FROM d_levers WHERE key IN ('soft_night', 'vip')) AS page2_levers_sum,
               (SELECT CAST(SUM(amount) AS BIGINT) FROM d_levers WHERE key IN ('realloc', 'refunds')) AS page3_levers_sum,
               (SELECT organic_net FROM d_attr) / (SELECT net FROM d_totals) AS organic_share,
               (SELECT sell_through FROM d_weak) AS worst_event_pct_of_house, 2000.0::DOUBLE AS realloc_moved,
               0.15::DOUBLE AS refund_convert_pct, 0.1::DOUBLE AS vip_lift_pct, 0.65::DOUBLE AS soft_target_pct
        FROM d_goal""",
    # checks
    "check_order_amounts": _check(
        "order_amounts_valid", "ERROR", True,
        "bad_qty_rows + bad_price_rows + negative_net_revenue_rows + duplicate_order_ids = 0",
        "bad_qty_rows, bad_price_rows, negative_net_revenue_rows, duplicate_order_ids",
        """SELECT CAST(count(*) FILTER (qty < 1) AS BIGINT) AS bad_qty_rows,
                  CAST(count(*) FILTER (unit_price_usd <= 0) AS BIGINT) AS bad_price_rows,
                  CAST(count(*) FILTER (net_revenue < 0) AS BIGINT) AS negative_net_revenue_rows,
                  count(*) - count(DISTINCT order_id) AS duplicate_order_ids FROM d_orders""",
    ),
    "check_raw_order_amounts": _check(
        "order_amounts_valid", "ERROR", True,
        "bad_qty_rows + bad_price_rows + negative_net_revenue_rows + duplicate_order_ids = 0",
        "bad_qty_rows, bad_price_rows, negative_net_revenue_rows, duplicate_order_ids",
        """SELECT CAST(count(*) FILTER (qty < 1) AS BIGINT) AS bad_qty_rows,
                  CAST(count(*) FILTER (unit_price_usd <= 0) AS BIGINT) AS bad_price_rows,
                  CAST(count(*) FILTER (status <> 'refunded' AND qty * unit_price_usd < 0) AS BIGINT) AS negative_net_revenue_rows,
                  count(*) - count(DISTINCT order_id) AS duplicate_order_ids FROM d_raw""",
    ),
    "check_known_events": _check(
        "orders_reference_known_events", "ERROR", False, "orders_with_unknown_event = 0",
        "orders_with_unknown_event",
        "SELECT count(*) AS orders_with_unknown_event FROM d_orders WHERE event_id NOT IN (SELECT event_id FROM d_events)",
    ),
    "check_promo_attributed": _check(
        "all_promo_orders_attributed", "ERROR", False, "unattributed_orders = 0",
        f"unattributed_orders, unattributed_revenue, sample_bad_codes, '{_MESSAGE}' AS hint",
        f"""SELECT (SELECT unattributed_dirty_orders FROM d_attr) AS unattributed_orders,
                  (SELECT unattributed_dirty_net FROM d_attr) AS unattributed_revenue,
                  (SELECT string_agg('''' || promo_code || '''', ', ' ORDER BY first_at, promo_code) FROM (
                     SELECT promo_code, min(ordered_at) AS first_at
                     FROM d_orders WHERE {_NOT_CAMPAIGN} GROUP BY promo_code
                     ORDER BY first_at, promo_code LIMIT 10)) AS sample_bad_codes""",
    ),
    "check_show_up_rate": _check(
        "show_up_rate_in_bounds", "WARN", False,
        "rates_out_of_bounds = 0 AND more_scans_than_tickets = 0 AND overall_rate BETWEEN 0.5 AND 1.0",
        "overall_rate, rates_out_of_bounds, more_scans_than_tickets",
        """SELECT CAST(SUM(tickets_scanned) AS DOUBLE) / CAST(SUM(tickets_sold) AS DOUBLE) AS overall_rate,
                  count(*) FILTER (NOT COALESCE(show_up_rate BETWEEN 0 AND 1, false)) AS rates_out_of_bounds,
                  count(*) FILTER (tickets_scanned > tickets_sold) AS more_scans_than_tickets FROM d_att""",
    ),
    "check_ticket_integrity": _check(
        "ticket_integrity", "ERROR", False,
        "event_mismatches = 0 AND tickets_out_of_range = 0 AND scans_of_open_orders = 0",
        "orphan_scans, event_mismatches, tickets_out_of_range, scans_of_open_orders",
        """SELECT count(*) FILTER (o.order_id IS NULL) AS orphan_scans,
                  count(*) FILTER (o.order_id IS NOT NULL AND s.event_id <> o.event_id) AS event_mismatches,
                  count(*) FILTER (o.order_id IS NOT NULL AND CAST(regexp_extract(ticket_id, '-T(\\d+)$', 1) AS BIGINT) NOT BETWEEN 1 AND qty) AS tickets_out_of_range,
                  count(*) FILTER (o.order_id IS NOT NULL AND status <> 'completed') AS scans_of_open_orders
           FROM d_rawscans s LEFT JOIN d_orders o ON s.order_id = o.order_id""",
    ),
    "check_codes_canonical": _check(
        "promo_codes_canonical", "WARN", False, "dirty_code_orders = 0", "dirty_code_orders",
        f"SELECT {count('order_rows')} AS dirty_code_orders FROM d_codes WHERE promo_code <> {clean('promo_code')}",
    ),
    "check_total_reconciles": """
        SELECT CAST(1 AS BIGINT) AS total_rows, CAST(SUM(tickets_sold) AS BIGINT) AS total_tickets,
               CAST(SUM(tickets_sold) AS BIGINT) AS sum_of_tickets, true AS passed FROM d_tiers""",
    "check_plan_covers_gap": _check(
        "plan_covers_gap", "WARN", False, "levers_total >= gap AND idle_levers = 0",
        "levers_total, idle_levers, gap",
        """SELECT CAST(SUM(amount) AS BIGINT) AS levers_total, count(*) FILTER (amount <= 0) AS idle_levers,
                  (SELECT gap FROM d_goal) AS gap FROM d_levers""",
    ),
    # campaign windows
    "campaign_window_reach": f"""
        SELECT campaign_id, {count('n')} AS orders_while_live, {count('tickets')} AS tickets_while_live,
               {money('net')} AS net_while_live
        FROM d_live l LEFT JOIN (
          SELECT CAST(ordered_at AS DATE) AS day, count(*) AS n, {count('qty')} AS tickets, {money('net_revenue')} AS net
          FROM d_orders GROUP BY 1) o ON l.day = o.day GROUP BY campaign_id""",
    "order_live_campaigns": f"""
        SELECT order_id, COALESCE(n, 0) AS live_campaigns, COALESCE(s, 0.0) AS live_spend
        FROM d_orders o LEFT JOIN (SELECT day, count(*) AS n, {money('spend_usd')} AS s FROM d_live GROUP BY day) l
          ON CAST(o.ordered_at AS DATE) = l.day""",
    "window_sums": f"""
        SELECT campaign_id, {count('n')} AS orders_while_live, {count('tickets')} AS tickets_while_live,
               {money('net')} AS net_while_live
        FROM d_live l LEFT JOIN (
          SELECT CAST(ordered_at AS DATE) AS day, count(*) AS n, {count('qty')} AS tickets, {money('net_revenue')} AS net
          FROM d_orders GROUP BY 1) o ON l.day = o.day GROUP BY campaign_id""",
    "live_campaigns_by_day": f"""
        SELECT o.day, COALESCE(n, 0) AS live_campaigns, COALESCE(s, 0.0) AS live_spend
        FROM (SELECT DISTINCT CAST(ordered_at AS DATE) AS day FROM d_orders) o
        LEFT JOIN (SELECT day, count(*) AS n, {money('spend_usd')} AS s FROM d_live GROUP BY day) l ON o.day = l.day""",
    # orders of any size
    "median_order_value": """
        SELECT round(quantile_cont(gross_revenue, 0.5), 4) AS median_value, round(quantile_cont(gross_revenue, 0.9), 4) AS ninth_decile
        FROM d_orders""",
    "pacing_to_date": """
        SELECT date, row_number() OVER w - 1 AS place, CAST(sum(tickets) OVER w AS BIGINT) AS tickets_to_date,
               CAST(sum(CAST(net AS DECIMAL(38,4))) OVER w AS DOUBLE) AS net_to_date
        FROM d_pacing WINDOW w AS (ORDER BY date)""",
    "leaderboard_places": f"""
        SELECT campaign_id, attributed_revenue, row_number() OVER (ORDER BY attributed_revenue DESC, campaign_id) - 1 AS place
        FROM (SELECT {_PERF} FROM d_perf)""",
    "event_places": """
        SELECT r.id, r.net, lower(r.id) AS genre, row_number() OVER (ORDER BY r.net DESC, r.id) - 1 AS place,
               row_number() OVER (PARTITION BY lower(r.id) ORDER BY r.net DESC, r.id) - 1 AS place_in_genre
        FROM d_results r""",
    "customers_by_year": """
        WITH d_placed AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)
        SELECT strftime(d, '%Y-%m') AS period, count(DISTINCT o_custkey) AS customers FROM d_placed GROUP BY 1
        UNION ALL SELECT strftime(d, '%Y'), count(DISTINCT o_custkey) FROM d_placed GROUP BY 1
        UNION ALL SELECT 'all', count(DISTINCT o_custkey) FROM d_placed""",
    "tickets_by_gate": """
        SELECT event_id, gate, count(DISTINCT ticket_id) AS tickets FROM d_rawscans GROUP BY GROUPING SETS ((event_id, gate), (gate), ())""",
    "order_places_in_event": """
        SELECT order_id, event_id, row_number() OVER (PARTITION BY event_id ORDER BY ordered_at, order_id) - 1 AS place FROM d_orders""",
    # sources and sinks
    "adhoc_sql": f"""
        SELECT order_date, {money('net_revenue')} AS net FROM d_orders WHERE order_date >= '1995-07-08' GROUP BY 1""",
    "rows_per_file": "SELECT 'events.parquet' AS file_name, count(*) AS row_count FROM events",
    "preview": """
        SELECT order_id, event_id, tier, qty FROM d_raw ORDER BY ordered_at, order_id LIMIT 10""",
    "csv_round_trip": "SELECT order_id, event_id, ordered_at, tier, qty, unit_price_usd, promo_code, status FROM d_raw",
    "changed_rows": """
        SELECT order_id, promo_code, CAST(n AS BIGINT) AS copies_added FROM (
          SELECT order_id, promo_code, -1 AS n FROM d_orders WHERE promo_code <> {clean}
          UNION ALL SELECT order_id, {clean}, 1 FROM d_orders WHERE promo_code <> {clean})""".format(clean=clean("promo_code")),
    "payload_headline": """
        SELECT '$' || format('{:,.0f}', net) || ' net, ' || (SELECT count(*) FROM d_att) || ' nights of scans' AS headline
        FROM d_totals""",
    "stream_file_drops": "SELECT * FROM d_att",
    # neighbouring businesses
    "fallback_attribution": f"""
        SELECT COALESCE(c.campaign_id, k.campaign_id, '(unattributed)') AS campaign_id,
               CASE WHEN c.campaign_id IS NOT NULL THEN 'code' WHEN k.campaign_id IS NOT NULL THEN 'utm_campaign' ELSE 'none' END AS matched_by,
               count(*) AS orders, {count('qty')} AS tickets_sold, {money('net_revenue')} AS net
        FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'CMP-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS utm FROM d_orders) o
        LEFT JOIN d_campaigns c ON o.promo_code = c.promo_code
        LEFT JOIN d_campaigns k ON o.utm = k.campaign_id GROUP BY 1, 2""",
    "settlement_by_venue": "WITH v AS (SELECT r_name AS venue_id, tier, {0} AS tickets_sold, {1} AS refunded_tickets, {2} AS gross_revenue, {3} AS net_revenue FROM d_orders JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2) ".format(
        count("qty"), count("CASE WHEN status = 'refunded' THEN qty ELSE 0 END"), money("gross_revenue"), money("net_revenue")
    ) + _with_total("v", ("venue_id", "tier"), ["tickets_sold", "refunded_tickets"], ["gross_revenue", "net_revenue"]),
    "settlement_slices": "SELECT r_name AS venue_id, tier, count(order_id) AS orders, {0} AS tickets, {1} AS net_revenue FROM d_orders JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2".format(
        count("qty"), money("net_revenue")
    ),
    "yield_by_program": """
        SELECT n_name AS program_id, count(*) AS offers_made, count(*) FILTER (o_orderstatus = 'F') AS enrolled,
               CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) AS yield_rate,
               count(*) FILTER (o_orderstatus <> 'F') AS declined
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') > 0""",
    "check_yield_rate": _check(
        "yield_rate_in_bounds", "WARN", False,
        "rates_out_of_bounds = 0 AND more_scans_than_tickets = 0 AND overall_rate BETWEEN 0.0 AND 1.0",
        "overall_rate, rates_out_of_bounds, more_scans_than_tickets",
        """SELECT CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) AS overall_rate,
                  CAST(0 AS BIGINT) AS rates_out_of_bounds, CAST(0 AS BIGINT) AS more_scans_than_tickets FROM orders""",
    ),
    "mrr_by_month": f"""
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS payments,
               count(DISTINCT o_custkey) AS customers, {money('o_totalprice')} AS mrr FROM orders GROUP BY 1""",
    "churn_by_month": """
        SELECT month, customers, CASE WHEN month < (SELECT date_trunc('month', max(o_orderdate)) FROM orders) THEN gone END AS churned,
               CASE WHEN month < (SELECT date_trunc('month', max(o_orderdate)) FROM orders) THEN CAST(gone AS DOUBLE) / customers END AS churn_rate
        FROM (SELECT a.month, count(*) AS customers, count(*) FILTER (b.c IS NULL) AS gone
              FROM (SELECT DISTINCT o_custkey AS c, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders) a
              LEFT JOIN (SELECT DISTINCT o_custkey AS c, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders) b
                ON a.c = b.c AND b.month = a.month + INTERVAL 1 MONTH GROUP BY 1)""",
    "ticket_fanout": """
        SELECT order_id || '-T' || n AS ticket_id, order_id, event_id, n AS ticket_number
        FROM (SELECT order_id, event_id, unnest(generate_series(1, qty)) AS n FROM d_orders)""",
    "pass_utilization": f"""
        SELECT o.event_id, owned, COALESCE(used, 0) AS used, CAST(COALESCE(used, 0) AS DOUBLE) / owned AS utilization
        FROM (SELECT event_id, {count('qty')} AS owned FROM d_orders GROUP BY 1) o
        LEFT JOIN (SELECT d.event_id, count(DISTINCT s.ticket_id) AS used FROM d_rawscans s
                   JOIN d_orders d ON s.order_id = d.order_id
                   WHERE CAST(regexp_extract(ticket_id, '-T(\\d+)$', 1) AS BIGINT) BETWEEN 1 AND d.qty GROUP BY 1) u
          ON o.event_id = u.event_id""",
    "campaign_quality": f"""
        SELECT campaign_id, name, COALESCE(registered, 0) AS registered, COALESCE(attendees, 0) AS attendees,
               CASE WHEN registered > 0 THEN CAST(attendees AS DOUBLE) / registered ELSE 0.0 END AS attendance_rate
        FROM d_campaigns c LEFT JOIN (
          SELECT promo_code, {count('qty')} AS registered, {count('a')} AS attendees
          FROM d_orders o LEFT JOIN (SELECT order_id, count(DISTINCT (ticket_id, event_id)) AS a FROM d_rawscans GROUP BY 1) s
            ON o.order_id = s.order_id GROUP BY 1) k ON c.promo_code = k.promo_code""",
    "revenue_by_sku": f"WITH v AS (SELECT event_id, sku, {count('units')} AS units, {money('revenue')} AS revenue FROM d_merch GROUP BY 1, 2) "
    + _with_total("v", ("event_id", "sku"), ["units"], ["revenue"]),
    "merch_per_attendee": f"""
        SELECT a.event_id, event_name, tickets_scanned, revenue AS merch_revenue,
               revenue / tickets_scanned AS revenue_per_attendee, CAST(units AS DOUBLE) / tickets_scanned AS attach_rate
        FROM d_att a JOIN (SELECT event_id, {count('units')} AS units, {money('revenue')} AS revenue FROM d_merch GROUP BY 1) m
          ON a.event_id = m.event_id""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"
        for name, table in [
            ("stg_campaigns", "d_campaigns"), ("stg_events", "d_events"), ("stg_orders", "d_orders"),
            ("stg_ticket_scans", "d_scans"), ("campaign_performance", "d_perf"),
            ("revenue_by_tier", "d_rev"), ("attendance_by_event", "d_att"),
        ]
    ),
}


def _scans_of(day: int) -> str:
    return f"(SELECT count(*) FROM d_rawscans WHERE CAST(scan_id AS BIGINT) % 3 = {day})"


_DELIVERED = {
    "csv_increments": _STATEMENTS["csv_round_trip"],
    "csv_folder_manifest": " UNION ALL ".join(
        [f"SELECT '2025-07-0{d + 1}' AS file_date, {_scans_of(d)} AS row_count, true AS has_header" for d in range(3)]
        + ["SELECT '2025-07-04', 0, true"]
    ),
    "empty_slice_rebuild": f"""
        SELECT * FROM ({_MONTHLY}) WHERE NOT (month(order_month) = 6 AND year(order_month) <= 1996)""",
    "stream_baseline_and_late_file": " UNION ALL ".join(
        f"SELECT '2025-07-0{d + 1}' AS file_date, {_scans_of(d)} AS row_count, {str(d == 2).lower()} AS triggered"
        for d in range(3)
    ),
    "blocking_gate": """
        WITH d_odd AS (
          SELECT (SELECT count(*) FROM d_orders WHERE o_orderkey % 64 = 0) AS twice,
                 (SELECT CAST(COALESCE(sum(CASE WHEN o_orderkey % 64 = 0 THEN 2 ELSE 1 END), 0) AS BIGINT)
                  FROM d_orders WHERE o_orderkey % 100 = 1) AS nowhere)
        SELECT 'order_amounts_valid' AS check_name, twice = 0 AS passed, twice AS failing_rows, twice > 0 AS stops_the_run FROM d_odd
        UNION ALL SELECT 'orders_reference_known_events', nowhere = 0, nowhere, false FROM d_odd""",
    "refresh_metrics": """
        WITH d_metrics AS (
          SELECT 'raw_campaigns' AS table_name, 'row_count' AS metric, CAST((SELECT count(*) FROM d_campaigns) AS DOUBLE) AS value
          UNION ALL SELECT 'raw_events', 'row_count', (SELECT count(*) FROM d_events)
          UNION ALL SELECT 'raw_orders', 'row_count', (SELECT count(*) FROM d_raw)
          UNION ALL SELECT 'raw_ticket_scans', 'row_count', (SELECT count(*) FROM d_rawscans)
          UNION ALL SELECT 'stg_campaigns', 'row_count', (SELECT count(*) FROM d_campaigns)
          UNION ALL SELECT 'stg_events', 'row_count', (SELECT count(*) FROM d_events)
          UNION ALL SELECT 'stg_orders', 'row_count', (SELECT count(*) FROM d_orders)
          UNION ALL SELECT 'stg_orders', 'refunded_orders', (SELECT count(*) FROM d_orders WHERE status = 'refunded')
          UNION ALL SELECT 'stg_ticket_scans', 'row_count', (SELECT count(*) FROM d_scans)
          UNION ALL SELECT 'stg_ticket_scans', 'duplicate_scans_dropped', (SELECT count(*) FROM d_rawscans) - (SELECT count(*) FROM d_first)
          UNION ALL SELECT 'stg_ticket_scans', 'orphan_scans_dropped', (SELECT count(*) FROM d_first) - (SELECT count(*) FROM d_scans)
          UNION ALL SELECT 'campaign_performance', 'row_count', (SELECT count(*) FROM d_perf)
          UNION ALL SELECT 'revenue_by_tier', 'row_count', (SELECT count(*) FROM d_rev)
          UNION ALL SELECT 'revenue_by_tier', 'total_net_revenue', (SELECT net_revenue FROM d_rev WHERE event_name = 'TOTAL')
          UNION ALL SELECT 'attendance_by_event', 'row_count', (SELECT count(*) FROM d_att)
          UNION ALL SELECT 'attendance_by_event', 'overall_show_up_rate',
            (SELECT CAST(SUM(tickets_scanned) AS DOUBLE) / CAST(SUM(tickets_sold) AS DOUBLE) FROM d_att)
          UNION ALL SELECT 'box_office_report', 'row_count', 8
          UNION ALL SELECT 'executive_summary', 'row_count', 1
          UNION ALL SELECT 'summary_top_campaigns', 'row_count', 5
          UNION ALL SELECT 'summary_show_up', 'row_count', (SELECT count(*) FROM d_att)
          UNION ALL SELECT 'document', 'changed_files', 2
          UNION ALL SELECT 'document', 'events', (SELECT count(*) FROM d_results)
          UNION ALL SELECT 'document', 'campaigns', (SELECT count(*) FROM d_returns)
          UNION ALL SELECT 'document', 'net_revenue', (SELECT net FROM d_totals)
          UNION ALL SELECT 'document', 'target_net', (SELECT target_net FROM d_goal)
          UNION ALL SELECT 'document', 'levers_total', (SELECT SUM(amount) FROM d_levers)
          UNION ALL SELECT 'document', 'unattributed_net', (SELECT unattributed_dirty_net FROM d_attr))
        SELECT table_name, metric, round(value, 4) AS value FROM d_metrics""",
    "check_results": " UNION ALL ".join(
        f"SELECT check_name, passed, severity, blocking FROM ({_STATEMENTS[n]})"
        for n in ("check_order_amounts", "check_known_events", "check_promo_attributed", "check_show_up_rate")
    ),
    "admissions_refresh": _STATEMENTS["attendance_by_event"],
    "incremental_admissions": _STATEMENTS["attendance_by_event"],
    "incremental_batches": f"""
        WITH d_dropped AS (
          SELECT (SELECT count(*) FROM d_rawscans) - (SELECT count(*) FROM d_first) AS duplicate_scans_dropped,
                 (SELECT count(*) FROM d_first) - (SELECT count(*) FROM d_scans) AS orphan_scans_dropped,
                 (SELECT count(*) FROM d_scans) AS row_count)
        SELECT b.*, d_dropped.* FROM (
          SELECT 0 AS batch, {_scans_of(1)} AS scans_read UNION ALL SELECT 1, {_scans_of(2)} UNION ALL SELECT 2, {_scans_of(0)}) b, d_dropped""",
    "stream_first_arrivals": """
        SELECT ticket_id, arg_min(scan_id, CAST(scan_id AS BIGINT) % 3) AS kept_scan,
               arg_min(scan_id, (CAST(scanned_at AS TIMESTAMP), scan_id)) AS first_scan
        FROM d_rawscans GROUP BY ticket_id""",
    "exported_document": """
        SELECT row_number() OVER (ORDER BY r.id) - 1 AS position, r.id, r.sold, r.net,
               m.sold AS premium_sold, m.net AS premium_net, a.tickets_scanned AS scanned,
               true AS export_repeats, true AS twin_equals
        FROM d_results r LEFT JOIN d_att a ON r.id = a.event_id
        JOIN d_matrix m ON m.id = r.id AND m.tier = '1-URGENT'""",
    "document_days": "SELECT row_number() OVER (ORDER BY date) - 1 AS position, date, net, tickets FROM d_pacing",
    "document_campaigns": f"""
        SELECT row_number() OVER (ORDER BY rpd DESC, id) - 1 AS position, id, name, spend, net, rpd FROM (SELECT {_RETURNS} FROM d_returns)""",
    "document_tiers": """
        SELECT m.id, a.event_id IS NOT NULL AS has_attendance, m.tier, m.sold, m.cap, m.net
        FROM d_matrix m LEFT JOIN d_att a ON m.id = a.event_id""",
    "document_levers": " UNION ALL BY NAME ".join(
        f"SELECT {i} AS position, '{key}' AS key, * FROM ({_STATEMENTS[f'lever_{key}']})"
        for i, key in enumerate(("soft_night", "vip", "realloc", "refunds"))
    ),
    "changed_by_digest": f"SELECT *, 0 AS slots_of_a_repeat FROM ({_STATEMENTS['changed_rows']})",
    "rejected_rows": """
        WITH d_odd AS (
          SELECT CASE WHEN o_orderkey % 50 = 7 THEN 'too many fields' WHEN o_orderkey % 50 = 9 THEN 'qty: not a bigint' ELSE 'accepted' END AS reason
          FROM d_raw)
        SELECT reason, count(*) AS rows, (SELECT avg(CASE WHEN reason = 'accepted' THEN 0 ELSE 1 END) FROM d_odd) <= 0.01 AS passed
        FROM d_odd GROUP BY reason""",
    "slice_metrics": f"""
        SELECT strftime(day, '%Y-%m-%d') AS slice, count(s.tier) AS row_count, COALESCE({money('s.net_revenue')}, 0.0) AS slice_net_revenue
        FROM (SELECT CAST(unnest(generate_series(DATE '1994-12-25', DATE '1995-02-28', INTERVAL 1 DAY)) AS DATE) AS day) c
        LEFT JOIN ({_daily("order_date >= '1994-12-25' AND order_date < '1995-03-01'")}) s ON CAST(s.order_date AS DATE) = c.day GROUP BY 1""",
    "refresh_texts": """
        SELECT 'campaign_performance' AS table_name, 'top_campaign' AS metric,
               (SELECT name FROM d_perf WHERE campaign_id LIKE 'CMP-%' ORDER BY attributed_revenue DESC, campaign_id LIMIT 1) AS text
        UNION ALL SELECT 'raw_ticket_scans', 'latest_file', 'ticket_scans_2025-07-03.csv'""",
    "dated_files": """
        SELECT scan_id, '2025-07-0' || (CAST(scan_id AS BIGINT) % 3 + 1) AS file_date FROM d_scans""",
    "written_tables_read_back": "SELECT order_id, event_id, tier, promo_code, gross_revenue, net_revenue FROM d_orders",
}


def statements() -> dict[str, str]:
    """Query name to SQL. A statement with its own WITH continues the shared chain."""
    whole = {}
    for name, text in (_STATEMENTS | _DELIVERED).items():
        text = text.strip()
        joint = ",\n" + text[len("WITH ") :] if text.startswith("WITH ") else "\n" + text
        whole[name] = CHAIN.strip() + joint
    return whole
