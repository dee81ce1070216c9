"""SQL for the named views and their alert rows."""

from __future__ import annotations

from oracles.prelude import line_level, p, p2, r, rolling_7d, sql

LL_COLS = """shipment_id, shipment_number, order_number, carrier_code, carrier_name, carrier_mode, vendor_code,
  vendor_region, shipping_point, route, order_date, requested_date, actual_ship_date, actual_delivery_date,
  line_number::BIGINT AS line_number, sku, category, ordered_qty::DOUBLE AS ordered_qty, confirmed_qty::DOUBLE AS confirmed_qty,
  delivered_qty::DOUBLE AS delivered_qty, damage_qty::DOUBLE AS damage_qty, is_on_time::BIGINT AS is_on_time,
  is_in_full::BIGINT AS is_in_full, is_otif::BIGINT AS is_otif, backorder_cents / 100.0::DOUBLE AS backorder_value"""

_PORTABLE = line_level("pl", "coalesce(dl.damage_qty, 0)")
_FAIL_COLS = "vendor_code, actual_delivery_date, delivery_rank, is_otif::BIGINT AS is_otif, failure_streak_label, failure_reason"

_RUNNING = """
run AS (
  SELECT b.backorder_id, d.delivery_line_id, b.order_number, b.line_number, b.product_id, b.backorder_qty,
         b.backorder_qty * pr.price_cents AS cents, b.created_at, b.status
  FROM f_backorders b JOIN f_delivery_lines d ON d.order_number = b.order_number AND d.line_number = b.line_number
  JOIN f_products pr ON pr.sku = d.sku)"""

HIERARCHY = f"""SELECT vendor_code, vendor_name, vendor_region, tier, ordered::DOUBLE AS total_ordered_qty,
        delivered::DOUBLE AS total_delivered_qty, total_shipments, total_orders, {r(p('passed', 'flagged'), 2)} AS overall_otif_pct,
        row_number() OVER (PARTITION BY vendor_region ORDER BY {p('passed', 'flagged')} DESC NULLS LAST, vendor_code) AS rank_in_region,
        CASE WHEN {p('passed', 'flagged')} >= 95 THEN 'EXCEEDING' WHEN {p('passed', 'flagged')} >= 92 THEN 'MEETING'
             WHEN {p('passed', 'flagged')} >= 85 THEN 'AT_RISK' ELSE 'CRITICAL' END AS sla_status
        FROM (SELECT v.vendor_code, v.vendor_name, v.region AS vendor_region, v.tier,
                coalesce(sum(x.ordered_qty), 0) AS ordered, coalesce(sum(x.delivered_qty), 0) AS delivered,
                count(DISTINCT x.shipment_id) AS total_shipments, count(DISTINCT x.order_number) AS total_orders,
                coalesce(sum(x.is_otif), 0) AS passed, count(x.is_otif) AS flagged
              FROM f_vendors v LEFT JOIN (
                SELECT s.vendor_code, s.shipment_id, s.order_number, a.ordered_qty, b.delivered_qty, c.is_otif
                FROM f_shipments s LEFT JOIN f_order_lines a USING (order_number)
                LEFT JOIN f_delivery_lines b USING (shipment_number) LEFT JOIN ll c USING (shipment_id)) x USING (vendor_code)
              GROUP BY 1, 2, 3, 4)"""

VIEWS = {
    "v01_otif_line_level": sql(f"SELECT {LL_COLS} FROM ll"),
    "v02_date_anchor": sql(
        "SELECT d AS max_delivery_date, d30 AS window_start_30d, d90 AS window_start_90d, d180 AS window_start_180d FROM anchor"
    ),
    "v03_rolling_active_7": sql("SELECT * FROM r7"),
    "v04_rolling_active_30": sql(
        f"""SELECT vendor_code, vendor_region, metric_date, total_lines, otif_lines, on_time_lines, in_full_lines,
        otif_pct, on_time_pct, in_full_pct, {r('avg(' + p('otif_lines', 'total_lines') + ') OVER w', 2)} AS rolling_30d_otif_pct,
        (sum(total_lines) OVER w)::BIGINT AS rolling_30d_line_count FROM r7
        WINDOW w AS (PARTITION BY vendor_code ORDER BY metric_date, vendor_region ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""
    ),
    "v05_vendor_hierarchy": sql(HIERARCHY),
    "v05b_vendor_hierarchy_dedupe": sql(
        f"""SELECT v.vendor_code, v.vendor_name, v.region AS vendor_region, v.tier,
        coalesce(a.ordered, 0)::DOUBLE AS total_ordered_qty, coalesce(b.delivered, 0)::DOUBLE AS total_delivered_qty,
        coalesce(c.total_shipments, 0) AS total_shipments, coalesce(c.total_orders, 0) AS total_orders,
        {r(p('d.passed', 'd.flagged'), 2)} AS overall_otif_pct,
        row_number() OVER (PARTITION BY v.region ORDER BY {p('d.passed', 'd.flagged')} DESC NULLS LAST, v.vendor_code) AS rank_in_region,
        CASE WHEN {p('d.passed', 'd.flagged')} >= 95 THEN 'EXCEEDING' WHEN {p('d.passed', 'd.flagged')} >= 92 THEN 'MEETING'
             WHEN {p('d.passed', 'd.flagged')} >= 85 THEN 'AT_RISK' ELSE 'CRITICAL' END AS sla_status
        FROM f_vendors v
        LEFT JOIN (SELECT s.vendor_code, sum(ol.ordered_qty) AS ordered FROM f_shipments s
                   JOIN f_order_lines ol USING (order_number) GROUP BY 1) a USING (vendor_code)
        LEFT JOIN (SELECT s.vendor_code, sum(dl.delivered_qty) AS delivered FROM f_shipments s
                   JOIN f_delivery_lines dl USING (shipment_number) GROUP BY 1) b USING (vendor_code)
        LEFT JOIN (SELECT vendor_code, count(DISTINCT shipment_id) AS total_shipments, count(DISTINCT order_number) AS total_orders
                   FROM f_shipments GROUP BY 1) c USING (vendor_code)
        LEFT JOIN (SELECT vendor_code, sum(is_otif) AS passed, count(*) AS flagged FROM ll GROUP BY 1) d USING (vendor_code)"""
    ),
    "v06_geographic": sql(
        f"""SELECT s.shipping_point, s.vendor_region, s.carrier_mode, count(*) AS total_lines,
        sum(x.is_otif)::BIGINT AS otif_pass_count, sum(x.is_on_time)::BIGINT AS on_time_count,
        sum(x.is_in_full)::BIGINT AS in_full_count, {p2('sum(x.is_otif)', 'count(*)')} AS otif_pct,
        {p2('sum(x.is_on_time)', 'count(*)')} AS on_time_pct, {p2('sum(x.is_in_full)', 'count(*)')} AS in_full_pct,
        row_number() OVER (ORDER BY {p('sum(x.is_otif)', 'count(*)')} DESC NULLS LAST, s.shipping_point, s.vendor_region, s.carrier_mode) AS rank
        FROM ll x JOIN f_shipments s ON s.shipment_id = x.shipment_id GROUP BY 1, 2, 3"""
    ),
    "v07_carrier_scorecard": sql("SELECT * FROM scorecard"),
    "v08_consecutive_failures": sql(f"SELECT {_FAIL_COLS} FROM failures"),
    "v09_failures_lead": sql(
        """SELECT vendor_code, actual_delivery_date, is_otif::BIGINT AS is_otif, n1::BIGINT AS next_delivery_otif,
        CASE WHEN is_otif = 0 AND n1 = 0 THEN 'IMMINENT_STREAK' WHEN is_otif = 0 AND n1 = 1 THEN 'RECOVERING'
             WHEN is_otif = 1 AND n1 = 0 THEN 'IMPENDING_FAILURE' ELSE 'STABLE' END AS forward_look_status,
        CASE WHEN is_otif = 0 AND n1 = 0 AND n2 = 0 THEN 'ESCALATE' ELSE 'MONITOR' END AS escalation_flag FROM ranked"""
    ),
    "v10_dwell_times": sql(
        """SELECT order_number, order_date, requested_delivery_date, actual_ship_date, actual_delivery_date,
        order_to_ship_days::BIGINT AS order_to_ship_days, ship_to_delivery_days::BIGINT AS ship_to_delivery_days,
        ship_variance_days::BIGINT AS ship_variance_days, total_lead_time_days::BIGINT AS total_lead_time_days,
        is_delayed::BIGINT AS is_delayed FROM dwell"""
    ),
    "v11_dwell_time_trends": sql("SELECT * FROM trends"),
    "v12_backorder_running_costs": sql(
        """SELECT backorder_id, order_number, line_number::BIGINT AS line_number, product_id, backorder_qty::DOUBLE AS backorder_qty,
        cents / 100.0::DOUBLE AS backorder_cost, created_at AS backorder_date, status,
        (sum(CASE WHEN status = 'open' THEN cents ELSE 0 END) OVER w)::BIGINT / 100.0::DOUBLE AS cumulative_open_cost,
        (sum(cents) OVER w)::BIGINT / 100.0::DOUBLE AS cumulative_total_cost,
        (sum(cents) OVER (ORDER BY created_at, backorder_id, delivery_line_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))::BIGINT
          / 100.0::DOUBLE AS rolling_7d_backorder_cost
        FROM run WINDOW w AS (ORDER BY created_at, backorder_id, delivery_line_id ROWS UNBOUNDED PRECEDING)""",
        _RUNNING,
    ),
    "v13_order_state_sequence": sql(
        """SELECT order_number, order_status, order_date, requested_delivery_date,
        lead(order_status) OVER (PARTITION BY order_number ORDER BY order_date DESC, order_id DESC) AS previous_status,
        (CASE WHEN order_status IN ('pending', 'confirmed') AND order_date < (SELECT d FROM anchor) - 14 THEN 1 ELSE 0 END)::BIGINT AS is_stalled,
        (CASE WHEN requested_delivery_date - order_date <= 3 THEN 1 ELSE 0 END)::BIGINT AS is_rush_order FROM f_orders"""
    ),
    "v14_alert_otif_below_threshold": sql("SELECT * FROM otif_alert"),
    "v14b_alert_otif_vendor_targets": sql(
        f"""SELECT vendor_code, vendor_region, metric_date AS last_metric_date, rolling_7d_otif_pct, rolling_7d_line_count,
        rolling_7d_backorder_cost, target AS sla_threshold, {r('target - rolling_7d_otif_pct', 2)} AS gap_to_threshold,
        CASE WHEN rolling_7d_otif_pct < 85 THEN 'CRITICAL' ELSE 'BREACHED' END AS alert_severity, (SELECT d FROM anchor) AS alert_generated_at
        FROM (SELECT r7.*, CASE WHEN tier = 'strategic' THEN 95.0 ELSE 92.0 END::DOUBLE AS target,
              row_number() OVER (PARTITION BY vendor_code ORDER BY metric_date DESC, r7.vendor_region DESC) AS rn
              FROM r7 LEFT JOIN (SELECT vendor_code, tier FROM f_vendors) USING (vendor_code))
        WHERE rn = 1 AND rolling_7d_otif_pct < target"""
    ),
    "v14c_alert_otif_warning_band": sql(
        """SELECT * REPLACE (CASE WHEN rolling_7d_otif_pct < 85 THEN 'CRITICAL' WHEN rolling_7d_otif_pct < 88 THEN 'BREACHED'
        ELSE 'WARNING' END AS alert_severity) FROM otif_alert"""
    ),
    "v15_alert_backorder_threshold": sql("SELECT * FROM backorder_alert"),
    "v15b_alert_backorder_aggregate": sql(
        """SELECT vendor_code, cents / 100.0::DOUBLE AS total_open_backorder_cost, open_backorder_count, latest_backorder_date,
        10000.0::DOUBLE AS vendor_threshold, 50000.0::DOUBLE AS aggregate_threshold,
        CASE WHEN (SELECT sum(cents) FROM vendor_backorders) >= 5000000 THEN 'CRITICAL' ELSE 'EXCEEDED' END AS alert_severity,
        CASE WHEN (SELECT sum(cents) FROM vendor_backorders) >= 5000000 THEN 'Aggregate backorder cost exceeds $50K'
             ELSE 'Vendor backorder cost exceeds $10K' END AS alert_reason, latest_backorder_date AS alert_generated_at
        FROM vendor_backorders WHERE cents >= 1000000"""
    ),
    "v16_alert_consecutive_failures": sql("SELECT * FROM failure_alert"),
    "v17_alert_carrier_performance": sql("SELECT * FROM carrier_alert"),
    "v18_alert_dwell_time_spike": sql("SELECT * FROM spikes"),
    "v19_alert_dashboard_summary": sql("SELECT * FROM summary"),
    "v20a_portable_line_level": sql(f"SELECT {LL_COLS} FROM pl", _PORTABLE),
    "v20b_portable_rolling_7": sql("SELECT * FROM p7", _PORTABLE, rolling_7d("p7", "pl", "")),
    "v20c_portable_failures": sql(
        """SELECT vendor_code, actual_delivery_date, delivery_rank, is_otif::BIGINT AS is_otif,
        CASE WHEN b1 = 0 AND b2 = 0 AND b3 = 0 THEN '4+ CONSECUTIVE FAILURES' WHEN b1 = 0 AND b2 = 0 THEN '3 CONSECUTIVE FAILURES'
             WHEN b1 = 0 THEN '2 CONSECUTIVE FAILURES' ELSE 'SINGLE FAILURE' END AS failure_streak_label,
        CASE WHEN is_on_time = 0 AND is_in_full = 0 THEN 'LATE + SHORT' WHEN is_on_time = 0 THEN 'LATE'
             WHEN is_in_full = 0 THEN 'SHORT' ELSE 'UNKNOWN' END AS failure_reason
        FROM (SELECT *, row_number() OVER w AS delivery_rank, lag(is_otif, 1) OVER w AS b1, lag(is_otif, 2) OVER w AS b2,
              lag(is_otif, 3) OVER w AS b3 FROM pl
              WINDOW w AS (PARTITION BY vendor_code ORDER BY actual_delivery_date, shipment_number, line_number)) WHERE is_otif = 0""",
        _PORTABLE,
    ),
    "v20d_portable_alert_otif": sql(
        f"""SELECT vendor_code, vendor_region, metric_date AS last_metric_date, rolling_7d_otif_pct, rolling_7d_line_count,
        rolling_7d_backorder_cost, 92.0::DOUBLE AS sla_threshold, {r('92.0 - rolling_7d_otif_pct', 2)} AS gap_to_threshold,
        CASE WHEN rolling_7d_otif_pct < 85 THEN 'CRITICAL' ELSE 'BREACHED' END AS alert_severity
        FROM (SELECT *, row_number() OVER (PARTITION BY vendor_code ORDER BY metric_date DESC, vendor_region DESC) AS rn FROM p7)
        WHERE rn = 1 AND rolling_7d_otif_pct < 92""",
        _PORTABLE, rolling_7d("p7", "pl", ""),
    ),
    "v21_top_failing_vendors": sql(
        "SELECT vendor_code, count(*) AS failures FROM ll WHERE is_otif = 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
    ),
}

VIEWS["v12b_backorder_running_costs_segments"] = VIEWS["v12_backorder_running_costs"]
