"""SQL for the measures and the dashboard queries."""

from __future__ import annotations

from oracles.prelude import p, p2, r, sql

FX = """
fx AS (
  SELECT d.shipment_number, s.vendor_code, s.vendor_region, s.carrier_code, s.carrier_mode, s.actual_delivery_date AS day,
         CASE WHEN d.delivered_qty > 0 AND s.actual_delivery_date <= o.requested_delivery_date
               AND s.actual_delivery_date >= o.requested_delivery_date - 1 THEN 1 ELSE 0 END AS on_time,
         CASE WHEN d.delivered_qty - coalesce(d.damage_qty, 0) >= coalesce(ol.ordered_qty, 0) THEN 1 ELSE 0 END AS in_full
  FROM f_delivery_lines d LEFT JOIN f_shipments s USING (shipment_number)
  LEFT JOIN f_orders o ON o.order_number = d.order_number
  LEFT JOIN f_order_lines ol ON ol.order_number = d.order_number AND ol.line_number = d.line_number)"""

COSTED = """
ob AS (
  SELECT b.*, ol.sku, b.backorder_qty * ol.price_cents AS cents
  FROM f_backorders b JOIN f_order_lines ol USING (order_number, line_number) WHERE b.status = 'open'),
lv AS (
  SELECT DISTINCT d.order_number, d.line_number, s.vendor_code, s.vendor_region
  FROM f_delivery_lines d JOIN f_shipments s USING (shipment_number)),
vnew AS (
  SELECT vendor_code, max(created_at) AS newest FROM f_backorders JOIN lv USING (order_number, line_number) GROUP BY 1),
vcost AS (
  SELECT vendor_code, sum(cents)::BIGINT / 100.0::DOUBLE AS open_cost, count(*) AS open_count
  FROM ob JOIN lv USING (order_number, line_number) GROUP BY 1)"""

STATUS = """CASE WHEN {x} >= 0.85 THEN CASE WHEN {x} >= 0.92 THEN 'EXCEEDING' ELSE 'MEETING' END
  WHEN {x} >= 0.75 THEN 'AT_RISK' ELSE 'CRITICAL' END"""


def rolled(key: str) -> str:
    """Rolling shares per ``key`` by calendar days back from the key's own last day."""
    def s(a: int, b: int) -> str:
        w = f"top - day BETWEEN {a} AND {b}"
        return (f"coalesce(sum(CASE WHEN {w} THEN on_time * in_full END)::DOUBLE"
                f" / nullif(sum(CASE WHEN {w} THEN 1 END), 0)::DOUBLE, 0)")
    return f"""
rolled AS (
  SELECT {key}, {s(0, 6)} AS r7, {s(0, 29)} AS r30, {s(7, 13)} AS before7
  FROM (SELECT {key}, max(actual_delivery_date) AS top FROM f_shipments WHERE actual_delivery_date IS NOT NULL GROUP BY 1)
  LEFT JOIN fx USING ({key}) GROUP BY {key})"""


RECENT_FAILS = """
ship_pass AS (
  SELECT s.vendor_code, s.shipment_number, s.actual_delivery_date AS day, coalesce(sum(f.on_time * f.in_full), 0) AS good
  FROM f_shipments s LEFT JOIN fx f USING (shipment_number)
  WHERE s.actual_delivery_date IS NOT NULL GROUP BY 1, 2, 3),
recent_fails AS (
  SELECT vendor_code, sum(CASE WHEN good = 0 THEN 1 ELSE 0 END)::BIGINT AS value
  FROM (SELECT *, rank() OVER (PARTITION BY vendor_code ORDER BY day DESC) AS rk FROM ship_pass) WHERE rk <= 100 GROUP BY 1)"""


def m(body: str, *extra: str) -> str:
    return sql(body, FX, *extra)


def _count(expr: str, key: str = "vendor_code") -> str:
    return m(f"SELECT {key}, ({expr})::BIGINT AS value FROM fx GROUP BY 1")


def _share(expr: str, key: str = "vendor_code") -> str:
    return m(f"SELECT {key}, coalesce(sum({expr})::DOUBLE / nullif(count(*), 0)::DOUBLE, 0) AS value FROM fx GROUP BY 1")


def _roll(expr: str, key: str = "vendor_code") -> str:
    return m(f"SELECT {key}, {expr} AS value FROM rolled", rolled(key))


def _ship(a: str, b: str) -> str:
    return sql(
        f"""SELECT carrier_code, avg({b} - {a}) AS value FROM (
        SELECT s.*, o.order_date FROM f_shipments s LEFT JOIN f_orders o USING (order_number)) GROUP BY 1"""
    )


_AD = "(SELECT d FROM anchor)"

MEASURES = {
    "m01_total_delivery_lines": _count("count(*)"),
    "m02_total_orders": sql(
        "SELECT vendor_region, count(DISTINCT order_number) AS value FROM f_shipments JOIN f_orders USING (order_number) GROUP BY 1"
    ),
    "m02b_total_orders_all": sql("SELECT count(DISTINCT order_number) AS value FROM f_orders"),
    "m03_total_shipments": sql("SELECT carrier_code, count(DISTINCT shipment_number) AS value FROM f_shipments GROUP BY 1"),
    "m04_on_time_count": _count("sum(on_time)"),
    "m05_in_full_count": _count("sum(in_full)"),
    "m06_otif_count": _count("sum(on_time * in_full)"),
    "m07_otif_share": _share("on_time * in_full"),
    "m08_on_time_share": _share("on_time"),
    "m09_in_full_share": _share("in_full"),
    "m10_rolling_7d_otif": _roll("r7"),
    "m10b_rolling_7d_otif_all": m(
        """SELECT coalesce(sum(on_time * in_full)::DOUBLE / nullif(count(*), 0)::DOUBLE, 0) AS value FROM fx
        WHERE day >= (SELECT max(actual_delivery_date) FROM f_shipments) - 6"""
    ),
    "m11_rolling_30d_otif": _roll("r30"),
    "m12_current_failure_streak": m("SELECT * FROM recent_fails", RECENT_FAILS),
    "m12b_true_streak": sql(
        """SELECT vendor_code, sum(CASE WHEN last_good IS NULL OR pos > last_good THEN 1 ELSE 0 END)::BIGINT AS value
        FROM (SELECT vendor_code, pos, max(CASE WHEN is_otif = 1 THEN pos END) OVER (PARTITION BY vendor_code) AS last_good
              FROM (SELECT vendor_code, is_otif, delivery_rank AS pos FROM ranked)) GROUP BY 1"""
    ),
    "m13_max_consecutive_failures": m("SELECT max(value) AS value FROM recent_fails", RECENT_FAILS),
    "m14_open_backorder_cost": sql("SELECT vendor_code, open_cost AS value FROM vcost", COSTED),
    "m14b_open_backorder_cost_all": sql("SELECT sum(cents)::BIGINT / 100.0::DOUBLE AS value FROM ob", COSTED),
    "m15_open_backorder_count": sql("SELECT vendor_code, open_count AS value FROM vcost", COSTED),
    "m14c_open_backorder_cost_by_carrier": sql(
        """SELECT carrier_code, sum(cents)::BIGINT / 100.0::DOUBLE AS value FROM (
          SELECT DISTINCT carrier_code, backorder_id, cents FROM ob JOIN f_delivery_lines d USING (order_number, line_number)
          JOIN f_shipments s ON s.shipment_number = d.shipment_number) GROUP BY 1""",
        COSTED,
    ),
    "m14d_open_backorder_cost_of_a_day": sql(
        f"""SELECT coalesce(sum(cents)::BIGINT / 100.0::DOUBLE, 0) AS value FROM ob WHERE (order_number, line_number) IN (
          SELECT (order_number, line_number) FROM f_delivery_lines WHERE shipment_number IN (
            SELECT shipment_number FROM f_shipments WHERE actual_delivery_date = {_AD}))""",
        COSTED,
    ),
    "m14e_open_backorder_cost_as_of": sql(
        f"SELECT coalesce(sum(cents)::BIGINT / 100.0::DOUBLE, 0) AS value FROM ob WHERE created_at < {_AD} - 29",
        COSTED,
    ),
    "m16_rolling_7d_backorder_cost": sql(
        """SELECT vendor_code, coalesce(sum(cents), 0)::BIGINT / 100.0::DOUBLE AS value FROM vnew
        LEFT JOIN (SELECT v.vendor_code, cents FROM ob JOIN lv v USING (order_number, line_number)
                   JOIN vnew n ON n.vendor_code = v.vendor_code AND created_at >= newest - INTERVAL 6 DAY) x USING (vendor_code)
        GROUP BY 1""",
        COSTED,
    ),
    "m16b_rolling_7d_backorder_cost_all": sql(
        """SELECT coalesce(sum(cents), 0)::BIGINT / 100.0::DOUBLE AS value FROM ob
        WHERE created_at >= (SELECT max(created_at) FROM f_backorders) - INTERVAL 6 DAY""",
        COSTED,
    ),
    "m17c_backorder_to_revenue_by_status": m(
        """SELECT coalesce((SELECT sum(cents)::BIGINT / 100.0::DOUBLE FROM (SELECT DISTINCT backorder_id, cents FROM ob
            JOIN lv USING (order_number, line_number) JOIN low USING (vendor_code)))
          / nullif((SELECT sum(total_value)::DOUBLE FROM f_orders WHERE order_number IN (
              SELECT order_number FROM f_shipments JOIN low USING (vendor_code))), 0), 0) AS value""",
        COSTED, rolled("vendor_code"), "low AS (SELECT vendor_code FROM rolled WHERE r7 < 0.85)",
    ),
    "m17_backorder_to_revenue": sql(
        """SELECT vendor_code, coalesce(open_cost / nullif(revenue, 0), 0) AS value FROM (
          SELECT vendor_code, sum(total_value)::DOUBLE AS revenue FROM (SELECT DISTINCT vendor_code, order_number FROM f_shipments)
          JOIN f_orders USING (order_number) GROUP BY 1) LEFT JOIN vcost USING (vendor_code)""",
        COSTED,
    ),
    "m17b_backorder_to_revenue_all": sql(
        """SELECT (SELECT sum(cents)::BIGINT / 100.0::DOUBLE FROM ob) / (SELECT sum(total_value)::DOUBLE FROM f_orders) AS value""",
        COSTED,
    ),
    "m18_avg_order_to_ship_days": _ship("order_date", "actual_ship_date"),
    "m19_avg_ship_to_delivery_days": _ship("actual_ship_date", "actual_delivery_date"),
    "m20_avg_total_lead_time_days": _ship("order_date", "actual_delivery_date"),
    "m21_sla_target": sql(
        "SELECT vendor_code, CASE WHEN tier = 'strategic' THEN 0.95 ELSE 0.92 END::DOUBLE AS value FROM f_vendors"
    ),
    "m22_sla_breached": _roll("(CASE WHEN r7 < 0.92 THEN 1 ELSE 0 END)::BIGINT"),
    "m23_sla_gap": _roll("r7 - 0.92::DOUBLE"),
    "m24_vendor_compliance_score": _roll(
        "(CASE WHEN r7 >= 0.95 THEN 100 WHEN r7 >= 0.92 THEN 85 WHEN r7 >= 0.85 THEN 60 WHEN r7 >= 0.75 THEN 30 ELSE 0 END)::BIGINT"
    ),
    "m25_vendor_sla_status": _roll(STATUS.format(x="r7")),
    "m26_carrier_on_time_share": _share("on_time", "carrier_code"),
    "m27_otif_trend": _roll("r7 - before7"),
    "m28_otif_trend_direction": _roll(
        "CASE WHEN r7 - before7 > 0.01 THEN 'UP' WHEN r7 - before7 < -0.01 THEN 'DOWN' ELSE 'FLAT' END"
    ),
    "m29_target_attainment": m(
        """SELECT vendor_region, metric, share, target, (CASE WHEN share >= target THEN 1 ELSE 0 END)::BIGINT AS met FROM (
          SELECT vendor_region, 'on_time' AS metric, sum(on_time)::DOUBLE / count(*)::DOUBLE AS share, 0.95::DOUBLE AS target FROM fx GROUP BY 1
          UNION ALL SELECT vendor_region, 'in_full', sum(in_full)::DOUBLE / count(*)::DOUBLE, 0.98::DOUBLE FROM fx GROUP BY 1
          UNION ALL SELECT vendor_region, 'otif', sum(on_time * in_full)::DOUBLE / count(*)::DOUBLE, 0.92::DOUBLE FROM fx GROUP BY 1)"""
    ),
    "m30_measure_table": m(
        f"""SELECT vendor_code, lines, on_time, in_full, otif, otif / lines::DOUBLE AS otif_share, on_time / lines::DOUBLE AS on_time_share,
        in_full / lines::DOUBLE AS in_full_share, r7 AS rolling_7d_otif, r30 AS rolling_30d_otif,
        (CASE WHEN r7 < 0.92 THEN 1 ELSE 0 END)::BIGINT AS sla_breached, r7 - 0.92::DOUBLE AS sla_gap,
        (CASE WHEN r7 >= 0.95 THEN 100 WHEN r7 >= 0.92 THEN 85 WHEN r7 >= 0.85 THEN 60 WHEN r7 >= 0.75 THEN 30 ELSE 0 END)::BIGINT AS compliance_score,
        {STATUS.format(x='r7')} AS sla_status, r7 - before7 AS otif_trend,
        CASE WHEN r7 - before7 > 0.01 THEN 'UP' WHEN r7 - before7 < -0.01 THEN 'DOWN' ELSE 'FLAT' END AS otif_trend_direction
        FROM rolled JOIN (SELECT vendor_code, count(*) AS lines, sum(on_time)::BIGINT AS on_time, sum(in_full)::BIGINT AS in_full,
                          sum(on_time * in_full)::BIGINT AS otif FROM fx GROUP BY 1) USING (vendor_code)""",
        rolled("vendor_code"),
    ),
}

_WEEKS = ", ".join(
    f"(sum(CASE WHEN ago = {w} THEN good END)::DOUBLE / nullif(sum(CASE WHEN ago = {w} THEN 1 END), 0)::DOUBLE) AS w{w:02d}"
    for w in range(14)
)

DASHBOARD = {
    "d01_kpi_row": m(
        f"""SELECT sum(on_time * in_full)::DOUBLE / count(*)::DOUBLE AS otif_share,
        sum(CASE WHEN day BETWEEN {_AD} - 6 AND {_AD} THEN on_time * in_full END)::DOUBLE
          / sum(CASE WHEN day BETWEEN {_AD} - 6 AND {_AD} THEN 1 END)::DOUBLE AS rolling_7d_otif,
        (SELECT sum(cents)::BIGINT / 100.0::DOUBLE FROM ob) AS open_backorder_cost,
        sum(CASE WHEN day = {_AD} THEN 1 ELSE 0 END)::BIGINT AS lines_today,
        (SELECT avg(s.actual_delivery_date - o.order_date) FROM f_shipments s JOIN f_orders o USING (order_number)) AS avg_total_lead_time_days
        FROM fx""",
        COSTED,
    ),
    "d02_colour_bands": m(
        """SELECT vendor_code, share AS otif_share, coalesce(open_cost, 0) AS open_backorder_cost,
        CASE WHEN share >= 0.95 THEN 'green' WHEN share >= 0.92 THEN 'amber' ELSE 'red' END AS otif_colour,
        CASE WHEN share >= 0.95 THEN 'green' WHEN share >= 0.92 THEN 'yellow' WHEN share >= 0.85 THEN 'orange' ELSE 'red' END AS otif_colour_four,
        CASE WHEN coalesce(open_cost, 0) < 10000 THEN 'green' WHEN open_cost < 50000 THEN 'amber' ELSE 'red' END AS backorder_colour
        FROM (SELECT vendor_code, sum(on_time * in_full)::DOUBLE / count(*)::DOUBLE AS share FROM fx GROUP BY 1) LEFT JOIN vcost USING (vendor_code)""",
        COSTED,
    ),
    "d03_daily_deliveries": m(
        f"""SELECT c.day::DATE AS day, (SELECT count(*) FROM fx WHERE fx.day = c.day::DATE) AS delivered_lines,
        coalesce((SELECT sum(on_time * in_full)::DOUBLE / count(*)::DOUBLE FROM fx WHERE fx.day BETWEEN c.day::DATE - 6 AND c.day::DATE), 0) AS rolling_7d_otif,
        0.92::DOUBLE AS sla_target
        FROM (SELECT unnest(generate_series({_AD} - 90, {_AD}::TIMESTAMP, INTERVAL 1 DAY)) AS day) c"""
    ),
    "d04_vendor_week_heatmap": m(
        f"""SELECT vendor_code, {_WEEKS} FROM (
          SELECT vendor_code, on_time * in_full AS good, (date_trunc('week', {_AD})::DATE - date_trunc('week', day)::DATE) // 7 AS ago
          FROM fx WHERE day BETWEEN {_AD} - 90 AND {_AD})
        WHERE vendor_code IN (SELECT vendor_code FROM fx WHERE day BETWEEN {_AD} - 90 AND {_AD}
                              GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 15) GROUP BY 1"""
    ),
    "d05_vendor_gauge": m(
        """SELECT vendor_code, r7 AS rolling_7d_otif, 0.92::DOUBLE AS target, 1.0::DOUBLE AS maximum FROM rolled WHERE vendor_code = 'V00003'""",
        rolled("vendor_code"),
    ),
    "d06_backorder_treemap": sql("SELECT vendor_code, open_cost FROM vcost", COSTED),
    "d06b_backorder_treemap_by_truck": sql(
        """SELECT vendor_code, sum(cents)::BIGINT / 100.0::DOUBLE AS open_cost FROM (
          SELECT DISTINCT s.vendor_code, backorder_id, cents FROM ob JOIN f_delivery_lines d USING (order_number, line_number)
          JOIN f_shipments s ON s.shipment_number = d.shipment_number WHERE s.carrier_mode = 'truck') GROUP BY 1""",
        COSTED,
    ),
    "d07_vendor_table": m(
        f"""SELECT vendor_code, r7 AS rolling_7d_otif, coalesce(total_lines, 0) AS total_lines, {STATUS.format(x='r7')} AS sla_status, value AS consecutive_failures
        FROM rolled LEFT JOIN (SELECT vendor_code, count(*) AS total_lines FROM fx GROUP BY 1) USING (vendor_code)
        LEFT JOIN recent_fails USING (vendor_code)""",
        rolled("vendor_code"), RECENT_FAILS,
    ),
    "d08_carrier_table": m(
        """SELECT carrier_code, carrier_mode, sum(on_time)::DOUBLE / count(*)::DOUBLE AS on_time_share, count(*) AS total_deliveries
        FROM fx GROUP BY 1, 2"""
    ),
    "d09_region_rolling": _roll("r7", "vendor_region"),
    "d10_active_alerts_by_severity": sql(
        f"SELECT alert_severity, count(*) AS alerts FROM summary WHERE event_date >= {_AD} - 7 GROUP BY 1"
    ),
    "d11_sliced_kpis": m(
        f"""SELECT vendor_code, count(*) AS lines, sum(on_time * in_full)::DOUBLE / count(*)::DOUBLE AS otif_share,
        sum(on_time)::DOUBLE / count(*)::DOUBLE AS on_time_share, sum(in_full)::DOUBLE / count(*)::DOUBLE AS in_full_share
        FROM fx WHERE day BETWEEN {_AD} - 90 AND {_AD} AND carrier_mode IN ('truck', 'air') GROUP BY 1"""
    ),
    "d11b_sliced_by_status": m(
        """SELECT vendor_code, count(*) AS value FROM fx
        WHERE vendor_code IN (SELECT vendor_code FROM rolled WHERE r7 < 0.85) GROUP BY 1""",
        rolled("vendor_code"),
    ),
    "d12_vendor_profile": sql(
        f"""SELECT v.vendor_code, v.vendor_name, v.tier, v.region AS vendor_region, {r(p('passed', 'flagged'), 2)} AS overall_otif_pct
        FROM f_vendors v LEFT JOIN (SELECT vendor_code, sum(o * g) AS passed, sum(c * g) AS flagged FROM (
          SELECT s.vendor_code, x.o, x.c, y.n * z.n AS g FROM f_shipments s
          JOIN (SELECT shipment_id, sum(is_otif) AS o, count(*) AS c FROM ll GROUP BY 1) x USING (shipment_id)
          JOIN (SELECT order_number, count(*) AS n FROM f_order_lines GROUP BY 1) y USING (order_number)
          JOIN (SELECT shipment_number, count(*) AS n FROM f_delivery_lines GROUP BY 1) z USING (shipment_number)) GROUP BY 1) USING (vendor_code)"""
    ),
    "d13_recent_deliveries": sql(
        """SELECT vendor_code, actual_delivery_date, shipment_number, order_number, line_number::BIGINT AS line_number,
        is_on_time::BIGINT AS is_on_time, is_in_full::BIGINT AS is_in_full, is_otif::BIGINT AS is_otif, rn AS recency,
        CASE WHEN is_otif = 1 THEN 'NONE' WHEN is_on_time = 0 AND is_in_full = 0 THEN 'LATE + SHORT' WHEN is_on_time = 0 THEN 'LATE'
             WHEN is_in_full = 0 THEN 'SHORT' ELSE 'UNKNOWN' END AS failure_reason
        FROM (SELECT *, row_number() OVER (PARTITION BY vendor_code ORDER BY actual_delivery_date DESC, shipment_number DESC, line_number DESC) AS rn FROM ll)
        WHERE rn <= 30"""
    ),
    "d14_otif_trend": sql(
        f"""SELECT date_trunc('month', actual_delivery_date)::DATE AS period, count(*) AS lines, {p2('sum(is_otif)', 'count(*)')} AS otif_pct
        FROM ll WHERE actual_delivery_date >= (SELECT d180 FROM anchor) GROUP BY 1"""
    ),
    "d15_failure_breakdown": sql("SELECT vendor_code, failure_reason, count(*) AS failures FROM failures GROUP BY 1, 2"),
    "d16_failure_history": sql(
        """SELECT vendor_code, actual_delivery_date, delivery_rank, is_otif::BIGINT AS is_otif, failure_streak_label, failure_reason
        FROM failures WHERE failure_streak_label <> 'SINGLE FAILURE'"""
    ),
    "d17_open_backorders": sql(
        """SELECT backorder_id, vendor_code, sku, backorder_qty::DOUBLE AS backorder_qty, cents / 100.0::DOUBLE AS cost, estimated_fill_date
        FROM ob LEFT JOIN lv USING (order_number, line_number)""",
        COSTED,
    ),
    "d17b_open_backorders_of_a_vendor": sql(
        """SELECT backorder_id, vendor_code, sku, backorder_qty::DOUBLE AS backorder_qty, cents / 100.0::DOUBLE AS cost, estimated_fill_date
        FROM ob JOIN lv USING (order_number, line_number) WHERE vendor_code = 'V00003'""",
        COSTED,
    ),
    "d18_cumulative_backorder_cost": sql(
        """SELECT day, cents / 100.0::DOUBLE AS cost, (sum(cents) OVER (ORDER BY day))::BIGINT / 100.0::DOUBLE AS cumulative_cost
        FROM (SELECT created_at::DATE AS day, sum(cents)::BIGINT AS cents FROM ob GROUP BY 1)""",
        COSTED,
    ),
    "d19_days_open": sql(
        f"SELECT avg({_AD} - created_at::DATE) AS avg_days_open, count(*) AS open_backorders FROM f_backorders WHERE status = 'open'"
    ),
    "d20_date_dimension": sql(
        """SELECT c.day::DATE AS day, year(c.day) AS year, month(c.day) AS month, date_trunc('week', c.day)::DATE AS week_start,
        (CASE WHEN isodow(c.day) >= 6 THEN 1 ELSE 0 END)::BIGINT AS is_weekend, coalesce(n, 0) AS shipments
        FROM (SELECT unnest(generate_series((SELECT min(actual_delivery_date) FROM f_shipments)::TIMESTAMP,
              (SELECT max(actual_delivery_date) FROM f_shipments)::TIMESTAMP, INTERVAL 1 DAY)) AS day) c
        LEFT JOIN (SELECT actual_delivery_date AS day, count(*) AS n FROM f_shipments GROUP BY 1) s ON s.day = c.day::DATE"""
    ),
}
