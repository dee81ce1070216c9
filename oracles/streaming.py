"""SQL for the replayed streaming queries."""

from __future__ import annotations

from oracles.prelude import sql
from oracles.rest import ALERTING, FIGURES
from oracles.views import VIEWS

SLIDING = """
sliding AS (
  SELECT vendor_code, (actual_delivery_date - 6 + i)::DATE AS first_day, (actual_delivery_date + i)::DATE AS last_day,
         count(*) AS lines, sum(is_otif)::BIGINT AS otif_lines, sum(is_otif)::DOUBLE / count(*)::DOUBLE AS otif_share
  FROM ll, (SELECT unnest(range(7))::INTEGER AS i) GROUP BY 1, 2, 3)"""

_CH = "CASE severity WHEN 'CRITICAL' THEN 'Teams,Email,Slack' WHEN 'BREACHED' THEN 'Teams,Email' ELSE 'Email' END"

STREAMING = {
    "t01_refresh_on_arrival": FIGURES,
    "t11_maintained_lines": VIEWS["v01_otif_line_level"],
    "t12_merged_service": sql(
        """SELECT vendor_region, carrier_code, count(*) AS lines, sum(is_on_time)::BIGINT AS on_time, sum(is_in_full)::BIGINT AS in_full,
        sum(is_otif)::BIGINT AS otif, 100.0 * sum(is_on_time)::DOUBLE / count(*) AS on_time_pct,
        100.0 * sum(is_in_full)::DOUBLE / count(*) AS in_full_pct, 100.0 * sum(is_otif)::DOUBLE / count(*) AS otif_pct FROM ll GROUP BY 1, 2"""
    ),
    "t02_line_level_stream": sql(
        """SELECT shipment_number, line_number::BIGINT AS line_number, vendor_code, is_on_time::BIGINT AS is_on_time,
        is_in_full::BIGINT AS is_in_full, is_otif::BIGINT AS is_otif FROM ll"""
    ),
    "t03_daily_kpis": sql(
        """SELECT vendor_code, actual_delivery_date AS first_day, actual_delivery_date AS last_day, count(*) AS lines,
        sum(is_otif)::BIGINT AS otif_lines, sum(is_otif)::DOUBLE / count(*)::DOUBLE AS otif_share FROM ll GROUP BY 1, 2, 3"""
    ),
    "t03b_sliding_kpis": sql("SELECT * FROM sliding", SLIDING),
    "t04_failure_streaks": sql(
        """SELECT vendor_code, actual_delivery_date, shipment_number, line_number::BIGINT AS line_number, delivery_rank,
        CASE WHEN b1 = 0 AND b2 = 0 AND b3 = 0 THEN '4+ CONSECUTIVE FAILURES' WHEN b1 = 0 AND b2 = 0 THEN '3 CONSECUTIVE FAILURES'
             WHEN b1 = 0 THEN '2 CONSECUTIVE FAILURES' ELSE 'SINGLE FAILURE' END AS failure_streak_label
        FROM ranked WHERE is_otif = 0"""
    ),
    "t05_cooldown": f"SELECT alert_id, alert_type, entity, severity FROM ({ALERTING['a11_cooldown']})",
    "t06_escalation": f"SELECT alert_id, entity FROM ({ALERTING['a09_escalation']})",
    "t07_repeated_critical": sql(
        """SELECT alert_id, alert_type, entity, severity, ts FROM (
        SELECT *, lag(ts) OVER (PARTITION BY entity ORDER BY ts, alert_id) AS prev FROM f_alerts WHERE severity = 'CRITICAL')
        WHERE prev >= ts - INTERVAL 24 HOUR"""
    ),
    "t08_threshold_alerts": sql(
        """SELECT vendor_code, last_day, otif_share, CASE WHEN otif_share < 0.85 THEN 'Critical' ELSE 'Breached' END AS severity
        FROM sliding WHERE otif_share < 0.92""", SLIDING
    ),
    "t09_channel_fan_out": sql(
        f"""SELECT channel, severity, n AS sends FROM (SELECT severity, unnest(string_split({_CH}, ',')) AS channel, n
        FROM (SELECT severity, count(*) AS n FROM f_alerts GROUP BY 1)) WHERE channel <> 'Slack'"""
    ),
    "t10_late_corrections": sql(
        """SELECT vendor_code, actual_delivery_date AS first_day, count(*) AS lines, sum(is_otif)::BIGINT AS otif_lines
        FROM ll WHERE actual_delivery_date < DATE '1996-01-01' GROUP BY 1, 2"""
    ),
}

# The keyed forms give the same rows.
STREAMING["t04b_keyed_streaks"] = STREAMING["t04_failure_streaks"]
STREAMING["t05b_keyed_cooldown"] = STREAMING["t05_cooldown"]
