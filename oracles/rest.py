"""SQL for ERP mapping, row security, quality checks, sources and alert handling."""

from __future__ import annotations

from oracles.measures import FX, RECENT_FAILS, rolled
from oracles.prelude import sql
from oracles.views import HIERARCHY

# --- ERP documents, restated over the common tables -------------------------------------

DOCS = """
x_kna1 AS (SELECT customer_code AS kunnr, customer_name AS name1, CASE WHEN customer_id % 11 <> 0 THEN region END AS regio,
                  CASE WHEN customer_id % 13 <> 0 THEN 'US' END AS land1 FROM f_customers),
x_lfa1 AS (SELECT vendor_code AS lifnr, vendor_name AS name1, CASE WHEN vendor_id % 7 <> 0 THEN region END AS regio,
                  CASE WHEN vendor_id % 5 <> 0 THEN 'US' END AS land1 FROM f_vendors),
x_mara AS (SELECT sku AS matnr, CASE WHEN product_id % 9 <> 0 THEN product_name END AS maktx, category AS matkl,
                  CASE WHEN product_id % 4 = 0 THEN '' WHEN product_id % 4 <> 1 THEN 'EA' END AS meins FROM f_products),
x_items AS (SELECT ol.order_number AS vbeln, ol.order_number::BIGINT AS k, ol.line_number AS n, ol.ordered_qty AS q,
                   o.requested_delivery_date AS due FROM f_order_lines ol JOIN f_orders o USING (order_number)),
x_vbep AS (
  SELECT 100 AS mandt, vbeln, n AS posnr, 1 AS etenr, due + (n % 2)::INTEGER AS edatu, q AS wmeng,
         CASE WHEN (k + n) % 10 <> 0 THEN q END AS lmeng FROM x_items WHERE (k + n) % 6 <> 0
  UNION ALL SELECT 100, vbeln, n, 2, due + 7, 1, 1 FROM x_items WHERE (k + n) % 4 = 0
  UNION ALL SELECT 200, vbeln, n, 0, DATE '1990-01-01', 0, 0 FROM x_items WHERE k % 20 = 1),
x_first_o AS (SELECT vbeln, edatu FROM (SELECT *, row_number() OVER (PARTITION BY vbeln ORDER BY etenr, posnr) AS rn
              FROM x_vbep WHERE mandt = 100) WHERE rn = 1),
x_first_l AS (SELECT vbeln, posnr, lmeng, wmeng FROM (SELECT *, row_number() OVER (PARTITION BY vbeln, posnr ORDER BY etenr) AS rn
              FROM x_vbep WHERE mandt = 100) WHERE rn = 1),
x_flow AS (SELECT shipment_number AS vbeln, n AS posnn, order_number AS vbeln_v FROM f_delivery_lines WHERE (3 * k + n) % 50 <> 0),
xo AS (SELECT order_number, order_date, coalesce(edatu, order_date) AS requested_delivery_date, total_value,
              currency, '10' || (order_id % 3) AS sales_org, customer_code
       FROM f_orders LEFT JOIN x_first_o ON vbeln = order_number),
xs AS (SELECT s.*, f.vbeln_v FROM f_shipments s JOIN x_flow f ON f.vbeln = s.shipment_number WHERE s.actual_delivery_date IS NOT NULL),
xd AS (SELECT d.shipment_number, f.vbeln_v AS order_number, d.line_number, d.sku, d.delivered_qty
       FROM f_delivery_lines d JOIN x_flow f ON f.vbeln = d.shipment_number AND f.posnn = d.line_number)"""

ERP = {
    "e01_sap_customers": sql(
        "SELECT kunnr AS customer_code, name1 AS customer_name, coalesce(regio, 'N/A') AS region, coalesce(land1, 'US') AS country FROM x_kna1", DOCS),
    "e02_sap_vendors": sql(
        "SELECT lifnr AS vendor_code, name1 AS vendor_name, coalesce(regio, 'N/A') AS region, coalesce(land1, 'US') AS country, 'standard' AS tier FROM x_lfa1", DOCS),
    "e03_sap_products": sql(
        "SELECT matnr AS sku, coalesce(maktx, matnr) AS product_name, matkl AS category, CASE WHEN meins = '' THEN 'EA' ELSE meins END AS unit_of_measure FROM x_mara", DOCS),
    "e04_sap_orders": sql(
        """SELECT order_number, order_date, requested_delivery_date, total_value::DOUBLE AS total_value, currency, sales_org,
        'completed' AS order_status, customer_code FROM xo""", DOCS),
    "e05_sap_order_lines": sql(
        """SELECT ol.order_number, ol.line_number::DOUBLE AS line_number, ol.sku, ol.category, ol.ordered_qty::DOUBLE AS ordered_qty,
        coalesce(f.lmeng, ol.ordered_qty)::DOUBLE AS confirmed_qty, coalesce(f.wmeng, ol.ordered_qty)::DOUBLE AS delivered_qty,
        'EA' AS unit_of_measure, CASE WHEN ol.order_number::BIGINT % 2 = 0 THEN 'X' END AS partial_delivery_flag,
        price_cents / 100.0::DOUBLE AS unit_price
        FROM f_order_lines ol LEFT JOIN x_first_l f ON f.vbeln = ol.order_number AND f.posnr = ol.line_number""", DOCS),
    "e06_sap_shipments": sql(
        """SELECT shipment_number, vbeln_v AS order_number, planned_ship_date, planned_delivery_date, actual_ship_date,
        actual_delivery_date, 'delivered' AS shipment_status, shipping_point, route, incoterm, 'LF' AS delivery_type,
        NULL::VARCHAR AS carrier_code, NULL::VARCHAR AS carrier_name, NULL::VARCHAR AS carrier_mode, NULL::VARCHAR AS vendor_code,
        NULL::VARCHAR AS vendor_region FROM xs""", DOCS),
    "e07_sap_delivery_lines": sql(
        """SELECT shipment_number, order_number, line_number::DOUBLE AS line_number, sku, delivered_qty::DOUBLE AS delivered_qty,
        0::BIGINT AS damage_qty, 'EA' AS unit_of_measure FROM xd""", DOCS),
    "e08_line_level_on_erp": sql(
        """SELECT s.shipment_number, s.order_number, d.line_number::BIGINT AS line_number, o.requested_delivery_date AS requested_date,
        s.actual_delivery_date, ol.ordered_qty::DOUBLE AS ordered_qty, d.delivered_qty::DOUBLE AS delivered_qty,
        (CASE WHEN s.actual_delivery_date BETWEEN o.requested_delivery_date - 1 AND o.requested_delivery_date THEN 1 ELSE 0 END)::BIGINT AS is_on_time,
        (CASE WHEN d.delivered_qty >= ol.ordered_qty THEN 1 ELSE 0 END)::BIGINT AS is_in_full,
        (CASE WHEN s.actual_delivery_date BETWEEN o.requested_delivery_date - 1 AND o.requested_delivery_date
               AND d.delivered_qty >= ol.ordered_qty THEN 1 ELSE 0 END)::BIGINT AS is_otif,
        (ol.ordered_qty - d.delivered_qty) * ol.price_cents / 100.0::DOUBLE AS backorder_value
        FROM (SELECT DISTINCT shipment_number, vbeln_v AS order_number, actual_delivery_date FROM xs) s
        JOIN xo o USING (order_number) JOIN xd d USING (shipment_number, order_number)
        JOIN f_order_lines ol ON ol.order_number = d.order_number AND ol.line_number = d.line_number""", DOCS),
}

# --- Row security -----------------------------------------------------------------------

_ORDERS_IN = "SELECT order_number FROM f_orders WHERE customer_code IN (SELECT customer_code FROM f_customers WHERE region {w})"


def _tally(**sizes: str) -> str:
    names = ["customers", "vendors", "products", "carriers", "orders", "order_lines", "shipments",
             "delivery_lines", "backorders", "alert_history"]
    return sql("\nUNION ALL ".join(f"SELECT '{n}' AS table_name, ({sizes.get(n, '0::BIGINT')}) AS rows" for n in names))


def _full() -> dict[str, str]:
    names = {n: n for n in ["customers", "vendors", "products", "orders", "order_lines", "shipments", "delivery_lines", "backorders"]}
    out = {n: f"SELECT count(*) FROM f_{t}" for n, t in names.items()}
    out["carriers"] = "SELECT count(DISTINCT v % 9) FROM f_supplier"
    out["alert_history"] = "SELECT count(*) FROM f_history"
    return out


def _regional(w: str) -> dict[str, str]:
    return {
        "customers": f"SELECT count(*) FROM f_customers WHERE region {w}",
        "vendors": f"SELECT count(*) FROM f_vendors WHERE region {w}",
        "orders": f"SELECT count(*) FROM ({_ORDERS_IN.format(w=w)})",
        "order_lines": f"SELECT count(*) FROM f_order_lines WHERE order_number IN ({_ORDERS_IN.format(w=w)})",
        "shipments": f"SELECT count(*) FROM f_shipments WHERE vendor_region {w}",
        "alert_history": f"SELECT count(*) FROM f_history WHERE region {w}",
    }


_IN = _ORDERS_IN.format(w="= 'ASIA'")

SECURITY = {
    "r01_region_unset": _tally(),
    "r02a_region_customers": sql("SELECT customer_id, customer_code, customer_name, region, country FROM f_customers WHERE region = 'ASIA'"),
    "r02b_region_vendors": sql("SELECT vendor_code, vendor_name, region, tier FROM f_vendors WHERE region = 'ASIA'"),
    "r02c_region_alert_history": sql("SELECT alert_history_id, alert_type, entity, region, severity FROM f_history WHERE region = 'ASIA'"),
    "r03_region_orders": sql(
        f"""SELECT order_id, order_number, customer_code, order_date, requested_delivery_date, order_status, channel, currency,
        total_value::DOUBLE AS total_value FROM f_orders WHERE order_number IN ({_IN})"""),
    "r04_region_order_lines": sql(
        f"SELECT order_number, line_number::BIGINT AS line_number, sku, ordered_qty::DOUBLE AS ordered_qty FROM f_order_lines WHERE order_number IN ({_IN})"),
    "r05_region_shipments": sql("SELECT shipment_number, vendor_code, vendor_region FROM f_shipments WHERE vendor_region = 'ASIA'"),
    "r06_reporting_user": _tally(**_full()),
    "r07_auditor": _tally(alert_history="SELECT count(*) FROM f_history"),
    "r08_default_deny": _tally(**_regional("= 'ASIA'")),
    "r09_combined_grants": _tally(**{**_regional("IN ('ASIA', 'AFRICA')"), "alert_history": "SELECT count(*) FROM f_history"}),
    "r10_regional_line_level": sql(
        f"""SELECT vendor_code, count(*) AS lines, sum(is_otif)::BIGINT AS otif_lines FROM ll
        WHERE vendor_region = 'ASIA' AND order_number IN ({_IN}) GROUP BY 1"""),
}

# --- Quality ----------------------------------------------------------------------------

_DUP = "SELECT '{label}' AS check_name, count(*) AS violations FROM (SELECT 1 FROM {src} GROUP BY {keys} HAVING count(*) > 1)"


def _dup(label: str, src: str, keys: str) -> str:
    return _DUP.format(label=label, src=src, keys=keys)


def _orphan(child: str, parent: str, keys: str) -> str:
    on = " AND ".join(f"p.{k} = c.{k}" for k in keys.split(","))
    return (f"SELECT '{child}->{parent}({keys})' AS check_name, count(*) AS violations FROM f_{child} c "
            f"WHERE NOT EXISTS (SELECT 1 FROM f_{parent} p WHERE {on})")


QUALITY = {
    "q01_snapshot_keys": sql("\nUNION ALL ".join([
        _dup("rolling_7d", "r7", "vendor_code, metric_date"),
        _dup("vendor_hierarchy", "f_vendors", "vendor_code"),
        _dup("carrier_scorecard", "scorecard", "carrier_code, delivery_week"),
        _dup("alert_summary", "summary", "alert_type, entity, metric_value, event_date"),
    ])),
    "q02_natural_keys": sql("\nUNION ALL ".join([
        _dup("orders.order_number", "f_orders", "order_number"),
        _dup("shipments.shipment_number", "f_shipments", "shipment_number"),
    ])),
    "q03_orphans": sql("\nUNION ALL ".join([
        _orphan("order_lines", "orders", "order_number"), _orphan("shipments", "orders", "order_number"),
        _orphan("delivery_lines", "shipments", "shipment_number"),
        _orphan("delivery_lines", "order_lines", "order_number,line_number"),
        _orphan("backorders", "order_lines", "order_number,line_number"),
    ])),
    "q02b_repeated_natural_keys": sql(
        """SELECT 'orders.order_number' AS check_name, count(*) FILTER (order_id % 50 = 0 AND order_id % 40 <> 0) AS violations FROM f_orders
        UNION ALL SELECT 'shipments.shipment_number', count(*) FILTER (shipment_id % 3 = 0) FROM f_shipments"""),
    "q03b_lost_parents": sql(
        """, gone AS (SELECT order_number FROM f_orders WHERE order_id % 40 = 0)
        SELECT 'order_lines->orders(order_number)' AS check_name, count(*) AS violations FROM f_order_lines SEMI JOIN gone USING (order_number)
        UNION ALL SELECT 'shipments->orders(order_number)', coalesce(sum(CASE WHEN shipment_id % 3 = 0 THEN 2 ELSE 1 END), 0)::BIGINT
          FROM f_shipments SEMI JOIN gone USING (order_number)
        UNION ALL VALUES ('delivery_lines->shipments(shipment_number)', 0), ('delivery_lines->order_lines(order_number,line_number)', 0),
          ('backorders->order_lines(order_number,line_number)', 0)"""),
    "q04b_masters_in_two_regions": sql(
        """SELECT 'vendor_code with several regions' AS check_name, count(DISTINCT vendor_code) AS violations
          FROM f_shipments WHERE shipment_id % 3 = 0
        UNION ALL SELECT 'carrier_code with several names or modes', 0"""),
    "q04_ambiguous_masters": sql(
        """SELECT 'vendor_code with several regions' AS check_name, count(*) AS violations FROM
          (SELECT vendor_code FROM f_shipments GROUP BY 1 HAVING count(DISTINCT vendor_region) > 1)
        UNION ALL SELECT 'carrier_code with several names or modes', count(*) FROM
          (SELECT carrier_code FROM f_shipments GROUP BY 1 HAVING count(DISTINCT carrier_name || carrier_mode) > 1)"""),
    "q05_in_full_asymmetry": sql(
        """SELECT vendor_code, sum(CASE WHEN is_otif = 1 AND is_in_full = 0 THEN 1 ELSE 0 END)::BIGINT AS otif_not_in_full,
        count(*) AS lines FROM ll GROUP BY 1"""),
}

# --- Sources ----------------------------------------------------------------------------

_NUMBERS = {
    "rolling_7d": ("r7", "vendor_code || '/' || metric_date",
                   "total_lines on_time_lines in_full_lines otif_lines otif_pct on_time_pct in_full_pct rolling_7d_otif_pct "
                   "rolling_7d_line_count rolling_7d_backorder_cost"),
    "vendor_hierarchy": ("hierarchy", "vendor_code",
                         "total_ordered_qty total_delivered_qty total_shipments total_orders overall_otif_pct rank_in_region"),
    "carrier_scorecard": ("scorecard", "carrier_code || '/' || delivery_week",
                          "total_deliveries on_time_count on_time_pct rolling_4wk_on_time_pct"),
    "alert_summary": ("summary", "concat_ws('/', alert_type, entity, event_date::DATE)", "metric_value sla_threshold gap_to_threshold"),
}


def _long(name: str, source: str, key: str, numbers: str) -> str:
    labels, values = (", ".join(form.format(c) for c in numbers.split()) for form in ("'{}'", "{}::DOUBLE"))
    return f"SELECT '{name}' AS snapshot, {key} AS row_key, unnest([{labels}]) AS figure, unnest([{values}]) AS value FROM {source}"


#: Every number of the four snapshots.
FIGURES = sql(
    " UNION ALL ".join(_long(name, *x) for name, x in _NUMBERS.items()), f"hierarchy AS ({HIERARCHY})"
)

# Column of a table -> SQL over its rows; one that is named alone stands for itself.
_CONTENTS = {
    "customers": ("f_customers", "customer_id customer_code customer_name region country", {}),
    "vendors": ("f_vendors", "vendor_id vendor_code vendor_name region country tier", {}),
    "products": ("f_products", "product_id sku product_name category subcategory unit_of_measure unit_price",
                 {"unit_price": "(price_cents / 100.0)::DECIMAL(18,2)"}),
    "orders": ("f_orders", "order_id order_number customer_code order_date requested_delivery_date order_status channel currency "
               "total_value", {}),
    "order_lines": ("f_order_lines", "order_line_id order_number line_number sku product_name category ordered_qty confirmed_qty "
                    "unit_price line_total partial_delivery_allowed",
                    {"ordered_qty": "ordered_qty::DECIMAL(18,3)", "confirmed_qty": "confirmed_qty::DECIMAL(18,3)",
                     "unit_price": "(price_cents / 100.0)::DECIMAL(18,2)", "line_total": "(line_cents / 100.0)::DECIMAL(18,2)",
                     "partial_delivery_allowed": "1"}),
    "shipments": ("f_shipments", "shipment_id shipment_number order_number carrier_code carrier_name carrier_mode vendor_code "
                  "vendor_region shipping_point route planned_ship_date planned_delivery_date actual_ship_date actual_delivery_date "
                  "shipment_status delivery_type incoterm", {}),
    "delivery_lines": ("f_delivery_lines", "delivery_line_id shipment_number order_number line_number product_id sku delivered_qty "
                       "damage_qty", {"delivered_qty": "delivered_qty::DECIMAL(18,3)", "damage_qty": "damage_qty::DECIMAL(18,3)"}),
    "backorders": ("f_backorders", "backorder_id order_number line_number product_id backorder_qty estimated_fill_date status "
                   "created_at", {"backorder_qty": "backorder_qty::DECIMAL(18,3)"}),
}


def _sums(table: str, left_out: str = "", where: str = "true") -> str:
    source, columns, forms = _CONTENTS[table]
    texts = [f"({forms.get(c, c)})::VARCHAR" for c in sorted(columns.split()) if c not in left_out.split()]
    row = " || ".join(f"coalesce(length({x}) || '=' || {x}, '-')" for x in texts)
    parts = " || '-' || ".join(f"coalesce(sum(('0x' || substr(h, {k}, 15))::BIGINT), 0)::VARCHAR" for k in (1, 16))
    return f"SELECT count(*) AS rows, {parts} AS checksum FROM (SELECT md5({row}) AS h FROM {source} WHERE {where})"


def _all_sums(**left_out: str) -> str:
    return sql(" UNION ALL ".join(f"SELECT '{t}' AS table_name, * FROM ({_sums(t, left_out.get(t, ''))})" for t in _CONTENTS))


SOURCES = {
    "m02c_orders_sketched": sql("SELECT vendor_region, count(DISTINCT order_number) AS exact, true AS close FROM ll GROUP BY 1"),
    "m03b_shipments_sketched": sql(
        "SELECT vendor_region, carrier_mode, count(DISTINCT shipment_number) AS exact, true AS close FROM ll GROUP BY 1, 2"
    ),
    "a17_dated_targets": sql(
        """SELECT vendor_code, carrier_code, actual_delivery_date, otif_pct, target, target - otif_pct AS gap FROM (
        SELECT *, CASE WHEN strategic AND actual_delivery_date >= DATE '1996-01-01' THEN 95.0
                       WHEN carrier_code = one AND actual_delivery_date BETWEEN DATE '1995-03-15' AND DATE '1997-06-20' THEN 90.0
                       WHEN month(actual_delivery_date) IN (11, 12) THEN 88.0 ELSE 92.0 END::DOUBLE AS target
        FROM (SELECT ll.vendor_code, ll.carrier_code, actual_delivery_date, 100.0::DOUBLE * sum(is_otif)::DOUBLE / count(*)::DOUBLE AS otif_pct,
                     coalesce(bool_or(v.tier = 'strategic'), false) AS strategic,
                     (SELECT min(carrier_code) FROM ll) AS one
              FROM ll LEFT JOIN f_vendors v ON v.vendor_code = ll.vendor_code GROUP BY 1, 2, 3)) WHERE otif_pct < target"""
    ),
    "s01_typed_tables": sql(
        """SELECT order_id, order_number, customer_code, order_date, requested_delivery_date, order_status, channel, currency,
        total_value::DOUBLE AS total_value FROM f_orders"""),
    "s02_typed_erp_tables": sql(
        """SELECT 'kna1' AS table_name, (SELECT count(*) FROM x_kna1) AS rows UNION ALL SELECT 'lfa1', (SELECT count(*) FROM x_lfa1)
        UNION ALL SELECT 'mara', (SELECT count(*) FROM x_mara) UNION ALL SELECT 'vbak', (SELECT count(*) FROM f_orders)
        UNION ALL SELECT 'vbap', (SELECT count(*) FROM f_order_lines) UNION ALL SELECT 'vbep', (SELECT count(*) FROM x_vbep)
        UNION ALL SELECT 'likp', (SELECT count(*) FROM f_shipments) UNION ALL SELECT 'lips', (SELECT count(*) FROM f_delivery_lines)
        UNION ALL SELECT 'vbfa', (SELECT count(*) FROM f_delivery_lines)""", DOCS),
    "s03_absent_column_defaults": sql(
        """SELECT 'vendors' AS table_name, 'US/standard' AS filled, count(*) AS rows FROM f_vendors
        UNION ALL SELECT 'delivery_lines', '0', count(*) FROM f_delivery_lines"""),
    "s04_csv_round_trip": sql(
        """SELECT row_number() OVER (ORDER BY shipment_number, order_number, line_number) AS delivery_line_id, shipment_number, order_number,
        line_number::BIGINT AS line_number, product_id, sku, delivered_qty::DOUBLE AS delivered_qty, damage_qty::DOUBLE AS damage_qty
        FROM f_delivery_lines"""),
    "s04b_csv_checksums": _all_sums(
        customers="customer_id", vendors="vendor_id country", products="product_id", orders="order_id",
        order_lines="order_line_id", shipments="shipment_id", delivery_lines="delivery_line_id", backorders="backorder_id",
    ),
    "s06_surrogate_keys": sql("SELECT row_number() OVER (ORDER BY shipment_number) AS shipment_id, shipment_number FROM f_shipments"),
    "s07_reload": _tally(**_full()),
    "s07b_reload_checksums": _all_sums(),
    "s08b_unchanged_snapshot": sql(f"SELECT *, 2 AS versions FROM ({_sums('shipments', where='shipment_id % 2 = 0')})"),
    "s08_snapshot": sql("SELECT * FROM r7"),
    "s10_refresh_all": FIGURES,
    "s11_row_counts": _tally(**_full()),
    "s12_bi_extract": sql(
        """SELECT carrier_mode, count(*) AS total_lines, (SELECT count(*) FROM f_customers) AS customers FROM ll GROUP BY 1"""),
}

# --- Alert handling ---------------------------------------------------------------------

ACTIVE = """
active AS (SELECT * FROM summary WHERE alert_severity IN ('CRITICAL', 'BREACHED', 'HIGH', 'WARNING'))"""

BODIES = """
bodies AS (
  SELECT event_id, (round(value)::BIGINT % 100) / 100.0::DOUBLE AS m,
         CASE WHEN event_id % 2 = 0 THEN 'Less than' ELSE 'Greater than' END AS way, event_id % 10 > 6 AS ok, user_id
  FROM events)"""

_CH = "CASE severity WHEN 'CRITICAL' THEN 'Teams,Email,Slack' WHEN 'BREACHED' THEN 'Teams,Email' WHEN 'HIGH' THEN 'Teams,Email' ELSE 'Email' END"
_ABS = "CASE WHEN m < 0.85 THEN 'Critical' WHEN m < 0.92 THEN 'Breached' ELSE 'Warning' END"

_OUTLIERS = """SELECT order_week, stage, average, outlier_limit FROM (
          SELECT *, sum(CASE WHEN average > outlier_limit THEN 1 ELSE 0 END) OVER (PARTITION BY stage ORDER BY order_week ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM (
            SELECT order_week, 'ORDER_TO_SHIP' AS stage, avg_order_to_ship AS average, {a}::DOUBLE AS outlier_limit FROM trends
            UNION ALL SELECT order_week, 'SHIP_TO_DELIVERY', avg_ship_to_delivery, {b}::DOUBLE FROM trends
            UNION ALL SELECT order_week, 'TOTAL_LEAD_TIME', avg_total_lead_time, {c}::DOUBLE FROM trends)) WHERE n = 2"""

_TREND = """SELECT vendor_code, r7 AS rolling_7d_otif, r7 - before7 AS change, 'WARNING' AS alert_severity FROM rolled
        WHERE r7 >= {target} AND r7 - before7 < {fall}"""

ALERTING = {
    "a01_active_alerts": sql("SELECT * FROM active", ACTIVE),
    "a01b_active_with_exceeded": sql("SELECT alert_type, alert_severity, count(*) AS alerts FROM summary GROUP BY 1, 2"),
    "a02_channels": sql(
        f"""SELECT severity AS alert_severity, unnest(string_split(ch, ',')) AS channel, n AS sends FROM
        (SELECT severity, {_CH} AS ch, n FROM (SELECT alert_severity AS severity, count(*) AS n FROM active GROUP BY 1))""", ACTIVE),
    "a03_payload": sql(
        """SELECT alert_type AS "AlertType", alert_severity AS "Severity", strftime(alert_generated_at, '%Y-%m-%dT%H:%M:%S') AS "TriggerTime",
        entity AS "EntityID", metric_value AS "MetricValue", sla_threshold AS "Threshold", gap_to_threshold AS "Gap",
        alert_description AS "Message" FROM active""", ACTIVE),
    "a04_audit_append": sql(
        f"""SELECT (SELECT max(alert_history_id) FROM f_history) + row_number() OVER (ORDER BY alert_type, entity, event_date, metric_value) AS alert_history_id,
        alert_type, entity, region, severity, metric_value::FLOAT::DOUBLE AS metric_value, sla_threshold::FLOAT::DOUBLE AS threshold_value,
        alert_description, {_CH} AS channels, 0::BIGINT AS acknowledged, 0::BIGINT AS escalated
        FROM (SELECT active.*, alert_severity AS severity, region FROM active LEFT JOIN f_vendors ON vendor_code = entity)""", ACTIVE),
    "a05_a06_event_severity": sql(
        f"""SELECT event_id, m AS metric_value, {_ABS} AS absolute,
        CASE WHEN m < 0.85::DOUBLE * 0.92::DOUBLE THEN 'Critical' WHEN m < 0.92 THEN 'Breached' ELSE 'Warning' END AS relative,
        CASE WHEN way = 'Less than' THEN CASE WHEN m < 0.85::DOUBLE * 0.92::DOUBLE THEN 'Critical' WHEN m < 0.92 THEN 'Breached' ELSE 'Warning' END
             ELSE CASE WHEN m * 0.85::DOUBLE > 0.92 THEN 'Critical' WHEN m > 0.92 THEN 'Breached' ELSE 'Warning' END END AS directed
        FROM bodies WHERE ok""", BODIES),
    "a07_event_validation": sql("SELECT event_id, ok AS is_valid, CASE WHEN ok THEN m END AS metric_value FROM bodies", BODIES),
    "a07b_event_dialects": sql(
        """SELECT event_id, m AS metric_value, 0.92::DOUBLE AS threshold, 'Less than' AS direction,
        CASE WHEN event_id % 2 = 0 THEN 'Critical' END AS severity, CASE WHEN event_id % 2 = 0 THEN 'V' || user_id END AS vendor_code,
        CASE WHEN event_id % 2 = 0 THEN 'ASIA' END AS region FROM bodies""", BODIES),
    "a08_acknowledgment": sql(
        """SELECT alert_history_id, entity, (CASE WHEN alert_history_id % 3 = 0 THEN 1 ELSE 0 END)::BIGINT AS acknowledged,
        CASE WHEN alert_history_id % 6 = 0 THEN 'manager' WHEN alert_history_id % 3 = 0 THEN 'analyst' END AS acknowledged_by,
        CASE WHEN alert_history_id % 6 = 0 THEN created_at + to_minutes(alert_history_id % 60 + 5)
             WHEN alert_history_id % 3 = 0 THEN created_at + to_minutes(alert_history_id % 60) END AS acknowledged_at,
        0::BIGINT AS escalated FROM f_history"""),
    "a09_escalation": sql(
        """SELECT alert_id, entity, ts, ts + INTERVAL 30 MINUTE AS escalate_at FROM f_alerts a WHERE severity = 'CRITICAL'
        AND NOT EXISTS (SELECT 1 FROM f_acks k WHERE k.entity = a.entity AND k.ack_ts BETWEEN a.ts AND a.ts + INTERVAL 30 MINUTE)"""),
    "a10_repeated_critical": sql(
        """SELECT alert_id, alert_type, entity, severity, ts FROM (
        SELECT *, lag(ts) OVER (PARTITION BY entity ORDER BY ts, alert_id) AS prev FROM f_alerts WHERE severity = 'CRITICAL')
        WHERE prev >= ts - INTERVAL 24 HOUR"""),
    "a10b_repeated_critical_all": sql(
        """SELECT alert_id, alert_type, entity, severity, ts FROM (
        SELECT *, lag(ts) OVER (ORDER BY ts, alert_id) AS prev FROM f_alerts WHERE severity = 'CRITICAL')
        WHERE prev >= ts - INTERVAL 24 HOUR"""),
    "a11_cooldown": sql(
        """, walk AS (
        SELECT alert_type, entity, min(ts) AS ts FROM f_alerts GROUP BY 1, 2
        UNION ALL
        SELECT w.alert_type, w.entity, (SELECT min(a.ts) FROM f_alerts a WHERE a.alert_type = w.alert_type AND a.entity = w.entity
          AND a.ts >= w.ts + CASE WHEN w.alert_type = 'CONSECUTIVE_FAILURES' THEN INTERVAL 1 HOUR ELSE INTERVAL 6 HOUR END)
        FROM walk w WHERE w.ts IS NOT NULL)
        SELECT min(a.alert_id) AS alert_id, a.alert_type, a.entity, min_by(a.severity, a.alert_id) AS severity, a.ts
        FROM walk w JOIN f_alerts a ON a.alert_type = w.alert_type AND a.entity = w.entity AND a.ts = w.ts GROUP BY 2, 3, 5"""
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "a12_quiet_hours": sql(
        """SELECT alert_id, alert_type, entity, severity, ts FROM f_alerts WHERE isodow(ts) < 6 AND day(ts) NOT IN (1, 15)"""),
    "a13_measure_alerts": sql(
        """SELECT rule, metric, entity, value, direction, threshold FROM (
          SELECT 'rolling_7d_otif' AS metric, 'ALL' AS entity, sum(on_time * in_full)::DOUBLE / count(*)::DOUBLE AS value FROM fx WHERE day >= (SELECT max(day) FROM fx) - 6
          UNION ALL SELECT 'open_backorder_cost', 'ALL', (SELECT sum(b.backorder_qty * ol.price_cents)::BIGINT / 100.0::DOUBLE
            FROM f_backorders b JOIN f_order_lines ol USING (order_number, line_number) WHERE b.status = 'open')
          UNION ALL SELECT 'current_failure_streak', vendor_code, value::DOUBLE FROM recent_fails
          UNION ALL SELECT 'carrier_on_time_share', carrier_code, sum(on_time)::DOUBLE / count(*)::DOUBLE FROM fx GROUP BY carrier_code)
        JOIN (VALUES ('OTIF SLA Breach', 'rolling_7d_otif', 'Less than', 0.92::DOUBLE),
          ('Backorder Cost Threshold', 'open_backorder_cost', 'Greater than', 10000::DOUBLE),
          ('Backorder Cost Aggregate', 'open_backorder_cost', 'Greater than', 50000::DOUBLE),
          ('Consecutive Delivery Failures', 'current_failure_streak', 'Greater than', 2::DOUBLE),
          ('Carrier Performance Breach', 'carrier_on_time_share', 'Less than', 0.85::DOUBLE)) r(rule, metric, direction, threshold) USING (metric)
        WHERE CASE WHEN direction = 'Less than' THEN value < threshold ELSE value > threshold END""", FX, RECENT_FAILS),
    "a14_trend_warning": sql(_TREND.format(target=0.92, fall=-0.05), FX, rolled("vendor_code")),
    "a14b_trend_warning_wide": sql(_TREND.format(target=0.70, fall=-0.01), FX, rolled("vendor_code")),
    "a15_dwell_outliers": sql(_OUTLIERS.format(a=5.0, b=7.0, c=10.0)),
    "a15b_dwell_outliers_tight": sql(_OUTLIERS.format(a=4.4, b=1.8, c=6.3)),
    "a16_message_fields": sql(
        f"""SELECT event_id, 'Complete deliveries fell' AS title, printf('%.2f%%', m * 100) AS metric, '92.00%' AS threshold_text,
        way AS direction_text, 'Fulfilment watch' AS dashboard, 'Weekly share' AS card, {_ABS} AS severity
        FROM bodies WHERE ok""", BODIES),
}

ALERTING["a11b_cooldown_by_joins"] = ALERTING["a11_cooldown"]
