import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from dockside.operators import alerts, backorders, dwell, otif, sequences
from micro import day, frame, merged, one_line_order, rows, tables

R7 = (
    T.StructType().add("vendor_code", "string").add("vendor_region", "string").add("metric_date", "date")
    .add("rolling_7d_otif_pct", "double").add("rolling_7d_line_count", "long")
    .add("rolling_7d_backorder_cost", "decimal(18,2)")
)


def test_streak_labels(spark):
    # The late ones arrive a day later, so give each its own due date far apart.
    parts = []
    for i, ok in enumerate([0, 1, 0, 0, 1, 0, 0, 0, 0, 0]):
        due = dt.date(2024, 1, 1) + dt.timedelta(days=5 * i)
        parts.append(one_line_order(i + 1, requested=due, delivered_on=due if ok else due + dt.timedelta(days=2)))
    ll = otif.line_level(tables(spark, **merged(*parts)))
    got = sequences.consecutive_failures(ll).orderBy("delivery_rank")
    assert rows(got, "delivery_rank", "failure_streak_label", "failure_reason") == [
        (1, "SINGLE FAILURE", "LATE"), (3, "SINGLE FAILURE", "LATE"), (4, "2 CONSECUTIVE FAILURES", "LATE"),
        (6, "SINGLE FAILURE", "LATE"), (7, "2 CONSECUTIVE FAILURES", "LATE"),
        (8, "3 CONSECUTIVE FAILURES", "LATE"), (9, "4+ CONSECUTIVE FAILURES", "LATE"),
        (10, "4+ CONSECUTIVE FAILURES", "LATE"),
    ]
    fired = alerts.consecutive_failure_alerts(sequences.consecutive_failures(ll)).orderBy("delivery_rank")
    assert rows(fired, "delivery_rank", "alert_severity") == [(8, "HIGH"), (9, "CRITICAL"), (10, "CRITICAL")]
    ahead = sequences.failures_lead(ll).orderBy("actual_delivery_date")
    assert rows(ahead, "forward_look_status", "escalation_flag") == [
        ("RECOVERING", "MONITOR"), ("IMPENDING_FAILURE", "MONITOR"), ("IMMINENT_STREAK", "MONITOR"),
        ("RECOVERING", "MONITOR"), ("IMPENDING_FAILURE", "MONITOR"), ("IMMINENT_STREAK", "ESCALATE"),
        ("IMMINENT_STREAK", "ESCALATE"), ("IMMINENT_STREAK", "ESCALATE"), ("IMMINENT_STREAK", "MONITOR"),
        ("STABLE", "MONITOR"),
    ]


@pytest.mark.parametrize("share, severity", [
    (92.0, None), (91.99, "BREACHED"), (85.0, "BREACHED"), (84.99, "CRITICAL"), (None, None),
])
def test_otif_alert_bands(spark, share, severity):
    r7 = frame(spark, R7, [
        dict(vendor_code="V1", vendor_region="R", metric_date="2024-01-01", rolling_7d_otif_pct=10.0),
        dict(vendor_code="V1", vendor_region="R", metric_date="2024-01-02", rolling_7d_otif_pct=share),
    ])
    got = alerts.otif_below_threshold(r7, day("2024-01-02"))
    assert rows(got, "alert_severity") == ([] if severity is None else [(severity,)])


def test_rolling_frame_counts_delivery_days_not_calendar_days(spark):
    parts = []
    for i in range(9):
        due = dt.date(2024, 1, 1) + dt.timedelta(days=7 * i)
        parts.append(one_line_order(i + 1, requested=due, delivered_on=due, delivered=10 if i >= 2 else 5))
    ll = otif.line_level(tables(spark, **merged(*parts)))
    last = otif.rolling_active_days(ll, day("2024-02-26")).orderBy(F.desc("metric_date")).first()
    assert (last.rolling_7d_otif_pct, last.rolling_7d_line_count) == (100.0, 7)
    assert float(last.rolling_7d_backorder_cost) == 0.0
    month = otif.rolling_active_month(otif.rolling_active_days(ll, day("2024-02-26")))
    assert month.orderBy(F.desc("metric_date")).first().rolling_30d_line_count == 9


def test_lookback_clips_history(spark):
    old = one_line_order(1, requested="2024-01-01", delivered_on="2024-01-01")
    new = one_line_order(2, requested="2024-04-01", delivered_on="2024-04-01")
    ll = otif.line_level(tables(spark, **merged(old, new)))
    assert otif.rolling_active_days(ll, day("2024-04-01")).count() == 1
    assert otif.rolling_active_days(ll, None, lookback_days=None).count() == 2


def test_hierarchy_equals_the_plain_outer_join(spark, small_model):
    t, ll = small_model.tables, small_model.line_level
    naive = (
        t.vendors.alias("v")
        .join(t.shipments.alias("s"), "vendor_code", "left")
        .join(t.orders.alias("o"), F.col("s.order_number") == F.col("o.order_number"), "left")
        .join(t.order_lines.alias("ol"), F.col("ol.order_number") == F.col("o.order_number"), "left")
        .join(t.delivery_lines.alias("dl"), F.col("dl.shipment_number") == F.col("s.shipment_number"), "left")
        .join(ll.alias("x"), F.col("x.shipment_id") == F.col("s.shipment_id"), "left")
        .groupBy("v.vendor_code")
        .agg(
            F.coalesce(F.sum("ol.ordered_qty"), F.lit(0)).cast("double").alias("a"),
            F.coalesce(F.sum("dl.delivered_qty"), F.lit(0)).cast("double").alias("b"),
            F.count_distinct("s.shipment_id").alias("c"),
            F.count_distinct("o.order_number").alias("d"),
            F.round(100.0 * F.sum("x.is_otif") / F.count("x.is_otif") + 1e-9, 2).cast("double").alias("e"),
        )
    )
    ours = otif.vendor_hierarchy(t, ll).select(
        "vendor_code", F.col("total_ordered_qty").cast("double").alias("a"),
        F.col("total_delivered_qty").cast("double").alias("b"), F.col("total_shipments").alias("c"),
        F.col("total_orders").alias("d"), F.col("overall_otif_pct").alias("e"),
    )
    assert sorted(map(tuple, naive.collect()), key=str) == sorted(map(tuple, ours.collect()), key=str)


def test_vendor_without_shipments_is_critical_and_last(spark):
    t = tables(spark, **merged(
        one_line_order(1, requested="2024-01-10", delivered_on="2024-01-20"),
        dict(vendors=[dict(vendor_id=1, vendor_code="V1", vendor_name="a", region="R1"),
                      dict(vendor_id=2, vendor_code="V0", vendor_name="b", region="R1")]),
    ))
    got = otif.vendor_hierarchy(t, otif.line_level(t)).orderBy("rank_in_region")
    assert rows(got, "vendor_code", "overall_otif_pct", "sla_status", "total_shipments") == [
        ("V1", 0.0, "CRITICAL", 1), ("V0", None, "CRITICAL", 0),
    ]


def backorder_tables(spark, qty, status="open"):
    base = one_line_order(1, requested="2024-01-10", delivered_on="2024-01-10")
    return tables(spark, **merged(base, dict(
        products=[dict(product_id=1, sku="S1", product_name="p", unit_price=100)],
        backorders=[dict(backorder_id=1, order_number="O1", line_number=1, product_id=1, backorder_qty=qty,
                         status=status, created_at="2024-01-10T00:00:00")],
    )))


@pytest.mark.parametrize("qty, severity", [("99.999", None), (100, "EXCEEDED"), ("499.999", "EXCEEDED"), (500, "CRITICAL")])
def test_backorder_limits(spark, qty, severity):
    got = alerts.backorder_threshold(backorder_tables(spark, qty))
    assert rows(got, "alert_severity") == ([] if severity is None else [(severity,)])


def test_filled_backorders_do_not_alert(spark):
    assert alerts.backorder_threshold(backorder_tables(spark, 1000, "filled")).count() == 0


def test_backorder_cost_is_credited_per_shipment_of_the_order(spark):
    t = backorder_tables(spark, 100)
    extra = tables(spark, shipments=[dict(shipment_id=9, shipment_number="SH9", order_number="O1", vendor_code="V1")])
    both = t.but(shipments=t.shipments.unionByName(extra.shipments))
    got = backorders.vendor_backorder_totals(both).first()
    assert (float(got.total_open_backorder_cost), got.open_backorder_count) == (20000.0, 1)


@pytest.mark.parametrize("segments", [1, 3, 16])
def test_running_costs_equal_one_window(small_model, segments):
    got = backorders.backorder_running_costs(small_model.tables, segments=segments)
    base = sorted(
        ((r.created_at, r.backorder_id, r.delivery_line_id, r.status, r.cost) for r in backorders.costed(small_model.tables)
         .withColumn("cost", F.round(F.col("backorder_qty") * F.col("unit_price"), 2)).collect())
    )
    opened = total = 0
    want, costs = [], []
    for _, i, _, status, cost in base:
        total += cost
        opened += cost if status == "open" else 0
        costs.append(cost)
        want.append((i, opened, total, sum(costs[-7:])))
    have = rows(got, "backorder_id", "cumulative_open_cost", "cumulative_total_cost", "rolling_7d_backorder_cost")
    assert sorted(have) == sorted(want)


TRENDS = (
    T.StructType().add("order_week", "date").add("avg_total_lead_time", "double")
    .add("avg_order_to_ship", "double").add("avg_ship_to_delivery", "double")
)


@pytest.mark.parametrize("before, now, hit", [(0.6, 0.9, 0), (6.0, 9.0, 0), (6.0, 9.1, 1), (0.0, 5.0, 0), (-1.0, 5.0, 0)])
def test_dwell_spike_needs_more_than_half(spark, before, now, hit):
    trends = frame(spark, TRENDS, [
        dict(order_week="2024-01-01", avg_total_lead_time=before),
        dict(order_week="2024-01-08", avg_total_lead_time=now),
    ])
    assert dwell.dwell_time_spikes(trends, day("2024-01-20")).count() == hit


def test_dwell_outlier_needs_consecutive_weeks(spark):
    weeks = [6.0, 4.0, 6.0, 6.0, 6.0]
    trends = frame(spark, TRENDS, [
        dict(order_week=str(dt.date(2024, 1, 1) + dt.timedelta(days=7 * i)), avg_order_to_ship=w,
             avg_ship_to_delivery=0.0, avg_total_lead_time=0.0)
        for i, w in enumerate(weeks)
    ])
    got = dwell.dwell_outliers(trends).orderBy("order_week")
    assert rows(got, "order_week", "stage") == [(day("2024-01-22"), "ORDER_TO_SHIP"), (day("2024-01-29"), "ORDER_TO_SHIP")]


def test_dwell_handles_orders_without_shipments(spark):
    t = tables(spark, orders=[dict(order_id=1, order_number="O1", order_date="2024-01-01")])
    assert rows(dwell.dwell_times(t), "order_to_ship_days", "total_lead_time_days", "is_delayed") == [(None, None, 0)]


def test_order_states(spark):
    t = tables(spark, orders=[
        dict(order_id=1, order_number="O1", order_date="2024-01-01", requested_delivery_date="2024-01-04", order_status="pending"),
        dict(order_id=2, order_number="O1", order_date="2024-01-03", requested_delivery_date="2024-01-07", order_status="shipped"),
        dict(order_id=3, order_number="O2", order_date="2024-01-16", requested_delivery_date="2024-01-30", order_status="confirmed"),
    ])
    got = sequences.order_state_sequence(t, day("2024-01-30")).orderBy("order_number", "order_date")
    assert rows(got, "previous_status", "is_stalled", "is_rush_order") == [
        (None, 1, 1), ("pending", 0, 0), (None, 0, 0),
    ]


def test_summary_is_the_union_of_its_parts(small_model):
    m = small_model
    parts = [m.alert_otif, m.alert_backorder, m.alert_failures, m.alert_carrier, m.alert_dwell]
    assert m.alert_summary.count() == sum(p.count() for p in parts) > 0
