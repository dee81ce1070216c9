import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from dockside.operators import cooldown, routing
from fixtures import sample_events

ALERT = "alert_id long, alert_type string, entity string, severity string, ts timestamp_ntz"
ACK = "ack_id long, entity string, ack_ts timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_cooldown_matches_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):  # one busy key, one quiet one
        key = "busy" if rng.random() < 0.8 else "quiet"
        kind = rng.choice(["CONSECUTIVE_FAILURES", "OTIF_THRESHOLD"])
        rows.append((i, kind, key, "CRITICAL", at(rng.randrange(0, 20000, 7))))
    df = spark.createDataFrame(rows, ALERT)
    want, last = set(), {}
    for i, kind, key, _, ts in sorted(rows, key=lambda r: (r[4], r[0])):
        gap = dt.timedelta(hours=1 if kind == "CONSECUTIVE_FAILURES" else 6)
        if (kind, key) not in last or ts >= last[kind, key] + gap:
            last[kind, key] = ts
            want.add(i)
    assert {r.alert_id for r in cooldown.throttle(df).collect()} == want


def test_cooldown_on_regular_chain(spark):
    # Every alert exactly one period after the last fires; in between none does.
    rows = [(i, "X", "e", "CRITICAL", at(180 * i)) for i in range(65)]
    got = cooldown.throttle(spark.createDataFrame(rows, ALERT))
    assert sorted(r.alert_id for r in got.collect()) == list(range(0, 65, 2))


def test_escalation_boundaries(spark):
    alerts = spark.createDataFrame(
        [(1, "X", "a", "CRITICAL", at(0)), (2, "X", "b", "CRITICAL", at(0)), (3, "X", "c", "CRITICAL", at(0)),
         (4, "X", "d", "CRITICAL", at(10)), (5, "X", "d", "BREACHED", at(10))], ALERT)
    acks = spark.createDataFrame(
        [(1, "a", at(30)), (2, "b", at(31)), (3, "c", at(0)), (4, "d", at(9))], ACK)
    got = routing.unacknowledged(alerts, acks)
    assert sorted((r.alert_id, r.escalate_at) for r in got.collect()) == [(2, at(30)), (4, at(40))]


def test_escalation_matches_brute_force(spark):
    rng = random.Random(5)
    alerts = [(i, "X", rng.choice("aaab"), "CRITICAL", at(rng.randrange(3000))) for i in range(200)]
    acks = [(i, rng.choice("aaab"), at(rng.randrange(3000))) for i in range(60)]
    want = {
        a[0] for a in alerts
        if not any(k[1] == a[2] and a[4] <= k[2] <= a[4] + dt.timedelta(minutes=30) for k in acks)
    }
    got = routing.unacknowledged(spark.createDataFrame(alerts, ALERT), spark.createDataFrame(acks, ACK))
    assert {r.alert_id for r in got.collect()} == want


def test_repeated_critical(spark):
    rows = [(1, "X", "a", "CRITICAL", at(0)), (2, "X", "a", "CRITICAL", at(24 * 60)),
            (3, "X", "a", "CRITICAL", at(48 * 60 + 1)), (4, "X", "b", "CRITICAL", at(48 * 60 + 1)),
            (5, "X", "a", "WARNING", at(48 * 60 + 2))]
    df = spark.createDataFrame(rows, ALERT)
    assert [r.alert_id for r in routing.repeated_critical(df).collect()] == [2]
    everywhere = routing.repeated_critical(df, scope=[])
    assert sorted(r.alert_id for r in everywhere.collect()) == [2, 4]


def test_quiet_hours(spark):
    days = [(i, "X", "a", "CRITICAL", T0 + dt.timedelta(days=i)) for i in range(7)]  # a Monday first
    holiday = spark.createDataFrame([(dt.date(2024, 1, 3),)], "day date")
    got = routing.quiet_hours(spark.createDataFrame(days, ALERT), holiday)
    assert sorted(r.alert_id for r in got.collect()) == [0, 1, 3, 4]


def test_channels_and_rank(spark):
    df = spark.createDataFrame([(s,) for s in ["CRITICAL", "BREACHED", "HIGH", "WARNING", "EXCEEDED"]], "alert_severity string")
    got = routing.sends(df).groupBy("alert_severity").agg(F.sort_array(F.collect_list("channel")).alias("c"))
    assert {r[0]: r[1] for r in got.collect()} == {
        "CRITICAL": ["Email", "Slack", "Teams"], "BREACHED": ["Email", "Teams"], "HIGH": ["Email", "Teams"],
        "WARNING": ["Email"], "EXCEEDED": ["Email"],
    }
    assert routing.active_alerts(df).count() == 4
    assert routing.active_alerts(df, include_exceeded=True).count() == 5
    ranks = {r[0]: r[1] for r in df.select("alert_severity", routing.severity_rank(F.col("alert_severity"))).collect()}
    assert ranks["CRITICAL"] > ranks["HIGH"] == ranks["BREACHED"] > ranks["WARNING"]


def test_payload_keeps_nulls(spark):
    df = spark.sql(
        """SELECT 'T' alert_type, 'HIGH' alert_severity, 'V1' entity, 3.0D metric_value, CAST(NULL AS DOUBLE) sla_threshold,
        0.0D gap_to_threshold, 'm' alert_description, TIMESTAMP_NTZ'2024-01-02 00:00:00' alert_generated_at""")
    assert json.loads(routing.payload(df).first().payload) == {
        "EventContext": {"AlertType": "T", "Severity": "HIGH", "TriggerTime": "2024-01-02T00:00:00"},
        "Payload": {"EntityID": "V1", "MetricValue": 3.0, "Threshold": None, "Gap": 0.0, "Message": "m"},
    }


GOOD = {
    "type": "alert", "alertTitle": "t", "dashboardName": "d", "cardName": "c", "metricName": "m", "metricValue": 0.5,
    "threshold": 0.92, "direction": "Less than", "url": "https://example.org/r", "dashboardId": "i", "occurred": "2025-01-15T14:30:00Z",
}


def test_every_required_member_is_checked(spark):
    bodies = [json.dumps(GOOD)]
    bodies += [json.dumps({k: v for k, v in GOOD.items() if k != gone}) for gone in GOOD]
    bodies += [json.dumps({**GOOD, "type": "note"}), json.dumps({**GOOD, "direction": "Sideways"}),
               json.dumps({**GOOD, "metricValue": "high"}), json.dumps({**GOOD, "occurred": "soon"}), "not json",
               json.dumps({**GOOD, "alertTitle": 5}), json.dumps({**GOOD, "url": {"a": 1}}), json.dumps({**GOOD, "url": "no scheme"}),
               json.dumps({**GOOD, "threshold": "0.9"}), json.dumps({**GOOD, "occurred": "2025-01-15"}), json.dumps({**GOOD, "cardName": None})]
    valid, rejected = routing.split_events(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert valid.count() == 1 and rejected.count() == len(bodies) - 1


@pytest.mark.parametrize("metric, threshold, way, relative, directed", [
    (0.70, 0.92, "Less than", "Critical", "Critical"), (0.90, 0.92, "Less than", "Breached", "Breached"),
    (0.92, 0.92, "Less than", "Warning", "Warning"), (15234.5, 10000.0, "Greater than", "Warning", "Critical"),
    (10500.0, 10000.0, "Greater than", "Warning", "Breached"), (9000.0, 10000.0, "Greater than", "Breached", "Warning"),
])
def test_relative_severity(spark, metric, threshold, way, relative, directed):
    m, t, w = F.lit(metric), F.lit(threshold), F.lit(way)
    row = spark.range(1).select(
        routing.relative_severity(m, t).alias("r"), routing.relative_severity(m, t, w).alias("d")).first()
    assert (row.r, row.d) == (relative, directed)


@pytest.mark.parametrize("metric, want", [(0.849, "Critical"), (0.85, "Breached"), (0.919, "Breached"), (0.92, "Warning")])
def test_absolute_severity(spark, metric, want):
    assert spark.range(1).select(routing.absolute_severity(F.lit(metric))).first()[0] == want


def test_latest_ack_wins(small_model):
    history = small_model.tables.alert_history
    done = routing.acknowledge(history, sample_events.alert_acks(history))
    assert done.count() == history.count() and done.columns == history.columns
    r = done.where("alert_history_id % 6 = 0").first()
    assert (r.acknowledged, r.acknowledged_by) == (1, "manager")


def test_audit_ids_continue(small_model):
    m = small_model
    top = m.tables.alert_history.agg(F.max("alert_history_id")).first()[0]
    made = routing.audit_rows(routing.active_alerts(m.alert_summary), m.tables.alert_history)
    ids = sorted(r[0] for r in made.select("alert_history_id").collect())
    assert ids == list(range(top + 1, top + 1 + len(ids)))
    assert made.where("region is not null").count() == 0
    assert made.dtypes == m.tables.alert_history.dtypes
