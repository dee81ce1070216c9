"""From alert rows to messages: severity, channels, payloads, audit, acknowledgment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from dockside.config import SlaConfig
from dockside.functions.exprs import banded, below, divide
from dockside.operators import measures
from dockside.operators.measures import Slice
from dockside.plans.ordered import ordered_columns
from dockside.plans.staging import stage
from dockside.schemas import ALERT_EVENT, GENERIC
from dockside.tables import Tables

# Severities that are dispatched, strongest first.
ACTIVE = ["CRITICAL", "BREACHED", "HIGH", "WARNING"]
SEVERITY_ORDER = {"CRITICAL": 4, "HIGH": 3, "BREACHED": 3, "EXCEEDED": 3, "WARNING": 2, "INFO": 1}
# Channels by severity.
CHANNELS = {
    "CRITICAL": ["Teams", "Email", "Slack"],
    "BREACHED": ["Teams", "Email"],
    "HIGH": ["Teams", "Email"],
}
OTHER_CHANNELS = ["Email"]


def active_alerts(summary: DataFrame, *, include_exceeded: bool = False) -> DataFrame:
    wanted = ACTIVE + (["EXCEEDED"] if include_exceeded else [])
    return summary.where(F.col("alert_severity").isin(wanted))


def severity_rank(severity: Column) -> Column:
    return banded([(severity == s, F.lit(r)) for s, r in SEVERITY_ORDER.items()], otherwise=0)


def channels_for(severity: Column) -> Column:
    names = lambda xs: F.array(*[F.lit(x) for x in xs])
    return banded(
        [(severity == s, names(xs)) for s, xs in CHANNELS.items()], otherwise=names(OTHER_CHANNELS)
    )


def sends(alerts: DataFrame, severity: str = "alert_severity") -> DataFrame:
    """One row per alert and channel."""
    return alerts.withColumn("channel", F.explode(channels_for(F.col(severity))))


def payload(alerts: DataFrame) -> DataFrame:
    """Alerts with their nested JSON message; missing figures stay as nulls."""
    iso = F.date_format("alert_generated_at", "yyyy-MM-dd'T'HH:mm:ss")
    body = F.struct(
        F.struct(
            F.col("alert_type").alias("AlertType"),
            F.col("alert_severity").alias("Severity"),
            iso.alias("TriggerTime"),
        ).alias("EventContext"),
        F.struct(
            F.col("entity").alias("EntityID"),
            F.col("metric_value").cast("double").alias("MetricValue"),
            F.col("sla_threshold").cast("double").alias("Threshold"),
            F.col("gap_to_threshold").cast("double").alias("Gap"),
            F.col("alert_description").alias("Message"),
        ).alias("Payload"),
    )
    return alerts.withColumn("payload", F.to_json(body, {"ignoreNullFields": "false"}))


PAYLOAD_SCHEMA = (
    "EventContext struct<AlertType string, Severity string, TriggerTime string>, "
    "Payload struct<EntityID string, MetricValue double, Threshold double, Gap double, Message string>"
)


def audit_rows(
    alerts: DataFrame, history: DataFrame, *, vendors: DataFrame | None = None,
    created_at: dt.datetime | None = None,
) -> DataFrame:
    """Dispatched alerts as new audit rows, numbered after the highest id so far.

    ``vendors`` fills the region, which the source leaves empty.
    """
    top = history.agg(F.coalesce(F.max("alert_history_id"), F.lit(0))).first()[0]
    numbered = ordered_columns(
        alerts, [],
        [("alert_type", True), ("entity", True), ("event_date", True), ("metric_value", True)],
        rank="_n",
    )
    region = F.lit(None).cast("string")
    if vendors is not None:
        regions = vendors.groupBy(F.col("vendor_code").alias("entity")).agg(
            F.min("region").alias("_region")
        )
        numbered = numbered.join(regions, "entity", "left")
        region = F.col("_region")
    stamp = F.localtimestamp() if created_at is None else F.lit(created_at)
    made = numbered.select(
        (F.col("_n") + F.lit(top)).alias("alert_history_id"), "alert_type", "entity",
        region.alias("region"), F.col("alert_severity").alias("severity"), "metric_value",
        F.col("sla_threshold").alias("threshold_value"), "alert_description",
        F.array_join(channels_for(F.col("alert_severity")), ",").alias("channels"),
        F.lit(0).alias("acknowledged"), F.lit(0).alias("escalated"), stamp.alias("created_at"),
    )
    return made.select(*[
        (F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in GENERIC["alert_history"]
    ])


def append_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def absolute_severity(metric: Column) -> Column:
    # Shares below which an event is critical or breached.
    return below(metric, (0.85, "Critical"), (0.92, "Breached"), otherwise="Warning")


def relative_severity(metric: Column, threshold: Column, direction: Column | None = None) -> Column:
    """Severity by distance from the event's own threshold.

    With ``direction`` the rule is mirrored for 'Greater than' events; without
    it every event is read as 'Less than'.
    """
    # Fixed value: share of the threshold at which a breach turns critical.
    step = F.lit(0.85)
    less = [(metric < step * threshold, "Critical"), (metric < threshold, "Breached")]
    if direction is None:
        return banded(less, otherwise="Warning")
    up = direction == "Greater than"
    more = [(up & (metric * step > threshold), "Critical"), (up & (metric > threshold), "Breached")]
    return banded(more + [(~up & c, label) for c, label in less], otherwise="Warning")


# Formats of the two formatted members.
_URI = r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$"
_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def _json_types(body: Column) -> Column:
    """Whether every member has the JSON type that its column stands for: number or string."""
    message = F.try_parse_json(body)
    right = F.lit(True)
    for f in ALERT_EVENT.fields:
        kind = F.schema_of_variant(F.try_variant_get(message, f"$.{f.name}", "variant"))
        right = right & kind.rlike("^(BIGINT|DOUBLE|DECIMAL.*)$" if isinstance(f.dataType, T.DoubleType) else "^STRING$")
    return right


def parse_events(raw: DataFrame, column: str = "body") -> DataFrame:
    """Incoming JSON with its members and an ``is_valid`` verdict on presence, types, formats and enumerations."""
    e = F.from_json(F.col(column), ALERT_EVENT, {"mode": "PERMISSIVE"})
    parsed = raw.withColumn("event", e)
    present = _json_types(F.col(column)) & F.col("event.url").rlike(_URI)
    present = present & F.get_json_object(F.col(column), "$.occurred").rlike(_DATE_TIME)
    for f in ALERT_EVENT.fields:
        present = present & F.col(f"event.{f.name}").isNotNull()
    # Allowed members of the two enumerations.
    known = (F.col("event.type") == "alert") & F.col("event.direction").isin("Greater than", "Less than")
    return parsed.withColumn("is_valid", F.coalesce(present & known, F.lit(False)))


def split_events(raw: DataFrame, column: str = "body") -> tuple[DataFrame, DataFrame]:
    """(valid events as columns, rejected rows as they came)."""
    parsed = parse_events(raw, column)
    valid = parsed.where("is_valid").select(*raw.columns, "event.*")
    return valid, parsed.where(~F.col("is_valid")).select(*raw.columns)


_DIALECT = T.StructType(
    ALERT_EVENT.fields
    + [
        T.StructField("thresholdValue", T.DoubleType()),
        T.StructField("severity", T.StringType()),
        T.StructField("vendorCode", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("powerBiReportUrl", T.StringType()),
    ]
)


def normalise_events(raw: DataFrame, column: str = "body") -> DataFrame:
    """Both message dialects in one shape, with figures as shares of one.

    The flow dialect carries percentages under ``thresholdValue``.
    """
    e = F.from_json(F.col(column), _DIALECT, {"mode": "PERMISSIVE"})
    flow = F.col("e.thresholdValue").isNotNull()
    scale = F.when(flow, F.lit(100.0)).otherwise(F.lit(1.0))
    return raw.withColumn("e", e).select(
        *raw.columns,
        F.col("e.alertTitle").alias("alert_title"),
        F.col("e.metricName").alias("metric_name"),
        (F.col("e.metricValue") / scale).alias("metric_value"),
        (F.coalesce("e.threshold", "e.thresholdValue") / scale).alias("threshold"),
        F.coalesce("e.direction", F.lit("Less than")).alias("direction"),
        F.coalesce("e.occurred", "e.timestamp").alias("occurred"),
        F.coalesce("e.url", "e.powerBiReportUrl").alias("url"),
        F.col("e.severity").alias("severity"),
        F.col("e.vendorCode").alias("vendor_code"),
        F.col("e.region").alias("region"),
    )


def acknowledge(history: DataFrame, acks: DataFrame) -> DataFrame:
    """History with the latest acknowledgment of each alert filled in.

    ``acks``: alert_history_id, ack_id, acknowledged_by, ack_ts.
    """
    latest = acks.groupBy("alert_history_id").agg(
        F.max_by(F.struct("acknowledged_by", "ack_ts"), F.struct("ack_ts", "ack_id")).alias("ack")
    )
    hit = F.col("ack").isNotNull()
    out = history.join(latest, "alert_history_id", "left")
    return out.select(*[
        {
            "acknowledged": F.when(hit, 1).otherwise(F.col("acknowledged")).alias("acknowledged"),
            "acknowledged_by": F.coalesce("ack.acknowledged_by", "acknowledged_by").alias("acknowledged_by"),
            "acknowledged_at": F.coalesce(
                F.col("ack.ack_ts").cast("timestamp_ntz"), "acknowledged_at"
            ).alias("acknowledged_at"),
        }.get(c, F.col(c))
        for c in history.columns
    ])


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def unacknowledged(
    alerts: DataFrame, acks: DataFrame, cfg: SlaConfig = SlaConfig(), *, key: str = "entity"
) -> DataFrame:
    """Critical alerts nobody acknowledged in time (second escalation level).

    Time is cut into buckets as long as the limit, so the answer to an alert
    lies in its own bucket (some ack not before it: compare the bucket's
    latest) or in the next (some ack not past the limit: compare the bucket's
    earliest).  One summary row per key and bucket decides, and no alert is
    ever paired with every ack of a busy key.
    """
    width = cfg.escalation_minutes * 60 * 1_000_000
    bucketed = acks.select(
        key, _micros("ack_ts").alias("_at"), F.floor(_micros("ack_ts") / width).alias("_bucket")
    ).groupBy(key, "_bucket").agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
    none = F.lit(None).cast("long")
    own = bucketed.select(key, "_bucket", F.col("_hi").alias("_own"), none.alias("_next"))
    nxt = bucketed.select(
        key, (F.col("_bucket") - 1).alias("_bucket"), none.alias("_own"), F.col("_lo").alias("_next")
    )
    # Staged, so that the join reads two plain exchanges and a hot bucket can be split.
    around = stage(
        own.unionByName(nxt).groupBy(key, "_bucket").agg(
            F.max("_own").alias("_own"), F.min("_next").alias("_next")
        ),
        "acks-around",
    )
    critical = alerts.where(F.col("severity") == "CRITICAL").withColumn("_ts", _micros("ts")).withColumn(
        "_bucket", F.floor(F.col("_ts") / width)
    )
    answered = (F.col("_own") >= F.col("_ts")) | (F.col("_next") <= F.col("_ts") + width)
    return (
        critical.join(around, [key, "_bucket"], "left")
        .where(~F.coalesce(answered, F.lit(False)))
        .select(*alerts.columns, (F.col("ts") + F.expr(f"INTERVAL {cfg.escalation_minutes} MINUTES")).alias("escalate_at"))
    )


def repeated_critical(
    alerts: DataFrame, cfg: SlaConfig = SlaConfig(), *, scope: list[str] | None = None
) -> DataFrame:
    """Critical alerts that are at least the n-th of their scope within the window (third level)."""
    scope = ["entity"] if scope is None else scope
    n, hours = cfg.repeat_critical_count, cfg.repeat_window_hours
    seq = ordered_columns(
        alerts.where(F.col("severity") == "CRITICAL"), scope, [("ts", True), ("alert_id", True)],
        lags={"nth_before": ("ts", n - 1)},
    )
    near = F.col("nth_before") >= F.col("ts") - F.expr(f"INTERVAL {hours} HOURS")
    return seq.where(near).drop("nth_before")


def quiet_hours(alerts: DataFrame, holidays: DataFrame | None = None, *, ts: str = "ts") -> DataFrame:
    """Drop alerts of weekends and of the listed holidays (column ``day``)."""
    day = F.to_date(ts)
    out = alerts.where(F.weekday(day) < 5)
    if holidays is not None:
        out = out.withColumn("_day", day).join(
            holidays.select(F.col("day").alias("_day")), "_day", "left_anti"
        )
    return out.select(*alerts.columns)


def rules(cfg: SlaConfig, spark) -> DataFrame:
    """The measure alert rules as rows."""
    share = cfg.otif_target / 100
    rows = [
        ("OTIF SLA Breach", "rolling_7d_otif", "Less than", share),
        ("Backorder Cost Threshold", "open_backorder_cost", "Greater than", cfg.backorder_vendor_limit),
        ("Backorder Cost Aggregate", "open_backorder_cost", "Greater than", cfg.backorder_aggregate_limit),
        ("Consecutive Delivery Failures", "current_failure_streak", "Greater than", float(cfg.streak_limit)),
        ("Carrier Performance Breach", "carrier_on_time_share", "Less than", cfg.carrier_target / 100),
    ]
    return spark.createDataFrame(rows, "rule string, metric string, direction string, threshold double")


def measure_alerts(t: Tables, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """Every rule whose measure is on the wrong side of its threshold."""
    everything, vendors = Slice(), Slice(("vendor_code",))
    # Three of the four measures count the same lines; they share one pass.
    results = stage(measures.shipment_results(t, everything, cfg), "shipment-results")
    carriers = results.where(F.col("carrier_code").isNotNull()).groupBy("carrier_code").agg(
        divide(F.sum("on_time"), F.sum("lines")).alias("value")
    )

    def long(df: DataFrame, name: str, value: str, entity: str | None = None) -> DataFrame:
        who = F.lit("ALL") if entity is None else F.col(entity)
        return df.select(
            F.lit(name).alias("metric"), who.alias("entity"), F.col(value).cast("double").alias("value")
        )

    figures = (
        long(measures.rolling_calendar_days(t, everything, cfg, results), "rolling_7d_otif", "rolling_7d")
        .unionByName(long(measures.backorder_sums(t, everything), "open_backorder_cost", "open_cost"))
        .unionByName(
            long(measures.vendor_failures(t, vendors, cfg, results), "current_failure_streak", "value", "vendor_code")
        )
        .unionByName(long(carriers, "carrier_on_time_share", "value", "carrier_code"))
    )
    hit = F.when(F.col("direction") == "Less than", F.col("value") < F.col("threshold")).otherwise(
        F.col("value") > F.col("threshold")
    )
    # A handful of rules, fixed by the configuration.
    return figures.join(F.broadcast(rules(cfg, t.spark)), "metric").where(hit).select(
        "rule", "metric", "entity", "value", "direction", "threshold"
    )


def trend_warnings(t: Tables, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """Vendors still on target whose share fell sharply against the week before."""
    rolled = measures.rolling_calendar_days(t, Slice(("vendor_code",)), cfg)
    change = F.col("rolling_7d") - F.col("previous_7d")
    return rolled.where(
        (F.col("rolling_7d") >= cfg.otif_target / 100) & (change < -cfg.trend_decline)
    ).select("vendor_code", F.col("rolling_7d").alias("rolling_7d_otif"), change.alias("change"),
             F.lit("WARNING").alias("alert_severity"))


def percent(x: Column) -> Column:
    return F.format_string("%.2f%%", x * 100)


def message_fields(events: DataFrame) -> DataFrame:
    """The facts a channel message shows, as columns and as JSON."""
    facts = {
        "title": F.col("alertTitle"),
        "metric": percent(F.col("metricValue")),
        "threshold_text": percent(F.col("threshold")),
        "direction_text": F.col("direction"),
        "dashboard": F.col("dashboardName"),
        "card": F.col("cardName"),
        "time": F.date_format("occurred", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "severity": absolute_severity(F.col("metricValue")),
    }
    out = events.select("*", *[c.alias(n) for n, c in facts.items()])
    return out.withColumn("message", F.to_json(F.struct(*facts), {"ignoreNullFields": "false"}))
