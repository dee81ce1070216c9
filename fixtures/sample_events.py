"""Alert messages and acknowledgments derived from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def message_bodies(events: DataFrame) -> DataFrame:
    """One JSON message per event; the event id decides which ones are faulty.

    id % 10: 0 has no url, 1 an unknown direction, 2 a figure that is no
    number, 3 another type, 4 a number for a title, 5 an object for a url, 6 a
    url without a scheme; all others are complete.
    """
    rest = F.col("event_id") % 10
    share = (F.round(F.col("value")).cast("long") % 100).cast("string")
    figure = F.when(rest == 2, F.lit('"n/a"')).otherwise(F.concat(F.lit("0."), F.lpad(share, 2, "0")))
    parts = [
        F.lit('{"type":"'), F.when(rest == 3, "note").otherwise("alert"),
        F.lit('","alertTitle":'), F.when(rest == 4, "5").otherwise('"Complete deliveries fell"'),
        F.lit(',"dashboardName":"Fulfilment watch","cardName":"Weekly share",'
              '"metricName":"weekly_share","metricValue":'), figure,
        F.lit(',"threshold":0.92,"direction":"'),
        F.when(rest == 1, "Sideways").when(F.col("event_id") % 2 == 0, "Less than").otherwise("Greater than"),
        F.lit('"'), F.when(rest == 0, "").when(rest == 5, ',"url":{"a":1}').when(rest == 6, ',"url":"example.org/report"')
        .otherwise(',"url":"https://example.org/report"'),
        F.lit(',"dashboardId":"d-1","occurred":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"}'),
    ]
    return events.select("event_id", F.concat(*parts).alias("body"))


def flow_bodies(events: DataFrame) -> DataFrame:
    """Messages in both dialects: even ids as percentages, odd ids as shares."""
    cents = (F.round(F.col("value")).cast("long") % 100).cast("string")
    flow = F.concat(
        F.lit('{"alertTitle":"Vendor fell behind","metricName":"weekly_percent","metricValue":'), cents,
        F.lit('.0,"thresholdValue":92.0,"severity":"Critical","vendorCode":"V'), F.col("user_id").cast("string"),
        F.lit('","region":"ASIA"}'),
    )
    share = F.concat(
        F.lit('{"alertTitle":"Complete deliveries fell","metricName":"weekly_share","metricValue":0.'),
        F.lpad(cents, 2, "0"), F.lit(',"threshold":0.92,"direction":"Less than"}'),
    )
    return events.select("event_id", F.when(F.col("event_id") % 2 == 0, flow).otherwise(share).alias("body"))


def alert_acks(history: DataFrame) -> DataFrame:
    """Acknowledgments per alert: every third alert, every sixth a second time."""
    i = F.col("alert_history_id")
    once = history.where(i % 3 == 0).select(
        "alert_history_id", (i * 2).alias("ack_id"), F.lit("analyst").alias("acknowledged_by"),
        F.timestamp_add("MINUTE", (i % 60).cast("int"), F.col("created_at")).alias("ack_ts"),
    )
    twice = history.where(i % 6 == 0).select(
        "alert_history_id", (i * 2 + 1).alias("ack_id"), F.lit("manager").alias("acknowledged_by"),
        F.timestamp_add("MINUTE", (i % 60 + 5).cast("int"), F.col("created_at")).alias("ack_ts"),
    )
    return once.unionByName(twice)


def holidays(events: DataFrame) -> DataFrame:
    """Days of the event table that count as holidays: the 1st and the 15th."""
    day = F.to_date("ts")
    return events.where(F.dayofmonth(day).isin(1, 15)).select(day.alias("day")).distinct()
