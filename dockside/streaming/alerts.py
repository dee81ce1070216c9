"""Alert handling on streams: cooldown, escalation, repetition, fan-out."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F

from dockside.config import SlaConfig
from dockside.operators.cooldown import KEY
from dockside.operators.routing import channels_for
from dockside.plans.staging import stage

def first_of_period(alerts: DataFrame, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """The simple form of the cooldown: repeats inside the watermark are dropped."""
    timed = alerts.withColumn("event_time", F.col("ts").cast("timestamp"))
    return timed.withWatermark("event_time", f"{cfg.cooldown_hours} hours").dropDuplicatesWithinWatermark(KEY)


def escalations(
    alerts: DataFrame, acks: DataFrame, cfg: SlaConfig = SlaConfig(), *, delay: str = "10 minutes"
) -> DataFrame:
    """Critical alerts without an acknowledgment in time; emitted once the watermark passes."""
    fired = (
        alerts.where(F.col("severity") == "CRITICAL")
        .withColumn("alert_time", F.col("ts").cast("timestamp"))
        .withWatermark("alert_time", delay)
    )
    answered = acks.select(
        F.col("entity").alias("ack_entity"), F.col("ack_ts").cast("timestamp").alias("ack_time")
    ).withWatermark("ack_time", delay)
    limit = F.expr(f"INTERVAL {cfg.escalation_minutes} MINUTES")
    in_time = (
        (F.col("entity") == F.col("ack_entity"))
        & (F.col("ack_time") >= F.col("alert_time"))
        & (F.col("ack_time") <= F.col("alert_time") + limit)
    )
    return (
        fired.join(answered, in_time, "leftOuter")
        .where(F.col("ack_time").isNull())
        .select("alert_id", "entity", "ts", (F.col("ts") + limit).alias("escalate_at"))
    )


def repeated_critical(
    alerts: DataFrame, cfg: SlaConfig = SlaConfig(), *, delay: str = "1 hour", slide: str = "1 hour"
) -> DataFrame:
    """Entities with several critical alerts inside a sliding day."""
    span = f"{cfg.repeat_window_hours} hours"
    return (
        alerts.where(F.col("severity") == "CRITICAL")
        .withColumn("event_time", F.col("ts").cast("timestamp"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", span, slide).alias("w"), "entity")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .where(F.col("alerts") >= cfg.repeat_critical_count)
        .select("entity", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "alerts")
    )


def fan_out(
    senders: dict[str, Callable[[DataFrame, int], None]], folder: str, *, fallback: Callable[[DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """A batch action that hands each channel its alerts, all channels side by side.

    The batch is written once and every channel reads that copy.  A channel that fails does not hold up the others;
    what failed is kept in ``folder/failures`` by batch.  Only when every channel fails does the fallback get the batch.
    """

    def send(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = stage(batch.withColumn("channel", F.explode(channels_for(F.col("severity")))), "fan-out")

        def attempt(channel: str) -> tuple[str, str] | None:
            try:
                senders[channel](rows.where(F.col("channel") == channel), batch_id)
            except Exception as problem:  # noqa: BLE001 - one channel must not stop the rest
                return channel, str(problem)
            return None

        with ThreadPoolExecutor(max(1, len(senders))) as pool:
            broken = [x for x in pool.map(attempt, senders) if x]
        spark.createDataFrame(broken, "channel string, problem string").write.mode("overwrite").parquet(
            f"{folder}/failures/batch={batch_id}"
        )
        if senders and len(broken) == len(senders):
            fallback(batch, batch_id)

    return send
