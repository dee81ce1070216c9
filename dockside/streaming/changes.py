"""Escalations as a log of changes: what comes late withdraws or adds what was said before.

Alerts and acknowledgments lie in folders by day and batch.  A batch touches the half hours of its own rows: only alerts of
those entities and half hours are judged again, against the acknowledgments of the days around, and the log gets a row where
the verdict changed, ``insert`` or ``retract``, under the batch's number as version.  Folding the log by alert gives the
answer of the batch operator over all that has come, however late.  A batch that is run again overwrites its own folders.

No row is too late: the cost of a late one is reading its day, not the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockside.config import SlaConfig
from dockside.operators.routing import unacknowledged
from dockside.plans.staging import stage

EVENT = "kind string, id long, alert_type string, entity string, severity string, ts timestamp"
#: A row of the log.
CHANGE = "alert_id long, entity string, ts timestamp, escalate_at timestamp, change string"


def events(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """Alerts and acknowledgments as rows of one stream."""
    none = F.lit(None).cast("string")
    fired = alerts.select(F.lit("alert").alias("kind"), F.col("alert_id").alias("id"), "alert_type", "entity", "severity", F.col("ts").cast("timestamp").alias("ts"))
    answered = acks.select(
        F.lit("ack").alias("kind"), F.col("ack_id").alias("id"), none.alias("alert_type"), "entity", none.alias("severity"),
        F.col("ack_ts").cast("timestamp").alias("ts"),
    )
    return fired.unionByName(answered)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder by batch and day; without any file, an empty table."""
    found = f"{schema}, batch long, day date"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], found)
    return spark.read.schema(found).parquet(path)


def fold(log: DataFrame) -> DataFrame:
    """The escalations that hold: the newest change of each alert, if it is an insert."""
    newest = log.groupBy("alert_id", "entity").agg(F.max_by(F.struct("ts", "escalate_at", "change"), "batch").alias("x"))
    return newest.where(F.col("x.change") == "insert").select("alert_id", "entity", "x.ts", "x.escalate_at")


def escalation_log(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, f"{folder}/log", CHANGE)


def escalation_action(folder: str, cfg: SlaConfig = SlaConfig()) -> Callable[[DataFrame, int], None]:
    """A batch action on rows of :func:`events`; the log lies in ``folder/log``."""
    width = cfg.escalation_minutes * 60 * 1_000_000
    slot = F.floor(F.unix_micros("ts") / width)

    def act(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day").parquet(f"{folder}/events/batch={batch_id}")
        every = _read(spark, f"{folder}/events", EVENT)
        days = [r[0] for r in every.where(F.col("batch") == batch_id).select("day").distinct().collect()]
        # An alert and its answer lie at most one limit apart, so in days next to each other at most.
        around = F.col("day").isin(*days) | F.date_add("day", 1).isin(*days) | F.date_sub("day", 1).isin(*days)
        seen = every.where(around & (F.col("batch") <= batch_id)).withColumn("slot", slot)
        new = seen.where(F.col("batch") == batch_id)
        touched = stage(
            new.select("entity", F.explode(F.when(F.col("kind") == "ack", F.array(F.col("slot") - 1, F.col("slot"))).otherwise(F.array("slot"))).alias("slot")).distinct(),
            "touched-slots",
        )
        alerts = stage(
            seen.where("kind = 'alert' and severity = 'CRITICAL'").join(touched, ["entity", "slot"], "left_semi")
            .select(F.col("id").alias("alert_id"), "alert_type", "entity", "severity", "ts"), "touched-alerts",
        )
        answers = touched.unionByName(touched.select("entity", (F.col("slot") + 1).alias("slot"))).distinct()
        acks = seen.where("kind = 'ack'").join(answers, ["entity", "slot"], "left_semi").select("entity", F.col("ts").alias("ack_ts"))
        said = fold(escalation_log(spark, folder).where(around & (F.col("batch") < batch_id)))
        now = stage(unacknowledged(alerts, acks, cfg).select("alert_id", "entity", "ts", "escalate_at"), "escalated-now")
        before = stage(said.join(alerts.select("alert_id", "entity"), ["alert_id", "entity"], "left_semi"), "escalated-before")
        key = ["alert_id", "entity"]
        log = now.join(before, key, "left_anti").withColumn("change", F.lit("insert")).unionByName(
            before.join(now, key, "left_anti").select(*now.columns).withColumn("change", F.lit("retract"))
        )
        log.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day").parquet(f"{folder}/log/batch={batch_id}")

    return act
