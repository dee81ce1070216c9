"""Sequences over micro-batches of any size.

A keyed processor sees all rows of a key in one task.  Where a batch may be a
backlog, or one key most of it, each batch runs the distributed batch operator
instead, and what the next batch needs, a few numbers per key, is carried in a
table with one version per batch.  A batch that is run again reads the same
version and overwrites its own output, so nothing is counted twice.

Rows may come late.  A key with a row from before its carried state is run
again over all its rows so far, and what it put out before no longer counts:
``output`` reads, for each key, the batches from its last such run on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from dockside.config import SlaConfig
from dockside.operators import cooldown
from dockside.operators.cooldown import KEY, period_micros
from dockside.operators.otif import LINE_KEY
from dockside.plans.ordered import ordered_columns, same_keys
from dockside.plans.staging import COMPACT, freed, fresh_path, set_aside, stage
from dockside.streaming.runner import run_available

# Step: (rows of the batch, state before) -> (output, state of the keys seen); its attribute late: which rows are late.
# In a state schema the key columns are the strings.
# It stages under the label it gets third, which is removed once output and state are written.
Step = Callable[[DataFrame, DataFrame, str], tuple[DataFrame, DataFrame]]

STREAKS = (
    "vendor_code string, open_run long, seen long, "
    "newest struct<actual_delivery_date: date, shipment_number: string, line_number: int>"
)
FIRED = "alert_type string, entity string, fired_at long"


def batch_action(step: Step, schema: str, folder: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` action.

    Output lands in ``folder/out``, state in ``folder/state``, all rows in ``folder/history`` and the keys that late rows
    made run again in ``folder/again``.  ``step.late`` tells late rows (``a``) by the state of their key (``p``), and
    ``step.columns``, where it is given, what a step needs of them.
    """

    def act(batch: DataFrame, batch_id: int) -> None:
        with set_aside(batch.sparkSession, "carried-batch") as aside:
            run_batch(batch.select(*getattr(step, "columns", batch.columns)), batch_id, aside)

    def run_batch(batch: DataFrame, batch_id: int, aside: str) -> None:
        spark = batch.sparkSession
        prior = _state(spark, schema, folder, batch_id - 1)
        keys = _keys(schema)
        batch.write.mode("overwrite").options(**COMPACT).parquet(f"{folder}/history/{batch_id}")
        rows = spark.read.schema(batch.schema).parquet(f"{folder}/history/{batch_id}")
        rows.alias("a").join(prior.alias("p"), same_keys("a", "p", keys)).where(step.late).select(
            *[f"a.{k}" for k in keys]
        ).distinct().write.mode("overwrite").parquet(f"{folder}/again/batch={batch_id}")
        again = spark.read.schema(_key_schema(keys)).parquet(f"{folder}/again/batch={batch_id}")
        if not again.isEmpty():
            only = lambda df, how: df.alias("a").join(again.alias("g"), same_keys("a", "g", keys), how)
            earlier = spark.read.schema(batch.schema).parquet(*[f"{folder}/history/{k}" for k in range(batch_id)])
            rows = stage(rows.unionByName(only(earlier, "left_semi")), f"{aside}/again")
            carried = stage(only(prior, "left_anti"), f"{aside}/prior")
        else:
            carried = prior
        output, seen = step(rows, carried, aside)
        output.write.mode("overwrite").options(**COMPACT).parquet(f"{folder}/out/batch={batch_id}")
        kept = prior.alias("p").join(seen.alias("s"), same_keys("p", "s", keys), "left_anti")
        seen.select(*prior.columns).unionByName(kept).write.mode("overwrite").parquet(
            f"{folder}/state/{batch_id}"
        )

    return act


def _keys(schema: str) -> list[str]:
    return [f.name for f in StructType.fromDDL(schema) if isinstance(f.dataType, StringType)]


def _key_schema(keys: list[str]) -> str:
    return ", ".join(f"{k} string" for k in keys)


def output(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What holds of a batch action's output: a key that was run again counts from that batch on."""
    keys = _keys(schema)
    again = spark.read.schema(_key_schema(keys) + ", batch int").parquet(f"{folder}/again")
    since = again.groupBy(*keys).agg(F.max("batch").alias("since"))
    out = spark.read.parquet(f"{folder}/out")
    gone = same_keys("o", "s", keys) & (F.col("o.batch") < F.col("s.since"))
    return out.alias("o").join(since.alias("s"), gone, "left_anti").drop("batch")


def _state(spark: SparkSession, schema: str, folder: str, batch_id: int) -> DataFrame:
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/state/{batch_id}")


def run(stream: DataFrame, folder: str, schema: str, step: Step) -> None:
    """Process what has arrived; call again with the same folder when more has."""
    with freed(stream.sparkSession):
        run_available(
            stream.writeStream.foreachBatch(batch_action(step, schema, folder))
            .option("checkpointLocation", f"{folder}/checkpoint")
        )


def replay(stream: DataFrame, label: str, schema: str, step: Step) -> DataFrame:
    spark = stream.sparkSession
    folder = fresh_path(spark, label)
    run(stream, folder, schema, step)
    return output(spark, folder, schema)


def streak_step() -> Step:
    """Failed lines with their streak label, continuing each vendor's open run."""

    columns = ["vendor_code", "actual_delivery_date", "shipment_number", "line_number", "is_otif"]

    def step(lines: DataFrame, prior: DataFrame, aside: str) -> tuple[DataFrame, DataFrame]:
        seq = ordered_columns(
            lines.select(*columns), ["vendor_code"], LINE_KEY,
            rank="place",
            lags={"back_1": ("is_otif", 1), "back_2": ("is_otif", 2), "back_3": ("is_otif", 3)},
            aside=f"{aside}/",
        )
        carried = F.coalesce("open_run", F.lit(0))

        def failures_before(depth: int) -> Column:
            """Failures directly before a row; three are as good as any more."""
            if depth > 3:
                return F.lit(0)
            flag = F.col(f"back_{depth}")
            return (
                F.when(flag.isNull(), carried).when(flag == 1, F.lit(0))
                .otherwise(F.lit(1) + failures_before(depth + 1))
            )

        run_length = F.least(F.lit(1) + failures_before(1), F.lit(4))
        done = stage(
            seq.alias("l").join(prior.alias("p"), same_keys("l", "p", ["vendor_code"]), "left").select(
                *[F.col(f"l.{c}") for c in columns],
                (F.coalesce("seen", F.lit(0)) + F.col("place")).alias("delivery_rank"),
                F.when(F.col("is_otif") == 0, run_length).otherwise(0).cast("long").alias("run"),
            ),
            f"{aside}/streak-lines",
        )
        label = (
            F.when(F.col("run") >= 4, "4+ CONSECUTIVE FAILURES").when(F.col("run") == 3, "3 CONSECUTIVE FAILURES")
            .when(F.col("run") == 2, "2 CONSECUTIVE FAILURES").otherwise("SINGLE FAILURE")
        )
        output = done.where(F.col("is_otif") == 0).withColumn("failure_streak_label", label).drop("is_otif", "run")
        seen = done.groupBy("vendor_code").agg(
            F.max_by("run", "delivery_rank").alias("open_run"), F.max("delivery_rank").alias("seen"),
            F.max(F.struct("actual_delivery_date", "shipment_number", F.col("line_number").cast("int").alias("line_number"))).alias("newest"),
        )
        return output, seen

    place = F.struct(*[F.col(f"a.{c}") for c, _ in LINE_KEY[:2]], F.col("a.line_number").cast("int").alias("line_number"))
    step.late, step.columns = place < F.col("p.newest"), columns
    return step


def throttle_step(cfg: SlaConfig = SlaConfig()) -> Step:
    """Alerts that fire: the batch cooldown over what the last fired alert leaves free."""

    def step(alerts: DataFrame, prior: DataFrame, aside: str) -> tuple[DataFrame, DataFrame]:
        at = F.unix_micros(F.col("ts").cast("timestamp"))
        over = at >= F.col("fired_at") + period_micros(cfg, "a.alert_type")
        free = F.col("fired_at").isNull() | over
        waiting = (
            alerts.alias("a").join(prior.alias("p"), same_keys("a", "p", KEY), "left")
            .where(free).select("a.*")
        )
        fired = stage(cooldown.throttle(waiting, cfg), f"{aside}/fired")
        return fired, fired.groupBy(*KEY).agg(F.max(at).alias("fired_at"))

    # Up to a period behind the last alert that fired nothing can, whenever it comes; at or before it the chain may change.
    step.late = F.unix_micros(F.col("a.ts").cast("timestamp")) <= F.col("p.fired_at")
    return step
