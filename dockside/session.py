"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: coalesce small partitions, split hot ones, switch
    # to a broadcast once a side has proved small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even where that costs one more exchange above.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Bytes of input that one shuffle partition stands for before adaptive execution merges partitions.
PARTITION_BYTES = 64 << 20


def build_session(
    app: str = "dockside", master: str | None = None, *, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with these settings; ``extra`` (dots as ``__``) wins.

    Adaptive execution only merges partitions, so shuffles begin with as many as ``input_bytes``, the size of the
    largest table, asks for.
    """
    initial = max(1000, (input_bytes or 0) // PARTITION_BYTES)
    extra = {"spark__sql__adaptive__coalescePartitions__initialPartitionNum": str(initial), **extra}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
