"""Starting and replaying streaming queries."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from dockside.plans.staging import freed, fresh_path

_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None):
    """Keep state in RocksDB (needed by keyed processors) for queries started inside.

    A query's number of state partitions is fixed for its life; the default is
    one per core of the application.
    """
    wanted = {
        _PROVIDER: _ROCKSDB,
        _PARTITIONS: str(partitions or spark.sparkContext.defaultParallelism),
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def file_stream(spark: SparkSession, df: DataFrame, label: str, *, files_per_batch: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back as a stream of files."""
    path = fresh_path(spark, label)
    df.write.parquet(path)
    reader = spark.readStream.schema(df.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that has arrived, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def replay(stream: DataFrame, label: str, keys: list[str] | None = None) -> DataFrame:
    """Run a streaming frame over what has arrived and return its output as a table.

    With ``keys`` the stream runs in update mode and the newest row of each key counts; without, it appends.  Every
    batch has a folder of its own and overwrites it, so a batch that is run again doubles nothing.
    """
    spark = stream.sparkSession
    out, checkpoint = fresh_path(spark, f"{label}-out"), fresh_path(spark, f"{label}-checkpoint")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with rocksdb_state(spark), freed(spark):
        run_available(
            stream.writeStream.outputMode("update" if keys else "append").foreachBatch(keep)
            .option("checkpointLocation", checkpoint)
        )
    rows = spark.read.schema(stream.schema).parquet(f"{out}/batch=*") if not keys else spark.read.parquet(out)
    return latest(rows, keys).select(*stream.columns) if keys else rows


def replay_parts(parts: list[DataFrame], build: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """What an appending stream puts out when ``parts`` arrive one after the other, each as micro-batches of its own.

    The query stops after every part and goes on from its checkpoint.
    """
    spark = parts[0].sparkSession
    source, out, checkpoint = (fresh_path(spark, f"{label}-{x}") for x in ("source", "out", "checkpoint"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with rocksdb_state(spark), freed(spark):
        for part in parts:
            part.write.mode("append").parquet(source)
            stream = build(spark.readStream.schema(part.schema).parquet(source))
            run_available(stream.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", checkpoint))
    return spark.read.schema(stream.schema).parquet(f"{out}/batch=*")


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the newest ``batch`` of each key.

    Rows meet by key once and are not grouped before: a key has a row a batch at most, so that would only sort and spill
    them.  Numbers and dates are taken one by one, which takes a hash table where a row as a whole takes a sort.
    """
    rest = [c for c in rows.columns if c not in [*keys, "batch"]]
    newest = rows.repartition(*keys).groupBy(*keys).agg(*[F.max_by(c, "batch").alias(c) for c in rest], F.max("batch").alias("batch"))
    return newest.select(*rows.columns)


def every(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, *,
          minutes: int = 30, once: bool = False) -> StreamingQuery:
    """Run ``action`` on each micro-batch at a fixed cadence, or once over the backlog."""
    writer = stream.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    with freed(stream.sparkSession):  # batches run in a session that is a copy of this one
        return run_available(writer) if once else writer.trigger(processingTime=f"{minutes} minutes").start()
