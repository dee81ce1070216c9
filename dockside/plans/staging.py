"""Intermediate tables written to a folder that driver and executors share.

A staged table cuts lineage and outlives lost executors: a reader never has
to replay the joins behind it.  The folder is the one named by
``spark.checkpoint.dir``; where that is unset it lies in the session's
warehouse, which a cluster shares as well.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


#: Spark removes an execution's shuffle files when it ends, not when the driver happens to collect its garbage.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: WeakKeyDictionary[SparkSession, list] = WeakKeyDictionary()  # session -> [how many hold it, the setting before]
_lock = Lock()

#: Writer options of tables that are written to be read again: smaller files than Spark's default codec makes.
COMPACT = {"compression": "zstd"}


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def staged_under(spark: SparkSession, label: str) -> str:
    """The folder of what is staged with labels that begin with ``label`` and a slash."""
    return f"{shared_dir(spark)}/dockside/{spark.sparkContext.applicationId}/{label}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return staged_under(spark, f"{label}-{uuid.uuid4().hex}")


@contextmanager
def freed(spark: SparkSession):
    """What runs inside gives back its shuffle files as each execution ends, also in streams started inside.

    For executions whose result is written or collected once; a frame that is executed again makes them anew.
    """
    with _lock:
        held = _freeing.setdefault(spark, [0, spark.conf.get(FREE, None)])
        held[0] += 1
        spark.conf.set(FREE, "true")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                del _freeing[spark]
                spark.conf.unset(FREE) if held[1] is None else spark.conf.set(FREE, held[1])


@contextmanager
def set_aside(spark: SparkSession, label: str):
    """A label for what is staged inside; it is removed in the end, when nothing reads it any more."""
    aside = f"{label}-{uuid.uuid4().hex}"
    try:
        with freed(spark):
            yield aside
    finally:
        remove_folder(spark, staged_under(spark, aside))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written copy."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with freed(spark):
        df.write.options(**COMPACT).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(frames: dict[str, DataFrame], label: str, *, at_once: int = 4) -> dict[str, DataFrame]:
    """Stage several frames, a few jobs side by side, so small tables fill idle cores."""
    with ThreadPoolExecutor(at_once) as pool:
        jobs = {name: pool.submit(stage, df, f"{label}-{name}") for name, df in frames.items()}
        return {name: job.result() for name, job in jobs.items()}


def folder_bytes(spark: SparkSession, path) -> int:
    """Bytes of a file, or of the files in a folder; 0 where there is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is read from."""
    spark = df.sparkSession
    return sum(folder_bytes(spark, spark.sparkContext._jvm.java.net.URI(f)) for f in df.inputFiles())


def remove_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.delete(p, True)


def release(spark: SparkSession) -> bool:
    """Remove what this application staged; call it last, when nothing reads it any more."""
    return remove_folder(spark, f"{shared_dir(spark)}/dockside/{spark.sparkContext.applicationId}")
