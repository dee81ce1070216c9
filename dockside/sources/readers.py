"""Typed readers and writers of the common and ERP tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from dockside.operators.erp import trimmed
from dockside.plans.ordered import ordered_columns
from dockside.schemas import DEFAULTS, ERP, GENERIC, NATURAL_KEYS, STAMPED, SURROGATE_KEYS
from dockside.tables import Later, Tables

# Tables of the flat-file exchange, parents before children.
EXCHANGE = [
    "customers", "vendors", "products", "carriers", "orders", "order_lines", "shipments",
    "delivery_lines", "backorders",
]
# Columns the flat files leave out besides the surrogate keys.
NOT_EXCHANGED = {"vendors": ["country"]}


def _check(name: str) -> None:
    if name not in GENERIC:
        raise ValueError(f"unknown table: {name}")


def with_defaults(df: DataFrame, name: str) -> DataFrame:
    """Add absent columns with their default (a NULL in a present column stays NULL)."""
    _check(name)
    out = []
    for f in GENERIC[name]:
        if f.name in df.columns:
            c = F.col(f.name)
        elif f.name in DEFAULTS.get(name, {}):
            c = F.lit(DEFAULTS[name][f.name])
        elif STAMPED.get(name) == f.name:
            c = F.localtimestamp()
        else:
            c = F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def with_surrogate_key(df: DataFrame, name: str, *, aside: str = "") -> DataFrame:
    """Number rows 1..n in natural-key order, without a single-task sort."""
    _check(name)
    key = SURROGATE_KEYS[name]
    order = [(c, True) for c in NATURAL_KEYS[name]]
    numbered = ordered_columns(df.drop(key), [], order, rank=key, aside=aside)
    return numbered.select(*[f.name for f in GENERIC[name] if f.name in numbered.columns])


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", *, aside: str = "") -> DataFrame:
    """One common table with its declared types; nothing is inferred."""
    _check(name)
    if fmt == "csv":
        return _read_csv(spark, name, path, aside)
    return with_defaults(spark.read.format(fmt).load(path), name)


def exchanged_columns(name: str) -> list[str]:
    left_out = {SURROGATE_KEYS[name], *NOT_EXCHANGED.get(name, [])}
    return [f.name for f in GENERIC[name] if f.name not in left_out]


def _read_csv(spark: SparkSession, name: str, path: str, aside: str) -> DataFrame:
    from pyspark.sql.types import StructType

    columns = exchanged_columns(name)
    schema = StructType([f for f in GENERIC[name] if f.name in columns])
    raw = spark.read.schema(schema).option("header", True).csv(path)
    return with_defaults(with_surrogate_key(raw, name, aside=aside), name)


def write_csv(t: Tables, folder: str, names: Iterable[str] | None = None) -> None:
    """Flat files with a header, one folder per table, surrogate ids left out."""
    for name in names or EXCHANGE:
        df = getattr(t, name).select(*exchanged_columns(name))
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def read_csv(spark: SparkSession, folder: str, alert_history: DataFrame, *, aside: str = "") -> Tables:
    """The flat files; a table's rows are numbered when it is first read, and what that stages is labelled ``aside``."""
    frames = {n: Later(spark, GENERIC[n], partial(read_table, spark, n, f"{folder}/{n}", "csv", aside=aside)) for n in EXCHANGE}
    return Tables(**frames, alert_history=alert_history)


def write_tables(t: Tables, folder: str, names: Iterable[str] | None = None) -> None:
    """Reload: each named table is replaced as a whole, so repeating it changes nothing."""
    for name in names or Tables.names():
        _check(name)
        getattr(t, name).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_tables(spark: SparkSession, folder: str, fmt: str = "parquet") -> Tables:
    return Tables(**{n: read_table(spark, n, f"{folder}/{n}", fmt) for n in Tables.names()})


def read_erp_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    if name not in ERP:
        raise ValueError(f"unknown table: {name}")
    reader = spark.read.schema(ERP[name])
    if fmt == "csv":
        reader = reader.option("header", True)
    return trimmed(name, reader.format(fmt).load(path))


def read_erp(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {n: read_erp_table(spark, n, f"{folder}/{n}", fmt) for n in ERP}


def jdbc_options(url: str, table: str, *, batch: int = 10_000, connections: int = 8) -> dict[str, str]:
    """Writer options for a database table; PostgreSQL and SQLite URLs pick their driver."""
    drivers = {"jdbc:postgresql:": "org.postgresql.Driver", "jdbc:sqlite:": "org.sqlite.JDBC"}
    driver = next((d for prefix, d in drivers.items() if url.startswith(prefix)), None)
    if driver is None:
        raise ValueError(f"unsupported database url: {url}")
    if driver == "org.sqlite.JDBC":
        connections = 1  # one writer at a time
    return {
        "url": url, "dbtable": table, "driver": driver, "batchsize": str(batch),
        "numPartitions": str(connections), "truncate": "true",
    }


def jdbc_writer(df: DataFrame, url: str, table: str) -> DataFrameWriter:
    """A configured writer; call ``.save()`` where the database is reachable."""
    _check(table)
    return df.write.format("jdbc").mode("overwrite").options(**jdbc_options(url, table))


def row_counts(t: Tables, names: Iterable[str] | None = None) -> DataFrame:
    out = None
    for name in names or Tables.names():
        one = getattr(t, name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        out = one if out is None else out.unionByName(one)
    return out
