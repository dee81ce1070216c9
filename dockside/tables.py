"""The bundle of base tables every operator reads from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Later:
    """A table that is made when it is first read; its columns are known before."""

    def __init__(self, spark: SparkSession, schema: StructType, make: Callable[[], DataFrame]):
        self.spark, self.schema = spark, schema
        self._make, self._made, self._lock = make, None, RLock()

    def __call__(self) -> DataFrame:
        with self._lock:
            if self._made is None:
                self._made = self._make()
            return self._made


@dataclass(frozen=True)
class Tables:
    """Each field is a DataFrame, or a :class:`Later` that reads as one."""

    customers: DataFrame
    vendors: DataFrame
    products: DataFrame
    carriers: DataFrame
    orders: DataFrame
    order_lines: DataFrame
    shipments: DataFrame
    delivery_lines: DataFrame
    backorders: DataFrame
    alert_history: DataFrame

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    def items(self):
        return [(n, getattr(self, n)) for n in self.names()]

    def __getattribute__(self, name: str):
        value = object.__getattribute__(self, name)
        return value() if isinstance(value, Later) else value

    def unread(self, name: str) -> DataFrame | Later:
        """A table as it is held, without making it."""
        return vars(self)[name]

    def schema(self, name: str) -> StructType:
        return self.unread(name).schema

    def but(self, **frames: DataFrame) -> "Tables":
        return type(self)(**{**vars(self), **frames})

    @property
    def spark(self):
        orders = self.unread("orders")
        return orders.spark if isinstance(orders, Later) else orders.sparkSession
