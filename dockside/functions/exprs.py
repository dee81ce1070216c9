"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(x: Column, digits: int) -> Column:
    """Round half away from zero.

    Binary doubles put exact decimal ties a hair below or above the tie; the
    nudge moves both the same way, so the result does not depend on the order
    in which a sum was accumulated.
    """
    d = x.cast("double")
    return F.round(d + F.signum(d) * F.lit(1e-9), digits)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double; NULL when the denominator is zero."""
    n, d = as_column(num).cast("double"), as_column(den).cast("double")
    return n / F.nullif(d, F.lit(0.0))


def divide(num: Column | str, den: Column | str) -> Column:
    """num / den, 0 when the denominator is zero or missing."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def pct(num: Column | str, den: Column | str) -> Column:
    return F.lit(100.0) * as_column(num).cast("double") / F.nullif(
        as_column(den).cast("double"), F.lit(0.0)
    )


def pct2(num: Column | str, den: Column | str) -> Column:
    return round_to(pct(num, den), 2)


def week_of(d: Column | str) -> Column:
    """Monday of the ISO week, as a date."""
    return F.date_trunc("week", as_column(d)).cast("date")


def days(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start))


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def banded(bands: list[tuple[Column, object]], otherwise) -> Column:
    """First matching label of an ordered list of (condition, label)."""
    out = None
    for condition, label in bands:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(otherwise)


def below(value: Column, *steps: tuple[float, str], otherwise: str) -> Column:
    return banded([(value < F.lit(s), label) for s, label in steps], otherwise)


def at_least(value: Column, *steps: tuple[float, str], otherwise: str) -> Column:
    return banded([(value >= F.lit(s), label) for s, label in steps], otherwise)
