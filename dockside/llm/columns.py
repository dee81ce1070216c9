"""Names for working columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as ``df`` makes necessary."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out
