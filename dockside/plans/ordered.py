"""Ordered (window) columns that survive a hot group.

A window partitioned by vendor puts every row of a vendor into one task, a
dead end once a single vendor holds a third of the data.  ``ordered_columns``
works on range segments instead, at every size: rows are range-partitioned on
(group, order), the segment number is frozen by staging the result, and each
segment is windowed on its own.  What a segment needs from its neighbours is
small: the totals of the segments before it, and the few rows next to its
borders that LAG, LEAD or a trailing frame can reach.  Those rows are copied
in, used, and filtered out.

A segment never exceeds its range partition however large the group is, and
there are as many ranges as the session's initial shuffle partitions, merged
by adaptive execution where they prove small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.plans.staging import stage

SEG = "_segment"
GHOST = "_ghost"

Order = list[tuple[str, bool]]  # (column, ascending)


def _sort(order: Order) -> list[Column]:
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in order]


def _flip(order: Order) -> list[Column]:
    return [F.col(c).desc() if up else F.col(c).asc() for c, up in order]


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def ordered_columns(
    df: DataFrame,
    group: list[str],
    order: Order,
    *,
    rank: str | None = None,
    lags: dict[str, tuple[str, int]] | None = None,
    leads: dict[str, tuple[str, int]] | None = None,
    running: dict[str, tuple[str, str]] | None = None,
    trailing: dict[str, tuple[str, int]] | None = None,
    segments: int | None = None,
    aside: str = "",
) -> DataFrame:
    """Add order-dependent columns to ``df``.

    rank      name of a 1-based position within the group
    lags      {new: (column, distance)}; leads likewise
    running   {new: (column, 'sum' | 'min')} from the start of the group
    trailing  {new: (column, rows)} sum over the last ``rows`` rows

    ``order`` must be total within a group.  ``segments`` fixes the number of
    ranges, for tests.  What is staged gets labels that begin with ``aside``.
    """
    return _segmented(
        df, group, order, segments=segments, rank=rank, lags=lags or {}, leads=leads or {},
        running=running or {}, trailing=trailing or {}, aside=aside,
    )


def _segmented(df, group, order, *, rank, lags, leads, running, trailing, segments, aside):
    by = [*[F.col(g).asc() for g in group], *_sort(order)]
    # Without a count, adaptive execution merges neighbouring small ranges.
    ranged = df.repartitionByRange(segments, *by) if segments else df.repartitionByRange(*by)
    # Staging freezes the segment number: later reads cannot re-sample the ranges.  Sorted rows take less room, there and
    # in the exchanges that read them.
    rows = stage(ranged.sortWithinPartitions(*by).withColumn(SEG, F.spark_partition_id()), f"{aside}segments")

    key = [*group, SEG]
    back = max([k for _, k in lags.values()] + [n - 1 for _, n in trailing.values()] + [0])
    ahead = max([k for _, k in leads.values()] + [0])
    starts = _segment_starts(rows, group, key, running, aside)

    border = list(dict.fromkeys(
        [c for c, _ in order] + [c for c, _ in [*lags.values(), *leads.values(), *trailing.values()]]
    ))
    border = [c for c in border if c not in group]
    body = rows.withColumn(GHOST, F.lit(False))
    if back:
        body = body.unionByName(
            _borrowed(rows, starts, group, key, order, border, back, before=True),
            allowMissingColumns=True,
        )
    if ahead:
        body = body.unionByName(
            _borrowed(rows, starts, group, key, order, border, ahead, before=False),
            allowMissingColumns=True,
        )

    w = Window.partitionBy(*key).orderBy(*_sort(order))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = ~F.col(GHOST)
    new = {}
    if rank:
        new["_rank"] = F.sum(F.when(own, 1).otherwise(0)).over(upto)
    for name, (c, k) in lags.items():
        new[name] = F.lag(c, k).over(w)
    for name, (c, k) in leads.items():
        new[name] = F.lead(c, k).over(w)
    for name, (c, how) in running.items():
        inner = F.when(own, F.col(c))
        new[f"_run_{name}"] = (F.sum if how == "sum" else F.min)(inner).over(upto)
    for name, (c, n) in trailing.items():
        new[name] = F.sum(c).over(w.rowsBetween(-(n - 1), Window.currentRow))
    local = body.select("*", *[x.alias(n) for n, x in new.items()]).where(own)

    if rank or running:
        joined = local.alias("l").join(starts.alias("s"), same_keys("l", "s", key))
        final = [F.col(f"l.{c}") for c in df.columns]
        final += [F.col(f"l.{n}") for n in [*lags, *leads, *trailing]]
        if rank:
            final.append((F.col("s._start") + F.col("l._rank")).cast("long").alias(rank))
        for name, (c, how) in running.items():
            inside, earlier = F.col(f"l._run_{name}"), F.col(f"s._before_{name}")
            if how == "sum":
                final.append((F.coalesce(earlier, F.lit(0)) + F.coalesce(inside, F.lit(0))).alias(name))
            else:
                final.append(F.least(earlier, inside).alias(name))
        return joined.select(*final)
    return local.select(*df.columns, *lags, *leads, *trailing)


def _segment_starts(rows, group, key, running, aside) -> DataFrame:
    """Row count and totals in front of every (group, segment)."""
    totals = [F.count(F.lit(1)).alias("_size")]
    for name, (c, how) in running.items():
        totals.append((F.sum if how == "sum" else F.min)(c).alias(f"_total_{name}"))
    sizes = rows.groupBy(*key).agg(*totals)
    # One row per (group, segment): at most groups + segments rows in all.
    before = Window.partitionBy(*group).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")]
    for name, (_, how) in running.items():
        f = F.sum if how == "sum" else F.min
        cols.append(f(f"_total_{name}").over(before).alias(f"_before_{name}"))
    return stage(sizes.select(*key, "_size", *cols), f"{aside}segment-starts")


def _borrowed(rows, starts, group, key, order, border, depth, *, before) -> DataFrame:
    """The ``depth`` rows next to each segment, tagged with that segment.

    Positions are matched by equality, so a segment shorter than ``depth``
    still hands on the rows of the segments behind it.
    """
    edge = Window.partitionBy(*key).orderBy(*(_flip(order) if before else _sort(order)))
    near = (
        rows.select(*key, *border)
        .withColumn("_edge", F.row_number().over(edge))
        .where(F.col("_edge") <= depth)
    )
    at = near.alias("n").join(starts.alias("s"), same_keys("n", "s", key))
    if before:
        position = F.col("s._start") + F.col("s._size") - F.col("n._edge") + 1
        reach = F.sequence(position, position + (depth - 1))
        anchor = F.col("t._start")
    else:
        position = F.col("s._start") + F.col("n._edge")
        reach = F.sequence(position - depth, position - 1)
        anchor = F.col("t._start") + F.col("t._size")
    offers = at.select(
        *[F.col(f"n.{c}").alias(c) for c in [*group, *border]],
        F.col(f"n.{SEG}").alias("_from"),
        F.explode(reach).alias("_at"),
    )
    wanted = (
        same_keys("o", "t", group)
        & (F.col("o._at") == anchor)
        & (F.col("o._from") != F.col(f"t.{SEG}"))
    )
    return offers.alias("o").join(starts.alias("t"), wanted).select(
        *[F.col(f"o.{c}").alias(c) for c in [*group, *border]],
        F.col(f"t.{SEG}").alias(SEG),
        F.lit(True).alias(GHOST),
    )
