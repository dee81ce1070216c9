"""What moves: wide rows once, small sides by their known size, nothing for what was found out before."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dockside import registry
from dockside.operators import backorders, otif
from dockside.plans import model as plans_model, ordered, staging
from dockside.plans.model import FulfilmentModel
from dockside.sources import readers, snapshots
from dockside.streaming import carried, kpis, runner
from fixtures import sample_mart
from tests.conftest import SMALL
from tests.test_skew import settings

PLAIN = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def moved(df):
    """The columns of every exchange of a plan."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "Exchange":
            out.append({node.output().apply(i).name() for i in range(node.output().size())})
    return out


def spied(monkeypatch, module):
    """What a module stages, by label."""
    seen = {}

    def stage(df, label, **options):
        seen[label] = df
        return staging.stage(df, label, **options)

    monkeypatch.setattr(module, "stage", stage)
    return seen


def test_wide_shipments_move_once(spark, small_model):
    with settings(spark, PLAIN):
        assert sum("carrier_name" in c for c in moved(otif.line_level(small_model.tables))) == 1


def test_newest_day_is_found_without_the_line_level(spark, small_model, monkeypatch):
    newest = otif.line_level(small_model.tables).agg(F.max("actual_delivery_date")).first()[0]
    monkeypatch.setattr(otif, "line_level", None)
    assert otif.anchor_date(small_model.tables) == newest
    none = small_model.tables.but(order_lines=small_model.tables.order_lines.where("false"))
    assert otif.anchor_date(none) is None


def test_rows_found_unique_are_not_checked_again(spark, monkeypatch):
    calls, check = [], snapshots.duplicate_keys
    monkeypatch.setattr(snapshots, "duplicate_keys", lambda df, keys: calls.append(keys) or check(df, keys))
    df = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    root = staging.fresh_path(spark, "unique")
    for _ in range(3):
        assert snapshots.publish(df, root, "s", ["k"]) == 2
    assert calls == [["k"]]
    with pytest.raises(ValueError):
        snapshots.publish(df, root, "s", ["v"])
    assert len(snapshots.published_versions(spark, root, "s")) == 1


def test_staged_files_are_compact(spark):
    df = staging.stage(spark.range(5), "compact")
    assert all(".zstd." in f for f in df.inputFiles()) and df.count() == 5


def test_shipments_of_the_mart_are_not_exchanged_for_their_region(spark, monkeypatch):
    seen = spied(monkeypatch, sample_mart)
    with settings(spark, PLAIN | {"spark.sql.autoBroadcastJoinThreshold": "20KB"}):
        assert sample_mart.derive_tables(spark, SMALL).shipments.count() > 0
        assert moved(seen["mart-shipments"]) == []


def test_segments_are_written_sorted(spark, monkeypatch):
    seen = spied(monkeypatch, ordered)
    rows = [(g, (i * 37) % 101) for g in ("a", "b") for i in range(101)]
    ordered.ordered_columns(spark.createDataFrame(rows, "g string, i int"), ["g"], [("i", True)], rank="r", segments=3)
    parts = seen["segments"].rdd.glom().collect()
    assert sum(map(len, parts)) == 202 and all([*map(tuple, p)] == sorted(map(tuple, p)) for p in parts)


def test_shipments_without_a_backorder_are_not_grouped(spark, small_model):
    plan = backorders.vendor_backorder_totals(small_model.tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2


def test_shared_lines_move_no_more_once_joined(small_model, monkeypatch):
    seen = spied(monkeypatch, plans_model)
    shared = FulfilmentModel.for_alerts(small_model.tables)
    assert shared._recent(30).count() == otif.line_level(small_model.tables, since=shared.anchor - dt.timedelta(days=30)).count()
    assert "RebalancePartitions" not in seen["line-level"]._jdf.queryExecution().optimizedPlan().toString()
    assert "shipment_id" not in seen["line-level"].columns


def test_late_corrections_join_lines_once(spark, monkeypatch):
    seen = spied(monkeypatch, registry)
    assert registry.QUERIES["t10_late_corrections"](spark, SMALL).columns
    assert [x for x in seen if x == "late-lines"]


def test_the_newest_rows_meet_once_and_are_not_sorted(spark):
    df = spark.createDataFrame([("a", 1, 0.5, 0), ("a", 1, None, 2), ("a", 2, 0.1, 1)], "k string, d int, share double, batch int")
    newest = runner.latest(df, ["k", "d"])
    assert sorted(map(tuple, newest.collect())) == [("a", 1, None, 2), ("a", 2, 0.1, 1)]
    with settings(spark, PLAIN):
        plan = runner.latest(df, ["k", "d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Sort" not in plan and plan.index("HashAggregate") < plan.index("Exchange")
    assert "partial_max" not in plan[plan.index("Exchange"):]


def test_lines_of_a_batch_are_joined_by_shares_of_orders(spark, small_model, monkeypatch):
    t, folder = small_model.tables, staging.fresh_path(spark, "shares")
    size = sum(staging.input_bytes(getattr(t, n)) for n in kpis.BY_ORDER)
    assert size > 1000 and kpis.by_orders(t) == [t]
    monkeypatch.setattr(kpis, "SLICE_BYTES", size // 3 + 1)
    assert len(kpis.by_orders(t)) == 3
    joined, line_level = [], otif.line_level
    monkeypatch.setattr(otif, "line_level", lambda t, *a: (joined.append(t), line_level(t, *a))[1])
    act = kpis.line_level_action(lambda: t, folder)
    for _ in range(2):  # a batch that runs again replaces what it wrote
        act(t.delivery_lines, 0)
    got, want = spark.read.parquet(f"{folder}/out").drop("batch"), line_level(t)
    assert len(joined) > 5 and got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_a_batch_of_streaks_keeps_what_it_needs(spark, small_model):
    """History has the columns of the step; segments and the like are gone with the batch, what waited two batches ago too."""
    folder, under = staging.fresh_path(spark, "lean"), staging.staged_under(spark, "").rstrip("/")
    step = carried.streak_step()
    lines = small_model.line_level
    before = set(os.listdir(under))
    carried.batch_action(step, carried.STREAKS, folder)(lines, 0)
    assert set(os.listdir(under)) - before == {os.path.basename(folder)}
    assert spark.read.parquet(f"{folder}/history/0").columns == step.columns
    t, folder = small_model.tables, staging.fresh_path(spark, "waited")
    act = kpis.line_level_action(lambda: t.but(shipments=t.shipments.where("false")), folder)
    for k in range(3):
        act(t.delivery_lines.where(f"delivery_line_id % 3 = {k}"), k)
    assert sorted(os.listdir(f"{folder}/waiting")) == ["1", "2"]
    assert spark.read.parquet(f"{folder}/waiting/2").count() == t.delivery_lines.count()


def test_flat_files_go_once_they_are_summed(spark, monkeypatch):
    seen, write = [], readers.write_csv
    monkeypatch.setattr(readers, "write_csv", lambda t, folder, *a: (seen.append(folder), write(t, folder, *a))[1])
    assert registry.QUERIES["s04b_csv_checksums"](spark, SMALL).count() == len(registry.SUMMED)
    assert len(seen) == len(readers.EXCHANGE) and not any(map(os.path.exists, seen))
