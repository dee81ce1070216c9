"""The maintained line level: equal to a full one, and reading and writing no more than what the arrivals touch."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from dockside.config import SlaConfig
from dockside.operators import otif
from dockside.plans import maintained
from dockside.plans.maintained import BY_ORDER, MaintainedLineLevel
from tests import micro


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def orders(spark, ids, **how):
    return micro.tables(spark, **micro.merged(*[
        micro.one_line_order(i, requested="2024-02-10", delivered_on=f"2024-0{1 + i % 3}-0{1 + i % 9}", vendor=f"V{i % 4}", **how) for i in ids
    ]))


def both(spark, *bundles):
    """All bundles as one."""
    first, *more = bundles
    for b in more:
        first = first.but(**{n: getattr(first, n).unionByName(getattr(b, n)) for n in BY_ORDER})
    return first


def files(root):
    return {p: (os.path.getmtime(p), os.path.getsize(p)) for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def test_a_new_file_touches_one_partition(spark, tmp_path):
    store = MaintainedLineLevel(spark, str(tmp_path), order_parts=16, vendor_shares=4)
    history = orders(spark, range(60))
    first = store.apply(history, 0)
    assert len(first.partitions) > 3
    before = files(tmp_path / "lines")
    new = orders(spark, [99])
    change = store.apply(new, 1)
    assert len(change.order_parts) == 1 and len(change.partitions) == 1
    after = files(tmp_path / "lines")
    month, share = change.partitions[0]
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed and all(f"{otif.MONTH}={month}/{maintained.SHARE}={share}/" in p for p in changed)
    assert rows(store.line_level(history)) == rows(otif.line_level(both(spark, history, new)))


def test_bytes_read_follow_the_change(spark, tmp_path):
    store = MaintainedLineLevel(spark, str(tmp_path), order_parts=16, vendor_shares=4)
    store.apply(orders(spark, range(80)), 0)
    part = store.apply(orders(spark, [200]), 1).order_parts[0]
    schema = orders(spark, []).shipments.schema
    scan = store._base("shipments", schema).where(F.col(maintained.PART).isin(part))
    read = sum(r[1] for r in scan.select("_metadata.file_path", "_metadata.file_size").distinct().collect())
    every = sum(size for _, size in files(tmp_path / "base/shipments").values())
    assert 0 < read < every / 4


@pytest.mark.parametrize("again", [False, True])
def test_rows_of_one_order_may_come_in_any_order(spark, tmp_path, again):
    store = MaintainedLineLevel(spark, str(tmp_path), order_parts=4, vendor_shares=2)
    whole = orders(spark, range(12))
    none = {n: getattr(whole, n).where(F.lit(False)) for n in BY_ORDER}
    steps = [{"delivery_lines": whole.delivery_lines}, {"orders": whole.orders}, {"shipments": whole.shipments}, {"order_lines": whole.order_lines}]
    for k, step in enumerate(steps):
        for _ in range(2 if again else 1):  # a batch that runs again changes nothing more
            change = store.apply(whole.but(**none | step), k)
        assert (not change.partitions) or k == 3
    assert rows(store.line_level(whole)) == rows(otif.line_level(whole))
    days = store.days(whole)
    assert days.agg(F.sum("lines")).first()[0] == 12
    assert rows(maintained.service_by(days, ["vendor_code"])) == rows(maintained.service_by(maintained.day_counts(otif.line_level(whole)), ["vendor_code"]))


def test_a_repeated_line_multiplies_as_the_join_does(spark, tmp_path):
    store = MaintainedLineLevel(spark, str(tmp_path), order_parts=4, vendor_shares=2)
    whole = orders(spark, [1, 2])
    store.apply(whole, 0)
    none = {n: getattr(whole, n).where(F.lit(False)) for n in BY_ORDER}
    twice = whole.but(**none | {"order_lines": whole.order_lines.where("order_number = 'O1'")})
    store.apply(twice, 1)
    assert rows(store.line_level(whole)) == rows(otif.line_level(both(spark, whole, twice)))


def test_nothing_arrives_and_nulls(spark, tmp_path):
    store = MaintainedLineLevel(spark, str(tmp_path), order_parts=4, vendor_shares=2)
    none = orders(spark, [])
    assert store.apply(none, 0) == maintained.Change((), ())
    assert store.line_level(none).count() == 0
    odd = micro.tables(spark, shipments=[dict(shipment_id=1)], delivery_lines=[dict(delivery_line_id=1)], orders=[dict(order_id=1)])
    assert store.apply(odd, 1).partitions == ()
    assert store.line_level(none).count() == 0


def test_views_read_the_maintained_lines(spark, tmp_path, small_model):
    t = small_model.tables
    store = MaintainedLineLevel(spark, str(tmp_path), SlaConfig(), order_parts=4, vendor_shares=2)
    store.apply(t, 0)
    kept = store.model(store.tables(t))
    assert kept.anchor == small_model.anchor
    assert rows(kept.rolling_7d) == rows(small_model.rolling_7d)
    assert "BroadcastExchange" not in kept.geographic._jdf.queryExecution().optimizedPlan().toString()
    assert rows(kept.geographic) == rows(small_model.geographic)


def test_a_batch_leaves_nothing_aside(spark):
    """What a batch stages is removed with it."""
    from dockside.plans.staging import fresh_path, staged_under

    folder = staged_under(spark, "").rstrip("/")
    os.makedirs(folder, exist_ok=True)
    root = fresh_path(spark, "kept")
    store = MaintainedLineLevel(spark, root, order_parts=2, vendor_shares=1)
    before = set(os.listdir(folder))
    store.apply(micro.tables(spark), 0)
    assert set(os.listdir(folder)) - before == {os.path.basename(root)}


def test_a_batch_adds_lines_and_leaves_those_before(spark, tmp_path):
    """Lines of an order that come in two batches are each written once, in the same partition."""
    store = MaintainedLineLevel(spark, str(tmp_path), order_parts=4, vendor_shares=1)
    whole = orders(spark, range(0, 12, 3))
    none = {n: getattr(whole, n).where(F.lit(False)) for n in BY_ORDER}
    store.apply(whole, 0)
    before = files(tmp_path / "lines") | files(tmp_path / "days")
    again = whole.but(**none | {"delivery_lines": whole.delivery_lines.where("order_number in ('O3', 'O6')")})
    assert store.apply(again, 1).partitions
    after = files(tmp_path / "lines") | files(tmp_path / "days")
    assert before.items() <= after.items()
    assert store.line_level(whole).count() == 6 and store.days(whole).agg(F.sum("lines")).first()[0] == 6
    assert rows(store.line_level(whole)) == rows(otif.line_level(both(spark, whole, again)))


@pytest.mark.parametrize("few", [0, 1000])
def test_folders_of_orders_are_joined_one_after_the_other(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(maintained, "SLICE_BYTES", 1)
    monkeypatch.setattr(maintained, "FEW", few)
    joined, line_level = [], otif.line_level
    monkeypatch.setattr(otif, "line_level", lambda t, *a, **b: (joined.append(b.get("newest")), line_level(t, *a, **b))[1])
    store = MaintainedLineLevel(spark, str(tmp_path), order_parts=4, vendor_shares=2)
    history, new = orders(spark, range(20)), orders(spark, range(20, 26))
    parts = [len(store.apply(x, k).order_parts) for k, x in enumerate((history, new))]
    assert joined.count(maintained.BATCH) == sum(parts) > 5
    assert rows(store.line_level(history)) == rows(line_level(both(spark, history, new)))


def test_shuffle_files_go_with_their_execution(spark, tmp_path, monkeypatch):
    """Not when the driver happens to collect its garbage; the session's own setting is the same afterwards."""
    from dockside.plans import staging

    seen, write = [], MaintainedLineLevel._write
    monkeypatch.setattr(MaintainedLineLevel, "_write", lambda self, *a: (seen.append(spark.conf.get(staging.FREE)), write(self, *a)))
    before = spark.conf.get(staging.FREE, None)
    store = MaintainedLineLevel(spark, str(tmp_path), order_parts=2, vendor_shares=1)
    assert store.apply(orders(spark, range(5)), 0).partitions
    assert set(seen) == {"true"} and spark.conf.get(staging.FREE, None) == before
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    shuffles = lambda: {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}
    kept = shuffles()
    staging.stage(spark.range(1000).groupBy(F.col("id") % 7).count(), "freed")
    for _ in range(100):
        if shuffles() <= kept:
            break
        time.sleep(0.1)
    assert shuffles() <= kept
