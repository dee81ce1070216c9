import pytest

from dockside.config import SlaConfig
from dockside.operators import otif
from micro import day, merged, one_line_order, rows, tables


def flags(spark, **kw):
    t = tables(spark, **one_line_order(1, **kw))
    return rows(otif.line_level(t), "is_on_time", "is_in_full", "is_otif")


@pytest.mark.parametrize("came, on_time", [
    ("2024-01-08", 0), ("2024-01-09", 1), ("2024-01-10", 1), ("2024-01-11", 0),
])
def test_on_time_window(spark, came, on_time):
    assert flags(spark, requested="2024-01-10", delivered_on=came) == [(on_time, 1, on_time)]


@pytest.mark.parametrize("delivered, damage, in_full, otif_flag", [
    (10, 0, 1, 1), (11, 1, 1, 1), (10, 1, 0, 0), (9, 0, 0, 0), (10, None, 0, 1), (9, None, 0, 0),
])
def test_in_full(spark, delivered, damage, in_full, otif_flag):
    got = flags(spark, requested="2024-01-10", delivered_on="2024-01-10", delivered=delivered, damage=damage)
    assert got == [(1, in_full, otif_flag)]


def test_missing_damage_counts_as_zero_in_portable_form(spark):
    t = tables(spark, **one_line_order(1, requested="2024-01-10", delivered_on="2024-01-10", damage=None))
    assert rows(otif.line_level(t, null_damage="zero"), "is_in_full", "is_otif") == [(1, 1)]


def test_undelivered_shipments_are_left_out(spark):
    t = tables(spark, **one_line_order(1, requested="2024-01-10", delivered_on=None))
    assert otif.line_level(t).count() == 0
    assert otif.anchor_date(t) is None


def test_missing_requested_date_is_late(spark):
    assert flags(spark, requested=None, delivered_on="2024-01-10") == [(0, 1, 0)]


def test_backorder_value_may_be_negative(spark):
    t = tables(spark, **one_line_order(1, requested="2024-01-10", delivered_on="2024-01-10", delivered=12))
    assert float(otif.line_level(t).first()["backorder_value"]) == -10.0


def test_two_shipments_of_one_line_give_two_rows(spark):
    a = one_line_order(1, requested="2024-01-10", delivered_on="2024-01-10")
    b = one_line_order(2, requested="2024-01-10", delivered_on="2024-01-12")
    for part in ("shipments", "delivery_lines"):
        b[part][0]["order_number"] = "O1"
    t = tables(spark, **merged(a, {k: b[k] for k in ("shipments", "delivery_lines")}))
    assert sorted(rows(otif.line_level(t), "shipment_number", "is_otif")) == [("SH0001", 1), ("SH0002", 0)]


def test_since_gives_the_same_rows(spark, small_model):
    cut = day("2001-06-01")
    t = small_model.tables
    full = otif.line_level(t).where(f"actual_delivery_date >= date'{cut}'")
    assert full.exceptAll(otif.line_level(t, since=cut)).count() == 0
    assert otif.line_level(t, since=cut).count() == full.count() > 0


def test_anchor_skips_newer_shipments_without_lines(spark):
    old = one_line_order(1, requested="2024-01-10", delivered_on="2024-01-10")
    new = one_line_order(2, requested="2025-01-10", delivered_on="2025-01-10")
    t = tables(spark, **merged(old, {"shipments": new["shipments"]}))
    assert otif.anchor_date(t) == day("2024-01-10")
    assert otif.date_anchor(otif.line_level(t)).first().asDict() == {
        "max_delivery_date": day("2024-01-10"), "window_start_30d": day("2023-12-11"),
        "window_start_90d": day("2023-10-12"), "window_start_180d": day("2023-07-14"),
    }


def test_otif_never_exceeds_its_parts_when_damage_is_known(small_model):
    bad = small_model.line_level.where("damage_qty is not null and is_otif > least(is_on_time, is_in_full)")
    assert bad.count() == 0


def test_tolerance_is_a_setting(spark):
    t = tables(spark, **one_line_order(1, requested="2024-01-10", delivered_on="2024-01-07"))
    assert rows(otif.line_level(t, SlaConfig(early_tolerance_days=3)), "is_on_time") == [(1,)]
