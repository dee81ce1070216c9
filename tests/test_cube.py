"""The cube's measures against those computed from the tables, over many slices, and where it reads them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dockside.config import SlaConfig
from dockside.operators import cube as cubes, dashboard, measures
from dockside.operators.measures import Slice
from fixtures.sample_mart import load_mart

SMALL = "/root/testdata/sf0.001"
CFG = SlaConfig()


@pytest.fixture(scope="module")
def tables(spark):
    t = load_mart(spark, SMALL)
    odd = t.delivery_lines.limit(3).withColumn("shipment_number", F.lit("nowhere"))  # lines without a shipment
    undated = F.when(F.crc32("shipment_number") % 11 == 0, None).otherwise(F.col("actual_delivery_date"))
    return t.but(delivery_lines=t.delivery_lines.unionByName(odd), shipments=t.shipments.withColumn("actual_delivery_date", undated))


@pytest.fixture(scope="module")
def cube(tables):
    return cubes.Cube.build(tables, CFG)


def rows(df):
    plain = lambda v: round(float(v), 9) if isinstance(v, float) or hasattr(v, "as_tuple") else v
    return sorted((tuple(plain(v) for v in r) for r in df.select(sorted(df.columns)).collect()), key=str)


def slices(t):
    vendor = t.shipments.agg(F.min("vendor_code")).first()[0]
    day = t.shipments.agg(F.max("actual_delivery_date")).first()[0] - dt.timedelta(days=40)
    return [
        Slice(), Slice(("vendor_code",)), Slice(("vendor_region",), {"vendor_code": [vendor]}), Slice((), {"carrier_mode": "TRUCK"}),
        Slice(("carrier_code", "carrier_mode"), as_of=day),
    ]


def test_measures_equal_those_of_the_tables(tables, cube):
    for s in slices(tables):
        for name in ("total_delivery_lines", "avg_total_lead_time_days"):
            assert rows(cube.measure(name, s)) == rows(measures.MEASURES[name](tables, s, CFG)), (name, s)
        assert rows(cube.measure_table(s)) == rows(measures.measure_table(tables, s, CFG)), s


def test_failures_and_vendor_table(tables, cube):
    for s in (Slice(("vendor_code",)), Slice(("vendor_code",), {"carrier_mode": "TRUCK"})):
        for recent in (1, 100):
            assert rows(cube.vendor_failures(s, recent=recent)) == rows(measures.vendor_failures(tables, s, CFG, recent=recent))
    assert rows(cube.vendor_table()) == rows(dashboard.vendor_table(tables, CFG))


def test_smallest_cuboid_is_read(cube):
    assert cube.route(set()) == () and cube.route({"vendor_code", "actual_delivery_date"}) == ("vendor_code",)
    assert cube.route({"carrier_mode"}) == ("carrier_code", "carrier_name", "carrier_mode")
    assert len(cube.route({"vendor_code", "carrier_code"})) == 5
    assert cube.rows[()] <= cube.rows[("vendor_code",)] <= cube.rows[cube.route({"vendor_code", "carrier_code"})]
    with pytest.raises(ValueError):
        cube.route({"tier"})
    with pytest.raises(ValueError):
        cube.rolling(Slice(("actual_delivery_date",)))
    read = cube.measure_table(Slice(("vendor_code",))).inputFiles()
    assert read and all("cuboid=01111" in f for f in read)


def test_no_rows(tables):
    none = cubes.Cube.build(tables.but(shipments=tables.shipments.limit(0), delivery_lines=tables.delivery_lines.limit(0)), CFG)
    assert none.measure("otif_share", Slice(("vendor_code",))).count() == 0 and none.rolling(Slice()).count() == 1


def test_a_cuboid_is_written_by_several_tasks(spark):
    wide = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(wide)
    spark.conf.set(wide, "false")
    try:
        built = cubes.Cube.build(load_mart(spark, SMALL), CFG)
    finally:
        spark.conf.set(wide, before)
    assert len(built.cuboids[("vendor_code",)].inputFiles()) > 1
