import pytest
from pyspark.sql import functions as F

from dockside.operators import erp, quality, security
from dockside.operators.otif import line_level
from dockside.plans.model import FulfilmentModel
from dockside.plans import staging
from dockside.plans.staging import fresh_path
from dockside.schemas import ERP, GENERIC
from dockside.sources import readers, snapshots
from micro import day, frame, rows, tables


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([("V1", None)], "vendor_code string, tier string")
    got = readers.with_defaults(df, "vendors").first()
    assert (got.country, got.tier, got.otif_rate) == ("US", None, None)
    stamped = readers.with_defaults(spark.createDataFrame([("O1",)], "order_number string"), "backorders").first()
    assert stamped.status == "open" and stamped.created_at is not None


def test_csv_round_trip(spark, small_model):
    t = small_model.tables
    folder = fresh_path(spark, "csv-test")
    readers.write_csv(t, folder)
    back = readers.read_csv(spark, folder, t.alert_history)
    for name in readers.EXCHANGE:
        cols = readers.exchanged_columns(name)
        a, b = getattr(t, name).select(*cols), getattr(back, name).select(*cols)
        assert a.exceptAll(b).count() == 0 and a.count() == b.count(), name
        assert getattr(back, name).dtypes == getattr(t, name).dtypes
    assert "country" not in spark.read.option("header", True).csv(f"{folder}/vendors").columns
    assert back.vendors.where("country <> 'US'").count() == 0


def test_reload_is_idempotent(spark, small_model):
    folder = fresh_path(spark, "reload-test")
    for _ in range(2):
        readers.write_tables(small_model.tables, folder, ["orders", "vendors"])
    assert spark.read.parquet(f"{folder}/orders").count() == small_model.tables.orders.count()
    with pytest.raises(ValueError):
        readers.write_tables(small_model.tables, folder, ["orders; drop"])


def test_jdbc_options():
    o = readers.jdbc_options("jdbc:postgresql://db/otif", "orders")
    assert (o["driver"], o["truncate"], o["numPartitions"]) == ("org.postgresql.Driver", "true", "8")
    assert readers.jdbc_options("jdbc:sqlite:/x.db", "orders")["numPartitions"] == "1"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:other:x", "orders")


def test_snapshot_versions(spark):
    root = fresh_path(spark, "snap-test")
    with pytest.raises(LookupError):
        snapshots.current(spark, root, "s")
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    assert snapshots.publish(one, root, "s", ["k"]) == 1
    with pytest.raises(ValueError):
        snapshots.publish(one.unionByName(one), root, "s", ["k"])
    assert snapshots.current(spark, root, "s").count() == 1  # the old version stands
    snapshots.publish(one.withColumn("v", F.lit("b")), root, "s", ["k"])
    assert snapshots.current(spark, root, "s").first().v == "b"


def test_refresh_isolates_failures(spark, small_model):
    class Broken(FulfilmentModel):
        @property
        def vendor_hierarchy(self):
            raise RuntimeError("no vendors today")

    report = snapshots.refresh_all(Broken(small_model.tables), fresh_path(spark, "refresh-test"))
    assert {o.snapshot: o.ok for o in report} == {
        "rolling_7d": True, "vendor_hierarchy": False, "carrier_scorecard": True, "alert_summary": True,
    }
    assert snapshots.failed(report)


def test_extract_registers_views(spark, small_model):
    names = snapshots.register_extract(small_model, "x_")
    assert "x_orders" in names and "x_v_rolling_7d" in names
    assert spark.sql("SELECT count(*) FROM x_v_vendor_hierarchy").first()[0] == 11


def test_quality_checks(spark):
    t = tables(
        spark,
        orders=[dict(order_id=1, order_number="O1", order_date="2024-01-01")] * 2,
        order_lines=[dict(order_line_id=1, order_number="O9", line_number=1, ordered_qty=1)],
        shipments=[dict(shipment_id=i, shipment_number=f"S{i}", order_number="O1", vendor_code="V1",
                        vendor_region=f"R{i}", carrier_code="C", carrier_name=f"n{i}") for i in range(2)],
    )
    got = dict(rows(quality.natural_key_violations(t), "check_name", "violations"))
    assert got == {"orders.order_number": 1, "shipments.shipment_number": 0}
    lost = dict(rows(quality.orphans(t), "check_name", "violations"))
    assert lost["order_lines->orders(order_number)"] == 1 and lost["shipments->orders(order_number)"] == 0
    assert [v for _, v in rows(quality.ambiguous_masters(t), "check_name", "violations")] == [1, 1]


# --- row security


def test_unset_region_sees_nothing(spark, small_model):
    t = small_model.tables
    for seen in (security.secure_tables(t, "regional_manager"), security.secure_tables(t, "regional_manager", ""),
                 security.secure_tables(t, "stranger", "ASIA")):
        assert all(df.count() == 0 for _, df in seen.items())


def test_region_from_session_setting(spark, small_model):
    spark.conf.set(security.REGION_SETTING, "ASIA")
    try:
        seen = security.secure_tables(small_model.tables, "regional_manager")
        assert {r[0] for r in seen.vendors.select("region").distinct().collect()} == {"ASIA"}
    finally:
        spark.conf.unset(security.REGION_SETTING)


def test_regional_rows_are_a_subset_and_views_inherit_it(small_model):
    t = small_model.tables
    seen = security.secure_tables(t, "regional_manager", "ASIA", derived=True)
    assert seen.orders.exceptAll(t.orders).count() == 0
    assert 0 < seen.orders.count() < t.orders.count()
    ll = line_level(seen)
    assert ll.where("vendor_region <> 'ASIA'").count() == 0
    assert ll.exceptAll(small_model.line_level).count() == 0


# --- ERP documents


def erp_tables(spark, **given):
    return {n: frame(spark, s, given.get(n, [])) for n, s in ERP.items()}


def test_schedule_lines(spark):
    d = erp_tables(
        spark,
        vbak=[dict(mandt=100, vbeln="1", erdat="2024-01-01", netwr=50), dict(mandt=100, vbeln="2", erdat="2024-01-02")],
        vbap=[dict(mandt=100, vbeln="1", posnr=10, kwmeng=5, netwr=50), dict(mandt=100, vbeln="1", posnr=20, kwmeng=0)],
        vbep=[
            dict(mandt=100, vbeln="1", posnr=20, etenr=1, edatu="2024-02-02"),
            dict(mandt=100, vbeln="1", posnr=10, etenr=1, edatu="2024-02-01", lmeng=4, wmeng=5),
            dict(mandt=100, vbeln="1", posnr=10, etenr=2, edatu="2024-03-01", lmeng=1, wmeng=1),
            dict(mandt=200, vbeln="2", posnr=10, etenr=1, edatu="2030-01-01"),
        ],
    )
    got = dict(rows(erp.orders(d["vbak"], d["vbep"]), "order_number", "requested_delivery_date"))
    assert got == {"1": day("2024-02-01"), "2": day("2024-01-02")}
    lines = erp.order_lines(d["vbap"], d["vbep"], priced=True).orderBy("line_number")
    assert [tuple(None if v is None else float(v) for v in r) for r in
            rows(lines, "confirmed_qty", "delivered_qty", "unit_price")] == [(4.0, 5.0, 10.0), (0.0, 0.0, None)]


def test_deliveries(spark):
    d = erp_tables(
        spark,
        likp=[dict(mandt=100, vbeln="80", podat="2024-01-05"), dict(mandt=100, vbeln="81")],
        lips=[dict(mandt=100, vbeln="80", posnr=10, lfimg=3), dict(mandt=100, vbeln="80", posnr=20, lfimg=4)],
        vbfa=[dict(mandt=100, vbeln="80", posnn=p, vbeln_v="1", vbtyp_n="J", vbtyp_v="C") for p in (10, 20)]
        + [dict(mandt=100, vbeln="80", posnn=30, vbeln_v="1", vbtyp_n="R", vbtyp_v="C"),
           dict(mandt=100, vbeln="81", posnn=10, vbeln_v="1", vbtyp_n="J", vbtyp_v="C")],
    )
    assert rows(erp.shipments(d["likp"], d["vbfa"]), "shipment_number") == [("80",), ("80",)]
    assert erp.shipments(d["likp"], d["vbfa"], dedupe=True).count() == 1
    assert sorted(float(q) for (q,) in rows(erp.delivery_lines(d["lips"], d["vbfa"]), "delivered_qty")) == [3.0, 4.0]


def test_masters(spark):
    d = erp_tables(
        spark,
        kna1=[dict(mandt=100, kunnr="K", name1="n", land1="DE ")], lfa1=[dict(mandt=100, lifnr="L", regio="NW")],
        mara=[dict(mandt=100, matnr="M", meins=""), dict(mandt=100, matnr="N", meins=None, maktx="x")],
    )
    assert rows(erp.customers(d["kna1"]), "region", "country") == [("N/A", "DE")]
    assert rows(erp.vendors(d["lfa1"]), "region", "country", "tier") == [("NW", "US", "standard")]
    assert sorted(rows(erp.products(d["mara"]), "product_name", "unit_of_measure")) == [("M", "EA"), ("x", None)]


def test_staged_tables_and_their_removal(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    staged = staging.stage(df, "stage-test")
    assert staged.schema == df.schema and staged.inputFiles()[0].find("stage-test") > 0
    folder = fresh_path(spark, "remove-test")
    df.write.parquet(folder)
    assert staging.remove_folder(spark, folder) and not staging.remove_folder(spark, folder)


def test_shared_folder_is_the_checkpoint_folder_or_the_warehouse():
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name.replace(".", "_"), default)

    class Session:
        conf = Conf(spark_checkpoint_dir="hdfs:/shared/", spark_sql_warehouse_dir="hdfs:/warehouse")

    assert staging.shared_dir(Session()) == "hdfs:/shared"
    Session.conf = Conf(spark_sql_warehouse_dir="hdfs:/warehouse")
    assert staging.shared_dir(Session()) == "hdfs:/warehouse"


def test_schemas_cover_every_table():
    assert len(GENERIC) == 10 and len(ERP) == 9


def test_tables_are_made_when_they_are_read(spark, tmp_path):
    """A query reads what it names: denied tables and those of other queries are never made."""
    from dockside.operators.security import secure_tables
    from dockside.tables import Later, Tables

    made = []

    def later(name):
        schema = GENERIC[name]
        return Later(spark, schema, lambda: made.append(name) or spark.createDataFrame([], schema))

    t = Tables(**{n: later(n) for n in Tables.names()})
    assert t.but(customers=t.unread("customers")).spark is not None and made == []
    seen = secure_tables(t, [("auditor", None)])
    assert readers.row_counts(seen).where("rows = 0").count() == len(Tables.names()) and made == ["alert_history"]
    assert secure_tables(t, [("regional_manager", "ASIA")]).orders.columns == GENERIC["orders"].names
    assert sorted(made) == ["alert_history", "customers", "orders"]
    assert t.orders is t.orders and len(made) == 3
