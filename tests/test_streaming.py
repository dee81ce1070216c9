import datetime as dt


from pyspark.sql import functions as F

from dockside.config import SlaConfig
from dockside.operators import cooldown, otif, sequences
from dockside.plans.staging import fresh_path
from dockside.sources import snapshots
from dockside.streaming import alerts, carried, kpis, runner
from micro import day
from test_alert_handling import ALERT, ACK, at


def test_unacknowledged_alerts_wait_for_the_watermark(spark):
    fired = spark.createDataFrame(
        [(1, "X", "a", "CRITICAL", at(0)), (2, "X", "b", "CRITICAL", at(0)), (9, "X", "z", "CRITICAL", at(500))], ALERT)
    acked = spark.createDataFrame([(1, "a", at(10)), (9, "z", at(520))], ACK)
    streams = [runner.file_stream(spark, df, "esc") for df in (fired, acked)]
    out = runner.replay(alerts.escalations(*streams), "esc")
    assert [r.alert_id for r in out.collect()] == [2]


def test_duplicates_inside_the_watermark(spark):
    rows = [(1, "X", "a", "HIGH", at(0)), (2, "X", "a", "HIGH", at(5)), (3, "X", "b", "HIGH", at(5))]
    stream = runner.file_stream(spark, spark.createDataFrame(rows, ALERT).coalesce(1), "dups")
    out = runner.replay(alerts.first_of_period(stream), "dups")
    assert sorted(r.entity for r in out.collect()) == ["a", "b"]


def test_one_broken_channel_does_not_stop_the_others(spark):
    batch = spark.createDataFrame([(1, "X", "a", "CRITICAL", at(0)), (2, "X", "b", "WARNING", at(1))], ALERT)
    sent, last_resort, folder = [], [], fresh_path(spark, "fan")

    def good(df, _):
        sent.extend((r.channel, r.alert_id) for r in df.collect())

    def broken(df, _):
        raise ConnectionError("down")

    last = lambda b, _: last_resort.append(b.count())
    alerts.fan_out({"Teams": broken, "Email": good, "Slack": good}, folder, fallback=last)(batch, 7)
    assert sorted(sent) == [("Email", 1), ("Email", 2), ("Slack", 1)] and not last_resort
    noted = spark.read.parquet(f"{folder}/failures").collect()
    assert [(r.channel, r.problem, r.batch) for r in noted] == [("Teams", "down", 7)]
    alerts.fan_out({"Teams": broken}, folder, fallback=last)(batch, 8)
    assert last_resort == [2]


def test_refresh_sees_rows_that_came_later(spark, small_model):
    t = small_model.tables
    ships, source, root, checkpoint = (fresh_path(spark, f"later-{x}") for x in ("ships", "source", "root", "check"))
    read = lambda: t.but(shipments=spark.read.schema(t.shipments.schema).parquet(ships))
    seen = []
    for part in ("shipment_id % 5 = 0", "shipment_id % 5 <> 0"):
        t.shipments.where(part).write.mode("append").parquet(ships)
        t.shipments.where(part).select("shipment_id").write.mode("append").parquet(source)
        arriving = spark.readStream.schema("shipment_id long").parquet(source)
        kpis.refresh_on_arrival(arriving, read, root, checkpoint, once=True)
        seen.append({r.carrier_code: r.asDict() for r in snapshots.current(spark, root, "carrier_scorecard").collect()})
    assert seen[0] != seen[1]
    assert list(seen[1].values()) and {k: v for k, v in seen[1].items()} == {
        r.carrier_code: r.asDict() for r in small_model.carrier_scorecard.collect()
    }


def test_lines_wait_for_their_shipment(spark, small_model):
    t = small_model.tables
    ships, folder = fresh_path(spark, "wait-ships"), fresh_path(spark, "wait")
    read = lambda: t.but(shipments=spark.read.schema(t.shipments.schema).parquet(ships))
    act = kpis.line_level_action(read, folder)
    t.shipments.where("shipment_id % 2 = 0").write.parquet(ships)
    act(t.delivery_lines.where("delivery_line_id % 3 = 0"), 0)
    act(t.delivery_lines.where("delivery_line_id % 3 = 1"), 1)
    t.shipments.where("shipment_id % 2 <> 0").write.mode("append").parquet(ships)
    for _ in range(2):  # a repeated batch changes nothing
        act(t.delivery_lines.where("delivery_line_id % 3 = 2"), 2)
    out = spark.read.parquet(f"{folder}/out").drop("batch")
    whole = otif.line_level(t)
    assert out.exceptAll(whole).count() == 0 and out.count() == whole.count()


def test_late_days_are_recomputed(spark):
    rows = lambda *x: spark.createDataFrame([("V1", day(d), o) for d, o in x], "vendor_code string, actual_delivery_date date, is_otif int")
    folder = fresh_path(spark, "late-days")
    act = kpis.late_action(folder, ts="actual_delivery_date", delay=dt.timedelta(days=2))
    act(rows(("2024-01-01", 1), ("2024-01-10", 1)), 0)
    act(rows(("2024-01-09", 0)), 1)  # in time
    for _ in range(2):
        act(rows(("2024-01-01", 0), ("2024-01-02", 1)), 2)
    act(rows(("2024-01-01", 0)), 3)
    fixed = runner.latest(spark.read.parquet(f"{folder}/corrections"), ["vendor_code", "first_day"])
    assert sorted((r.first_day, r.lines, r.otif_lines) for r in fixed.collect()) == [
        (day("2024-01-01"), 3, 1), (day("2024-01-02"), 1, 1),
    ]


def test_updates_replace_each_other(spark, small_model):
    ll = small_model.line_level.where("actual_delivery_date >= date'2000-06-01'")
    stream = runner.file_stream(spark, ll.repartition(3), "kpi", files_per_batch=1)
    got = runner.replay(kpis.daily_kpis(stream, delay="4000 days"), "kpi", ["vendor_code", "last_day"])
    want = {(r.vendor_code, r.actual_delivery_date): r["count"] for r in ll.groupBy("vendor_code", "actual_delivery_date").count().collect()}
    assert {(r.vendor_code, r.last_day): r.lines for r in got.collect()} == want


def test_late_rows_are_split_off(spark):
    rows = spark.createDataFrame([("V1", day("2024-01-01")), ("V1", day("2024-01-09"))], "vendor_code string, d date")
    accepted = spark.createDataFrame([("V1", day("2024-01-10"))], "vendor_code string, d date")
    fresh, late = kpis.split_late(rows, accepted, ts="d", delay=dt.timedelta(days=2))
    assert [r.d for r in fresh.collect()] == [day("2024-01-09")]
    assert [r.d for r in late.collect()] == [day("2024-01-01")]
    fresh, late = kpis.split_late(rows, None, ts="d", delay=dt.timedelta(days=2))
    assert fresh.count() == 2 and late.count() == 0


def test_state_provider_setting_is_restored(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with runner.rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_line_level_stream_equals_batch(spark, small_model):
    t = small_model.tables
    stream = kpis.line_level_stream(runner.file_stream(spark, t.delivery_lines, "dl", files_per_batch=1), t, SlaConfig())
    out = runner.replay(stream, "dl")
    assert out.exceptAll(otif.line_level(t)).count() == 0 and out.count() == small_model.line_level.count()
    assert out.agg(F.sum("is_otif")).first()[0] > 0


def carried_in_steps(spark, df, parts, schema, step, label):
    source, folder = fresh_path(spark, f"{label}-in"), fresh_path(spark, label)
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(source)
        carried.run(spark.readStream.schema(df.schema).parquet(source), folder, schema, step)
    return spark.read.parquet(f"{folder}/out")


def test_carried_streaks_equal_batch(spark, small_model):
    ll = small_model.line_level
    cuts = ["actual_delivery_date < date'1995-01-02'",
            "actual_delivery_date >= date'1995-01-02' and actual_delivery_date < date'1995-01-04'",
            "actual_delivery_date >= date'1995-01-04' and actual_delivery_date < date'2000-06-01'",
            "actual_delivery_date >= date'2000-06-01'"]
    got = carried_in_steps(spark, ll, cuts, carried.STREAKS, carried.streak_step(), "cs")
    want = sequences.consecutive_failures(ll)
    cols = ["vendor_code", "actual_delivery_date", "delivery_rank", "failure_streak_label"]
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0 and got.count() == want.count()


def test_carried_cooldown_equals_batch(spark):
    rows = [(i, "X", "abb"[i % 3], "CRITICAL", at(70 * i)) for i in range(90)]
    df = spark.createDataFrame(rows, ALERT)
    got = carried_in_steps(spark, df, ["alert_id < 17", "alert_id >= 17 and alert_id < 18", "alert_id >= 18"],
                           carried.FIRED, carried.throttle_step(), "ct")
    want = cooldown.throttle(df)
    assert sorted(r.alert_id for r in got.collect()) == sorted(r.alert_id for r in want.collect())


def test_a_repeated_batch_changes_nothing(spark):
    rows = [(i, "X", "a", "CRITICAL", at(200 * i)) for i in range(10)]
    df = spark.createDataFrame(rows, ALERT)
    folder = fresh_path(spark, "again")
    act = carried.batch_action(carried.throttle_step(), carried.FIRED, folder)
    act(df.where("alert_id < 5"), 0)
    for _ in range(2):
        act(df.where("alert_id >= 5"), 1)
    fired = sorted(r.alert_id for r in spark.read.parquet(f"{folder}/out").collect())
    assert fired == sorted(r.alert_id for r in cooldown.throttle(df).collect())


def test_late_lines_count_in_their_windows(spark, small_model):
    t, folder = small_model.tables, fresh_path(spark, "late-kpis")
    act = kpis.kpi_action(lambda: t, folder, days=7)
    # The newest deliveries first: all of the second and third batch come more than two days late.
    cuts = ["actual_delivery_date >= date'1997-01-01'", "actual_delivery_date < date'1994-01-01'",
            "actual_delivery_date >= date'1994-01-01' and actual_delivery_date < date'1997-01-01'"]
    numbers = [small_model.line_level.where(c).select("shipment_number", "line_number") for c in cuts]
    for k, part in enumerate(numbers):
        for _ in range(2 if k == 1 else 1):  # a repeated batch changes nothing
            act(t.delivery_lines.join(part, ["shipment_number", "line_number"], "left_semi"), k)
    got = runner.latest(spark.read.parquet(f"{folder}/kpis"), ["vendor_code", "last_day"])
    want = small_model.line_level.select("vendor_code", "is_otif", F.explode(F.expr(
        "sequence(actual_delivery_date, date_add(actual_delivery_date, 6))")).alias("last_day")
    ).groupBy("vendor_code", "last_day").agg(F.count(F.lit(1)).alias("lines"), F.sum("is_otif").alias("otif_lines"))
    cols = ["vendor_code", "last_day", "lines", "otif_lines"]
    rows = lambda df: sorted(tuple(r) for r in df.select(*cols).collect())
    assert rows(got) == rows(want)


def test_late_alerts_change_the_chain(spark):
    rows = [(i, "X", "abb"[i % 3], "CRITICAL", at(70 * i)) for i in range(90)]
    df = spark.createDataFrame(rows, ALERT)
    source, folder = fresh_path(spark, "late-ct-in"), fresh_path(spark, "late-ct")
    for part in ("alert_id >= 60", "alert_id < 20", "alert_id >= 20 and alert_id < 60"):
        df.where(part).write.mode("append").parquet(source)
        carried.run(spark.readStream.schema(df.schema).parquet(source), folder, carried.FIRED, carried.throttle_step())
    got = carried.output(spark, folder, carried.FIRED)
    assert sorted(r.alert_id for r in got.collect()) == sorted(r.alert_id for r in cooldown.throttle(df).collect())


def test_late_lines_correct_streaks(spark, small_model):
    ll, folder = small_model.line_level, fresh_path(spark, "late-cs")
    act = carried.batch_action(carried.streak_step(), carried.STREAKS, folder)
    for k, part in enumerate(["actual_delivery_date >= date'1997-01-01'", "actual_delivery_date < date'1994-01-01'",
                              "actual_delivery_date >= date'1994-01-01' and actual_delivery_date < date'1997-01-01'"]):
        for _ in range(2 if k == 1 else 1):  # a repeated batch changes nothing
            act(ll.where(part), k)
    got, want = carried.output(spark, folder, carried.STREAKS), sequences.consecutive_failures(ll)
    cols = ["vendor_code", "actual_delivery_date", "delivery_rank", "failure_streak_label"]
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0 and got.count() == want.count()


def test_touched_windows_meet_without_a_broadcast(spark):
    """Windows of a batch are never sent to the driver; late days, a vendor without code and old windows left alone."""
    day = lambda k: dt.date(2024, 1, k)
    rows = [("A", day(1), 2, 1, False), ("A", day(3), 4, 4, False), ("A", day(2), 1, 0, True), ("A", day(20), 5, 5, False),
            ("B", day(5), 1, 1, False), (None, day(9), 3, 2, True), (None, day(9), 1, 1, False)]
    counts = spark.createDataFrame(rows, "vendor_code string, actual_delivery_date date, lines long, otif_lines long, new boolean")
    found = kpis.touched_windows(counts, 3)
    assert "Broadcast" not in found._jdf.queryExecution().toString()
    want = {}
    for v in ("A", None):
        for first in (d - dt.timedelta(days=b) for w, d, *_, new in rows for b in range(3) if w == v and new):
            inside = [r for r in rows if r[0] == v and first <= r[1] < first + dt.timedelta(days=3)]
            want[v, first] = (sum(r[2] for r in inside), sum(r[3] for r in inside))
    assert {(r.vendor_code, r.first_day): (r.lines, r.otif_lines) for r in found.collect()} == want
