"""Keyed state and change logs against the batch operators, with rows out of order and late."""

import datetime as dt

from pyspark.sql import Row

from dockside.operators import routing
from dockside.streaming import changes, keyed, runner

T0 = dt.datetime(2024, 3, 1, 10)
ALERT = "alert_id long, alert_type string, entity string, severity string, ts timestamp"


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def alerts(spark, rows):
    return spark.createDataFrame([(i, kind, who, "CRITICAL", minutes(m)) for i, kind, who, m in rows], ALERT)


def test_streaks_wait_for_earlier_rows_and_start_from_what_is_known(spark):
    schema = "vendor_code string, actual_delivery_date date, shipment_number string, line_number int, is_otif int"
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    parts = [
        [("V1", day(2), "S3", 1, 0), ("V1", day(1), "S2", 2, 0), ("V2", day(1), "S9", 1, 0)],
        [("V1", day(1), "S2", 1, 0), ("V1", day(3), "S4", 1, 1), ("V1", day(4), "S5", 1, 0)],
        [("~", day(60), "", 1, 1)],
    ]
    before = spark.createDataFrame([("V1", 2, 5)], "vendor_code string, open_run long, seen long")
    frames = [spark.createDataFrame(p, schema) for p in parts]
    out = runner.replay_parts(frames, lambda s: keyed.failure_streaks(s, initial=before), "streaks")
    rows = sorted((r.vendor_code, r.delivery_rank, r.shipment_number, r.line_number, r.failure_streak_label) for r in out.collect())
    assert rows == [
        ("V1", 6, "S2", 1, "3 CONSECUTIVE FAILURES"), ("V1", 7, "S2", 2, "4+ CONSECUTIVE FAILURES"),
        ("V1", 8, "S3", 1, "4+ CONSECUTIVE FAILURES"), ("V1", 10, "S5", 1, "SINGLE FAILURE"), ("V2", 1, "S9", 1, "SINGLE FAILURE"),
    ]


def test_cooldown_counts_from_the_last_that_fired(spark):
    rows = [(1, "A", "x", 0), (2, "A", "x", 300), (3, "A", "x", 360), (4, "A", "x", 700), (5, "CONSECUTIVE_FAILURES", "x", 0),
            (6, "CONSECUTIVE_FAILURES", "x", 61), (7, "A", "y", 100), (8, "A", "x", 0)]
    late = [r for r in rows if r[0] in (1, 3)]
    parts = [alerts(spark, [r for r in rows if r not in late]), alerts(spark, late), alerts(spark, [(99, "~", "~", 60 * 24 * 30)])]
    known = spark.createDataFrame([("A", "y", int((T0.replace(tzinfo=dt.timezone.utc) - dt.timedelta(hours=1)).timestamp() * 1e6))],
                                  "alert_type string, entity string, fired_at long")
    out = runner.replay_parts(parts, lambda s: keyed.throttled(s, initial=known), "cooldown")
    assert sorted(r.alert_id for r in out.collect()) == [1, 3, 5, 6]  # 7 comes within six hours of what is known


def test_late_answers_retract_and_late_alerts_are_added(spark, tmp_path):
    fired = [(1, "A", "x", 0), (2, "A", "x", 200), (3, "A", "y", 14 * 60 - 5), (4, "A", "z", 0), (5, "A", "x", 201)]
    acks = [(1, "x", 20), (2, "y", 14 * 60 + 10), (3, "z", 31), (4, "x", 10)]  # y's lies beyond midnight, z's a minute too late
    a = {i: alerts(spark, [r]) for r in fired for i in [r[0]]}
    k = {i: spark.createDataFrame([(i, who, minutes(m))], "ack_id long, entity string, ack_ts timestamp") for i, who, m in acks}
    none_a, none_k = alerts(spark, []), k[1].where("false")
    steps = [
        changes.events(a[1].unionByName(a[2]).unionByName(a[4]), none_k),
        changes.events(none_a, k[1].unionByName(k[2]).unionByName(k[3])),
        changes.events(a[3].unionByName(a[5]), k[4]),
    ]
    act = changes.escalation_action(str(tmp_path))
    for n, step in enumerate(steps):
        for _ in range(2):  # a batch that runs again changes nothing more
            act(step, n)
    log = changes.escalation_log(spark, str(tmp_path))
    assert sorted((r.batch, r.change, r.alert_id) for r in log.collect()) == [
        (0, "insert", 1), (0, "insert", 2), (0, "insert", 4), (1, "retract", 1), (2, "insert", 5),
    ]
    every_a, every_k = (list(x.values()) for x in (a, k))
    for x in every_a[1:]:
        every_a[0] = every_a[0].unionByName(x)
    for x in every_k[1:]:
        every_k[0] = every_k[0].unionByName(x)
    want = routing.unacknowledged(every_a[0], every_k[0])
    assert sorted(r.alert_id for r in changes.fold(log).collect()) == sorted(r.alert_id for r in want.collect()) == [2, 4, 5]


def test_state_calls_are_as_many_as_spans_not_rows():
    calls = []

    class Held(dict):
        def getValue(self, k):
            calls.append("get")
            return (self[k],)

        def updateValue(self, k, v):
            calls.append("put")
            self[k] = v[0]

        def containsKey(self, k):
            calls.append("has")
            return k in self

        def removeKey(self, k):
            calls.append("remove")
            del self[k]

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            calls.append("state")
            self.held = v

    class Handle:
        timers = set()

        def getValueState(self, *_):
            return Value()

        def getMapState(self, *_):
            return Held()

        def registerTimer(self, at):
            calls.append("timer")
            self.timers.add(at)

    class At:
        def __init__(self, now):
            self.now = now

        def getCurrentWatermarkInMs(self):
            return self.now

        getExpiryTimeInMs = getCurrentWatermarkInMs

    day, streaks, handle = 86_400_000, keyed.Streaks(), Handle()
    streaks.init(handle)

    def passed(watermark):
        """What expired timers put out, in their order."""
        out = []
        while handle.timers and (at := min(handle.timers)) <= watermark:
            handle.timers.remove(at)
            out += streaks.handleExpiredTimer(("V1",), At(watermark), At(at))
        return [r.delivery_rank for r in out]

    rows = [Row(micros=d * day * 1000, shipment_number=f"S{d}-{n}", line_number=1, is_otif=0) for d in range(20, -1, -1) for n in range(5)]
    assert list(streaks.handleInputRows(("V1",), iter(rows), At(0))) == []
    assert passed(10 * day) == list(range(1, 51))  # the tenth day itself stays
    assert passed(30 * day) == list(range(51, 106)) and not streaks.rows
    assert len(calls) <= 12, calls


def test_rows_of_a_key_with_few_are_one_value_and_many_lie_by_spans(spark, monkeypatch):
    """Over years, a vendor of few lines takes a call or two a batch; where it has many, the result is the same."""
    puts = []
    monkeypatch.setattr(keyed._InOrder, "_hold", lambda self, rows, hold=keyed._InOrder._hold: (puts.append(len(rows)), hold(self, rows))[1])

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, v):
            self.held = v

    class Spans(dict):
        containsKey = dict.__contains__
        removeKey = dict.__delitem__

        def getValue(self, k):
            return (self[k],)

        def updateValue(self, k, v):
            self[k] = v[0]

    class Handle:
        def __init__(self):
            self.timers = set()

        def getValueState(self, *_):
            return Value()

        def getMapState(self, *_):
            return Spans()

        def registerTimer(self, at):
            self.timers.add(at)

    class At:
        def __init__(self, now):
            self.now = now

        def getCurrentWatermarkInMs(self):
            return self.now

    day = 86_400_000

    def walked(few):
        monkeypatch.setattr(keyed, "_FEW", few)
        streaks, handle, out = keyed.Streaks(), Handle(), []
        streaks.init(handle)
        for batch in range(4):
            days = [d for d in range(3000) if min(d // 800 + d % 2, 3) == batch]
            rows = [Row(micros=d * day * 1000, shipment_number=f"S{d}", line_number=1, is_otif=int(d % 5 == 0)) for d in reversed(days)]
            list(streaks.handleInputRows(("V1",), iter(rows), At(0)))
            watermark = batch * 800 * day if batch < 3 else 4000 * day
            while handle.timers and min(handle.timers) <= watermark:
                handle.timers.remove(min(handle.timers))
                out += streaks.handleExpiredTimer(("V1",), At(watermark), None)
        return out

    whole = walked(5000)
    assert not puts and [r.micros // 1000 // day for r in whole] == [d for d in range(3000) if d % 5]
    assert [r.delivery_rank for r in whole] == [d + 1 for d in range(3000) if d % 5]
    assert walked(100) == whole and puts
