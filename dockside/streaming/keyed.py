"""Sequences over a stream with keyed state.

Rows wait in their key's state until the watermark has passed them, and are then walked in order, one after the other, by an
event-time timer: rows may arrive in any order within the watermark's delay, and a key's rows never meet in one frame.  What
is kept of the past is a few numbers per key; a cooldown forgets its key once the period is over.  Rows older than the
watermark are dropped by Spark: where they may come, ``carried`` runs their keys again.

A stream can start from what the batch operators know: ``initial`` has one row of state per key.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dockside.config import SlaConfig

#: The watermark's delay: how far rows may be out of order.
DELAY = "3 days"
STREAK_LABELS = ("SINGLE FAILURE", "2 CONSECUTIVE FAILURES", "3 CONSECUTIVE FAILURES", "4+ CONSECUTIVE FAILURES")


#: Rows of a key that are gathered before its state is written.
_GATHER = 20_000
#: Rows of a key that wait in one value of state; more are held by spans of time.
_FEW = 5_000


class _InOrder(StatefulProcessor):
    """Holds rows and hands them on, in order, once the watermark is past them.

    A key has one timer for the earliest row that waits.  Its rows are one value of state while they are few, and lie by
    spans of time, each read as a whole, once they are not: calls of the state store are as many as keys, or spans of keys
    with many rows, not as rows.
    """

    #: Fields of a waiting row, and of the state that is carried.
    waiting: str
    carried: str
    #: Milliseconds whose rows are one value of state.
    span: int

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.carried)
        self.few = handle.getValueState("few", f"rows array<struct<{self.waiting}>>, spans boolean")
        self.rows = handle.getMapState("waiting", "span long", f"rows array<struct<{self.waiting}>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new, first, many = [], None, False
        for row in rows:
            at = row.micros // 1000
            first = at if first is None else min(first, at)
            new.append(self.held(row))
            if len(new) == _GATHER:
                self._hold(new)
                new, many = [], True
        if first is not None:
            few, spans = self._waiting()
            few = [*few, *new]
            if len(few) > _FEW:
                self._hold(few)
                few, many = [], True
            self.few.update((few, spans or many))
            self.handle.registerTimer(first + 1)  # after the last row of this millisecond
        return iter([])

    def _waiting(self) -> tuple[list[tuple], bool]:
        """The few rows that wait in one value, and whether others lie by spans."""
        found = self.few.get()
        return ([tuple(x) for x in found[0]], found[1]) if found else ([], False)

    def _held(self, span: int) -> list[tuple]:
        return [tuple(x) for x in self.rows.getValue((span,))[0]]

    def _hold(self, rows: list[tuple]) -> None:
        gathered: dict[int, list[tuple]] = defaultdict(list)
        for row in rows:
            gathered[row[0] // 1000 // self.span].append(row)
        for span, new in gathered.items():
            if self.rows.containsKey((span,)):
                new = [*self._held(span), *new]
            self.rows.updateValue((span,), (new,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Walks all rows before the watermark; the next timer is for the first that stays."""
        now = timerValues.getCurrentWatermarkInMs()
        few, spans = self._waiting()
        if spans:
            self._hold(few)
            yield from self._walk_spans(key, now)
        elif few:
            due = sorted(x for x in few if x[0] // 1000 < now)
            stay = [x for x in few if x[0] // 1000 >= now]
            if due and stay:
                self.few.update((stay, False))
            elif due:
                self.none_wait()
            if due:
                yield from self.walk(key, due)
            if stay:
                self.handle.registerTimer(min(x[0] for x in stay) // 1000 + 1)
        self.quiet(now)

    def _walk_spans(self, key, now: int) -> Iterator[Row]:
        left = False
        for span in sorted(k[0] for k in self.rows.keys()):
            if span * self.span >= now:
                self.handle.registerTimer(span * self.span + 1)
                left = True
                break
            held = self._held(span)
            due = sorted(x for x in held if x[0] // 1000 < now)
            stay = [x for x in held if x[0] // 1000 >= now]
            if due and stay:
                self.rows.updateValue((span,), (stay,))
            elif due:
                self.rows.removeKey((span,))
            if due:
                yield from self.walk(key, due)
            if stay:
                self.handle.registerTimer(min(x[0] for x in stay) // 1000 + 1)
                left = True
                break
        if left:
            self.few.update(([], True))
        else:
            self.none_wait()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.start(initialState)

    def close(self) -> None:
        pass

    def none_wait(self) -> None:
        """No row of the key waits any more."""
        self.few.clear()

    def quiet(self, now: int) -> None:
        """After the rows before a time."""


class Streaks(_InOrder):
    """A vendor's lines in order: rank, and for a failure the label of its streak."""

    waiting = "micros long, shipment_number string, line_number int, is_otif int"
    carried = "open_run long, seen long"
    span = 32 * 86_400_000

    def held(self, row: Row) -> tuple:
        return row.micros, row.shipment_number, row.line_number, row.is_otif

    def start(self, row: Row) -> None:
        self.state.update((row.open_run, row.seen))

    def none_wait(self) -> None:
        """A vendor is kept for good."""
        self.few.update(([], False))

    def walk(self, key, found: list[tuple]) -> Iterator[Row]:
        run, seen = self.state.get() or (0, 0)
        for micros, shipment, line, good in found:
            seen += 1
            run = 0 if good else run + 1
            if run:
                yield Row(vendor_code=key[0], micros=micros, shipment_number=shipment, line_number=line,
                          delivery_rank=seen, failure_streak_label=STREAK_LABELS[min(run, 4) - 1])
        self.state.update((run, seen))


class Cooldown(_InOrder):
    """Alerts of a type and entity in order; one that follows another within the type's period is held back."""

    waiting = "micros long, alert_id long, severity string"
    carried = "fired_at long, over long"
    span = 86_400_000

    def __init__(self, hours: float, by_type: dict[str, float]):
        self.hours, self.by_type = hours, by_type

    def _period(self, kind: str) -> int:
        return int(self.by_type.get(kind, self.hours) * 3_600_000_000)

    def held(self, row: Row) -> tuple:
        return row.micros, row.alert_id, row.severity

    def _fired(self, at: int, kind: str) -> None:
        over = at + self._period(kind)
        self.state.update((at, over))
        self.handle.registerTimer(-(-over // 1000))

    def start(self, row: Row) -> None:
        self._fired(row.fired_at, row.alert_type)

    def walk(self, key, found: list[tuple]) -> Iterator[Row]:
        before = self.state.get()[0] if self.state.exists() else None
        fired, period = before, self._period(key[0])
        for micros, alert, severity in found:
            if fired is None or micros >= fired + period:
                fired = micros
                yield Row(alert_id=alert, alert_type=key[0], entity=key[1], severity=severity)
        if fired != before:
            self._fired(fired, key[0])

    def quiet(self, now: int) -> None:
        """Once the period is over the last alert doesn't matter."""
        if self.state.exists() and self.state.get()[1] <= now * 1000:
            self.state.clear()


class Repeats(_InOrder):
    """Alerts of an entity that are at least the n-th inside the window that ends with them; n - 1 times are carried."""

    waiting = "micros long, alert_id long, alert_type string, severity string"
    carried = "recent array<long>"
    span = 86_400_000

    def __init__(self, n: int, hours: float):
        self.n, self.window = n, int(hours * 3_600_000_000)

    def held(self, row: Row) -> tuple:
        return row.micros, row.alert_id, row.alert_type, row.severity

    def start(self, row: Row) -> None:
        self._keep(list(row.recent))

    def _keep(self, recent: list[int]) -> None:
        self.state.update((recent,))
        self.handle.registerTimer(-(-(recent[-1] + self.window) // 1000) + 1)

    def walk(self, key, found: list[tuple]) -> Iterator[Row]:
        recent = list(self.state.get()[0]) if self.state.exists() else []
        for micros, alert, kind, severity in found:
            if self.n <= 1 or len(recent) == self.n - 1 and recent[0] >= micros - self.window:
                yield Row(alert_id=alert, alert_type=kind, entity=key[0], severity=severity, micros=micros)
            recent = [*recent, micros][-max(self.n - 1, 1):]
        self._keep(recent)

    def quiet(self, now: int) -> None:
        """A day after the last alert none of them matters."""
        if self.state.exists() and self.state.get()[0][-1] + self.window < now * 1000:
            self.state.clear()


def failure_streaks(lines: DataFrame, *, delay: str = DELAY, initial: DataFrame | None = None) -> DataFrame:
    """Labelled failures of a stream of flagged lines; ``initial`` has vendor_code, open_run and seen."""
    ts = F.col("actual_delivery_date").cast("timestamp")
    timed = lines.select(
        "vendor_code", "shipment_number", F.col("line_number").cast("int").alias("line_number"), F.col("is_otif").cast("int").alias("is_otif"),
        ts.alias("ts"), F.unix_micros(ts).alias("micros"),
    ).withWatermark("ts", delay)
    found = timed.groupBy("vendor_code").transformWithState(
        Streaks(), "vendor_code string, micros long, shipment_number string, line_number int, delivery_rank long, failure_streak_label string",
        "Append", "EventTime", initial.groupBy("vendor_code") if initial is not None else None,
    )
    return found.withColumn("actual_delivery_date", F.timestamp_micros("micros").cast("date")).drop("micros")


def throttled(alerts: DataFrame, cfg: SlaConfig = SlaConfig(), *, delay: str = DELAY, initial: DataFrame | None = None) -> DataFrame:
    """Alerts of a stream that fire; ``initial`` has alert_type, entity and fired_at in microseconds."""
    ts = F.col("ts").cast("timestamp")
    timed = alerts.select("alert_id", "alert_type", "entity", "severity", ts.alias("ts"), F.unix_micros(ts).alias("micros")).withWatermark("ts", delay)
    processor = Cooldown(cfg.cooldown_hours, {"CONSECUTIVE_FAILURES": cfg.streak_cooldown_hours})
    return timed.groupBy("alert_type", "entity").transformWithState(
        processor, "alert_id long, alert_type string, entity string, severity string",
        "Append", "EventTime", initial.groupBy("alert_type", "entity") if initial is not None else None,
    )


def repeated_critical(alerts: DataFrame, cfg: SlaConfig = SlaConfig(), *, delay: str = DELAY, initial: DataFrame | None = None) -> DataFrame:
    """Critical alerts of a stream that repeat within the window, to the microsecond; ``initial`` has entity and recent."""
    ts = F.col("ts").cast("timestamp")
    critical = alerts.where(F.col("severity") == "CRITICAL").select(
        "alert_id", "alert_type", "entity", "severity", ts.alias("ts"), F.unix_micros(ts).alias("micros")
    ).withWatermark("ts", delay)
    found = critical.groupBy("entity").transformWithState(
        Repeats(cfg.repeat_critical_count, cfg.repeat_window_hours),
        "alert_id long, alert_type string, entity string, severity string, micros long",
        "Append", "EventTime", initial.groupBy("entity") if initial is not None else None,
    )
    return found.withColumn("ts", F.timestamp_micros("micros").cast("timestamp_ntz")).drop("micros")
