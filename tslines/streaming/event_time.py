"""Stateful streams whose rows may come in any order of time, within a watermark.

A key's rows wait in a list until the watermark has passed them; a timer at the
earliest of them wakes the key. They are then worked on in order of time, which is
what the batch forms do, and no row that is accepted later can come before them.
What a key remembers beyond that has a time after which it cannot matter any more;
a second timer drops it then, so state does not grow with the keys that ever were.
Timers follow the watermark, not the clock: a query over what is available ends.

Rows that are later than the watermark allows are dropped by Spark and counted in
the query's progress. The last rows of an input wait until newer ones move the
watermark past them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tslines.functions import times
from tslines.operators.bursts import DEFAULT_QUIET_US, DEFAULT_THRESHOLD, DEFAULT_WINDOW_US, _Slots

NEVER_ENDS = 2**63 - 1
#: Columns beside the caller's; names with a leading underscore do not reach a stateful processor.
INSTANT, END = "tslines_us", "tslines_end_us"


class _InOrder(StatefulProcessor):
    """Rows of a key as tuples whose first cell is the instant in microseconds, sorted as a whole."""

    #: Cells of a waiting row, and of what the key remembers.
    row: T.StructType
    memory: T.StructType

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.row)
        self.known = handle.getValueState("known", self.memory)

    def work(self, key, rows: list[tuple], known: tuple | None):
        """(result frame, what to remember, until when)"""
        raise NotImplementedError

    def _wake(self, us: int, fired: int | None = None) -> None:
        """A timer at `us`, unless an earlier one, not the one that has just fired, will see to it."""
        at = -(-us // 1000)
        if at < min((t for t in self.handle.listTimers() if t != fired), default=at + 1):
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:  # one Arrow batch at a time
            if len(part):
                cells = list(zip(*(part[c].tolist() for c in self.row.names)))
                self.waiting.appendList(cells)
                first = min([c[0] for c in cells] + ([] if first is None else [first]))
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, fired = timerValues.getCurrentWatermarkInMs() * 1000, expiredTimerInfo.getExpiryTimeInMs()
        rows = sorted(tuple(r) for r in self.waiting.get())
        ready = [r for r in rows if r[0] <= now]
        rest = rows[len(ready):]
        if rest:
            self.waiting.put(rest)
            self._wake(rest[0][0], fired)
        else:
            self.waiting.clear()
        known = tuple(self.known.get()) if self.known.exists() else None
        out, known, until = self.work(key, ready, known)
        if until is None or until <= now:
            self.known.clear()
        else:
            self.known.update(known)
            if not rest and until < NEVER_ENDS:
                self._wake(until, fired)
        if len(out):
            yield out

    def close(self) -> None:
        pass


class _Alerter(_InOrder):
    row = T.StructType([T.StructField(INSTANT, T.LongType())])
    memory = T.StructType([T.StructField("at", T.ArrayType(T.LongType())),
                           T.StructField("n", T.ArrayType(T.LongType())), T.StructField("last", T.LongType())])

    def __init__(self, columns, window_us, threshold, quiet_us):
        self.columns = columns
        self.window, self.threshold, self.quiet = window_us, threshold, quiet_us

    def work(self, key, rows, known):
        at, n, last = (list(known[0]), list(known[1]), known[2]) if known else ([], [], None)
        fresh: dict[int, int] = {}
        for (us,) in rows:
            fresh[us] = fresh.get(us, 0) + 1
        found, head, total = [], 0, sum(n)
        for now, count in fresh.items():
            at.append(now)
            n.append(count)
            total += count
            while at[head] < now - self.window:
                total -= n[head]
                head += 1
            if total >= self.threshold and (last is None or now - last > self.quiet):
                last = now
                found.append((*key, now, count, total))
        until = at[-1] + self.window if at else None
        if last is not None:
            until = max(until or 0, last + self.quiet)
        return pd.DataFrame(found, columns=self.columns), (at[head:], n[head:], last), until


def alerts(df: DataFrame, keys: list[str], at: str, delay: str, window_us: int = DEFAULT_WINDOW_US,
           threshold: int = DEFAULT_THRESHOLD, quiet_us: int = DEFAULT_QUIET_US) -> DataFrame:
    """`bursts.alerts` of a stream: `keys`, `at_us`, `n_events`, `n_recent`.

    `at` is a timestamp column, rows may be `delay` late. Rows without an instant
    raise no alert.
    """
    columns = [*keys, "at_us", "n_events", "n_recent"]
    out = T.StructType([df.schema[k] for k in keys] + [T.StructField(c, T.LongType()) for c in columns[len(keys):]])
    rows = df.filter(F.col(at).isNotNull()).withColumn(INSTANT, times.micros(F.col(at))).select(*keys, at, INSTANT)
    return rows.withWatermark(at, delay).groupBy(*keys).transformWithStateInPandas(
        _Alerter(columns, window_us, threshold, quiet_us), out, "append", "EventTime")


class _Assigner(_InOrder):
    memory = T.StructType([T.StructField("ends", T.ArrayType(T.LongType())),
                           T.StructField("slots", T.ArrayType(T.LongType()))])

    def __init__(self, row, columns):
        self.row, self.columns = row, columns

    def work(self, key, rows, known):
        slots = _Slots(zip(*known) if known else ())
        end = self.row.names.index(END)
        found = [(*key, *r, slots.take(r[0], r[end])) for r in rows]
        ends = sorted(slots.open)
        return (pd.DataFrame(found, columns=self.columns), ([e for e, _ in ends], [s for _, s in ends]),
                ends[-1][0] if ends else None)


def slots(df: DataFrame, keys: list[str], start: str, end: str, *order: str, delay: str) -> DataFrame:
    """`bursts.slots` of a stream of sessions: `keys`, `order`, `start_us`, `end_us`, `slot`.

    `start` and `end` are timestamps; a session may come up to `delay` after newer
    ones. One without an end keeps its slot for good, one without a start has none
    and is left out. `order` breaks ties of starts; its columns must not be null.
    """
    rows = df.filter(F.col(start).isNotNull()).select(
        *keys, *order, start, times.micros(F.col(start)).alias(INSTANT),
        F.coalesce(times.micros(F.col(end)), F.lit(NEVER_ENDS)).alias(END))
    row = T.StructType([rows.schema[INSTANT], *[rows.schema[c] for c in order], rows.schema[END]])
    columns = [*keys, "start_us", *order, END, "slot"]
    out = T.StructType([*[rows.schema[k] for k in keys], T.StructField("start_us", T.LongType()),
                        *[rows.schema[c] for c in order], T.StructField(END, T.LongType()),
                        T.StructField("slot", T.LongType())])
    found = rows.withWatermark(start, delay).groupBy(*keys).transformWithStateInPandas(
        _Assigner(row, columns), out, "append", "EventTime")
    return found.select(*keys, *order, "start_us", F.nullif(END, F.lit(NEVER_ENDS)).alias("end_us"), "slot")
