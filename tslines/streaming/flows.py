"""Streaming forms: payload flow, batch cutting, burst alerts, deduplication.

State is kept per key. A key's rows of one micro-batch meet in one task, so
the source's rate limit (`maxFilesPerTrigger`, `maxBytesPerTrigger`,
`maxOffsetsPerTrigger`) bounds what a busy key can bring at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tslines.operators.batch import STATE_FIELDS, Limits, State, _bounds, walk_key
from tslines.sources import payloads


def run(df: DataFrame, to_batches: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
        *, key: tuple[str, ...] = (), order: list[str], interval: str | None = None,
        max_bytes: int = payloads.DEFAULT_MAX_BYTES):
    """Start a flow that writes each micro-batch as one commit of payloads.

    `to_batches` turns plain rows into lines with `batch_id`. A replayed
    micro-batch replaces its own commit. Without `interval` all available rows
    are processed and the query ends.
    """

    def flush(rows: DataFrame, number: int) -> None:
        # batching looks at key sizes first; the source is still read once
        kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            out = payloads.payloads(to_batches(kept), *key, order=order, limit=max_bytes)
            payloads.write(out, path, number)
        finally:
            kept.unpersist()

    writer = df.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


class _Cutter(StatefulProcessor):
    """Walks the batch kernel over a key's rows; the open batch is the state."""

    def __init__(self, limits, order, time, size):
        self.lim, self.order, self.time, self.size = _bounds(limits), order, time, size
        self.schema = T.StructType.fromDDL(
            "id bigint, rows bigint, bytes bigint, last bigint, txn string, seen bigint, "
            "started boolean")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("open", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(self.order)
        state = State(*self.state.get()) if self.state.exists() else State()
        zero = pd.Series(0, index=pdf.index)
        t = (pdf[self.time] if self.time else zero).to_numpy("int64")
        nb = (pdf[self.size] if self.size else zero).to_numpy("int64")
        pdf["batch_id"] = walk_key(t, nb, None, self.lim, state)
        self.state.update(tuple(getattr(state, f) for f in STATE_FIELDS))
        yield pdf

    def close(self) -> None:
        pass


def assign(df: DataFrame, limits: Limits, *, key: list[str], order: list[str],
           time: str | None = None, size: str | None = None) -> DataFrame:
    """`batch.assign` for a stream whose rows arrive in `order` within a key."""
    out = T.StructType(df.schema.fields + [T.StructField("batch_id", T.LongType())])
    return df.groupBy(*key).transformWithStateInPandas(
        _Cutter(limits, order, time, size), out, "append", "none")


class _Alerter(StatefulProcessor):
    """Keeps the instants of the trailing window and the last alert."""

    def __init__(self, keys, ts, window_us, threshold, quiet_us):
        self.keys, self.ts = keys, ts
        self.window, self.threshold, self.quiet = window_us, threshold, quiet_us
        self.schema = T.StructType.fromDDL("at array<bigint>, n array<bigint>, last bigint")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("recent", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows)).groupby(self.ts).size().sort_index()
        at, n, last = [], [], None
        if self.state.exists():
            old = self.state.get()
            at, n, last = list(old[0]), list(old[1]), old[2]
        found, head, total = [], 0, sum(n)
        for now, count in fresh.items():
            at.append(int(now))
            n.append(int(count))
            total += int(count)
            while at[head] < now - self.window:
                total -= n[head]
                head += 1
            if total >= self.threshold and (last is None or now - last > self.quiet):
                last = int(now)
                found.append((*key, last, int(count), total))
        self.state.update((at[head:], n[head:], last))
        yield pd.DataFrame(found, columns=[*self.keys, self.ts, "n_events", "n_recent"])

    def close(self) -> None:
        pass


def alerts(df: DataFrame, keys: list[str], ts: str, window_us: int, threshold: int,
           quiet_us: int) -> DataFrame:
    """`bursts.alerts` for a stream whose instants do not go back within a key."""
    fields = [df.schema[k] for k in keys] + T.StructType.fromDDL(
        f"`{ts}` bigint, n_events bigint, n_recent bigint").fields
    return df.groupBy(*keys).transformWithStateInPandas(
        _Alerter(keys, ts, window_us, threshold, quiet_us), T.StructType(fields), "append", "none")


def dedup(df: DataFrame, keys: list[str], at: str, delay: str = "10 minutes") -> DataFrame:
    """Drop re-sent rows within the watermark; `at` must be a timestamp.

    The first arrival stays (`land.dedup` with `keep="first"`); rows without an
    instant are never dropped.
    """
    known = df.filter(F.col(at).isNotNull()).withWatermark(at, delay)
    return known.dropDuplicatesWithinWatermark([*keys, at]).unionByName(df.filter(F.col(at).isNull()))
