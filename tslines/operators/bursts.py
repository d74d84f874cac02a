"""Bursts of events and concurrent sessions.

All instants are BIGINT microseconds. Rows of one key at one instant are first
combined map-side; after that no task holds more than a time slice of a key.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines import session
from tslines.operators.batch import NEVER, _codes, _key_at, cut
from tslines.operators.ordered import (
    SPREAD_ABOVE,
    measure,
    partitions_for,
    range_sorted,
    running,
)

DEFAULT_WINDOW_US = 5_000_000
DEFAULT_THRESHOLD = 25
DEFAULT_QUIET_US = 600_000_000
#: Rounds in which range partitions may settle their open sessions, and sessions one may report.
ROUNDS = 6
MOST_OPEN = 256


def instants(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """`keys`, `ts`, `n_events`: one row per key and instant."""
    return df.groupBy(*keys, ts).agg(F.count("*").alias("n_events"))


def counts(df: DataFrame, keys: list[str], ts: str, window_us: int = DEFAULT_WINDOW_US,
           slice_windows: int = 8) -> DataFrame:
    """Events of the key in the trailing window, both ends included, per instant.

    The key's time line is cut into slices of `slice_windows` windows; the last
    window of a slice is copied into the next one, so a slice is complete on
    its own and a busy key spreads over many tasks. An instant counts from its
    own time and leaves after the window, so a running sum over both says what
    is in the window, however many instants that are.
    """
    width = window_us * slice_windows
    own = F.call_function("div", F.col(ts), F.lit(width))
    spills = F.call_function("div", F.col(ts) + window_us, F.lit(width))
    line = instants(df, keys, ts).withColumn("_own", own)
    line = line.withColumn("_slice", F.explode(F.array_distinct(F.array("_own", spills))))
    edges = line.withColumn("_e", F.explode(F.array(
        F.struct(F.col(ts).alias("at"), F.col("n_events").alias("n"), F.lit(True).alias("comes")),
        F.struct((F.col(ts) + window_us + 1).alias("at"), (-F.col("n_events")).alias("n"),
                 F.lit(False).alias("comes")))))
    so_far = Window.partitionBy(*keys, "_slice").orderBy("_e.at").rangeBetween(Window.unboundedPreceding, 0)
    return (edges.withColumn("n_recent", F.sum("_e.n").over(so_far))
            .filter(F.col("_e.comes") & (F.col("_slice") == F.col("_own"))).drop("_own", "_slice", "_e"))


def alerts(df: DataFrame, keys: list[str], ts: str, window_us: int = DEFAULT_WINDOW_US,
           threshold: int = DEFAULT_THRESHOLD, quiet_us: int = DEFAULT_QUIET_US,
           **plan) -> DataFrame:
    """Instants at which a key reaches the threshold and was quiet for longer than `quiet_us`.

    After an alert the next one needs `now - last > quiet_us`: the same chain
    as batches cut by elapsed time, so it runs on the batch plans.
    """
    # the rows themselves bound the load, so the windows are not made twice
    plan.setdefault("load", measure(df, keys))
    busy = counts(df, keys, ts, window_us).filter(F.col("n_recent") >= threshold)
    flagged = cut(busy, (NEVER, NEVER, quiet_us + 1), order=[ts], keys=keys, time=ts,
                  flags=True, **plan)
    return flagged.filter(F.col("opens") | F.col("closes")).drop("closes", "opens", "batch_id")


def sessions(df: DataFrame, keys: list[str], ts: str, gap_us: int,
             slice_us: int | None = None, spread_above: int = SPREAD_ABOVE) -> DataFrame:
    """`keys`, `start_us`, `end_us`, `n_events`: runs of events at most `gap_us` apart.

    A session ends `gap_us` after its last event.
    """
    plan = dict(width=slice_us or 64 * gap_us, load=measure(df, keys), spread_above=spread_above)
    line = running(instants(df, keys, ts), keys, ts, F.col(ts), "max", "_prev", exclusive=True,
                   **plan)
    begins = F.col("_prev").isNull() | (F.col(ts) - F.col("_prev") > gap_us)
    line = running(line, keys, ts, F.when(begins, F.col(ts)), "max", "start_us", **plan)
    return line.groupBy(*keys, "start_us").agg(
        (F.max(ts) + gap_us).alias("end_us"), F.sum("n_events").alias("n_events"))


def concurrency(df: DataFrame, keys: list[str], start: str, end: str,
                slice_us: int = 3_600_000_000, spread_above: int = SPREAD_ABOVE) -> DataFrame:
    """`keys`, `at_us`, `n_open`: open sessions after each change."""
    edges = df.select(*keys, F.explode(F.array(
        F.struct(F.col(start).alias("at_us"), F.lit(1).cast("bigint").alias("d")),
        F.struct(F.col(end).alias("at_us"), F.lit(-1).cast("bigint").alias("d")))).alias("e"))
    net = edges.groupBy(*keys, F.col("e.at_us").alias("at_us")).agg(F.sum("e.d").alias("d"))
    return running(net, keys, "at_us", F.col("d"), "sum", "n_open", slice_us,
                   spread_above=spread_above).drop("d")


class _Slots:
    """Open sessions and free slots; a session ending when another starts frees its slot first."""

    def __init__(self, open_=()):
        self.open = [tuple(o) for o in open_]
        heapq.heapify(self.open)
        taken = {s for _, s in self.open}
        self.next = max(taken, default=-1) + 1
        self.free = [s for s in range(self.next) if s not in taken]
        heapq.heapify(self.free)

    def take(self, start: int, end: int) -> int:
        while self.open and self.open[0][0] <= start:
            heapq.heappush(self.free, heapq.heappop(self.open)[1])
        if self.free:
            slot = heapq.heappop(self.free)
        else:
            slot, self.next = self.next, self.next + 1
        heapq.heappush(self.open, (end, slot))
        return slot


def _slot_pass(keys, entry, columns, states_only):
    """Assign slots along sorted rows, or only report the open sessions at the end."""

    def go(batches):
        key, slots, first, pid = None, None, True, None
        first_key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bounds = _codes(batch, keys)
            start, end = (batch.column(c).to_numpy() for c in ("_start", "_end"))
            out = np.empty(batch.num_rows, dtype=np.int64)
            for lo, hi in zip(bounds, bounds[1:]):
                here = _key_at(batch, keys, lo)
                if first or here != key:
                    if first:
                        first_key = here
                        pid = batch.column("_pid")[0].as_py() if "_pid" in batch.schema.names else 0
                    slots = _Slots((entry or {}).get(pid, ()) if first else ())
                    key, first = here, False
                for i in range(lo, hi):
                    out[i] = slots.take(int(start[i]), int(end[i]))
            if not states_only:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in columns] + [pa.array(out)], [*columns, "slot"])
        if states_only and key is not None:
            found = [{"end": e, "slot": s} for e, s in sorted(slots.open[:MOST_OPEN + 1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), pa.array([repr(first_key)]), pa.array([repr(key)]),
                 pa.array([found if len(found) <= MOST_OPEN else None],
                          pa.list_(pa.struct([("end", pa.int64()), ("slot", pa.int64())])))],
                ["pid", "first", "last", "open"])

    return go


def slots(df: DataFrame, keys: list[str], start: str, end: str, *order: str,
          spread_above: int = SPREAD_ABOVE, slice_us: int = 3_600_000_000,
          partitions: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """`df` with the lowest `slot` that is free when the session starts, per key.

    A key is walked in a stream whose state is the open sessions. A key with
    more than `spread_above` rows is first split at moments without an open
    session into busy periods, which do not depend on each other. When one
    period is still larger, rows are range-partitioned instead: all partitions
    run at once from a guessed set of open sessions, and those whose guess
    differs from what the partition before them really leaves are run again
    until none differs. If that takes more than `rounds` rounds, or a partition
    ends with more than MOST_OPEN sessions, every period is streamed by one task
    after all, so neither jobs nor the driver's share grow with the partitions.
    A row without a start has no slot; one without an end never frees its own.
    """
    spark, columns = df.sparkSession, df.columns
    out = T.StructType(df.schema.fields + [T.StructField("slot", T.LongType())])
    never = F.lit(2**63 - 1)
    work = df.filter(F.col(start).isNotNull()).withColumns(
        {"_start": F.col(start), "_end": F.coalesce(F.col(end), never)})
    absent = df.filter(F.col(start).isNull()).withColumn("slot", F.lit(None).cast("bigint"))
    load = measure(df, keys)
    if not load.spread(keys, spread_above):
        near = work.repartition(*keys).sortWithinPartitions(*keys, "_start", *order)
        return near.mapInArrow(_slot_pass(keys, None, columns, False), out).unionByName(absent)

    plan = dict(width=slice_us, load=load, spread_above=spread_above)
    line = running(work, keys, "_start", F.col("_end"), "max", "_busy_until", exclusive=True,
                   **plan)
    begins = F.col("_busy_until").isNull() | (F.col("_busy_until") <= F.col("_start"))
    line = running(line, keys, "_start", F.when(begins, F.col("_start")), "max", "_period",
                   **plan).drop("_busy_until")
    line = session.checkpoint(line)
    period = [*keys, "_period"]
    sizes = line.groupBy(*period).count().agg(F.max("count"), F.sum("count")).first()

    def streamed():
        near = line.repartition(*period).sortWithinPartitions(*period, "_start", *order)
        return near.mapInArrow(_slot_pass(period, None, columns, False), out).unionByName(absent)

    if (sizes[0] or 0) <= spread_above:
        return streamed()
    width = partitions or partitions_for(sizes[1], spark)
    ranged = range_sorted(line, period, ["_start", *order], width)
    narrow = ranged.select(*period, "_start", "_end", "_pid")
    ends, entry, pending = {}, {}, None
    for _ in range(rounds):
        todo = narrow if pending is None else narrow.filter(F.col("_pid").isin(pending))
        for r in todo.mapInArrow(
                _slot_pass(period, entry, columns, True),
                "pid int, first string, last string, open array<struct<end:bigint,slot:bigint>>"
        ).collect():
            if r["open"] is None:
                return streamed()
            ends[r["pid"]] = (r["first"], r["last"], [(o["end"], o["slot"]) for o in r["open"]])
        pids, wanted = sorted(ends), {}
        for before, here in zip(pids, pids[1:]):
            if ends[before][1] == ends[here][0]:
                wanted[here] = ends[before][2]
        pending = [p for p in pids if wanted.get(p, []) != entry.get(p, [])]
        if not pending:
            done = ranged.mapInArrow(_slot_pass(period, entry, columns, False), out)
            return done.unionByName(absent)
        entry = wanted
    return streamed()
