"""Cut rows into batches by row count, bytes and elapsed time.

A batch closes after the row that reaches a limit; rows, bytes and the clock
then start again. The cut positions of one key form a chain, each depending on
the previous one. Two plans give the same result:

* no key is large: rows are hashed by key, sorted, and walked in a stream;
* some key is large: rows are range-partitioned on (key, order), so one key
  spreads over many tasks. Each task sums up its piece of a key as a table
  "if a batch ends at row j of my first batch length, my last row leaves this
  open batch". These tables compose, a tree of joins of fixed fan-in
  composes them, and a second pass over the rows starts from the right state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines import session
from tslines.operators.ordered import (
    SPREAD_ABOVE,
    Load,
    global_index,
    measure,
    partitions_for,
    range_sorted,
)

DEFAULT_ROWS = 75_000
DEFAULT_INTERVAL_MS = 1_000
DEFAULT_MAX_BYTES = 100 * 1024 * 1024
NEVER = np.iinfo(np.int64).max // 4


@dataclass(frozen=True)
class Limits:
    """Thresholds; None switches one off. `interval` is in milliseconds."""

    rows: int | None = DEFAULT_ROWS
    bytes: int | None = None
    interval: int | None = DEFAULT_INTERVAL_MS

    def __post_init__(self):
        for name in ("rows", "bytes", "interval"):
            value = getattr(self, name)
            if value is False or value == "off":
                object.__setattr__(self, name, None)
            elif value is not None and (isinstance(value, bool) or not isinstance(value, int)
                                        or value < 1):
                raise ValueError(f"`{name}` must be a positive integer or off, not {value!r}")
        if self.rows is None and self.bytes is None and self.interval is None:
            raise ValueError("at least one of rows, bytes and interval must be on")


OFF = (NEVER, NEVER, NEVER)


def _bounds(limits: Limits) -> tuple[int, int, int]:
    return (limits.rows or NEVER, limits.bytes or NEVER,
            limits.interval * 1000 if limits.interval else NEVER)


@dataclass
class State:
    """The open batch of one key: number, rows, bytes, clock, transaction, time of last row."""

    id: int = 0
    rows: int = 0
    bytes: int = 0
    last: int = 0
    txn: str | None = None
    seen: int = 0
    started: bool = False


STATE_FIELDS = ("id", "rows", "bytes", "last", "txn", "seen", "started")


def _walk(t, nb, lim, state: State) -> np.ndarray:
    """Batch numbers of rows under one set of limits; `state` moves on."""
    n, (max_rows, max_bytes, gap) = len(t), lim
    total = np.concatenate([[0], np.cumsum(nb)])
    ids, pos = np.empty(n, dtype=np.int64), 0
    while pos < n:
        cut = pos + max_rows - state.rows - 1
        if max_bytes != NEVER:
            need = total[pos] + max_bytes - state.bytes
            cut = min(cut, max(int(np.searchsorted(total, need)) - 1, pos))
        if gap != NEVER:
            cut = min(cut, max(int(np.searchsorted(t, state.last + gap)), pos))
        if cut >= n:
            ids[pos:] = state.id
            state.rows += n - pos
            state.bytes += int(total[n] - total[pos])
            break
        ids[pos:cut + 1] = state.id
        state.id, state.rows, state.bytes, state.last = state.id + 1, 0, 0, int(t[cut])
        pos = cut + 1
    state.seen = int(t[-1])
    return ids


def _close(state: State, txn, now: int) -> None:
    """A change of transaction ends the open batch and restarts the clock."""
    if state.rows:
        state.id += 1
    state.rows = state.bytes = 0
    state.last = state.seen if txn is None else now
    state.txn = txn


def _pieces(txn) -> list[tuple[int, int, str | None]]:
    """(start, end, transaction) of maximal runs."""
    if len(txn) == 0:
        return []
    change = [0, *[i for i in range(1, len(txn)) if txn[i] != txn[i - 1]], len(txn)]
    return [(a, b, txn[a]) for a, b in zip(change, change[1:])]


def walk_key(t, nb, txn, lim, state: State) -> np.ndarray:
    """Batch numbers of the next rows of one key."""
    if not state.started:
        state.started, state.last = True, int(t[0])
        state.txn = txn[0] if txn is not None else None
        state.seen = int(t[0])
    if txn is None:
        return _walk(t, nb, lim, state)
    out = []
    for a, b, value in _pieces(txn):
        if value != state.txn:
            _close(state, value, int(t[a]))
        out.append(_walk(t[a:b], nb[a:b], lim if value is None else OFF, state))
    return np.concatenate(out)


class Summary:
    """What one piece of a key does to the open batch that enters it.

    `head_*` describe the rows up to the first cut that any entering batch is
    sure to reach; `exit_*` the open batch at the end when a batch ends at that
    row. `fixed` is the exit when no head row cuts but a transaction boundary
    does. Without either, the entering batch just grows by `n` and `size`.
    """

    ARRAYS = ("head_bytes", "head_time", "exit_id", "exit_rows", "exit_bytes", "exit_last")
    SCALARS = ("n", "size", "first", "seen", "complete", "fixed_id", "fixed_rows",
               "fixed_bytes", "fixed_last", "has_fixed", "locked")
    TEXTS = ("txn_in", "txn_out")

    @classmethod
    def of(cls, t, nb, txn, lim) -> Summary:
        s = cls()
        s.first, s.seen, s.has_fixed = int(t[0]), int(t[-1]), False
        s.fixed_id = s.fixed_rows = s.fixed_bytes = s.fixed_last = 0
        s.txn_in = s.txn_out = None
        lead, runs = len(t), None
        if txn is not None:
            runs = _pieces(txn)
            s.txn_in, s.txn_out, lead = runs[0][2], runs[-1][2], runs[0][1]
        s.locked = s.txn_in is not None
        s._lead(t[:lead], nb[:lead], OFF if s.locked else lim)
        s.n, s.size = len(t), int(np.sum(nb))
        if lead < len(t):
            state = State(rows=0, seen=int(t[lead - 1]), txn=s.txn_in, started=True)
            walk_key(t[lead:], nb[lead:], txn[lead:], lim, state)
            s._then_fixed(state.id, state.rows, state.bytes, state.last)
            s.complete = True
        return s

    def _lead(self, t, nb, lim):
        n, (max_rows, max_bytes, gap) = len(t), lim
        total = np.concatenate([[0], np.cumsum(nb)]).astype(np.int64)
        # the latest possible first cut: an empty batch whose clock started at row 0
        sure = max_rows - 1
        sure = min(sure, int(np.searchsorted(total, max_bytes)) - 1) if max_bytes != NEVER else sure
        sure = min(sure, int(np.searchsorted(t, t[0] + gap))) if gap != NEVER else sure
        self.complete = sure < n
        head = min(sure + 1, n) if lim != OFF else 0
        starts = np.arange(n + 1)
        after = starts + min(max_rows, n + 1)
        if max_bytes != NEVER:
            after = np.minimum(after, np.maximum(
                np.searchsorted(total, total + max_bytes), starts + 1))
        if gap != NEVER:
            clock = np.concatenate([[t[0]], t]) + gap
            after = np.minimum(after, np.maximum(np.searchsorted(t, clock) + 1, starts + 1))
        # follow the chain of batch starts to the last one, doubling the step
        jump = np.where(after > n, starts, after)
        count = (jump != starts).astype(np.int64)
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            count, jump = count + count[jump], further
        end = jump[1:head + 1]
        self.head_bytes, self.head_time = total[1:head + 1], np.asarray(t[:head], dtype=np.int64)
        self.exit_id, self.exit_rows = count[1:head + 1] + 1, n - end
        self.exit_bytes = total[n] - total[end]
        self.exit_last = np.asarray(t, dtype=np.int64)[end - 1] if head else np.zeros(0, np.int64)

    def _then_fixed(self, id_, rows, bytes_, last):
        """All paths end in one known batch: a transaction boundary follows."""
        self.exit_id = self.exit_id + (self.exit_rows > 0) + id_
        shape = np.ones_like(self.exit_id)
        self.exit_rows, self.exit_bytes, self.exit_last = rows * shape, bytes_ * shape, last * shape
        self.has_fixed, self.fixed_id = True, id_ + 1
        self.fixed_rows, self.fixed_bytes, self.fixed_last = rows, bytes_, last

    def enter(self, id_, rows, bytes_, last, seen, txn, lim):
        """Exit batches for arrays of entering batches."""
        if txn != self.txn_in:
            id_, rows = id_ + (rows > 0), rows * 0
            bytes_, last = bytes_ * 0, last * 0 + (seen if self.txn_in is None else self.first)
        length = len(self.head_time)
        at = np.full(len(rows), NEVER)
        if not self.locked:
            max_rows, max_bytes, gap = lim
            at = max_rows - rows - 1
            if max_bytes != NEVER:
                at = np.minimum(at, np.searchsorted(self.head_bytes, max_bytes - bytes_))
            if gap != NEVER:
                at = np.minimum(at, np.searchsorted(self.head_time, last + gap))
        hit = at < length
        pick = np.where(hit, at, 0)
        take = lambda a: a[pick] if length else np.zeros(len(rows), dtype=np.int64)
        if self.has_fixed:
            miss = (id_ + self.fixed_id, self.fixed_rows, self.fixed_bytes, self.fixed_last)
        else:
            miss = (id_, rows + self.n, bytes_ + self.size, last)
        return (np.where(hit, id_ + take(self.exit_id), miss[0]),
                np.where(hit, take(self.exit_rows), miss[1]),
                np.where(hit, take(self.exit_bytes), miss[2]),
                np.where(hit, take(self.exit_last), miss[3]))

    def then(self, other: Summary, lim) -> Summary:
        """The summary of this piece followed by `other`."""
        out = Summary()
        out.n, out.size = self.n + other.n, self.size + other.size
        out.first, out.seen = self.first, other.seen
        out.txn_in, out.txn_out, out.locked = self.txn_in, other.txn_out, self.locked
        exits = other.enter(self.exit_id, self.exit_rows, self.exit_bytes, self.exit_last,
                            self.seen, self.txn_out, lim)
        out.head_bytes, out.head_time = self.head_bytes, self.head_time
        out.has_fixed, out.complete = self.has_fixed, self.complete
        out.fixed_id = out.fixed_rows = out.fixed_bytes = out.fixed_last = 0
        one = lambda v: np.array([v], dtype=np.int64)
        if self.has_fixed:
            fixed = other.enter(one(self.fixed_id), one(self.fixed_rows), one(self.fixed_bytes),
                                one(self.fixed_last), self.seen, self.txn_out, lim)
        elif self.txn_out != other.txn_in:
            # the boundary between the two ends whatever batch comes through
            fixed = other.enter(one(1), one(0), one(0), one(self.seen), self.seen,
                                self.txn_out, lim)
            out.has_fixed = out.complete = True
        elif not self.complete:
            if not self.locked:
                out.head_bytes = np.concatenate([self.head_bytes, self.size + other.head_bytes])
                out.head_time = np.concatenate([self.head_time, other.head_time])
                mine = (other.exit_id, other.exit_rows, other.exit_bytes, other.exit_last)
                exits = tuple(np.concatenate(p) for p in zip(exits, mine))
            out.complete, out.has_fixed = other.complete, other.has_fixed
            fixed = ((one(other.fixed_id), one(other.fixed_rows), one(other.fixed_bytes),
                      one(other.fixed_last)) if other.has_fixed else None)
        else:
            fixed = None
        if fixed is not None:
            out.fixed_id, out.fixed_rows, out.fixed_bytes, out.fixed_last = (
                int(f[0]) for f in fixed)
        out.exit_id, out.exit_rows, out.exit_bytes, out.exit_last = exits
        return out

    def row(self) -> dict:
        out = {k: getattr(self, k).tolist() for k in self.ARRAYS}
        out |= {k: int(getattr(self, k)) for k in self.SCALARS}
        return out | {k: getattr(self, k) for k in self.TEXTS}

    @classmethod
    def read(cls, table: pa.Table, i: int) -> Summary:
        s = cls()
        for k in cls.ARRAYS:
            setattr(s, k, np.asarray(table[k][i].values, dtype=np.int64))
        for k in cls.SCALARS + cls.TEXTS:
            setattr(s, k, table[k][i].as_py())
        return s


_SUMMARY_DDL = ", ".join(
    [f"{k} array<bigint>" for k in Summary.ARRAYS]
    + [f"{k} bigint" for k in Summary.SCALARS] + [f"{k} string" for k in Summary.TEXTS])
_ENTRY_DDL = "in_id bigint, in_rows bigint, in_bytes bigint, in_last bigint, " \
             "in_seen bigint, in_txn string, in_started boolean"


def _codes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Positions where a new key starts, plus the end."""
    n = batch.num_rows
    change = np.zeros(n, dtype=bool)
    change[:1] = True
    for k in keys:
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
        change[1:] |= codes[1:] != codes[:-1]
    return np.append(np.flatnonzero(change), n)


def _key_at(batch, keys, i):
    return tuple(batch.column(k)[i].as_py() for k in keys)


def _column(batch, name):
    """A BIGINT column as numbers; zeros when the column is not needed."""
    if name is None:
        return np.zeros(batch.num_rows, dtype=np.int64)
    if batch.column(name).null_count:
        raise ValueError(f"column {name!r} must not be null in rows that are cut into batches")
    return batch.column(name).to_numpy(zero_copy_only=False)


@dataclass(frozen=True)
class _Columns:
    """Names of the columns the kernel reads; None where it needs none."""

    time: str | None
    size: str | None
    txn: str | None


def _cutter(keys, lim, cols, entry, schema, flags=False):
    """The row pass: appends `batch_id`. `entry` maps partition numbers to states.

    With `flags`, also `closes` (the row reached a limit) and `opens` (the
    first row of its key).
    """

    def go(batches):
        key, state, first = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _codes(batch, keys)
            t, nb = _column(batch, cols.time), _column(batch, cols.size)
            ids = np.zeros(batch.num_rows, dtype=np.int64)
            closes, opens = np.zeros((2, batch.num_rows), dtype=bool)
            if flags:
                opens[starts[:-1]] = True
            busy = np.ones(len(starts) - 1, dtype=bool)
            if not cols.txn:
                # keys that begin and end here and stay below all limits are batch 0
                lo, hi = starts[:-1], starts[1:]
                busy = ((hi - lo >= lim[0]) | (np.add.reduceat(nb, lo) >= lim[1])
                        | (t[hi - 1] - t[lo] >= lim[2]))
                busy[0] = busy[-1] = True
            for i in np.flatnonzero(busy):
                lo, hi = starts[i], starts[i + 1]
                here = _key_at(batch, keys, lo)
                if first or here != key:
                    state = State()
                    if first and entry:
                        found = entry.get(batch.column("_pid")[0].as_py())
                        state = State(*found) if found else state
                    key, first = here, False
                opens[lo] = flags and not state.started
                txn = batch.column(cols.txn).slice(lo, hi - lo).to_pylist() if cols.txn else None
                ids[lo:hi] = walk_key(t[lo:hi], nb[lo:hi], txn, lim, state)
                closes[lo:hi - 1] = ids[lo + 1:hi] != ids[lo:hi - 1]
                closes[hi - 1] = state.rows == 0
            out = [batch.column(c) for c in schema] + [pa.array(ids)]
            names = [*schema, "batch_id"]
            if flags:
                out, names = out + [pa.array(closes), pa.array(opens)], names + ["closes", "opens"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return go


def _summarizer(keys, lim, cols, schema):
    """The first pass: summaries of the first and last key of each partition."""

    def go(batches):
        runs = []  # [key, times, sizes, transactions] of the first and the latest key
        pid = None
        for batch in batches:
            if not batch.num_rows:
                continue
            pid = batch.column("_pid")[0].as_py()
            starts = _codes(batch, keys)
            t, nb = _column(batch, cols.time), _column(batch, cols.size)
            last = len(starts) - 2
            for i in sorted({0, last}):
                lo, hi = starts[i], starts[i + 1]
                key = _key_at(batch, keys, lo)
                if not runs or runs[-1][0] != key or (i == last and last > 0):
                    # the first run stays, the latest one replaces any other
                    runs = runs[:1] + [[key, [], [], []]]
                runs[-1][1].append(t[lo:hi].copy())
                runs[-1][2].append(nb[lo:hi].copy())
                if cols.txn:
                    runs[-1][3] += batch.column(cols.txn).slice(lo, hi - lo).to_pylist()
        rows = []
        for i, (key, t, nb, txn) in enumerate(runs):
            s = Summary.of(np.concatenate(t), np.concatenate(nb), txn if cols.txn else None, lim)
            rows.append({**dict(zip(keys, key)), "seg": pid, "leads": i == 0, **s.row()})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return go


def _arrow_schema(ddl_schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(ddl_schema)


def _compose(keys, lim, schema):
    def go(table: pa.Table) -> pa.Table:
        table = table.sort_by("seg")
        parts = [Summary.read(table, i) for i in range(table.num_rows)]
        out = parts[0]
        for p in parts[1:]:
            out = out.then(p, lim)
        head = {k: table[k][0].as_py() for k in keys}
        row = {**head, "seg": table["up"][0].as_py(), "leads": True, **out.row()}
        return pa.Table.from_pylist([row], schema=schema)

    return go


def _descend(keys, lim, schema):
    """Entering state of each piece from the state that enters their group."""

    def go(table: pa.Table) -> pa.Table:
        table = table.sort_by("seg")
        rows = []
        state = State()
        if "in_started" in table.column_names:
            state = State(*(table[f"in_{k}"][0].as_py() for k in STATE_FIELDS))
        for i in range(table.num_rows):
            s = Summary.read(table, i)
            rows.append({**{k: table[k][i].as_py() for k in keys}, "seg": table["seg"][i].as_py(),
                         "leads": table["leads"][i].as_py(),
                         **{f"in_{k}": getattr(state, k) for k in STATE_FIELDS}})
            if not state.started:
                state = State(last=s.first, seen=s.first, txn=s.txn_in, started=True)
            one = [np.array([v], dtype=np.int64)
                   for v in (state.id, state.rows, state.bytes, state.last)]
            out = s.enter(*one, state.seen, state.txn, lim)
            state = State(*(int(v[0]) for v in out), s.txn_out, s.seen, True)
        return pa.Table.from_pylist(rows, schema=schema)

    return go


def _entries(summaries: DataFrame, keys, lim, key_fields, partitions, fan_in) -> DataFrame:
    """State that enters each (key, partition) piece, by a tree of fan-in `fan_in`."""
    ddl = T.StructType(key_fields + T.StructType.fromDDL(
        f"seg int, leads boolean, {_SUMMARY_DDL}").fields)
    entry = T.StructType(key_fields + T.StructType.fromDDL(
        f"seg int, leads boolean, {_ENTRY_DDL}").fields)
    up = F.floor(F.col("seg") / fan_in).cast("int")
    levels, width = [summaries], partitions
    while width > fan_in:
        nodes = levels[-1].withColumn("up", up)
        levels.append(session.checkpoint(nodes.groupBy(*keys, "up").applyInArrow(
            _compose(keys, lim, _arrow_schema(ddl)), ddl)))
        width = -(-width // fan_in)
    states = levels[-1].groupBy(*keys).applyInArrow(
        _descend(keys, lim, _arrow_schema(entry)), entry)
    for nodes in reversed(levels[:-1]):
        above = states.select(*keys, F.col("seg").alias("up"),
                              *[c for c in states.columns if c.startswith("in_")])
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"a.{k}")) for k in (*keys, "up")]
        joined = (nodes.withColumn("up", up).alias("n").join(above.alias("a"), on=same)
                  .select("n.*", *[f"a.{c}" for c in above.columns if c.startswith("in_")]))
        states = joined.groupBy(*keys, "up").applyInArrow(
            _descend(keys, lim, _arrow_schema(entry)), entry)
    return states


def assign(df: DataFrame, limits: Limits, *, order: list[str], key: list[str] | None = None,
           time: str | None = None, size: str | None = None, txn: str | None = None,
           **plan) -> DataFrame:
    """`df` with `batch_id`, counted from 0 within each key.

    Rows are taken in `order` within `key` (no key: the whole table is one
    sequence). `time` is the BIGINT microsecond column of the clock and must
    lead `order` when the interval is on; `size` holds bytes per row. Inside a
    transaction (`txn` not null) limits do not apply and its boundaries close
    the batch. `order` must name rows of a key uniquely.

    `plan` options: a key with more than `spread_above` rows, or no key at all,
    takes the spread plan, with `partitions` tasks and a tree of `fan_in`;
    `load` is an earlier `measure`.
    """
    if limits.interval and time is None:
        raise ValueError("an interval needs a `time` column")
    if limits.interval and order[0] != time:
        raise ValueError("with an interval, `order` must start with the `time` column")
    if limits.bytes and size is None:
        raise ValueError("a byte limit needs a `size` column")
    # The clock also restarts at transaction boundaries, but only matters with an interval.
    return cut(df, _bounds(limits), order=order, keys=list(key or []),
               time=time if limits.interval else None, size=size if limits.bytes else None,
               txn=txn, **plan)


def _typed(df: DataFrame, name: str | None, dtype: str, alias: str):
    """(frame, column name) with the column in `dtype`; no copy when it already is."""
    if name is None or df.schema[name].dataType.simpleString() == dtype:
        return df, name
    return df.withColumn(alias, F.col(name).cast(dtype)), alias


def cut(df: DataFrame, lim: tuple[int, int, int], *, order: list[str], keys: list[str],
        time: str | None = None, size: str | None = None, txn: str | None = None,
        spread_above: int = SPREAD_ABOVE, partitions: int | None = None, fan_in: int = 16,
        load: Load | None = None, flags: bool = False) -> DataFrame:
    """`assign` with raw bounds: rows, bytes and microseconds."""
    spark, columns = df.sparkSession, df.columns
    work, time = _typed(df, time, "bigint", "_t")
    work, size = _typed(work, size, "bigint", "_nb")
    work, txn = _typed(work, txn, "string", "_txn")
    cols = _Columns(time, size, txn)
    added = "batch_id bigint" + (", closes boolean, opens boolean" if flags else "")
    out = T.StructType(df.schema.fields + T.StructType.fromDDL(added).fields)

    load = load or measure(df, keys)
    if not load.spread(keys, spread_above):
        near = work.repartition(*keys).sortWithinPartitions(*keys, *order)
        return near.mapInArrow(_cutter(keys, lim, cols, None, columns, flags), out)

    partitions = partitions or partitions_for(load.rows, spark)
    ranged = range_sorted(work, keys, order, partitions)
    key_fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name in keys]
    ddl = T.StructType(key_fields + T.StructType.fromDDL(
        f"seg int, leads boolean, {_SUMMARY_DDL}").fields)
    narrow = ranged.select(*dict.fromkeys(
        [*keys, "_pid", *[c for c in (time, size, txn) if c]]))
    summaries = session.checkpoint(narrow.mapInArrow(
        _summarizer(keys, lim, cols, _arrow_schema(ddl)), ddl))
    states = _entries(summaries, keys, lim, key_fields, partitions, fan_in)
    # one small state per partition
    entry = {r["seg"]: tuple(r[f"in_{k}"] for k in STATE_FIELDS)
             for r in states.filter("leads").drop(*keys).collect()}
    return ranged.mapInArrow(_cutter(keys, lim, cols, entry, columns, flags), out)


def by_rows(df: DataFrame, n: int, *, order: list[str]) -> DataFrame:
    """Batches of `n` rows over the total order of the whole table."""
    Limits(rows=n, bytes=None, interval=None)
    at = global_index(df, order, "_idx")
    return at.withColumn("batch_id", F.call_function("div", F.col("_idx"), F.lit(n))).drop("_idx")


def ledger(df: DataFrame, *key: str, size: str = "n_bytes", at: str | None = None,
           table: str | None = None) -> DataFrame:
    """Per batch: rows, bytes, first and last instant, and whether it holds one table only."""
    aggs = [F.count("*").alias("n_rows"), F.sum(size).alias("n_bytes")]
    if at:
        aggs += [F.min(at).alias("first_at"), F.max(at).alias("last_at")]
    if table:
        aggs.append((F.min(table) == F.max(table)).alias("one_table"))
    return df.groupBy(*key, "batch_id").agg(*aggs)


def check_max(df: DataFrame, *key: str, size: str = "n_bytes",
              limit: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Batches that are too large to be sent."""
    return ledger(df, *key, size=size).filter(F.col("n_bytes") > limit)


def transactional(df: DataFrame, *key: str, table: str = "tbl",
                  size: str = "n_bytes") -> DataFrame:
    """Batches that mix tables and so cannot be one transaction."""
    return ledger(df, *key, size=size, table=table).filter(~F.col("one_table"))
