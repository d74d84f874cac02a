"""Lines from large message files, cut by many tasks.

A line of version 2 or 3 may hold any byte, so a byte that looks like a line end is
one only if no binary cell, quote or escape covers it, which depends on all that
stands before in the line. Spark's reader hands out each split of a file as the
segments between such bytes. Where a split's first line begins is not known to its
task, but every place after a line-end byte can be tried:

1. Every task follows the lines from all places in the head of its split together.
   Chains that meet go on as one, so what is left at the end of the split is a few
   places (as a rule one) where a last line begins that goes on in the next split.
2. These tails are joined with the heads of the splits that follow, which tells
   where each such line ends, that is, where the next split may be entered.
3. If a split can be entered at several places, its task says for each of them
   where it is left. The driver, which has a few numbers per split, then follows
   the one chain from the start of each file.
4. Every task cuts its split from its entry on; the lines across splits are those
   of step 2 on the chain.

A split is read in windows, so a task holds a window and its longest line. A line
that is longer than a head makes heads twice as large, for all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines import session
from tslines.functions import lines

#: Bytes at the start of a split in which its first line must begin.
HEAD = 1 << 18
_LINES = "split int, start bigint, line binary"


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What stands between line-end bytes, with the split it belongs to, in order."""
    rows = session.configure(spark).read.option("lineSep", "\n").text(path)
    place = rows.metadataColumn("_metadata")
    return rows.select(place["file_path"].alias("file"), place["file_block_start"].alias("block"),
                       F.col("value").cast("binary").alias("segment"))


def _runs(batches):
    """(file, block, bytes) of consecutive segments of one split, line ends put back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block").to_numpy()
        name = np.unique(np.asarray(file.dictionary_encode().indices))
        change = np.flatnonzero(np.diff(block)) + 1
        if len(name) > 1:
            code = np.asarray(file.dictionary_encode().indices)
            change = np.union1d(change, np.flatnonzero(np.diff(code)) + 1)
        cuts = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.column("segment").slice(a, b - a).cast(pa.large_binary())
            ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + b - a + 1]
            data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
            yield file[a].as_py(), int(block[a]), np.insert(data, ends[1:] - ends[0], 10)


class Walk:
    """Lines of a split from some places on, window by window.

    `live` are the places at which lines begin that are not finished yet; `emit`
    gets the starts and bytes of the finished lines of the only chain.
    """

    def __init__(self, live=None, emit=None, window: int = lines.BLOCK, head: int = HEAD):
        self.live, self.emit, self.window, self.head = live, emit, window, head
        self.base, self.size, self.want = 0, 0, max(window, head)
        self.parts: list[np.ndarray] = []
        self.held = 0

    def feed(self, data: np.ndarray) -> None:
        self.parts.append(data)
        self.held += len(data)
        self.size += len(data)
        while self.held > self.want:
            before = self.held
            self._window()
            self.want = self.window if self.held < before else 2 * self.want

    def _window(self) -> None:
        data = np.concatenate(self.parts)
        at = lines.candidates(data)
        if self.live is None:
            near = at[at < self.head] if self.base == 0 else at[:0]
            self.live = np.concatenate(([0], near[near < len(data)]))
        start = np.unique(np.concatenate((at[at < len(data)], self.live[self.live >= self.base] - self.base)))
        end, short = lines.line_ends(data, start)
        following = np.where(short, len(start), np.searchsorted(start, end + 1))
        ahead = self.live[self.live >= self.base + len(data)]
        first = np.searchsorted(start, self.live[self.live < self.base + len(data)] - self.base)
        on = lines.chain(first, start, following)
        if self.emit:
            done = np.flatnonzero(on & ~short)
            if len(done):
                self.emit(self.base + start[done], lines.slices(data, start[done], end[done]))
        open_ = self.base + start[on & short]
        # a chain that ends exactly with the window goes on with the byte after it
        if (on & ~short & (end + 1 == len(data))).any():
            open_ = np.append(open_, self.base + len(data))
        self.live = np.union1d(open_, ahead)
        drop = int(self.live.min() - self.base) if len(self.live) else len(data)
        drop = min(drop, len(data))
        self.parts, self.held, self.base = [data[drop:]], len(data) - drop, self.base + drop

    def close(self) -> list[tuple[int, bytes]]:
        """The unfinished lines: place and bytes so far; a place at the very end has none."""
        if self.held or self.live is None:
            self._window()
        data = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint8)
        return [(int(p), data[int(p) - self.base:].tobytes()) for p in self.live]


def _walked(batches, make):
    """Feed every split of a task to a walk of its own: (file, block, walk, first bytes)."""
    now = None
    for file, block, data in _runs(batches):
        if now is None or now[:2] != (file, block):
            if now is not None:
                yield now
            now = (file, block, make(file, block))
        if now[2] is not None:
            now[2].feed(data)
    if now is not None:
        yield now


def _survey(head: int, window: int):
    """Per split: its size, its first bytes, and the lines left open from any place in its head."""
    class First(Walk):
        def __init__(self, file, block):
            super().__init__(window=window, head=head)
            self.first = b""

        def feed(self, data):
            if len(self.first) < head:
                self.first += data[:head - len(self.first)].tobytes()
            super().feed(data)

    def run(batches):
        for file, block, walk in _walked(batches, First):
            tails = walk.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block]), pa.array([walk.size]), pa.array([walk.first], pa.binary()),
                 pa.array([[{"place": p, "tail": t} for p, t in tails]],
                          pa.list_(pa.struct([("place", pa.int64()), ("tail", pa.binary())])))],
                names=["file", "block", "size", "first", "tails"])
    return run


_SURVEY = "file string, block bigint, size bigint, first binary, tails array<struct<place:bigint,tail:binary>>"


def _crossing(batches):
    """How far a tail and what follows it make a line; null if more bytes are needed."""
    for batch in batches:
        rows = []
        for split, place, tail, look, whole in zip(*(c.to_pylist() for c in batch.columns)):
            data = np.frombuffer(tail + b"".join(look), np.uint8)
            end, short = lines.line_ends(data, np.zeros(1, np.int64)) if len(data) else ([0], [True])
            if short[0] and not whole:
                rows.append((split, place, None, None))
            elif short[0]:
                # nothing follows in this file; the last byte is the line end put back
                rows.append((split, place, len(data) - len(tail), data[:-1].tobytes()))
            else:
                rows.append((split, place, int(end[0]) + 1 - len(tail), data[:int(end[0])].tobytes()))
        cols = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.binary())], names=["split", "start", "beyond", "line"])


def _exits(entries, window: int):
    """(split, entry, place): where the last open line of a split begins, by entry."""
    def run(batches):
        def make(file, block):
            return [Walk(np.array([e]), window=window) for e in entries.value[file, block][1]]

        rows = []
        now = None
        for file, block, data in _runs(batches):
            if now is None or now[:2] != (file, block):
                now = (file, block, make(file, block))
                rows += [(entries.value[file, block][0], e, w) for e, w in
                         zip(entries.value[file, block][1], now[2])]
            for walk in now[2]:
                walk.feed(data)
        found = [(s, e, w.close()[0][0]) for s, e, w in rows]
        cols = list(zip(*found)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                         names=["split", "entry", "place"])
    return run


def _cut(entries, window: int):
    """The lines of every split from its entry on, but for the one it leaves open."""
    def run(batches):
        out: list[pa.RecordBatch] = []

        def make(file, block):
            split, entry = entries.value[file, block]
            if entry is None:
                return None

            def emit(start, found):
                out.append(pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(start), split, np.int32)), pa.array(start.astype(np.int64)), found],
                    names=["split", "start", "line"]))
            return Walk(np.array([entry]), emit, window)

        now = None
        for file, block, data in _runs(batches):
            if now is None or now[:2] != (file, block):
                if now is not None and now[2] is not None:
                    now[2].close()
                now = (file, block, make(file, block))
            if now[2] is not None:
                now[2].feed(data)
            yield from out
            out.clear()
        if now is not None and now[2] is not None:
            now[2].close()
        yield from out
    return run


def read(spark: SparkSession, path: str, head: int = HEAD, window: int = lines.BLOCK) -> DataFrame:
    """Lines of binary message files: `file`, `at_byte` (its first byte's place) and `line`.

    Files are cut into splits by the session's `spark.sql.files.maxPartitionBytes`,
    which must stay as it is until the result is read. Every line ends with a line
    end; a last one without it counts as well. A malformed line goes up to its first
    line end that is not escaped. No file, or empty ones: no lines.
    """
    segments = _segments(spark, path)
    survey_path = session.scratch(spark, "survey")
    segments.mapInArrow(_survey(head, window), _SURVEY).write.parquet(survey_path)
    survey = spark.read.schema(_SURVEY).parquet(survey_path)
    # a few numbers for each split reach the driver, no bytes
    found = sorted(survey.select("file", "block", "size", F.transform("tails", lambda t: t["place"]).alias("open")
                                 ).collect())
    if not found:
        return spark.createDataFrame([], "file string, at_byte bigint, line binary")
    base, last_of_file = [], []
    for i, r in enumerate(found):
        base.append(base[-1] + found[i - 1]["size"] if i and found[i - 1]["file"] == r["file"] else 0)
        last_of_file.append(i + 1 == len(found) or found[i + 1]["file"] != r["file"])
    number = {(r["file"], r["block"]): i for i, r in enumerate(found)}

    follow = []
    for i, r in enumerate(found):
        seen, k = 0, i
        while not last_of_file[k] and seen < head:
            k += 1
            seen += found[k]["size"]
            follow.append((i, k))
            if found[k]["size"] > head:
                break
        follow += [(i, -1)] if last_of_file[k] and (k == i or found[k]["size"] <= head) else []
    known = spark.createDataFrame([(i, f, b) for (f, b), i in number.items()], "split int, file string, block bigint")
    named = survey.join(F.broadcast(known), ["file", "block"]).drop("file", "block")
    pairs = spark.createDataFrame(follow, "split int, next int")
    look = (pairs.join(named.select(F.col("split").alias("next"), "first"), "next", "left")
            .groupBy("split").agg(
                F.transform(F.array_sort(F.collect_list(F.when(F.col("next") >= 0, F.struct("next", "first")))),
                            lambda x: x["first"]).alias("look"),
                F.min("next").alias("least")))
    tails = named.select("split", F.explode("tails").alias("t")).select("split", "t.*")
    crossing_path = session.scratch(spark, "crossing")
    schema = "split int, start bigint, beyond bigint, line binary"
    (tails.join(look, "split", "left")
     .select("split", "place", "tail", F.coalesce("look", F.array().cast("array<binary>")).alias("look"),
             (F.coalesce("least", F.lit(-1)) < 0).alias("whole"))
     .mapInArrow(_crossing, schema).write.parquet(crossing_path))
    crossing = spark.read.schema(schema).parquet(crossing_path)
    links = {}
    for r in crossing.select("split", "start", "beyond").collect():
        if r["beyond"] is None:
            return read(spark, path, 2 * head, window)
        # the byte after the line, counted from the end of its split
        k, rest = r["split"] + 1, r["beyond"]
        while k < len(found) and not last_of_file[k - 1] and rest >= found[k]["size"]:
            rest -= found[k]["size"]
            k += 1
        links[r["split"], r["start"]] = (k, rest) if k < len(found) and not last_of_file[k - 1] else None

    entries: dict[int, set] = {i: set() for i in range(len(found))}
    for i in range(len(found)):
        if base[i] == 0 and (not i or last_of_file[i - 1]):
            entries[i].add(0)
    for to in links.values():
        if to:
            entries[to[0]].add(to[1])
    exits = {(i, e): found[i]["open"][0] for i, es in entries.items() for e in es if len(found[i]["open"]) == 1}
    several = {i: sorted(es) for i, es in entries.items() if es and len(found[i]["open"]) > 1}
    if several:
        shared = spark.sparkContext.broadcast(
            {key: (i, several.get(i, [])) for key, i in number.items()})
        for r in segments.mapInArrow(_exits(shared, window), "split int, entry bigint, place bigint").collect():
            exits[r["split"], r["entry"]] = r["place"]

    entry: list[int | None] = [None] * len(found)
    crossed = []
    for i in range(len(found)):
        if base[i] or (i and not last_of_file[i - 1]):
            continue
        now = (i, 0)
        while now:
            entry[now[0]] = now[1]
            left = exits[now]
            crossed.append((now[0], left))
            now = links[now[0], left]
    shared = spark.sparkContext.broadcast({key: (i, entry[i]) for key, i in number.items()})
    inside = segments.mapInArrow(_cut(shared, window), _LINES)
    across = crossing.join(F.broadcast(spark.createDataFrame(crossed, "split int, start bigint")),
                           ["split", "start"]).select("split", "start", "line")
    # a split that ends with a line leaves nothing open
    across = across.where((F.octet_length("line") > 0))
    names = spark.createDataFrame([(i, r["file"], base[i]) for i, r in enumerate(found)],
                                  "split int, file string, base bigint")
    return (inside.unionByName(across).join(F.broadcast(names), "split")
            .select("file", (F.col("base") + F.col("start")).alias("at_byte"), "line"))


def write(payloads: DataFrame, path: str, column: str = "payload") -> None:
    """Payloads as message files, their bytes as they are; each one ends with a line end."""
    body = F.col(column)
    if payloads.schema[column].dataType.simpleString() == "binary":
        # the last byte is the line end that the writer puts there
        body = F.expr(f"cast(substring({column}, 1, octet_length({column}) - 1) as string)")
    else:
        body = F.expr(f"substring({column}, 1, length({column}) - 1)")
    payloads.select(body.alias("value")).write.mode("errorifexists").option("lineSep", "\n").text(path)
