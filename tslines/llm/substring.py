"""Repeated passages: windows of words counted by way of super-k-mers.

Each window of SPAN words has a minimiser, the smallest hash of its runs of
MINI words. Consecutive windows with one minimiser travel as one packed string
(their words, joined by one space) to that minimiser's bucket; equal windows
have equal minimisers, so they meet there. In the bucket the windows are sorted
by two hashes of their words, and a window that also starts in a document with a
smaller id marks its words. Hashes only bring windows together: stretches of
windows that are to be marked are compared with the text they repeat, byte by
byte, and where one differs the windows of its hash are told apart by their words.

What keeps buckets even: runs of words that are frequent in the whole corpus
(a table of fixed size counts them first) rank last as minimisers, so common
lines do not gather the text around them. Equal packed strings are brought
together before the shuffle: only the smallest document of each goes on, the
others are decided then and there. So a passage in a third of all documents
sends one string per task to its bucket. A bucket that still is too large for
memory is not kept: its task passes on each window with a cryptographic digest of
its words and its place, and a second shuffle, by the digest, finds the smallest
document of each.

Defined cases: a null or empty text has no words. A document with fewer than
SPAN words has no window and stays whole. Rows without an id have no order:
they stay whole and mark nothing. Rows with equal ids do not mark each other.
Very long texts are read in blocks that overlap by a window.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import common

SPAN = 50
MINI = 5
#: Cells of the table that counts runs of words; fixed, whatever the input.
CELL_BITS = 16
#: A cell with so many times the mean holds a frequent run.
FREQUENT = 8
#: Windows of one packed string at most.
LONGEST = 256
#: Bytes of packed strings that a task holds while it looks for equal ones.
HELD = 24 << 20
#: Bytes of packed strings that are sorted together, at least.
GATHER = 16 << 20
#: Bytes of one bucket that are sorted in memory; windows of a larger one go on by their hash.
BUCKET = 64 << 20
#: Strings of a larger bucket that are taken apart together.
STRINGS = 8_192
#: Marks are broadcast up to this size; beyond, the join shuffles.
BROADCAST_BYTES = 32 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = (common.mix64(np.arange(1, 257, dtype=np.uint64) * _BASE),
          common.mix64(np.arange(301, 557, dtype=np.uint64) * _BASE))
_STEP = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
#: A sum of powers is weak on long words that repeat themselves in patterns; these get a digest.
LONG_WORD = 64


def _powers(step: int, n: int) -> np.ndarray:
    out = np.full(n, step, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Rolling:
    """Polynomial hashes modulo 2**64 of stretches [a, b) of an array of values."""

    def __init__(self, step: int):
        self.step, self.inverse = step, pow(step, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if len(values) > len(self.up):
            n = max(1 << 16, 2 * len(values))
            self.up, self.down = _powers(self.step, n), _powers(self.inverse, n)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=total[1:])
        return common.mix64((total[b] - total[a]) * self.down[a])


_ROLL = tuple(_Rolling(s) for s in _STEP)


def word_hashes(line: bytes, which: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a text with single spaces."""
    data = np.frombuffer(line, np.uint8)
    space = np.flatnonzero(data == 32)
    start, end = np.concatenate(([0], space + 1)), np.concatenate((space, [len(data)]))
    out = _ROLL[which](_BYTES[which][data], start, end)
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        out[i] = np.uint64(_digest(line[start[i]:end[i]])[which])
    return start, end, out


def _digest(data: bytes) -> tuple[int, int]:
    """A 128-bit digest that has no patterns, as two numbers."""
    made = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(made[:8], "little"), int.from_bytes(made[8:], "little")


def _stretches(data: bytes, tail: int):
    """(index of the first word, own words, words of the block and `tail` more)."""
    after = re.compile(rb"[\x20\x09-\x0d]*(?:[^\x20\x09-\x0d]+[\x20\x09-\x0d]*){0,%d}" % tail)
    first = start = 0
    while start < len(data):
        end = min(start + common.BLOCK, len(data))
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        own = len(data[start:end].split())
        yield first, own, data[start:after.match(data, end).end()].split()
        first, start = first + own, end


def _runs(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of MINI words."""
    at = np.arange(len(hashes) - MINI + 1)
    return _ROLL[1](hashes, at, at + MINI)


def super_kmers(text: str | None, frequent: np.ndarray, span: int = SPAN):
    """(minimiser, packed words, first window, windows) of a document."""
    for first, own, words in _stretches(common.text_bytes(text), span - 1):
        n = min(own, len(words) - span + 1)
        if n <= 0:
            continue
        line = b" ".join(words[:n + span - 1])
        start, end, hashes = word_hashes(line)
        runs = _runs(hashes)
        rank = (runs >> np.uint64(1)) | (frequent[runs >> np.uint64(64 - CELL_BITS)] << np.uint64(63))
        width, want, low = 1, span - MINI + 1, rank
        while 2 * width <= want:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:n], low[want - width:want - width + n])
        cut = np.flatnonzero(low[1:] != low[:-1]) + 1
        cut = np.concatenate(([0], cut, [n]))
        if (np.diff(cut) > LONGEST).any():
            cut = np.unique(np.concatenate((cut, *(np.arange(a, b, LONGEST)
                                                   for a, b in zip(cut[:-1], cut[1:])))))
        a, b = cut[:-1], cut[1:]
        for mini, i, j, s, e in zip(low[a].view(np.int64).tolist(), a.tolist(), b.tolist(),
                                    start[a].tolist(), end[b + span - 2].tolist()):
            yield mini, line[s:e], first + i, j - i


def _census(span: int):
    """Per task: how many runs of words fall into each cell."""
    def run(batches):
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, own, words in _stretches(common.text_bytes(text), MINI - 1):
                    if len(words) >= MINI:
                        cells = _runs(word_hashes(b" ".join(words))[2]) >> np.uint64(64 - CELL_BITS)
                        np.add.at(total, cells.astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("i4")), pa.array(total[at])],
                                         names=["cell", "n"])
    return run


def frequent_cells(docs: DataFrame, span: int = SPAN) -> np.ndarray:
    """A bit for each cell of frequent runs; its size is fixed."""
    counts = (docs.select("text").mapInArrow(_census(span), "cell int, n bigint")
              .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(1 << CELL_BITS, np.uint64)
    mean = counts["n"].sum() / (1 << CELL_BITS)
    out[counts["cell"][counts["n"] > FREQUENT * max(mean, 8)]] = 1
    return out


_PACKED = "mini bigint, packed binary, doc_id bigint, tag bigint, first int, n int"
_TYPES = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)],
                                      names=["mini", "packed", "doc_id", "tag", "first", "n"])


def _pack(frequent, span: int):
    """Per task: packed strings; of equal ones the smallest document's, the rest decided.

    A decided row has no string; its bucket only spreads it.
    """
    def run(batches):
        held: dict[bytes, tuple] = {}
        out: list[tuple] = []
        size = 0  # of the strings and what holds them
        for batch in batches:
            for doc, tag, text in zip(*(c.to_pylist() for c in batch.columns)):
                for mini, packed, first, n in super_kmers(text, frequent.value, span):
                    row = (mini, packed, doc, tag, first, n)
                    other = held.get(packed)
                    if other is None:
                        held[packed] = row
                        size += len(packed) + 200
                        if size > HELD:
                            yield from map(_batch, _parts([*held.values(), *out]))
                            held, out, size = {}, [], 0
                        continue
                    if doc == other[2]:
                        out.append(row)
                        continue
                    if doc < other[2]:
                        held[packed], row = row, other
                    out.append((mini ^ hash((row[2], row[4])), None, *row[2:]))
            if len(out) > 50_000:
                yield from map(_batch, _parts(out))
                out = []
        yield from map(_batch, _parts([*held.values(), *out]))
    return run


def _parts(rows: list, size: int = 20_000):
    for i in range(0, len(rows), size):
        yield rows[i:i + size]


def _windows(packed: list[bytes], n: np.ndarray, span: int):
    """For all windows of the strings: string, offset, two hashes, and their bytes in one line."""
    line = b" ".join(packed)
    sides = []
    for which in (0, 1):
        start, end, hashes = word_hashes(line, which)
        if which == 0:
            base = np.cumsum(n + span - 1) - (n + span - 1)
            string = np.repeat(np.arange(len(n)), n)
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = base[string] + offset
        sides.append(_ROLL[which](hashes, at, at + span))
    return string, offset, *sides, line, start[at], end[at + span - 1]


def _earliest(string, h1, h2, least, line: bytes, start, end) -> np.ndarray:
    """Of each window the smallest document of those with its words."""
    doc = least[string]
    order = np.lexsort((doc, h2, h1))
    new = np.concatenate(([True], (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])))
    group = np.cumsum(new) - 1
    number, first = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    number[order], first[order] = group, order[new][group]
    out = doc[first]
    # stretches of windows that repeat a stretch of windows are compared as a whole
    at = np.flatnonzero(doc > out)
    if not len(at):
        return out
    other = first[at]
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(other) != 1) | (np.diff(string[at]) != 0)
                         | (np.diff(string[other]) != 0)) + 1
    head, tail = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1
    differ = []
    for a, b, x, y, i, j in zip(start[at[head]].tolist(), end[at[tail]].tolist(), start[other[head]].tolist(),
                                end[other[tail]].tolist(), head.tolist(), tail.tolist()):
        if line[a:b] != line[x:y]:
            differ.append(at[i:j + 1])
    if differ:
        again = np.flatnonzero(np.isin(number, np.unique(number[np.concatenate(differ)])))
        smallest: dict[bytes, int] = {}
        for i in again.tolist():
            words = line[start[i]:end[i]]
            smallest[words] = min(smallest.get(words, doc[i]), doc[i])
        out[again] = [smallest[line[start[i]:end[i]]] for i in again.tolist()]
    return out


def _late(done: pd.DataFrame, rows: pd.DataFrame, span: int):
    """What equal strings decide, and the rest.

    Marks of decided rows and of strings that a smaller document has as well, the
    other rows with the number of their string, and of each string its text, its
    smallest document and its windows.
    """
    number, strings = pd.factorize(rows["packed"])
    doc = rows["doc_id"].to_numpy()
    least = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(least, number, doc)
    n = np.zeros(len(strings), np.int64)
    n[number] = rows["n"].to_numpy()
    whole = doc > least[number]
    marks = [_ranges(x["doc_id"], x["tag"], x["first"], x["first"] + x["n"] + span - 1)
             for x in (done, rows[whole])]
    return pd.concat(marks), rows[~whole].assign(number=number[~whole]), list(strings), least, n


def _decide(rows: pd.DataFrame, span: int) -> pd.DataFrame:
    """Marked word ranges of whole buckets."""
    done, rows = rows[rows["packed"].isna()], rows[rows["packed"].notna()]
    # a string that is alone in its bucket has nothing to be compared with
    rows = rows[rows["mini"].duplicated(keep=False)]
    marks, rows, strings, least, n = _late(done, rows, span)
    if strings:
        string, offset, *rest = _windows(strings, n, span)
        again = least[string] > _earliest(string, *rest[:2], least, *rest[2:])
        at = np.flatnonzero(again)
        if len(at):
            broken = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(string[at]) > 0)))
            first, last = at[broken], at[np.concatenate((broken[1:], [True]))]
            pieces = pd.DataFrame({"number": string[first], "a": offset[first],
                                   "b": offset[last] + span})
            own = rows.merge(pieces, on="number")
            marks = pd.concat([marks, _ranges(own["doc_id"], own["tag"], own["first"] + own["a"],
                                              own["first"] + own["b"])])
    return marks


def _apart(rows: pd.DataFrame, span: int):
    """Parts of a bucket that is not kept: marks, and undecided windows with their hashes."""
    for i in range(0, len(rows), STRINGS):
        part = rows.iloc[i:i + STRINGS]
        marks, own, strings, _, n = _late(part[part["packed"].isna()], part[part["packed"].notna()], span)
        yield marks
        if strings:
            string, offset, _, _, line, first, last = _windows(strings, n, span)
            made = np.array([_digest(line[x:y]) for x, y in zip(first.tolist(), last.tolist())], np.uint64)
            made = made.view(np.int64)
            own = own.merge(pd.DataFrame({"number": string, "a": offset, "h1": made[:, 0], "h2": made[:, 1]}),
                            on="number")
            start = own["first"] + own["a"]
            yield _ranges(own["doc_id"], own["tag"], start, start + span).assign(
                h1=own["h1"], h2=own["h2"])


def _ranges(doc, tag, start, end) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": doc.astype("int64"), "tag": tag.astype("int64"),
                         "start": start.astype("int64"), "end": end.astype("int64")})


_MARKS = "doc_id bigint, tag bigint, start bigint, end bigint, h1 bigint, h2 bigint"


def _count(span: int, bucket: int):
    """Per task: rows sorted by bucket in, marked ranges and undecided windows out."""
    gather = min(GATHER, bucket)

    def out(found):
        cols = [pa.array(found[c].to_numpy()) if c in found else pa.nulls(len(found), pa.int64())
                for c in ("doc_id", "tag", "start", "end", "h1", "h2")]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "tag", "start", "end", "h1", "h2"])

    def run(batches):
        held, size, large = [], 0, None
        for batch in batches:
            rows = batch.to_pandas()
            if large is not None:
                more = (rows["mini"] == large).to_numpy()
                yield from map(out, _apart(rows[more], span))
                rows = rows[~more]
                if not len(rows):
                    continue
                large = None
            held.append(rows)
            size += batch.nbytes
            if size < gather:
                continue
            rows = pd.concat(held, ignore_index=True)
            open_ = (rows["mini"] == rows["mini"].iloc[-1]).to_numpy()
            if not open_.all():
                yield out(_decide(rows[~open_], span))
                rows = rows[open_]
                size = int(rows["packed"].str.len().sum()) + 64 * len(rows)
            held = [rows]
            if size > bucket:
                yield from map(out, _apart(rows, span))
                held, size, large = [], 0, rows["mini"].iloc[-1]
        if held:
            yield out(_decide(pd.concat(held, ignore_index=True), span))
    return run


def repeats(docs: DataFrame, span: int = SPAN, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, tag, start, end): ranges of words that windows of earlier documents cover.

    `tag` is the xxhash64 of the text. Ranges may overlap.
    """
    rows = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_cells(rows, span))
    found = common.stage(rows.mapInArrow(_pack(frequent, span), _PACKED)
                         .repartition("mini").sortWithinPartitions("mini")
                         .mapInArrow(_count(span, bucket), _MARKS), "marks")
    windows = found.where("h1 is not null")
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("_first"))
    late = windows.join(first, ["h1", "h2"]).where("doc_id > _first")
    return found.where("h1 is null").unionByName(late.drop("_first")).drop("h1", "h2")


def _keep(text: str | None, cuts) -> tuple[int, int, bytes]:
    """Words, removed words, and the rest joined by one space."""
    words = common.text_bytes(text).split()
    if cuts is None or not len(cuts):
        return len(words), 0, b" ".join(words)
    keep = np.ones(len(words), bool)
    for a, b in zip(cuts[::2], cuts[1::2]):
        keep[a:b] = False
    left = [words[i] for i in np.flatnonzero(keep).tolist()]
    return len(words), len(words) - len(left), b" ".join(left)


def without_repeats(docs: DataFrame, span: int = SPAN, texts: bool = True,
                    bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with `texts` the kept text."""
    found = common.stage(repeats(docs, span, bucket).groupBy("doc_id", "tag").agg(
        F.flatten(F.collect_set(F.array("start", "end"))).alias("cuts")), "repeats")
    size = found.agg(F.sum(F.size("cuts") * 8 + 48)).first()[0] or 0
    found = found.withColumnsRenamed({"doc_id": "_doc", "tag": "_tag"})
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    rows = docs.select("doc_id", "text").withColumn("tag", F.xxhash64("text"))
    rows = rows.join(found, (F.col("doc_id") == F.col("_doc")) & (F.col("tag") == F.col("_tag")), "left")

    @F.pandas_udf("n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    def keep(text: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        out = []
        for t, c in zip(text, cuts):
            n, removed, rest = _keep(t, c)
            out.append((n, removed, hashlib.sha256(rest).hexdigest(),
                        rest.decode("utf-8", "surrogatepass") if texts else None))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept"])

    out = rows.select("doc_id", keep("text", "cuts").alias("_k")).select("doc_id", "_k.*")
    return out if texts else out.drop("kept")


def op10_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(common.table(spark, sf_dir, "documents"), texts=False)
