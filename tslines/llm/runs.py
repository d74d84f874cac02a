"""Periodic stretches of words, found as maximal pairs of repeats.

A run is a stretch of at least max(LEAST, 3 q) words with smallest period q that
no neighbouring word extends. Two occurrences of a repeat of l words, at distance
p, that differ in the word before and in the word after, are a maximal pair; the
l + p words they span have period p and cannot be extended. So with l >= 2 p and
l + p >= LEAST such pairs are the runs, once for every multiple of q that is still
short enough; the smallest distance of a stretch is its period.

Pairs come from the tree of LCP intervals, walked bottom-up over the suffixes in
order. Each interval keeps the places of its suffixes in lists by the word on
their left. When two children join, every place of the smaller one looks in the
lists of the other, but for its own word's, for places within half the repeat's
length; then the lists are joined. Shorter repeats than SHORTEST words cannot make
a run, so only words inside a repeated SHORTEST-gram get suffixes: hashes find
these first (a collision adds a candidate, ranks then tell it apart).

Documents are worked on in groups of GROUP words, in which words of different
documents never count as equal; a longer document is a group of its own, whole.
Memory is in proportion to a group, and to the logarithm of its longest repeat.
Rows pass through one task each, nothing is shuffled.

Defined cases: a null or empty text has no words, no run and an empty collapsed
text. Rows are independent: repeated rows and rows without an id each get their
result. A run may overlap others; a word is dropped if any run holds it after
that run's first q words. No rows: no result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import common

#: Words of a run at least, and periods of it at least.
LEAST, TIMES = 24, 3
#: Words that are worked on together.
GROUP = 1 << 18
#: Distinct words that a task numbers before it starts anew.
NUMBERED = 1 << 20
#: Intervals with more left words than this also keep all places in one list.
MANY = 16
FOUND = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def shortest(least: int = LEAST, times: int = TIMES) -> int:
    """The shortest repeat of a pair that makes a run: at distance p it has max(least - p, (times - 1) p) words."""
    return min(max(least - p, (times - 1) * p) for p in range(1, least + 1))


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _repeated(keys: np.ndarray, n: int) -> np.ndarray:
    """Starts of n-grams that occur again, and few others."""
    if len(keys) < n:
        return np.zeros(0, np.int64)
    h, done = common.mix64(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while done < n:
        step = min(done, n - done)
        h = common.mix64(h[:-step] * np.uint64(0xD1342543DE82EF95) + h[step:])
        done += step
    order = np.sort(h)
    again = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(again):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(again, h), len(again) - 1)
    return np.flatnonzero(again[at] == h)


def _ranks(text: np.ndarray) -> list[np.ndarray]:
    """Ranks of the 1-, 2-, 4-, ... grams at every place, until all differ; -1 past the end."""
    out = [np.unique(text, return_inverse=True)[1]]
    n, width = len(text), 1
    while out[-1].max() + 1 < n:
        rank = out[-1]
        after = np.full(n, -1, np.int64)
        after[:-width] = rank[width:]
        out.append(np.unique(rank * (n + 1) + after, return_inverse=True)[1])
        width *= 2
    return out


def _shared(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of the suffixes at a and at b."""
    n, total = len(ranks[0]), np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        i, j = a + total, b + total
        inside = (i < n) & (j < n)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[k][i[inside]] == ranks[k][j[inside]]
        total += same.astype(np.int64) << k
    return total


class _Interval:
    """Places of an interval's suffixes, in order, by the word on the left."""

    __slots__ = ("by_left", "places", "size")

    def __init__(self, left: int, place: int):
        self.by_left, self.places, self.size = {left: [place]}, None, 1

    def take(self, other: _Interval) -> None:
        self.size += other.size
        for left, places in other.by_left.items():
            own = self.by_left.setdefault(left, places)
            if own is not places:
                if len(places) == 1:
                    insort(own, places[0])
                else:
                    own += places
                    own.sort()
        if self.places is not None or len(self.by_left) > MANY:
            if self.places is None:
                self.places = sorted(p for places in self.by_left.values() for p in places)
            else:
                more = [p for places in other.by_left.values() for p in places]
                if len(more) == 1:
                    insort(self.places, more[0])
                else:
                    self.places += more
                    self.places.sort()


def _join(a: _Interval, b: _Interval, length: int, lefts: list[int], found: dict,
          least: int, times: int) -> _Interval:
    """Report the maximal pairs between two children, then make them one."""
    if a.size < b.size:
        a, b = b, a
    reach, near = length // (times - 1), max(1, least - length)
    for left, places in b.by_left.items():
        for i in places:
            # whichever is less: left words, or places within reach
            if a.places is not None and (bisect_right(a.places, i + reach) - bisect_left(a.places, i - reach)
                                         <= len(a.by_left)):
                lists = (a.places,)
            else:
                lists = (there for other, there in a.by_left.items() if other != left)
            for there in lists:
                for k in range(bisect_left(there, i - reach), len(there)):
                    j = there[k]
                    if j > i + reach:
                        break
                    p = j - i if j > i else i - j
                    if p >= near and lefts[j] != left:
                        stretch = (min(i, j), length + p)
                        if p < found.get(stretch, p + 1):
                            found[stretch] = p
    a.take(b)
    return a


def maximal_runs(keys: np.ndarray, least: int = LEAST, times: int = TIMES) -> dict:
    """{(start, length): period} of all runs of an array of words as numbers."""
    short, found = shortest(least, times), {}
    starts = _repeated(keys, short)
    if not len(starts):
        return found
    cover = np.zeros(len(keys) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + short, -1)
    place = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    # the covered words, with a number of its own after each stretch of them
    ends = np.append(np.flatnonzero(np.diff(place) > 1), len(place) - 1)
    known = np.unique(keys[place], return_inverse=True)[1]
    text = np.insert(known, ends + 1, known.max() + 1 + np.arange(len(ends)))
    place = np.insert(place, ends + 1, -1)
    ranks = _ranks(text)
    wanted = np.zeros(len(keys) + 1, bool)
    wanted[starts] = True
    order = np.argsort(ranks[-1])
    order = order[wanted[place[order]]]  # the mark -1 stands for the last cell, never wanted
    lcp = _shared(ranks, order[:-1], order[1:]).tolist()
    lefts = np.concatenate(([-1], keys[:-1])).tolist()
    suffixes = place[order].tolist()

    stack: list[tuple[_Interval, int]] = []
    node = _Interval(lefts[suffixes[0]], suffixes[0])
    for here, length in zip(suffixes[1:], lcp):
        while stack and stack[-1][1] >= length:
            before, shared = stack.pop()
            node = _join(before, node, shared, lefts, found, least, times)
        if length >= short:
            stack.append((node, length))
        node = _Interval(lefts[here], here)
    while stack:
        before, shared = stack.pop()
        node = _join(before, node, shared, lefts, found, least, times)
    return found


def _group(texts: list[list[bytes]], numbers: _Numbers, least: int, times: int):
    """Runs (start, length, period) in order, and the kept words, of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    keys = np.fromiter((numbers[w] for t in texts for w in t), np.int64, total)
    keys += np.repeat(np.arange(len(texts), dtype=np.int64) << 40, sizes)
    begin = np.cumsum(sizes) - sizes
    runs: dict[int, list] = defaultdict(list)
    for (start, length), period in maximal_runs(keys, least, times).items():
        doc = int(np.searchsorted(begin, start, "right")) - 1
        runs[doc].append((start - int(begin[doc]), length, period))
    for doc, words in enumerate(texts):
        own = sorted(runs.get(doc, ()), key=lambda r: (r[0], r[2]))
        if own:
            edge = np.zeros(len(words) + 1, np.int64)
            for start, length, period in own:
                edge[start + period] += 1
                edge[start + length] -= 1
            keep = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
            yield len(words), own, b" ".join([words[i] for i in keep])
        else:
            yield len(words), own, b" ".join(words)


_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _detect(group: int, least: int, times: int):
    def run(batches):
        ids, texts, size, numbers = [], [], 0, _Numbers()

        def out():
            n, runs, left = zip(*_group(texts, numbers, least, times))
            runs = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(runs, pa.list_(_RUN)),
                 pa.array([x.decode("utf-8", "replace") for x in left], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = common.text_bytes(text).split()
                if ids and size + len(words) > group:
                    yield out()
                    ids, texts, size = [], [], 0
                    if len(numbers) > NUMBERED:
                        numbers = _Numbers()
                ids.append(doc)
                texts.append(words)
                size += len(words)
        if ids:
            yield out()
    return run


def find_runs(docs: DataFrame, group: int = GROUP, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period) and the text without what they repeat."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _detect(group, least, times), FOUND)


def with_period(text: Column, doc_id: Column) -> Column:
    """Texts of a tenth of the ids, from some word on, go on with the words from there in a circle."""
    h = F.crc32(doc_id.cast("string"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(words: Column) -> Column:
        n, g = F.size(words).cast("bigint"), F.call_function("div", h, F.lit(10))
        a = g % n
        p = F.call_function("div", n - a, 3 + g % 8) + 1
        again = F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")),
                               (F.call_function("div", n - a, p) + 1).cast("int"))
        whole = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.flatten(again))
        return F.array_join(F.slice(whole, F.lit(1), n.cast("int")), " ")

    # the words are made once, as the only element that the lambda sees
    new = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.lit("")))[0]
    return F.when((h % 10 == 0) & text.isNotNull(), new).otherwise(text)


def summary(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the one with the greatest exponent, and digests."""
    best = F.expr("""array_sort(runs, (a, b) -> CASE
        WHEN a.length * b.period <> b.length * a.period
            THEN CAST(signum(b.length * a.period - a.length * b.period) AS INT)
        WHEN a.start <> b.start THEN CAST(signum(a.start - b.start) AS INT)
        ELSE CAST(signum(a.period - b.period) AS INT) END)""")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", F.get(best, F.lit(0))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in
                                                                  ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda s: F.concat(s, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_maximal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return summary(find_runs(docs.select("doc_id", with_period(F.col("text"), F.col("doc_id")).alias("text"))))
