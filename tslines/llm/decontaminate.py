"""Benchmark passages in documents: q-gram lemma, then banded alignment.

Texts are compared as lower-case letters and digits with one space for all
else. A passage of m characters that occurs with at most k edits shares at
least m - q + 1 - k*q of its q-grams with the place, all of them on diagonals
(document position minus passage position) that lie within k of each other.
Shared q-grams are counted in diagonal bands of width 2(k+1) that overlap by
half, so that any such stretch lies in one band; bands that reach the count
(adjacent ones together) are verified by banded alignment of the whole passage.

The benchmark is a stated query set. It is dealt into blocks of bounded size,
and each block's index goes to all tasks in turn, so neither its size nor that
of the documents is limited by memory.

Defined cases: null or empty texts on either side match nothing, nor do
passages of fewer than `q` characters after normalising. Repeated documents
and repeated passages give a row each. Documents are read in overlapping
slices, so that very long ones need no more memory.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import common

Q = 8
#: Edits per character of a passage.
RATE = 0.1
#: Characters of benchmark text in one block.
BLOCK_CHARS = 4_000_000
#: Characters of a document that are looked up at once.
SLICE = 1 << 14
SPACE = 32
_STEP = np.uint64(0x100000001B3)
_FILTER_BITS = 22


@lru_cache(1)
def _plain() -> np.ndarray:
    """Lower-case code point of letters and digits, a space for all else."""
    out = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalnum():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the normalised text, and where each stood in the original."""
    code = _plain()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    keep = code != SPACE
    keep[1:] |= (code[1:] == SPACE) & (code[:-1] != SPACE)
    at = np.flatnonzero(keep)
    if len(at) and code[at[-1]] == SPACE:
        at = at[:-1]
    return code[at], at


def grams(code: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of all q-grams."""
    n = len(code) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = code.astype(np.uint64)
    h = wide[:n].copy()
    for t in range(1, q):
        h *= _STEP
        h += wide[t:t + n]
    return common.mix64(h)


@dataclass
class Index:
    """The q-grams of one block of passages, sorted by hash."""

    ids: list
    codes: list
    q: int
    edits: np.ndarray
    least: np.ndarray
    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    known: np.ndarray
    longest: int

    @classmethod
    def build(cls, passages: list[tuple], q: int, rate: float) -> Index:
        pairs = [(i, normalise(t or "")[0]) for i, t in passages]
        pairs = [(i, c) for i, c in pairs if len(c) >= q]
        size = np.array([len(c) for _, c in pairs], np.int64)
        # the count must stay above 0, so short passages get fewer edits
        edits = np.minimum((size * rate).astype(np.int64), (size - q) // q)
        hashes = [grams(c, q) for _, c in pairs]
        gram = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(pairs)), [len(h) for h in hashes])
        place = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, np.int64)])
        order = np.argsort(gram, kind="stable")
        known = np.zeros(1 << _FILTER_BITS, bool)
        known[gram >> np.uint64(64 - _FILTER_BITS)] = True
        return cls([i for i, _ in pairs], [c for _, c in pairs], q, edits,
                   size - q + 1 - edits * q, gram[order], item[order],
                   place[order].astype(np.int64), known, int(size.max(initial=0)))

    def bands(self, code: np.ndarray) -> list[tuple[int, int, int]]:
        """(passage, first and last diagonal) of stretches of bands with enough shared q-grams."""
        h = grams(code, self.q)
        pos = np.flatnonzero(self.known[h >> np.uint64(64 - _FILTER_BITS)])
        first = np.searchsorted(self.gram, h[pos], "left")
        n = np.searchsorted(self.gram, h[pos], "right") - first
        pos, first, n = pos[n > 0], first[n > 0], n[n > 0]
        if not len(pos):
            return []
        total = int(n.sum())
        entry = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total)
        item = self.item[entry]
        # a passage with too few shared q-grams anywhere has no band with enough
        some = (np.bincount(item, minlength=len(self.ids)) >= self.least)[item]
        if not some.any():
            return []
        item, place = item[some], self.place[entry[some]]
        diagonal = np.repeat(pos, n)[some] - place
        band = diagonal // (self.edits[item] + 1) + self.longest  # not negative
        span = len(code) + 2 * self.longest + 2
        key = np.concatenate((item * span + band, item * span + band - 1))
        place = np.concatenate((place, place))
        keys, back, counts = np.unique(key, return_inverse=True, return_counts=True)
        enough = counts >= self.least[keys // span]
        if not enough.any():
            return []
        # a q-gram of the passage counts once, however often the band repeats it
        some = enough[back]
        pairs = np.unique(np.stack((back[some], place[some])), axis=1)
        counts = np.bincount(pairs[0], minlength=len(keys))
        found = np.flatnonzero(counts >= self.least[keys // span])
        out: list[tuple[int, int, int]] = []
        for i, b in zip((keys[found] // span).tolist(), (keys[found] % span - self.longest).tolist()):
            half = int(self.edits[i]) + 1
            if out and out[-1][0] == i and b * half <= out[-1][2]:
                out[-1] = (i, out[-1][1], (b + 2) * half)
            else:
                out.append((i, b * half, (b + 2) * half))
        return out

    def find(self, text: str | None) -> list[tuple]:
        """(passage id, start, end, edits) of verified places, in the original's characters."""
        found = []
        step = max(SLICE, 4 * self.longest)
        code, at = normalise(text or "")
        for start in range(0, max(len(code), 1), step):
            part = code[start:start + step + 2 * self.longest]
            for i, low, high in self.bands(part):
                hit = align(self.codes[i], part, low, high, int(self.edits[i]))
                if hit:
                    a, b, edits = hit
                    found.append((i, int(at[start + a]), int(at[start + b - 1]) + 1, edits))
        return [(self.ids[i], *rest) for i, *rest in _best(found)]


def _best(found: list[tuple]) -> list[tuple]:
    """Of places of one passage that overlap, the one with the fewest edits."""
    out: list[tuple] = []
    for hit in sorted(set(found), key=lambda x: (x[0], x[3], x[1], x[2])):
        if not any(o[0] == hit[0] and o[1] < hit[2] and hit[1] < o[2] for o in out):
            out.append(hit)
    return out


def _band(item: np.ndarray, doc: np.ndarray, start: int, cost: np.ndarray) -> np.ndarray:
    """Edit costs after all of `item`, by diagonal start + i; `cost` holds those before."""
    width = len(cost)
    slope = np.arange(width)
    lined = np.full(len(item) + width, -1, np.int64)  # -1: outside the document
    a, b = max(start, 0), min(start + len(lined), len(doc))
    if b > a:
        lined[a - start:b - start] = doc[a:b]
    outside = 1 << 20
    for j, c in enumerate(item.tolist()):
        here = lined[j:j + width]
        after = cost + np.where(here < 0, outside, here != c)
        after[:-1] = np.minimum(after[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(after - slope) + slope
    return cost


def align(item: np.ndarray, doc: np.ndarray, first: int, last: int, budget: int):
    """(start, end, edits) of the whole passage on diagonals first..last, or None.

    Of several places the one with the fewest edits is returned; a place without
    any needs no table.
    """
    size, low = len(item), first - budget
    near = doc[max(first, 0):max(last + size, 0)]
    for at in np.flatnonzero(near[:max(len(near) - size + 1, 0)] == item[0]).tolist():
        if (near[at:at + size] == item).all():
            return max(first, 0) + at, max(first, 0) + at + size, 0
    cost = _band(item, doc, low, np.zeros(last - first + 2 * budget + 1, np.int64))
    best = int(np.argmin(cost))
    if cost[best] > budget:
        return None
    end = min(low + size + best, len(doc))
    # backwards from that end: the start costs what is skipped there
    back = _band(item[::-1], doc[:end][::-1], -budget, np.abs(np.arange(-budget, budget + 1)))
    start = end - size - (int(np.argmin(back)) - budget)
    return max(start, 0), end, int(cost[best])


def indexes(benchmark: DataFrame, q: int, rate: float, block_chars: int):
    """Broadcast indexes of blocks of about `block_chars` characters, one after the other."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where(
        "text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        rows = items.where(block == b).orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast(Index.build([(r[0], r[1]) for r in rows], q, rate))


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, start, end (characters of the text) and edits of every passage found."""
    fields = {"doc_id": pa.int64(), "item_id": pa.int64(), "start": pa.int32(),
              "end": pa.int32(), "edits": pa.int32()}

    def finder(index):
        def run(batches):
            for batch in batches:
                rows = [(d, *hit) for d, t in zip(*(c.to_pylist() for c in batch.columns))
                        for hit in index.value.find(t)]
                cols = list(zip(*rows)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, fields.values())], names=list(fields))
        return run

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = [texts.mapInArrow(finder(index), "doc_id bigint, item_id bigint, start int, "
                              "end int, edits int")
             for index in indexes(benchmark, q, rate, block_chars)]
    return reduce(DataFrame.unionByName, parts)


def clean(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without any benchmark passage; a document with one goes whole.

    The text decides, so rows without an id are judged like any other.
    """
    def dirty(index):
        @F.pandas_udf("boolean")
        def found(texts: pd.Series) -> pd.Series:
            return pd.Series([bool(index.value.find(t)) for t in texts], dtype=bool)
        return found

    for index in indexes(benchmark, q, rate, block_chars):
        docs = docs.where(~dirty(index)(F.col("text")))
    return docs


def op6_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(common.table(spark, sf_dir, "documents"),
                   common.table(spark, sf_dir, "benchmark"))
