"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has a bit set where more than half of the shingle hashes have
it. Fingerprints link at a bounded number of differing bits. Equal fingerprints
are one leaf, so exact copies never meet each other.

Pairs within `bits` errors agree on at least one of `bits + 1` blocks of the
fingerprint. Each block in turn is put at the top of a trie: below a node of
that block no error has been made yet, and such a node is the unit of work. A
unit with too many leaves is divided in the same way over the bits that are
left, so that no unit grows with the data; nothing is dropped. Inside a unit,
pairs of nodes go down together, add up the bits in which they differ and stop
where the budget is exceeded.

Defined cases: texts that are null or without a word have fingerprint zero;
they link like any other. With fewer words than a shingle has, the whole
sequence is the only shingle. Rows without an id get the component of their
fingerprint. Repeated rows come back as often as they were there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import common

WORDS = 3
BITS = 2
SEED = 42
#: Leaves of one unit; at most 2**14 are left after four divisions in any case.
UNIT = 50_000
#: Pairs of nodes that are held at once.
FRONTIER = 1 << 18
#: Rows that one call of the traversal works on, at least.
GATHER = 1 << 15


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64 bits as an unsigned number."""
    ones, n, carry, digest = np.zeros(64, np.int64), 0, [], xxhash.xxh64_intdigest
    for block in common.word_blocks(common.text_bytes(text).lower()):
        block = carry + block
        carry = block[len(block) - words + 1:] if len(block) >= words else block
        if len(block) < words:
            continue
        line = b" ".join(block)
        size = np.fromiter(map(len, block), np.int64, len(block)) + 1
        end = np.cumsum(size) - 1
        start = end - size + 1
        hashes = np.array([digest(line[a:b], SEED) for a, b in
                           zip(start[:len(block) - words + 1].tolist(), end[words - 1:].tolist())],
                          dtype="<u8")
        n += len(hashes)
        for at in range(0, len(hashes), 1 << 14):
            part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if not n:
        return digest(b" ".join(carry), SEED) if carry else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, words: int = WORDS) -> Column:
    @F.pandas_udf("bigint")
    def make(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, words) for t in texts], np.uint64)
        return pd.Series(values.view(np.int64))
    return make(text)


def blocks(free: int, parts: int) -> list[int]:
    """The set bits of `free` in `parts` masks of adjacent bits."""
    at = [i for i in range(63, -1, -1) if free >> i & 1]
    return [sum(1 << i for i in part.tolist()) for part in np.array_split(at, parts) if len(part)]


def trie_pairs(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, budget: int):
    """Index pairs of keys that differ in at most `budget` bits.

    `keys` ascend inside every unit [lo, hi) and are distinct there. Units are
    the roots; a pair of nodes is two ranges of keys with equal leading bits.
    """
    ones: dict[int, np.ndarray] = {}
    full = hi - lo > 1
    lo, hi = lo[full], hi[full]
    todo = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while todo:
        depth, al, ah, bl, bh, err = todo.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            todo += [(depth, *(x[s] for x in (al, ah, bl, bh, err)))
                     for s in (slice(half, None), slice(None, half))]
            continue
        single = (ah - al == 1) & (bh - bl == 1) & (al != bl)
        if single.any():
            i, j = al[single], bl[single]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            yield i[near], j[near]
        go = ~single
        al, ah, bl, bh, err = (x[go] for x in (al, ah, bl, bh, err))
        if not len(al) or depth == 64:
            continue
        if depth not in ones:
            bit = (keys >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        c = ones[depth]
        am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
        same = al == bl
        cross = ~same
        take = lambda which, *cols: [x[which] for x in cols]
        below = [take(same, al, am, al, am, err), take(same, am, ah, am, ah, err),
                 take(same, al, am, am, ah, err + 1),
                 take(cross, al, am, bl, bm, err), take(cross, am, ah, bm, bh, err),
                 take(cross, al, am, bm, bh, err + 1), take(cross, am, ah, bl, bm, err + 1)]
        al, ah, bl, bh, err = (np.concatenate(x) for x in zip(*below))
        live = (ah > al) & (bh > bl) & (err <= budget) & ((al != bl) | (ah - al > 1))
        todo.append((depth + 1, *(x[live] for x in (al, ah, bl, bh, err))))


def _settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Make the labels of linked items equal, each the smallest of its group."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label[:] = label[label]


def _links(bits: int):
    """Per task: rows sorted by unit in, for every linked key its group's smallest out."""
    def run(batches):
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch.to_pandas())
            if sum(map(len, held)) < GATHER:
                continue
            rows = pd.concat(held)
            last = rows.iloc[-1]
            open_ = ((rows["m"] == last["m"]) & (rows["k"] == last["k"])).to_numpy()
            if not open_.all():
                yield _forest(rows[~open_], bits)
            held = [rows[open_]]
        if held:
            yield _forest(pd.concat(held), bits)
    return run


def _forest(rows: pd.DataFrame, bits: int) -> pa.RecordBatch:
    key = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
    m, k = rows["m"].to_numpy(), rows["k"].to_numpy()
    order = np.lexsort((key, k, m))
    key, m, k = key[order], m[order], k[order]
    new = np.concatenate(([True], (m[1:] != m[:-1]) | (k[1:] != k[:-1]))) if len(key) else np.zeros(0, bool)
    lo = np.flatnonzero(new)
    hi = np.concatenate((lo[1:], [len(key)])).astype(np.int64)
    label = np.arange(len(key))
    for i, j in trie_pairs(key, lo, hi, bits):
        _settle(label, i, j)
    far = label != np.arange(len(key))
    return pa.RecordBatch.from_arrays(
        [pa.array(key[far].view(np.int64)), pa.array(key[label[far]].view(np.int64))],
        names=["u", "v"])


def links(prints: DataFrame, bits: int = BITS, unit: int = UNIT) -> DataFrame:
    """Edges (u, v) that connect whatever differs in at most `bits` bits.

    `prints` has distinct values `fp`. Inside a unit a forest stands for all
    its links.
    """
    def units(df, masks):
        """Every leaf once per mask; the mask is the key's own text."""
        tops = [F.struct(F.lit(common.signed(x)).alias("m"),
                         F.col("fp").bitwiseAND(F.lit(common.signed(x))).alias("k")) for x in masks]
        return df.select("fp", F.explode(F.array(*tops)).alias("_u")).select("fp", "_u.m", "_u.k")

    ready, full = [], (1 << 64) - 1
    todo = units(prints, blocks(full, bits + 1))
    while True:
        crowded = common.stage(todo.groupBy("m", "k").count().where(F.col("count") > unit), "crowded")
        masks = [r["m"] & full for r in crowded.select("m").distinct().collect()]
        if not masks:
            ready.append(todo)
            break
        ready.append(todo.join(crowded, ["m", "k"], "left_anti"))
        dense = todo.join(crowded, ["m", "k"], "left_semi")
        parts = [units(dense.where(F.col("m") == common.signed(m)).select("fp"),
                       [m | x for x in blocks(full & ~m, bits + 1)])
                 for m in masks if m != full]
        if not parts:
            break
        todo = common.stage(_union(parts), "divided")
    return (_union(ready).repartition("m", "k").sortWithinPartitions("m", "k")
            .mapInArrow(_links(bits), "u bigint, v bigint"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(u, root): the smallest vertex that every linked vertex reaches.

    Large-star and small-star steps in turn, each a minimum (added up before
    the shuffle) and a join, until the edges no longer change. Large stars are
    split by the skewed-join rule.
    """
    def star(df, keep):
        least = df.groupBy("u").agg(F.min("v").alias("_m"))
        least = least.select("u", F.least("u", "_m").alias("_m"))
        return keep(df.join(least, "u"))

    def large(df):
        both = df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        return star(both, lambda j: j.where("v > u").select(
            F.col("v").alias("u"), F.col("_m").alias("v")))

    def small(df):
        return star(df, lambda j: j.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("_m").alias("v")),
            F.struct("u", F.col("_m").alias("v")))).alias("_e")).select("_e.u", "_e.v")
            .where("u > v")).distinct()

    def state(df):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    now = common.stage(edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = state(now)
    while seen[0]:
        now = common.stage(small(large(now).where("u > v").distinct()), "edges")
        then = state(now)
        if then == seen:
            break
        seen = then
    return now.select("u", F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text",
                    words: int = WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint and component_id of every row.

    Beside them `root`, the smallest fingerprint of the component, and `tag`, a
    hash of the text that tells rows with one id apart.
    """
    prints = common.stage(docs.select(
        F.col(id_).alias("doc_id"), F.xxhash64(text).alias("tag"),
        fingerprints(F.col(text), words).alias("fp")), "prints")
    leaves = common.stage(prints.groupBy("fp").agg(F.min("doc_id").alias("_first")), "leaves")
    roots = components(links(leaves.select("fp"), bits)).withColumnRenamed("u", "fp")
    rooted = leaves.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    classes = rooted.select("fp", "root").join(least, "root")
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return prints.join(classes, "fp").select(
        "doc_id", hexed("fp").alias("fingerprint"), "component_id", hexed("root").alias("root"), "tag")


def keep_first(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row of each group: the one with the smallest id, or without one the first.

    Only rows whose id is their component's can be it. Of several such rows
    (repeated ones) the smallest by its other columns stays.
    """
    found = near_duplicates(docs, words=words, bits=bits)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keys = ["_no", "_id", "_tag"]

    def keyed(id_, tag):
        return [id_.isNull().alias("_no"), F.coalesce(id_, F.lit(0)).alias("_id"), tag.alias("_tag")]

    # one id and text per group, chosen before any text moves
    first = first.groupBy("root").agg(F.min(F.struct("doc_id", "tag")).alias("f")).select(
        *keyed(F.col("f.doc_id"), F.col("f.tag")))
    names = [f"_{n}" for n in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    id_, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    kept = rows.select(*keyed(id_, F.xxhash64(text)), *names).join(first.distinct(), keys)
    # repeated rows lie where the join has put them
    order = [common.orderable(rows, n).alias(n) for n in names]
    kept = kept.groupBy(*keys).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_row"))
    return kept.select(*[F.col("_row")[n].alias(c) for n, c in zip(names, docs.columns)])


def op3_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).drop("root", "tag")
