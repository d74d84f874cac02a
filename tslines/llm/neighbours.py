"""Approximate nearest neighbours over learned partitions.

The neighbour graph of a bounded sample is cut into parts of equal size with
few edges between them (spectral bisection, then swaps that lessen the cut). A
small network learns which parts a vector's neighbours lie in. It sends every
vector to its most probable part, and every query to several; how many is set
on part of the sample so that recall against brute force reaches RECALL. What
is found there is ranked by exact cosine in double precision.

Equal vectors are one entry with their smallest ids, found before any shuffle,
so copies fill no part; equal queries are asked once, for one neighbour more,
and each takes itself out of the answer. A part is dealt into blocks of bounded size by hash; a
task keeps one block and streams that block's queries past it.

Defined cases: vectors that are null, empty or zero, or hold a null or a
non-finite number take no part, nor do rows without an id, nor vectors whose
length is not the most frequent one. Repeated rows count once. Ties go to the
smaller id. With a single vector there is no neighbour and no row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tslines.llm import common

K = 5
#: Vectors of the sample on which partitions and network are learnt.
SAMPLE = 8_192
#: Of those, how many are only used to set the number of parts that are searched.
TUNING = 512
#: Share of the true neighbours that must be found on the tuning sample.
RECALL = 0.97
PER_PART, MOST_PARTS = 2_048, 256
#: Vectors of one block, on average.
BLOCK = 8_192
GRAPH = 10
HIDDEN, EPOCHS = 128, 30


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nearest(x: np.ndarray, among: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Positions of the k most similar rows of `among`, in blocks of queries."""
    out = np.zeros((len(x), k), np.int64)
    for i in range(0, len(x), 512):
        s = x[i:i + 512] @ among.T
        if own is not None:
            s[np.arange(len(s)), own[i:i + 512]] = -2
        out[i:i + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _bisect(near: np.ndarray, rng) -> np.ndarray:
    """Halves of equal size of a graph of neighbour lists (-1: none), few edges between."""
    n = len(near)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    f, root = rng.normal(size=n), np.sqrt(degree)
    for _ in range(60):  # second eigenvector of the normalised graph
        f -= root * (root @ f) / (root @ root)
        f = 0.5 * (f + np.bincount(a, (f / root)[b], n) / root)
        f /= np.linalg.norm(f) + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(f / root, kind="stable")[n // 2:]] = True
    for _ in range(10):
        other = np.bincount(a, side[a] != side[b], n)
        gain = 2 * other - degree
        low, high = np.flatnonzero(~side), np.flatnonzero(side)
        low, high = low[np.argsort(-gain[low])], high[np.argsort(-gain[high])]
        m = min(len(low), len(high))
        swap = np.flatnonzero(gain[low[:m]] + gain[high[:m]] > 2)[:max(1, n // 50)]
        if not len(swap):
            break
        before = other.sum()
        side[low[swap]], side[high[swap]] = True, False
        if np.count_nonzero(side[a] != side[b]) >= before:
            side[low[swap]], side[high[swap]] = False, True
            break
    return side


def partition(x: np.ndarray, parts: int, rng) -> np.ndarray:
    """A part for each vector: the neighbour graph halved until there are `parts`."""
    near = _nearest(x, x, min(GRAPH, len(x) - 1), np.arange(len(x)))
    part, count = np.zeros(len(x), np.int64), 1
    while count < parts:
        for p in range(count):
            at = np.flatnonzero(part == p)
            place = np.full(len(x), -1)
            place[at] = np.arange(len(at))
            part[at] += count * _bisect(place[near[at]], rng)
        count *= 2
    return part


@dataclass
class Router:
    """Network with one hidden layer; the parts of a vector, most probable first."""

    layers: list[np.ndarray]
    parts: int
    searched: int

    def ranked(self, x: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return np.zeros((len(x), 1), np.int64)
        a, b, c, d = self.layers
        return np.argsort(-(np.maximum(_unit(x) @ a + b, 0) @ c + d), axis=1, kind="stable")


def _train(x: np.ndarray, want: np.ndarray, rng) -> list[np.ndarray]:
    """Cross-entropy against the shares of each part among a vector's neighbours."""
    n, dim, parts = len(x), x.shape[1], want.shape[1]
    w = [rng.normal(size=(dim, HIDDEN)) * np.sqrt(2 / dim), np.zeros(HIDDEN),
         rng.normal(size=(HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(EPOCHS):
        for i in np.array_split(rng.permutation(n), max(1, n // 256)):
            hidden = np.maximum(x[i] @ w[0] + w[1], 0)
            z = hidden @ w[2] + w[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (z / z.sum(axis=1, keepdims=True) - want[i]) / len(i)
            dh = (dz @ w[2].T) * (hidden > 0)
            step += 1
            for j, g in enumerate((x[i].T @ dh, dh.sum(0), hidden.T @ dz, dz.sum(0))):
                m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.999 * v[j] + 0.001 * g * g
                w[j] -= 2e-3 * (m[j] / (1 - 0.9 ** step)) / (np.sqrt(v[j] / (1 - 0.999 ** step)) + 1e-8)
    return w


def learn(sample: np.ndarray, rows: int, recall: float = RECALL, seed: int = 11) -> Router:
    """Partitions, network and number of searched parts from a sample of `rows` vectors."""
    parts = 1
    while parts < MOST_PARTS and parts * 2 * PER_PART <= rows and len(sample) >= 64 * parts:
        parts *= 2
    if parts == 1:
        return Router([], 1, 1)
    rng = np.random.default_rng(seed)
    x = _unit(sample.astype(float))
    tune, base = x[:min(TUNING, len(x) // 4)], x[min(TUNING, len(x) // 4):]
    part = partition(base, parts, rng)
    near = _nearest(base, base, GRAPH, np.arange(len(base)))
    want = np.zeros((len(base), parts))
    for column in (part[near[:, j]] for j in range(GRAPH)):
        want[np.arange(len(base)), column] += 1 / GRAPH
    router = Router(_train(base, 0.5 * want + 0.5 * np.eye(parts)[part], rng), parts, parts)
    home = router.ranked(base)[:, 0]
    order = np.argsort(router.ranked(tune), axis=1)  # rank of each part for each query
    true = _nearest(tune, base, K)
    needed = np.sort(np.take_along_axis(order, home[true], 1).ravel())
    router.searched = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1
    return router


def valid(vector):
    """Not null, not zero, and all numbers finite."""
    inf = float("inf")
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def _search(k: int, dim: int):
    """Per task: blocks and then their queries in, the k best of each query and block out."""
    def run(batches):
        held: list[tuple] = []
        at, matrix, norms, ids, least = None, None, None, None, None

        def best(rows, vectors):
            nonlocal matrix, norms, ids, least
            if matrix is None:
                matrix = np.stack([v for v, _ in held]) if held else np.zeros((0, dim))
                norms, ids = np.linalg.norm(matrix, axis=1), [i for _, i in held]
                least = np.array([i[0] for i in ids], np.int64)
            for s in range(0, len(rows), 64):
                q = vectors[s:s + 64]
                sim = (q @ matrix.T) / norms
                take = min(k + 3, len(norms))
                if not take:
                    continue
                near = np.argpartition(-sim, take - 1, axis=1)[:, :take]
                size = np.linalg.norm(q, axis=1)
                # what may tie with the k-th best, but for rounding
                kth = np.sort(np.take_along_axis(sim, near, 1), axis=1)[:, -min(k, take)]
                tied = sim >= (kth - size * (dim + 8) * 1e-15)[:, None]
                many = tied.sum(axis=1) > take
                for i, row in enumerate(rows[s:s + 64]):
                    at_ = np.flatnonzero(tied[i]) if many[i] else near[i]
                    # the same sums in the same order wherever a vector is stored
                    exact = (matrix[at_] * q[i]).sum(axis=1) / (norms[at_] * size[i])
                    first = np.lexsort((least[at_], -exact))[:k]
                    found = sorted((-e, c) for e, n in zip(exact[first].tolist(), at_[first].tolist())
                                   for c in ids[n])
                    for e, c in found[:k]:
                        yield row, c, -e

        for batch in batches:
            out = []
            part = batch.to_pandas()
            for key, group in part.groupby(["part", "block"], sort=False):
                if key != at:
                    held, at, matrix = [], key, None
                index = group[group["query"].isna()]
                held += [(np.asarray(v, float), list(i)) for v, i in zip(index["vector"], index["ids"])]
                asks = group[group["query"].notna()]
                if len(asks):
                    out += best(asks["query"].astype("int64").tolist(),
                                np.stack([np.asarray(v, float) for v in asks["vector"]]))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def search(vectors: DataFrame, is_query, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that `is_query`."""
    spark = vectors.sparkSession
    rows = vectors.where(F.col("vec_id").isNotNull() & valid(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = sizes["n"] if sizes else 1
    rows = rows.where(F.size("vector") == dim)
    # one entry per distinct vector; k + 1 ids are enough for any query
    first = Window.partitionBy("vector").orderBy("vec_id")
    few = (rows.withColumn("_n", F.dense_rank().over(first)).where(F.col("_n") <= k + 1)
           .groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")))
    few = common.stage(few.withColumn("mark", F.xxhash64("vector")), "vectors")
    n = few.count()
    sample = [r[0] for r in few.orderBy("mark", "vector").limit(SAMPLE).select("vector").collect()]
    router = learn(np.array(sample, float).reshape(len(sample), dim), n)
    shared = spark.sparkContext.broadcast(router)

    @F.pandas_udf("array<int>")
    def routes(v: pd.Series) -> pd.Series:
        found = shared.value.ranked(np.stack([np.asarray(x, float) for x in v])) if len(v) else []
        return pd.Series([list(map(int, r[:shared.value.searched])) for r in found], dtype=object)

    homes = few.withColumn("part", F.element_at(routes("vector"), 1))
    homes = common.stage(homes, "homes")
    counts = {r["part"]: max(1, -(-r["count"] // block)) for r in homes.groupBy("part").count().collect()}
    blocks = F.array(*[F.lit(counts.get(p, 1)) for p in range(router.parts)])
    of_part = lambda p: F.element_at(blocks, p + 1)
    index = homes.select("part", F.pmod(F.xxhash64("mark"), of_part(F.col("part"))).cast("int").alias("block"),
                         F.lit(None).cast("bigint").alias("query"), "vector", "ids")
    queries = common.stage(rows.where(is_query).distinct(), "queries")
    distinct = common.stage(queries.select("vector").distinct()
                            .withColumn("query", F.monotonically_increasing_id()), "asked")
    asks = (distinct.select("query", "vector", F.explode(routes("vector")).alias("part"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), of_part(F.col("part")) - 1)))
            .select("part", "block", "query", "vector", F.lit(None).cast("array<bigint>").alias("ids")))
    found = (index.unionByName(asks).repartition("part", "block")
             .sortWithinPartitions("part", "block", F.col("query").asc_nulls_first())
             .mapInArrow(_search(k + 1, dim), "query bigint, vec_id bigint, score double"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = (found.distinct().withColumn("rank", F.row_number().over(best))
             .where(F.col("rank") <= k + 1).drop("rank"))
    own = queries.join(distinct, "vector").select(F.col("vec_id").alias("query_id"), "query")
    found = own.join(found, "query").where("vec_id <> query_id").drop("query").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op5_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
