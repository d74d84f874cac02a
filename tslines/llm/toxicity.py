"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear over the hashed distinct words of a text and their
beginnings, and is fitted in numpy from two samples: confirmed toxic documents, and documents of the
corpus whatever their label. With the class prior p, the risk is

    p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)])

where the second term estimates the risk on clean documents. Without the bound
it would go far below zero while the positives are learnt by heart; with it, a
batch whose estimate is negative only teaches the first term. Words are weighed
with logistic loss and shrunk; then scale and threshold are set on a part that
was kept back, by the same risk with a bounded loss.

The prior is counted over all labels that may be used. The samples are bounded
(POSITIVES, UNLABELLED documents, the smallest by a hash of their id); scoring
reads every whole text.

Defined cases: a null, empty or wordless text gets the score of no word at all.
Without any usable positive all scores are 0. A document with several labels is
toxic if one says so; null labels are none. Rows with a null id are scored and
never learnt from. Repeated rows get equal scores.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import common

#: Bounds of the two samples, in documents.
POSITIVES = 6_000
UNLABELLED = 18_000
FEATURE_BITS = 18
#: Letters of a word's beginnings.
BEGINNINGS = (4, 5)
EPOCHS = 60
BATCHES = 5
RATE = 0.03
SHRINK = 5e-4
THRESHOLD = 0.7
SLICE = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")
#: Words whose hashes a task remembers.
KNOWN = 200_000
_known: dict[str, list[int]] = {}


def features(text: str | None) -> np.ndarray:
    """Distinct hashed words of a whole text, and the beginnings of its longer words.

    The beginnings stand for inflected and compound forms not seen before.
    """
    words: set[str] = set()
    text = text or ""
    start = 0
    while start < len(text):
        end = start + SLICE
        while end < len(text) and text[end].isalpha():
            end += 1
        words.update(_WORD.findall(text[start:end].lower()))
        start = end
    found: set[int] = set()
    for w in words:
        hashes = _known.get(w)
        if hashes is None:
            forms = [w, *(f"{w[:n]}-" for n in BEGINNINGS if len(w) > n)]
            hashes = [zlib.crc32(common.text_bytes(f)) & ((1 << FEATURE_BITS) - 1) for f in forms]
            if len(w) <= 24:
                if len(_known) >= KNOWN:
                    _known.clear()
                _known[w] = hashes
        found.update(hashes)
    return np.fromiter(sorted(found), np.int32, len(found))


def _scale(n: int) -> float:
    """Long texts add up the noise of more words."""
    return 10 / np.sqrt(n + 100)


@dataclass
class Model:
    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        found = features(text)
        at = self.bias + float(self.weight[found].sum()) * _scale(len(found))
        return float(1 / (1 + np.exp(-np.clip(at, -30, 30))))


class _Rows:
    """Sparse rows of ones."""

    def __init__(self, rows: list[np.ndarray], known: np.ndarray):
        all_, rows = rows, [known[r][known[r] >= 0] for r in rows]
        self.n = len(rows)
        self.at = np.concatenate([*rows, np.zeros(0, np.int32)])
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), [len(r) for r in rows])
        self.scale = np.array([_scale(len(r)) for r in all_])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.n) * self.scale

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.at, (g * self.scale)[self.row], size)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
        seed: int = 7) -> Model:
    """Minimise the non-negative risk with logistic loss, by Adam over mini-batches."""
    weight = np.zeros(1 << FEATURE_BITS, np.float32)
    if not positive or not unlabelled or prior <= 0:
        return Model(weight, -np.inf)
    prior = min(prior, 0.99)
    seen = np.zeros(len(weight), bool)
    for r in (*positive, *unlabelled):
        seen[r] = True
    used = np.flatnonzero(seen)
    known = np.full(len(weight), -1, np.int32)
    known[used] = np.arange(len(used))
    rng = np.random.default_rng(seed)
    p_of, u_of = rng.permutation(len(positive)) % BATCHES, rng.permutation(len(unlabelled)) % BATCHES
    parts = [(_Rows([positive[i] for i in np.flatnonzero(p_of == b)], known),
              _Rows([unlabelled[i] for i in np.flatnonzero(u_of == b)], known))
             for b in range(min(BATCHES, len(positive), len(unlabelled)))]
    del positive, unlabelled
    start = np.zeros(len(used) + 1)  # the last is the bias
    start[-1] = np.log(prior / (1 - prior))

    def gradient(x, step):
        pos, unl = train[step % len(train)]
        gp, gu = _slopes(pos.dot(x[:-1]) + x[-1], unl.dot(x[:-1]) + x[-1], prior)
        return np.append(pos.back(gp, len(used)) + unl.back(gu, len(used)) + SHRINK * x[:-1],
                         gp.sum() + gu.sum())

    # one part is kept back, unless it is the only one
    aside, train = parts[-1], parts[:-1] or parts
    x = _descend(start, gradient, EPOCHS * len(train), RATE)
    zp, zu = (rows.dot(x[:-1]) for rows in aside)

    def scaled(ab, step):
        gp, gu = _bounded(ab[0] * zp + ab[1], ab[0] * zu + ab[1], prior)
        return np.array([gp @ zp + gu @ zu, gp.sum() + gu.sum()])

    scale, shift = _descend(np.array([1.0, x[-1]]), scaled, 300, 0.05)
    weight[used] = scale * x[:-1]
    return Model(weight, float(shift))


def _slopes(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the risk by the scores of positives and of unlabelled documents."""
    clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    gp, gu = -prior * _sigmoid(-zp) / len(zp), np.zeros(len(zu))
    if clean > 0:
        gp -= prior * _sigmoid(zp) / len(zp)
        gu = _sigmoid(zu) / len(zu)
    return gp, gu


def _bounded(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The same with the sigmoid as loss, which no single score can dominate."""
    p, u = _sigmoid(zp), _sigmoid(zu)
    gp, gu = -prior * p * (1 - p) / len(zp), np.zeros(len(zu))
    if u.mean() > prior * p.mean():
        gp *= 2
        gu = u * (1 - u) / len(zu)
    return gp, gu


def _descend(x: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    """Adam with a step size that falls to zero."""
    x, m, v = x.copy(), np.zeros_like(x), np.zeros_like(x)
    for step in range(steps):
        g = gradient(x, step)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        pace = rate * (1 - step / steps)
        x -= pace * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-8)
    return x


def _sample(docs: DataFrame, ids: DataFrame, n: int, name: str) -> list[np.ndarray]:
    """Features of the `n` documents with the smallest hash, one row of each.

    Of several rows with an id, the text with the smallest hash is taken.
    """
    @F.pandas_udf("binary")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tobytes() for t in texts], dtype=object)

    chosen = ids.select("doc_id").distinct().orderBy(F.xxhash64(F.lit(name), "doc_id"), "doc_id").limit(n)
    single = (docs.where("text is not null").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")))
    rows = single.select("doc_id", made("text").alias("x")).toArrow().sort_by("doc_id")
    return [np.frombuffer(x.as_buffer(), np.int32) for x in rows["x"]]


def learn(docs: DataFrame, labels: DataFrame, usable: Column, positives: int = POSITIVES,
          unlabelled: int = UNLABELLED) -> Model:
    """Fit from the rows of `labels` and `docs` whose doc_id is `usable`."""
    named = (labels.where(usable & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = common.stage(named.join(docs.where(usable).select("doc_id").distinct(), "doc_id"), "labels")
    toxic, all_ = known.agg(F.count(F.when(F.col("toxic") == 1, 1)), F.count("*")).first()
    if not toxic:
        return fit([], [], 0.0)
    return fit(_sample(docs, known.where("toxic = 1"), positives, "positive"),
               _sample(docs, docs.where(usable), unlabelled, "unlabelled"), toxic / all_)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return scored(text)


def op2_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    part = common.remainder(F.col("doc_id"), 3)
    model = learn(docs, labels, part != 1)
    out = docs.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"),
                      score(spark, model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
