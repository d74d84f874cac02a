"""Language identification by mixture inference.

Every language is a distribution over hashed letter trigrams, counted over all
documents that may be learnt from. A document is a mixture of languages:
expectation-maximisation estimates the proportions, and of the nested sets of
the strongest languages the one with the best penalised likelihood is kept.

Defined cases: a text that is null, empty or without any letter is `und` with
score 0, and so is every text if there is nothing to learn from. Rows whose id
is null are never learnt from. Repeated rows are treated alike. Long texts are
read in slices, so memory does not follow their length.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import common

UNKNOWN = "und"
BUCKETS = 1 << 16
SLICE = 1 << 20
#: Languages whose counts a task holds before it hands them on.
HELD = 32
SMOOTHING = 0.1
#: What each further language must add to the log-likelihood, times log(trigrams).
PENALTY = 4.0
LEAST_SHARE = 0.02
STEPS = 40


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all else."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets of a text's letter trigrams and their counts; None without a letter."""
    if not text:
        return None
    total, before = None, [0]
    for start in range(0, len(text), SLICE):
        raw = text[start:start + SLICE].encode("utf-32-le", "replace")
        code = _letters()[np.frombuffer(raw, "<u4")]
        after = [0] if start + SLICE >= len(text) else []
        code = np.concatenate((before, code, after)).astype(np.uint32)
        code = code[np.concatenate(([True], (code[1:] != 0) | (code[:-1] != 0)))]
        before = code[-2:]  # the trigrams that begin here end in the next slice
        if len(code) < 3:
            continue
        h = (code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77)
             + code[2:] * np.uint32(0xC2B2AE3D))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        h = (h >> np.uint32(16))[code[1:-1] != 0]
        if len(text) <= SLICE:
            return np.unique(h, return_counts=True)
        total = np.bincount(h, minlength=BUCKETS) + (0 if total is None else total)
    if total is None:
        return None
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass(frozen=True)
class Model:
    """Languages, and one row of trigram probabilities per bucket."""

    langs: list[str]
    share: np.ndarray

    def infer(self, text: str | None) -> list[tuple[str, float]]:
        """Selected languages and their proportions, the largest first."""
        found = trigrams(text) if self.langs else None
        if found is None:
            return []
        at, n = found
        p = self.share[at].astype(float)
        full = _mixture(p, n, steps=8)
        order = np.argsort(-full, kind="stable")
        order = order[full[order] >= LEAST_SHARE]
        best, chosen, shares = -np.inf, order[:1], np.ones(1)
        price = PENALTY * np.log(n.sum() + 1.0)
        for k in range(1, len(order) + 1):
            part = p[:, order[:k]]
            mix = np.ones(1) if k == 1 else _mixture(part, n, STEPS)
            gain = n @ np.log(part @ mix) - price * (k - 1)
            if gain <= best:
                break
            best, chosen, shares = gain, order[:k], mix
        ranked = np.argsort(-shares, kind="stable")
        return [(self.langs[chosen[i]], float(shares[i])) for i in ranked]


def _mixture(p: np.ndarray, n: np.ndarray, steps: int) -> np.ndarray:
    """Proportions that maximise the likelihood of counts `n` under columns `p`."""
    mix, total = np.full(p.shape[1], 1.0 / p.shape[1]), n.sum()
    for _ in range(steps):
        after = mix * ((n / (p @ mix)) @ p) / total
        done = np.abs(after - mix).max() < 1e-4
        mix = after
        if done:
            break
    return mix


def _count(batches):
    """Trigram counts of every language, added up inside the task."""
    held: dict[str, np.ndarray] = {}

    def rows(sums):
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype("i4")),
                 pa.array(total[at])], names=["lang", "bucket", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = trigrams(text)
            if found is None:
                continue
            if lang not in held and len(held) == HELD:
                yield from rows(held)
                held = {}
            held.setdefault(lang, np.zeros(BUCKETS, np.int64))[found[0]] += found[1]
    yield from rows(held)


def learn(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Count trigrams of all labelled rows; the model has BUCKETS cells per language."""
    counts = (docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
              .select(F.col(lang).alias("lang"), F.col(text).alias("text"))
              .mapInArrow(_count, "lang string, bucket int, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counts["lang"].unique())
    share = np.full((BUCKETS, len(langs)), SMOOTHING)
    where = {name: i for i, name in enumerate(langs)}
    share[counts["bucket"], counts["lang"].map(where).to_numpy(int)] += counts["n"]
    return Model(langs, (share / share.sum(axis=0)).astype(np.float32))


def identify(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct of lang_pred, score (its proportion) and the selected mixture."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, mixture string")
    def infer(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = shared.value.infer(t)
            rows.append((*found[0], ", ".join(f"{k} {v:.3f}" for k, v in found))
                        if found else (UNKNOWN, 0.0, ""))
        return pd.DataFrame(rows, columns=["lang_pred", "score", "mixture"])

    return infer(text)


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that are not held out: the crc32 of their id modulo 5 is not 0."""
    return docs.where(common.remainder(F.col("doc_id"), 5) != 0)


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(learnable(docs))
    held = F.coalesce(common.remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    found = docs.select("doc_id", held.alias("held_out"),
                        identify(spark, model, F.col("text")).alias("_f"))
    return found.select("doc_id", "held_out", "_f.lang_pred", "_f.score", "_f.mixture")


def keep_identified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents that known languages make up, one or a mixture of several."""
    model = learn(learnable(docs))
    flag = "_found_" + "_".join(docs.columns)
    found = docs.withColumn(flag, identify(spark, model, F.col("text")))
    return found.where(F.col(flag)["lang_pred"] != UNKNOWN).drop(flag)
