"""Small tables for the tests."""

from __future__ import annotations

import random
import uuid

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside themselves.
CLASH = ", size bigint, score double, copies bigint, key string, file string, tag string, u bigint"


def store(spark, folder, rows, schema=DOCS, parts=3):
    """A stored table, read back as a scan of files."""
    path = f"{folder}/{uuid.uuid4().hex}.parquet"
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def words(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def clashing(rows):
    return [(*r, 1, 0.5, 2, "k", "f", "t", 3) for r in rows]
