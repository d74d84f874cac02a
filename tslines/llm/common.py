"""Tables, staging and word cutting shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines import session

#: Rows of one Arrow batch; texts may be long, so batches stay small.
BATCH_ROWS = 512
#: What separates words: space, and the ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Batch size for texts; the other settings are the library's."""
    session.configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back.

    What follows no longer depends on the work before, and survives the loss of
    any executor.
    """
    path = session.scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unsigned_share(name: str, *parts: Column) -> Column:
    """A number in [0, 1) that depends on `name` and `parts` alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(name), *parts), 11) / F.lit(float(1 << 53))


def orderable(df: DataFrame, name: str) -> Column:
    """A column as it can be hashed and compared: one that holds maps as its JSON text."""
    column = F.col(f"`{name}`")
    return F.to_json(F.struct(column)) if "map<" in df.schema[name].dataType.simpleString() else column


def remainder(column: Column, by: int) -> Column:
    """crc32 of a value's text modulo `by`; null for null."""
    return F.crc32(column.cast("string")) % by


def text_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def word_blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size, cut at white space only."""
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[start:end].split()
        start = end


def signed(value: int) -> int:
    """A 64-bit pattern as Spark's BIGINT."""
    return value - (1 << 64) if value >> 63 else value


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
