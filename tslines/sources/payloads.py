"""Payloads out and in: one row per batch, committed as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines import session
from tslines.operators.batch import DEFAULT_MAX_BYTES, Limits, _codes, _key_at, assign
from tslines.operators.ordered import SPREAD_ABOVE, measure


def _join_lines(keys, limit, schema):
    """Concatenate the lines of each batch; rows come sorted by batch."""

    def go(batches):
        held = None  # [key, pieces, rows, bytes] of the batch that may go on

        def check(size):
            if size > limit:
                raise ValueError(f"a batch of {size} bytes exceeds the limit of {limit}")

        def emit(done):
            rows = [(*key, n, size, b"".join(pieces)) for key, pieces, n, size in done]
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            bounds, done = _codes(batch, keys), []
            lines = batch.column("line").cast(pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines)
            joined = pc.binary_join(lists, pa.scalar(b"\n", pa.binary()))
            sizes = np.add.reduceat(pc.binary_length(lines).to_numpy() + 1, bounds[:-1])
            for i, text in enumerate(joined):
                key = _key_at(batch, keys, int(bounds[i]))
                if held and held[0] != key:
                    done.append(held)
                    held = None
                held = held or [key, [], 0, 0]
                held[1] += [text.as_py(), b"\n"]
                held[2] += int(bounds[i + 1] - bounds[i])
                held[3] += int(sizes[i])
                check(held[3])
            if done:
                yield emit(done)
        if held:
            yield emit([held])

    return go


def payloads(lines: DataFrame, *key: str, order: list[str], limit: int = DEFAULT_MAX_BYTES,
             arranged: bool = False) -> DataFrame:
    """One row per batch: `key`, `batch_id`, `n_rows`, `n_bytes`, `payload`.

    Batches are spread by their number, so a key with many batches uses many
    tasks; a batch itself is at most `limit` bytes, more is an error.
    `arranged` rows already lie batch by batch in one partition each, and need
    no shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    keys = [*key, "batch_id"]
    ddl = T.StructType([f for f in lines.schema.fields if f.name in keys])
    ddl = T.StructType([ddl[k] for k in keys] + T.StructType.fromDDL(
        "n_rows bigint, n_bytes bigint, payload binary").fields)
    narrow = lines.select(*keys, "line", *[o for o in order if o not in keys])
    near = narrow if arranged else (
        narrow.repartition(*keys).sortWithinPartitions(*keys, *order))
    return near.mapInArrow(_join_lines(keys, limit, to_arrow_schema(ddl)), ddl)


def build(lines: DataFrame, limits: Limits, *, key: list[str], order: list[str],
          limit: int = DEFAULT_MAX_BYTES, spread_above: int = SPREAD_ABOVE, **how) -> DataFrame:
    """Cut lines into batches and join each batch, with one shuffle when no key is large.

    The plan for ordinary keys leaves every batch in one partition in its
    order; in the spread plan a batch may cross a partition border.
    """
    load = measure(lines, key)
    cut = assign(lines, limits, key=key, order=order, load=load, spread_above=spread_above, **how)
    return payloads(cut, *key, order=order, limit=limit,
                    arranged=not load.spread(key, spread_above))


def write(df: DataFrame, path: str, commit: str | int) -> None:
    """Write one commit, all or nothing; a complete commit is not written again.

    The rows are written beside the commits first (a folder that readers skip)
    and moved to their place when they are complete, so a failed attempt changes
    nothing.
    """
    spark, target = df.sparkSession, f"{path}/commit={commit}"
    if session.exists(spark, f"{target}/_SUCCESS"):
        return
    staged = f"{path}/_staged/{uuid.uuid4().hex}"
    df.write.parquet(staged)
    session.publish(spark, staged, target)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All committed payloads, with their `commit`."""
    return session.configure(spark).read.parquet(path)


def fan_out(df: DataFrame, sinks: list[Callable[[DataFrame], DataFrame | None]]) -> list:
    """Give the same rows to several sinks; they are computed once.

    Returns what the sinks return, in their order: a sink that refuses rows
    writes them elsewhere or returns them.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [sink(kept) for sink in sinks]
    finally:
        kept.unpersist()


def text_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Version 1 lines from text files, one row per line, in batch or as a stream.

    Lines with an escaped line end cannot be told apart in plain text files;
    keep those in payload tables and use `decode.split_text`.
    """
    reader = session.configure(spark).readStream if stream else session.configure(spark).read
    return reader.text(path).withColumnRenamed("value", "line")


def write_text(lines: DataFrame, path: str, column: str = "line") -> DataFrame:
    """Write lines as text files.

    Lines that hold a line end cannot be told apart there; they go whole to
    Parquet files in `path/_refused` and are returned from there.
    """
    spark, breaks = lines.sparkSession, F.col(column).contains("\n")
    lines.filter(~breaks).select(column).write.mode("overwrite").text(path)
    lines.filter(breaks).write.mode("overwrite").parquet(f"{path}/_refused")
    return spark.read.schema(lines.schema).parquet(f"{path}/_refused")
