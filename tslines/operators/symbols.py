"""Symbol dictionaries: distinct strings as small integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.operators.ordered import global_index

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1_000

# Largest dictionary for 8-bit and 16-bit codes.
MAX_8_BIT = 127
MAX_16_BIT = 32_767


def code_width(n: Column) -> Column:
    return F.when(n <= MAX_8_BIT, 8).when(n <= MAX_16_BIT, 16).otherwise(32)


def dictionary(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """`symbol`, zero-based `code` in value order, and `n_rows` per value.

    Values are combined map-side and ranked over range partitions.
    """
    values = (df.filter(F.col(column).isNotNull())
              .groupBy(F.col(column).alias("symbol")).agg(F.count("*").alias("n_rows")))
    return global_index(values, ["symbol"], "code", partitions)


def _lookup(df: DataFrame, column: str, table: DataFrame, key: str, value: str, out: str,
            broadcast_rows: int) -> DataFrame:
    """`df` with `out` looked up in the dictionary; unknown and null cells give null."""
    # alias the lookup side: the dictionary may be derived from `df` itself
    side = table.select(F.col(key).alias("_k"), F.col(value).alias(out))
    octets = lambda c: F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    n, size = side.limit(broadcast_rows + 1).agg(
        F.count("*"), F.sum(octets("_k") + octets(out) + 16)).first()
    if n <= broadcast_rows and (size or 0) <= BROADCAST_BYTES:
        return df.join(F.broadcast(side), F.col(column) == F.col("_k"), "left").drop("_k")
    # Values that fill more than one row in HOT_SHARE of `df`, known or not: at
    # most HOT_SHARE of them, so that side is always small. The rest has no large
    # key and may shuffle.
    found = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).count()
    total = found.agg(F.sum("count")).first()[0] or 0
    hot = found.filter(F.col("count") * HOT_SHARE > total).drop("count")
    hot = F.broadcast(hot.join(side, "_k", "left").select(
        "_k", F.col(out).alias("_hot"), F.lit(True).alias("_known")))
    marked = df.join(hot, F.col(column) == F.col("_k"), "left").drop("_k")
    apart = F.col("_known").isNotNull() | F.col(column).isNull()
    done = marked.filter(apart).drop("_known").withColumnRenamed("_hot", out)
    todo = marked.filter(~apart).drop("_hot", "_known")
    todo = todo.join(side, F.col(column) == F.col("_k"), "left").drop("_k")
    return done.unionByName(todo)


def encode(df: DataFrame, column: str, table: DataFrame, out: str = "code",
           broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the code of a string column."""
    return _lookup(df, column, table, "symbol", "code", out, broadcast_rows)


def decode(df: DataFrame, column: str, table: DataFrame, out: str = "symbol",
           broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the string of a code column."""
    return _lookup(df, column, table, "code", "symbol", out, broadcast_rows)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values and code width of each column, in one aggregate."""
    row = df.agg(*[F.count_distinct(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns)])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_symbols"),
                      code_width(F.col(f"n{i}")).alias("code_bits"))
             for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
