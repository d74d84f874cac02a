"""Order-dependent building blocks that never put one key's rows into one task."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tslines import session

ROWS_PER_TASK = 4_000_000
# A key with more rows than this is spread over several tasks.
SPREAD_ABOVE = 20_000_000
LOCAL_INDEX_MASK = (1 << 33) - 1


@dataclass(frozen=True)
class Load:
    """Rows of the table and of its largest key."""

    rows: int
    largest: int

    def spread(self, keys: list[str], above: int) -> bool:
        """Is there a key too large for one task? Without keys all rows are one."""
        return not keys or self.largest > above


def measure(df: DataFrame, keys: list[str]) -> Load:
    """Reads the key columns only, counts map-side; two numbers reach the driver."""
    if not keys:
        rows = df.count()
        return Load(rows, rows)
    found = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return Load(found[1] or 0, found[0] or 0)


def partitions_for(rows: int, spark) -> int:
    """At least the session's shuffle width, more when partitions would grow too large."""
    return max(session.default_partitions(spark), -(-rows // ROWS_PER_TASK))


def range_sorted(df: DataFrame, keys: list[str], order: list[str], partitions: int) -> DataFrame:
    """Rows in (keys, order) order over evenly filled partitions, numbered by `_pid`.

    Range bounds come from a sample and would differ between runs, so the
    result is checkpointed once and every later pass sees the same partitions.
    """
    cols = [F.col(c) for c in (*keys, *order)]
    out = df.repartitionByRange(partitions, *cols).sortWithinPartitions(*cols)
    return session.checkpoint(out.withColumn("_pid", F.spark_partition_id()))


def global_index(df: DataFrame, order: list[str], name: str = "idx",
                 partitions: int | None = None) -> DataFrame:
    """Zero-based position in the total order, without a single-task window.

    Pass one counts rows per range partition (one number per partition goes to
    the driver), pass two adds the offset to the position inside the partition.
    `order` must name rows uniquely.
    """
    spark = df.sparkSession
    ranged = range_sorted(df, [], order, partitions or session.default_partitions(spark))
    counts = sorted((r["_pid"], r["count"]) for r in ranged.groupBy("_pid").count().collect())
    starts = [0, *accumulate(c for _, c in counts)]
    offsets = spark.createDataFrame(
        [(p, s) for (p, _), s in zip(counts, starts)], "_pid int, _start bigint")
    local = F.monotonically_increasing_id().bitwiseAND(F.lit(LOCAL_INDEX_MASK))
    # one row per partition: the broadcast side cannot grow with the data
    return (ranged.withColumn("_local", local)
            .join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_start") + F.col("_local"))
            .drop("_pid", "_start", "_local"))


def same_keys(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of one name; NULL is a key like any other."""
    other = {n: f"_other_{n}" for n in names}
    right = right.withColumnsRenamed(other)
    on = [F.col(n).eqNullSafe(F.col(o)) for n, o in other.items()]
    return left.join(right, on, how).drop(*other.values())


def running(df: DataFrame, keys: list[str], pos: str, value: Column, op: str, name: str,
            width: int = 1 << 20, exclusive: bool = False, load: Load | None = None,
            spread_above: int = SPREAD_ABOVE, settle: bool = True) -> DataFrame:
    """Running `op` ('sum' or 'max') of `value` along the BIGINT column `pos` within `keys`.

    Rows with equal `pos` are peers; pre-aggregate them first if they are many.
    Rows without a position come first and are peers of each other; a NULL key
    is a key. Both plans keep every row.
    Without a large key this is one window, and chained calls share its
    shuffle. Otherwise each key is cut into slices of `width` positions. Slice
    totals are combined map-side and summed up over two levels, so a window
    only ever sees one slice of rows, or one slice of totals.

    The sliced plan reads `df` twice, for totals and for rows. `settle`
    checkpoints it first, so that chained calls do not repeat each other's
    work; switch it off for a plain scan. `load` is an earlier `measure` of
    these rows or of more.
    """
    load = load or measure(df, keys)
    total = {"sum": F.sum, "max": F.max}[op]
    join = (lambda a, b: a + b) if op == "sum" else (lambda a, b: F.greatest(a, b))
    zero = F.lit(0) if op == "sum" else F.lit(None)
    before = (Window.unboundedPreceding, -1)
    reach = before if exclusive else (Window.unboundedPreceding, Window.currentRow)
    if not load.spread(keys, spread_above):
        whole = Window.partitionBy(*keys).orderBy(pos).rangeBetween(*reach)
        return df.withColumn(name, F.coalesce(total(value).over(whole), zero))
    if settle:
        df = session.checkpoint(df)

    sliced = (df.withColumn("_v", value)
              .withColumn("_s1", F.call_function("div", F.col(pos), F.lit(width)))
              .withColumn("_s2", F.call_function("div", F.col("_s1"), F.lit(width))))
    level1 = sliced.groupBy(*keys, "_s2", "_s1").agg(total("_v").alias("_t"))
    level2 = level1.groupBy(*keys, "_s2").agg(total("_t").alias("_t"))
    by2 = Window.partitionBy(*keys).orderBy("_s2").rowsBetween(*before)
    level2 = level2.select(*keys, "_s2", F.coalesce(total("_t").over(by2), zero).alias("_c2"))
    by1 = Window.partitionBy(*keys, "_s2").orderBy("_s1").rowsBetween(*before)
    level1 = level1.select(*keys, "_s2", "_s1", F.coalesce(total("_t").over(by1), zero).alias("_c1"))
    carry = same_keys(level1, level2, [*keys, "_s2"]).select(
        *keys, "_s1", join(F.col("_c1"), F.col("_c2")).alias("_c"))
    frame = Window.partitionBy(*keys, "_s1").orderBy(pos).rangeBetween(*reach)
    inside = F.coalesce(total("_v").over(frame), zero)
    return (same_keys(sliced, carry, [*keys, "_s1"])
            .withColumn(name, join(inside, F.col("_c")))
            .drop("_v", "_s1", "_s2", "_c"))
