"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies that each of its
documents should get on average. The whole part is given to all; the fraction
is a probability that pivotal rounding turns into 0 or 1: two documents are
paired, and a number of words is moved from one to the other, in a random
direction that keeps both expectations, until one of them is integral. It is
decided then, and the other one goes on. Since words are moved and not bare
probabilities, the words that a source gives stay exactly at its target until
one document is left, whose rounding is the only error.

Documents meet in cells of about FAN, dealt by a hash, so a large source is as
many tasks as it needs. Each cell leaves one document; those meet in cells of
the next level, until one per source is left: a reduction tree whose depth is
the logarithm of the largest source. Everything is DataFrame functions.

Random choices are hashes of the documents' contents, so runs agree whatever
the partitioning. Wholly equal rows are told apart by their number among equals
and are interchangeable.

Defined cases: a null or empty text has size 0; its fraction is rounded by
hash alone, as it moves no words. A null source is a source, the last in order.
A source without any word has target 0 and gives no copy. Null ids do no harm.
An empty table gives an empty table.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tslines.llm import common
from tslines.operators import ordered

WEIGHTS = (5, 2, 1)
#: A target is at most so many times the size of its source.
MOST = 3
#: Documents of one cell on average.
FAN = 64
#: Rows of a file that are numbered together.
NUMBERED = 1 << 16
#: Bytes of the table of sources that may be broadcast.
SOURCES_BYTES = 8 << 20
SEED = "mix"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds `target` to the stored table (pos, source, source_size, n).

    Targets are the smaller of weight times one common level and the cap; the
    level rises until the targets use up all sizes. Each round is one aggregate
    over the sources, and caps more of them or ends.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.col("pos") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * most
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    level, known = 0.0, -1
    while True:
        capped = weight * F.lit(level) >= cap
        free, used, n = sizes.agg(F.sum(F.when(~capped, weight)), F.sum(F.when(capped, cap)),
                                  F.count(F.when(capped, 1))).first()
        if n == known or not free:
            break
        known, level = n, (total - (used or 0)) / free
    return sizes.withColumn("target", F.least(weight * F.lit(level), cap.cast("double")))


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds `i`, a row's number among rows of equal `key`, without bringing a key together."""
    rows = rows.withColumn("_part", F.call_function("div", F.col("row"), F.lit(NUMBERED)))
    here = Window.partitionBy("key", "file", "_part").orderBy("row")
    before = (Window.partitionBy("key").orderBy("file", "_part")
              .rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.groupBy("key", "file", "_part").agg(F.count("*").alias("_n"))
    parts = parts.select("key", "file", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    return (rows.withColumn("_at", F.row_number().over(here) - 1)
            .join(parts, ["key", "file", "_part"])
            .withColumn("i", F.col("_from") + F.col("_at")).drop("_part", "_at", "_from"))


def _step(state: Column, b: Column) -> Column:
    """Move words between the open document and the next one until one is decided."""
    a = state["open"]
    up = F.least((1 - a["f"]) * a["size"], b["f"] * b["size"])
    down = F.least(a["f"] * a["size"], (1 - b["f"]) * b["size"])
    chance = F.when(up + down > 0, down / (up + down)).otherwise(F.lit(0.0))
    rise = common.unsigned_share(SEED, a["key"], a["i"], b["key"], b["i"]) < chance
    a_ends = F.when(rise, (1 - a["f"]) * a["size"] <= b["f"] * b["size"]).otherwise(
        a["f"] * a["size"] <= (1 - b["f"]) * b["size"])
    left = lambda x, f: F.struct(x["size"].alias("size"), x["key"].alias("key"),
                                 x["i"].alias("i"), F.least(F.greatest(f, F.lit(0.0)), F.lit(1.0)).alias("f"))
    goes_on = F.when(a_ends, left(b, b["f"] + F.when(rise, -up).otherwise(down) / b["size"])) \
        .otherwise(left(a, a["f"] + F.when(rise, up).otherwise(-down) / a["size"]))
    ended = F.struct(F.when(a_ends, a["key"]).otherwise(b["key"]).alias("key"),
                     F.when(a_ends, a["i"]).otherwise(b["i"]).alias("i"),
                     (a_ends == rise).cast("int").alias("up"))
    return F.struct(goes_on.alias("open"), F.concat(state["done"], F.array(ended)).alias("done"))


def _round(items: DataFrame, largest: int, fan: int) -> DataFrame:
    """(key, i, up) for every item (pos, cells, size, key, i, f) with 0 < f < 1."""
    decided, cells = [], largest
    level = items
    while True:
        cells = max(1, -(-cells // fan))
        level = (level.withColumn("cells", F.ceil(F.col("cells") / fan))
                 .withColumn("cell", F.pmod(F.xxhash64(F.lit(SEED), "key", "i", "cells"), "cells"))
                 .groupBy("pos", "cells", "cell")
                 .agg(F.sort_array(F.collect_list(F.struct("size", "key", "i", "f")), False).alias("x")))
        start = F.struct(F.element_at("x", 1).alias("open"),
                         F.array().cast("array<struct<key:bigint,i:bigint,up:int>>").alias("done"))
        level = common.stage(level.select("pos", "cells", F.aggregate(
            F.slice("x", 2, F.size("x")), start, _step).alias("s")), "cells")
        decided.append(level.select(F.explode("s.done").alias("d")).select("d.*"))
        level = level.select("pos", "cells", "s.open.*")
        if cells == 1:
            break
    last = (common.unsigned_share(SEED, F.col("key"), F.col("i")) < F.col("f")).cast("int")
    decided.append(level.select("key", "i", last.alias("up")))
    return reduce(DataFrame.unionByName, decided)


# Fixed form: what Spark's writers put into file names to tell jobs apart.
_JOB = "[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"


def _file(docs: DataFrame) -> Column:
    """A number for a row's file that does not depend on the folder, nor on the job that wrote it.

    So the joins below deal rows out and sort them alike when the same rows are
    stored again. Files whose names do not tell them apart are known by their paths.
    """
    path = docs.metadataColumn("_metadata")["file_path"]
    names = [re.sub(_JOB, "", f.rpartition("/")[2]) for f in docs.inputFiles()]
    if len(set(names)) < len(names):
        return F.xxhash64(path)
    return F.xxhash64(F.regexp_replace(F.regexp_extract(path, "[^/]+$", 0), _JOB, ""))


def copies(docs: DataFrame, id_: str = "doc_id", text: str = "text", source: str = "source",
           weights=WEIGHTS, most: int = MOST, fan: int = FAN) -> DataFrame:
    """How often each row of a stored table is taken.

    `docs` must be a scan of files, whose row positions are the rows' identity
    (file, row). Returned with them: doc_id, size, source_size, target, copies.
    """
    place = docs.metadataColumn("_metadata")
    rows = common.stage(docs.select(
        F.col(id_).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"),
        F.xxhash64(*[common.orderable(docs, c) for c in docs.columns]).alias("key"),
        _file(docs).alias("file"), place["row_index"].alias("row")), "sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = common.stage(ordered.global_index(per.withColumn("_null", F.col("source").isNull()),
                                            ["_null", "source"], "pos").drop("_null"), "sources")
    largest, wide = per.agg(F.max("n"), F.sum(F.coalesce(F.length("source"), F.lit(0)) * 4 + 64)).first()
    per = common.stage(targets(per, weights, most), "targets")
    per = per.withColumnRenamed("source", "_source")
    # the table of sources is broadcast only if it is known to be small
    per = F.broadcast(per) if (wide or 0) <= SOURCES_BYTES else per
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(F.col("mean") + 1e-12)
    rows = _numbered(rows).join(per, F.col("source").eqNullSafe(F.col("_source")))
    rows = common.stage(rows.withColumn("mean", mean).withColumn("whole", whole).withColumn(
        "f", F.greatest(F.col("mean") - F.col("whole"), F.lit(0.0)))
        .drop("source", "_source", "mean"), "items")
    moving = rows.where("size > 0 and f > 1e-12").select(
        "pos", F.col("n").alias("cells"), "size", "key", "i", "f")
    decided = _round(moving, largest or 1, fan)
    alone = (common.unsigned_share(SEED, F.col("key"), F.col("i")) < F.col("f")).cast("int")
    extra = F.when(F.col("size") > 0, F.coalesce("up", F.lit(0))).otherwise(alone)
    return rows.join(decided, ["key", "i"], "left").select(
        "file", "row", "doc_id", "size", "source_size", "target",
        (F.col("whole") + extra).cast("bigint").alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of a stored table, each as often as the mix takes it."""
    place = docs.metadataColumn("_metadata")
    names = [F.col(f"`{c}`").alias(f"_{n}") for n, c in enumerate(docs.columns)]
    rows = docs.select(*names, _file(docs).alias("file"), place["row_index"].alias("row"))
    taken = copies(docs, **how).where("copies > 0").select("file", "row", "copies")
    rows = rows.join(taken, ["file", "row"]).withColumn(
        "_again", F.explode(F.expr("sequence(1, copies)")))
    return rows.select(*[F.col(f"_{n}").alias(c) for n, c in enumerate(docs.columns)])


def op9_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return copies(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("copies")).alias("taken"), "copies")
