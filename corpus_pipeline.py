"""A corpus from raw documents to training shards, in five stages.

Each stage takes (spark, docs, sf_dir), where `docs` is what the one before has
written, and works on all of it. All but the last return the columns of
documents. The last returns one row per written sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines import session
from tslines.llm import common, decontaminate, language, mixing, order, simhash


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in known languages, one or several; what has no letter goes."""
    common.prepare(spark)
    return language.keep_identified(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links at two bits or fewer, the document with the smallest id."""
    common.prepare(spark)
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    common.prepare(spark)
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order, and a row for each of their records."""
    common.prepare(spark)
    return order.materialise(docs)


STAGES = [("languages", languages), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixture", mixture), ("shards", shards)]

#: Random choices, trained models and token files have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each one's rows are written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = session.scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
