"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Parquet INT64 nanoseconds are illegal for Spark's timestamp; read them as BIGINT.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a Python task holds at a time is a few of these, whatever the size of the rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Stateful streaming operators need this store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Only takes effect when the session is created here.
STATIC = {
    "spark.ui.enabled": "false",
    # Checkpoint files go away with the frames that use them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "tslines", master: str | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings all operators rely on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only for a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tslines-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and keeps partitions and their order."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Move a written folder to its place in one step; an unfinished one there goes first."""
    fs, source = _file_system(spark, staged)
    _, target = _file_system(spark, path)
    if fs.exists(target):
        fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{staged} could not be moved to {path}")


def claim(spark: SparkSession, body: str, staged: str, path: str) -> bool:
    """Write a small file and move it to its place; false if something is there already.

    The move is one step that does not overwrite on file systems that promise it.
    """
    fs, source = _file_system(spark, staged)
    _, target = _file_system(spark, path)
    out = fs.create(source, False)
    try:
        out.write(bytearray(body, "utf-8"))
    finally:
        out.close()
    fs.mkdirs(target.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.valueOf("NONE")
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(source), fs.makeQualified(target), how)
        return True
    except Py4JJavaError as taken:
        if "FileAlreadyExistsException" not in str(taken.java_exception):
            raise
        fs.delete(source, False)
        return False


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove folders that were made for one piece of work."""
    for path in paths:
        fs, where = _file_system(spark, path)
        fs.delete(where, True)


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
