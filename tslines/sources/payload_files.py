"""One file per payload, all files of a commit or none.

A task writes the payloads it gets to a folder of its own, beside the commits and
with a name readers skip, and reports that folder. When all tasks are done, the
driver gathers the reported folders, one move for each task, and moves the whole to
its place in one step. A task that fails, or runs twice, leaves folders that nobody
reports; they go with the staging folder, as everything does when the write fails.
What tasks still write after that goes when the commit is tried again.

Files are reached through pyarrow's file systems, from tasks and from the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tslines import session

FORMAT = "tslines_payload_files"
SUFFIX = ".payload"


@dataclass
class Written(WriterCommitMessage):
    """A folder that a task has filled, and how many files are in it."""

    folder: str
    n_files: int


def _open(path: str) -> tuple[files.FileSystem, str]:
    return files.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _exists(where: files.FileSystem, path: str) -> bool:
    return where.get_file_info(path).type != files.FileType.NotFound


class Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.name = options["path"], options["commit"]
        self.staged = f"_staged/{self.name}@{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        where, base = _open(self.path)
        folder = f"task-{uuid.uuid4().hex}"
        into = f"{base}/{self.staged}/{folder}"
        n = 0
        for batch in batches:
            for name, body in zip(batch.column("name").to_pylist(), batch.column("payload")):
                if not n:
                    where.create_dir(into, recursive=True)
                with where.open_output_stream(f"{into}/{name}{SUFFIX}") as f:
                    f.write(body.as_buffer())
                n += 1
        return Written(folder, n)

    def commit(self, messages: list[Written | None]) -> None:
        where, base = _open(self.path)
        target, staged = f"{base}/commit={self.name}", f"{base}/{self.staged}"
        if not _exists(where, target):
            ready = f"{staged}/ready"
            where.create_dir(ready, recursive=True)
            for m in messages:
                if m is not None and m.n_files:
                    where.move(f"{staged}/{m.folder}", f"{ready}/{m.folder}")
            where.move(ready, target)
        self._clear(where, staged)

    def abort(self, messages: list[Written | None]) -> None:
        where, base = _open(self.path)
        self._clear(where, f"{base}/{self.staged}")

    @staticmethod
    def _clear(where, staged: str) -> None:
        if _exists(where, staged):
            where.delete_dir(staged)


class PayloadFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, payload binary"

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options)


def _clear_attempts(path: str, commit: str) -> None:
    where, base = _open(path)
    if _exists(where, f"{base}/_staged"):
        for left in where.get_file_info(files.FileSelector(f"{base}/_staged")):
            if left.base_name.startswith(f"{commit}@"):
                where.delete_dir(left.path)


def _name(*key) -> str:
    return "-".join("null" if k is None else "=" + quote(str(k), safe="") for k in key)


def write(payloads: DataFrame, path: str, commit: str | int, *key: str) -> None:
    """Write payloads as files below `path/commit=<commit>`; a commit that is there is not written again.

    `key` and `batch_id` name a payload; they make its file's name and must tell
    payloads apart. One commit is written by one writer at a time.
    """
    spark = session.configure(payloads.sparkSession)
    commit = quote(str(commit), safe="")
    if session.exists(spark, f"{path}/commit={commit}"):
        return
    _clear_attempts(path, commit)
    spark.dataSource.register(PayloadFiles)
    named = F.udf(_name, "string")(*[F.col(k).cast("string") for k in (*key, "batch_id")])
    rows = payloads.select(named.alias("name"), F.col("payload").cast("binary").alias("payload"))
    rows.write.format(FORMAT).mode("append").option("commit", commit).save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """`commit`, `name` (of its file), `n_bytes` and `payload` of every committed payload."""
    found = (session.configure(spark).read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", f"*{SUFFIX}").load(f"{path}/commit=*"))
    part = lambda pattern: F.regexp_extract("path", pattern, 1)
    return found.select(part("/commit=([^/]*)/").alias("commit"), part(rf"/([^/]*)\{SUFFIX}$").alias("name"),
                        F.col("length").alias("n_bytes"), F.col("content").alias("payload"))
