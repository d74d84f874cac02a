"""Training order: a keyed permutation, and shards of fixed stride.

Documents become token ids (a public byte-level BPE vocabulary read from a
path) plus an end mark, cut into sequences of fixed length. Sequences are
numbered 0..N-1 in the order of the stored table (file, row, part). A Feistel
network with a key permutes the numbers, walking cycles until the result is
below N, and that is a sequence's global slot. The shard is the slot divided by
the shard's length; each shard is sorted by slot in one task and written by
Spark's own committer, so a lost executor or a second attempt leaves no half
shard.

A record is 16 bytes of head (doc_id, part, number of tokens), LENGTH token
ids of two bytes, and a zero mark of two bytes, all little-endian. Slot s is
at byte (s mod PER_SHARD) * STRIDE of shard s div PER_SHARD, so a reader can
stop and go on anywhere.

Tokens are made once: tasks store them compressed, in blocks of documents that
follow each other, without padding. The number of sequences of each stretch of
rows that a task read is all that the driver needs for numbering. A second job
reads the blocks, gives every sequence its slot, and sends what goes to one task
as one compressed string; padding is made where the shards are written. The
numbers do not depend on how files are split.

Defined cases: a null or empty text is one sequence of the end mark alone.
Null ids are written as the smallest 64-bit number and read back as null.
Repeated rows are written as often as they are there. An empty table makes no
shard.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines import session
from tslines.llm import common

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's text is cut before merging; a fixed value of that vocabulary.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
END = 50256
LENGTH = 256
PER_SHARD = 1 << 15
KEY = 0x5EED0FDA7A
ROUNDS = 6
#: Bytes of text that are encoded at once.
PIECE = 1 << 20
#: Bytes of token ids that are compressed together, and how hard: as stored, and as sent.
BLOCK_BYTES, LEVEL, SENT_LEVEL = 8 << 20, 6, 9
#: Shards that one task writes, at most.
SHARDS_PER_TASK = 8
HEAD = np.dtype([("doc", "<i8"), ("part", "<i4"), ("n", "<i4")])
NO_ID = np.iinfo(np.int64).min
SHOWN = "slot bigint, shard bigint, doc_id bigint, part int, n_tokens int, tokens_xxh128 string"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def record(length: int) -> np.dtype:
    """Head and token ids; in a file the mark of two bytes follows."""
    return np.dtype([*((n, HEAD[n]) for n in HEAD.names), ("ids", "<u2", (length,))])


@lru_cache(2)
def _encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("stored", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _pieces(text: str) -> Iterator[str]:
    """A text cut before single spaces, where a token begins in any case."""
    start = 0
    while len(text) - start > PIECE:
        cut = _BETWEEN.search(text, start + PIECE)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def tokens(text: str, path: str = VOCABULARY) -> bytes:
    """Token ids as two-byte numbers; long texts are encoded in pieces."""
    coder = _encoder(path)
    return b"".join(array("H", coder.encode_ordinary(p)).tobytes() for p in _pieces(text))


def permute(x: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """Slots of the numbers `x` below `n`: a balanced Feistel network, cycles walked.

    The network permutes the smallest even number of bits that holds n - 1, at
    most four times n values, so a few steps bring every number below n.
    """
    half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    low = np.uint64((1 << int(half)) - 1)
    keys = common.mix64(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                        + np.uint64(key))

    def once(v):
        left, right = v >> half, v & low
        for k in keys:
            left, right = right, left ^ (common.mix64(right + k) & low)
        return (left << half) | right

    out = once(x.astype(np.uint64))
    while (far := out >= np.uint64(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def _cut(text: str | None, path: str) -> bytes:
    return tokens(text or "", path) + array("H", [END]).tobytes()


def _runs(batch: pa.RecordBatch):
    """Row ranges of a batch that follow each other in one file."""
    files, rows = batch.column("file").to_pylist(), batch.column("row").to_numpy()
    start = 0
    for i in range(1, len(files) + 1):
        if i == len(files) or files[i] != files[i - 1] or rows[i] != rows[i - 1] + 1:
            yield start, i, files[start], int(rows[start])
            start = i


_STAGED = "file string, stretch bigint, before bigint, n bigint, n_docs int, raw bigint, body binary"
_TYPES = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())


def _codec(level: int = LEVEL) -> pa.Codec:
    return pa.Codec("zstd", compression_level=level)


def _tokenise(path: str, length: int):
    """Blocks of token ids of rows that follow each other in a file.

    `stretch` is the first row of those that the task reads in one go, `before`
    the sequences of it that come before the block, `n` those of the block.
    """
    def block(codec, file, stretch, before, n, docs, sizes, ids):
        body = b"".join((np.array(docs, "<i8").tobytes(), np.array(sizes, "<i4").tobytes(), *ids))
        row = (file, stretch, before, n, len(docs), len(body), codec.compress(body, asbytes=True))
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, _TYPES)],
                                          names=[f.split()[0] for f in _STAGED.split(", ")])

    def run(batches):
        codec = _codec()
        file, stretch, row, before = None, 0, -1, 0
        docs, sizes, ids, n, held = [], [], [], 0, 0
        for batch in batches:
            texts, names = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b, name, first in _runs(batch):
                if (name, first) != (file, row):
                    if docs:
                        yield block(codec, file, stretch, before, n, docs, sizes, ids)
                    docs, sizes, ids, n, held = [], [], [], 0, 0
                    file, stretch, before = name, first, 0
                row = first + b - a
                for doc, text in zip(names[a:b], texts[a:b]):
                    own = _cut(text, path)
                    docs.append(NO_ID if doc is None else doc)
                    sizes.append(len(own) // 2)
                    ids.append(own)
                    n += -(-len(own) // (2 * length))
                    held += len(own)
                    if held >= BLOCK_BYTES:
                        yield block(codec, file, stretch, before, n, docs, sizes, ids)
                        before += n
                        docs, sizes, ids, n, held = [], [], [], 0, 0
        if docs:
            yield block(codec, file, stretch, before, n, docs, sizes, ids)
    return run


def _sequences(body: bytes, n_docs: int, length: int) -> np.ndarray:
    """The records of a block, each document's tokens cut and padded."""
    kind = record(length)
    docs = np.frombuffer(body, "<i8", n_docs)
    sizes = np.frombuffer(body, "<i4", n_docs, 8 * n_docs).astype(np.int64)
    ids = np.frombuffer(body, "<u2", offset=12 * n_docs)
    count = -(-sizes // length)
    last = np.cumsum(count)
    out = np.zeros(last[-1], kind)
    out["doc"] = np.repeat(docs, count)
    out["part"] = np.arange(last[-1]) - np.repeat(last - count, count)
    out["n"] = length
    out["n"][last - 1] = sizes - (count - 1) * length
    flat = np.zeros(last[-1] * length, "<u2")
    flat[np.arange(len(ids)) + np.repeat((last - count) * length - (np.cumsum(sizes) - sizes), sizes)] = ids
    out["ids"] = flat.reshape(-1, length)
    return out


def _deal(length: int, starts, total: int, key: int, per_task: int):
    """What of a block goes to each task: slots and records, as one compressed string."""
    def run(batches):
        codec = _codec(SENT_LEVEL)
        for batch in batches:
            for file, stretch, before, n_docs, raw, body in zip(*(
                    batch.column(c).to_pylist() for c in ("file", "stretch", "before", "n_docs", "raw", "body"))):
                rows = _sequences(codec.decompress(body, raw, asbytes=True), n_docs, length)
                number = starts.value[file, stretch] + before
                slots = permute(np.arange(number, number + len(rows)), total, key)
                order = np.argsort(slots)
                slots, rows = slots[order], rows[order]
                task = slots // per_task
                cut = np.concatenate(([0], np.flatnonzero(np.diff(task)) + 1, [len(task)]))
                made = [codec.compress(slots[a:b].tobytes() + rows[a:b].tobytes(), asbytes=True)
                        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(task[cut[:-1]].astype(np.int32)), pa.array(np.diff(cut).astype(np.int32)),
                     pa.array(made, pa.binary())], names=["task", "n", "body"])
    return run


def _unpack(length: int):
    """(slot, record) of the strings that a task got."""
    def run(batches):
        codec, kind = _codec(), record(length)
        for batch in batches:
            for n, body in zip(batch.column("n").to_pylist(), batch.column("body").to_pylist()):
                data = codec.decompress(body, n * (8 + kind.itemsize), asbytes=True)
                ends = np.arange(n + 1, dtype=np.int32) * kind.itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(data, "<i8", n)), pa.Array.from_buffers(
                        pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(data).slice(8 * n)])],
                    names=["slot", "body"])
    return run


def write_shards(docs: DataFrame, folder: str, path: str = VOCABULARY, length: int = LENGTH,
                 per_shard: int = PER_SHARD, key: int = KEY) -> int:
    """Write shards of a stored table of documents; returns the number of sequences.

    `docs` must be a scan of files. The only thing that reaches the driver is a
    number for each stretch of rows that a task reads. The blocks of tokens stay
    below the shared folder until the job that reads them is done.
    """
    spark = docs.sparkSession
    place = docs.metadataColumn("_metadata")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       place["file_path"].alias("file"), place["row_index"].alias("row"))
    stored = session.scratch(spark, "tokens")
    rows.mapInArrow(_tokenise(path, length), _STAGED).write.option("compression", "none").parquet(stored)
    blocks = spark.read.schema(_STAGED).parquet(stored)
    starts, total = {}, 0
    for r in sorted(blocks.groupBy("file", "stretch").agg(F.sum("n").alias("n")).collect()):
        starts[r["file"], r["stretch"]] = total
        total += r["n"]
    shared = spark.sparkContext.broadcast(starts)
    # a few shards to a task, but as many tasks as there are anyway
    n_shards = max(1, -(-total // per_shard))
    shards = min(SHARDS_PER_TASK, max(1, n_shards // session.default_partitions(spark)))
    dealt = blocks.mapInArrow(_deal(length, shared, total, key, shards * per_shard), "task int, n int, body binary")
    out = (dealt.repartitionById(-(-n_shards // shards), F.col("task"))
           .mapInArrow(_unpack(length), "slot bigint, body binary")
           .withColumn("shard", F.expr(f"slot div {per_shard}")))
    (out.sortWithinPartitions("shard", "slot")
     .select("shard", F.col("body").cast("string").alias("value"))
     .write.partitionBy("shard").option("lineSep", "\0\0").text(folder))
    session.discard(spark, stored)
    return total


def read_shards(spark: SparkSession, folder: str, length: int = LENGTH,
                per_shard: int = PER_SHARD, first: int = 0, stop: int | None = None) -> DataFrame:
    """slot, shard, doc_id, part, n_tokens and the token ids' XXH3 digest of every record.

    A reader that was interrupted goes on at the slot `first`, and ends before
    `stop`: only the shards in between are opened, each from its own first byte on.
    """
    kind = np.dtype([("row", record(length)), ("mark", "<u2")])
    head, digest = HEAD.itemsize, xxhash.xxh3_128_hexdigest

    def run(batches):
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns)):
                shard = int(name.rpartition("/shard=")[2].partition("/")[0])
                low = max(first - shard * per_shard, 0)
                high = None if stop is None else max(stop - shard * per_shard, low) * kind.itemsize
                view = memoryview(data)[low * kind.itemsize:high]
                rows = np.frombuffer(view, kind)["row"]
                size = rows["n"].tolist()
                marks = [digest(view[a:a + 2 * n]) for a, n in
                         zip(range(head, len(view), kind.itemsize), size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(rows)) + (shard * per_shard + low)),
                     pa.array(np.full(len(rows), shard)),
                     pa.array(rows["doc"].copy(), mask=rows["doc"] == NO_ID),
                     pa.array(rows["part"].copy()), pa.array(rows["n"].copy()), pa.array(marks)],
                    names=["slot", "shard", "doc_id", "part", "n_tokens", "tokens_xxh128"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(common.BATCH_ROWS))
    files = (spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary").load(folder))
    if first:
        files = files.where(F.col("shard") >= first // per_shard)
    if stop is not None:
        files = files.where(F.col("shard") <= (stop - 1) // per_shard)
    return files.select("path", "content").mapInArrow(run, SHOWN)


def materialise(docs: DataFrame, **how) -> DataFrame:
    """Write the shards into a new folder below the shared one and list their records."""
    folder = session.scratch(docs.sparkSession, "shards")
    if not write_shards(docs, folder, **how):
        return docs.sparkSession.createDataFrame([], SHOWN)
    layout = {k: v for k, v in how.items() if k in ("length", "per_shard")}
    return read_shards(docs.sparkSession, folder, **layout)


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(common.table(spark, sf_dir, "documents"))
