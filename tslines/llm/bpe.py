"""Byte-level BPE by an index of where each pair of symbols occurs.

A task cuts its texts into pieces as the vocabulary says and takes the distinct
ones it has not met yet. Their bytes are the symbols of one doubly linked list.
The index maps the rank of each pair that the vocabulary merges to all places
where the pair stands. Ranks are applied in ascending order, from a heap of those
that occur: at each place that still holds the pair, in order, the right symbol
goes and the left one becomes the merged symbol, and the two pairs that arise are
added to their lists. A merge only makes pairs of higher rank, which is checked
when the vocabulary is read, so every rank is applied once and the result is that
of merging piece by piece. A piece of any length costs in proportion to its
length, and what a text costs beyond its new pieces is a lookup.

The vocabulary file is read on the driver and sent to the tasks, its size
checked. Known pieces are kept up to a number and size, then forgotten.

Defined cases: a null or empty text has no token. The string of a special token
in a text is that token, as in the library that defines the format. Very long
texts and pieces are encoded whole. Rows are independent of each other, so
repeated rows, ties and rows without an id need no rule. No rows: no result.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import common

#: How texts are cut before merging; a fixed value of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Largest vocabulary file that is sent to tasks.
FILE_BYTES = 64 << 20
#: Pieces, and bytes of pieces, that a task remembers.
PIECES, PIECE_BYTES = 400_000, 24 << 20
#: Bits of a token id in the key of a pair.
SHIFT = 24
ENCODED = "doc_id bigint, n_tokens bigint, ids binary, decoded string"


def _letters() -> dict[str, int]:
    """Byte of each letter that the file format writes bytes with: printable ones stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """Symbols and merges of a byte-level BPE file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                           "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if (model["type"] != "BPE" or odd or spec["normalizer"] or cut.get("type") != "ByteLevel"
                or cut.get("add_prefix_space") or not cut.get("use_regex", True)):
            raise ValueError("only byte-level BPE without normaliser and prefix space is known")
        letters, ids = _letters(), model["vocab"]
        self.first = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.bytes = [b""] * (1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in ids.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError(f"token {t['content']!r} is matched in a way that is not known")
            self.special[t["content"]] = t["id"]
            self.bytes[t["id"]] = t["content"].encode()
        self.merges: list[tuple[int, int, int]] = []
        # of a pair (a, b), under a << SHIFT | b
        self.rank: dict[int, int] = {}
        made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, new = ids[a], ids[b], ids[a + b]
            made[new] = rank
            self.merges.append((left, right, new))
            self.rank[left << SHIFT | right] = rank
        # else a merge could make a pair of lower rank than its own
        for rank, (left, right, _) in enumerate(self.merges):
            if max(made.get(left, -1), made.get(right, -1)) >= rank:
                raise ValueError(f"merge {rank} does not come after all that make its parts")
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                   + ")") if self.special else None
        self.cut = regex.compile(PATTERN)
        # ranks of pairs of bytes, -1 for none
        self.byte_rank = np.array([[self.rank.get(a << SHIFT | b, -1) for b in self.first] for a in self.first],
                                  np.int64)
        self.byte_id = np.array(self.first, np.int64)


@lru_cache(2)
def vocabulary(data: bytes) -> Vocabulary:
    return Vocabulary(data)


def merge_all(pieces: list[bytes], words: Vocabulary, kind: str = "<u4") -> list[bytes]:
    """Token ids of each piece, by one index of all their pairs; ids as numbers of type `kind`."""
    rank_of, merges = words.rank.get, words.merges
    size = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    total, ends = len(data), np.cumsum(size)
    if not total:
        return [b""] * len(pieces)
    last, begin = ends[size > 0] - 1, (ends - size)[size > 0]
    after, before = np.arange(1, total + 1), np.arange(-1, total - 1)
    after[last], before[begin] = -1, -1
    # the places of all pairs of bytes, by rank
    found = np.append(words.byte_rank[data[:-1], data[1:]], -1)
    found[last] = -1
    place = np.argsort(found, kind="stable")
    place = place[np.searchsorted(found[place], 0):]
    ranks, at = np.unique(found[place], return_index=True)
    where = dict(zip(ranks.tolist(), (x.tolist() for x in np.split(place, at[1:])))) if len(place) else {}
    active = ranks.tolist()  # in order, which makes it a heap
    symbol, after, before = words.byte_id[data].tolist(), after.tolist(), before.tolist()
    while active:
        rank = heappop(active)
        left, right, new = merges[rank]
        base = new << SHIFT
        for i in sorted(where.pop(rank)):
            if symbol[i] != left:
                continue  # another place of this list, or a lower rank, took it
            j = after[i]
            if j < 0 or symbol[j] != right:
                continue
            symbol[i], symbol[j] = new, -1
            after[i] = k = after[j]
            h = before[i]
            if h >= 0:
                got = rank_of(symbol[h] << SHIFT | new)
                if got is not None:
                    if got in where:
                        where[got].append(h)
                    else:
                        where[got] = [h]
                        heappush(active, got)
            if k >= 0:
                before[k] = i
                got = rank_of(base | symbol[k])
                if got is not None:
                    if got in where:
                        where[got].append(i)
                    else:
                        where[got] = [i]
                        heappush(active, got)
    symbols = np.array(symbol)
    left_over = symbols >= 0
    ids = symbols[left_over].astype(kind)
    stop = np.concatenate(([0], np.cumsum(left_over)))[ends] * ids.itemsize
    raw, stop = ids.tobytes(), stop.tolist()
    return [raw[a:b] for a, b in zip([0, *stop], stop)]


class Encoder:
    """Token ids of texts; remembers the pieces it has met, up to a bound.

    `kind` is the type of an id. Without `special` the strings of special tokens
    are text like other.
    """

    def __init__(self, words: Vocabulary, pieces: int = PIECES, size: int = PIECE_BYTES,
                 kind: str = "<u4", special: bool = True):
        self.words, self.most, self.largest, self.kind = words, pieces, size, kind
        self.special = words.special if special else {}
        self.known: dict[str, bytes] = {}
        self.size = 0

    def _pieces(self, text: str) -> list[str]:
        words = self.words
        if not any(s in text for s in self.special):
            return words.cut.findall(text)
        out = []
        for part in words.split.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += words.cut.findall(part)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if len(self.known) > self.most or self.size > self.largest:
            self.known, self.size = {}, 0
        cut = [self._pieces(t) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.known))
        special = self.special
        for piece in new:
            if piece in special:
                self.known[piece] = np.array([special[piece]], self.kind).tobytes()
        new = [p for p in new if p not in special]
        data = [p.encode("utf-8", "surrogatepass") for p in new]
        self.known.update(zip(new, merge_all(data, self.words, self.kind)))
        self.size += sum(map(len, data))
        known = self.known
        return [b"".join([known[p] for p in pieces]) for pieces in cut]

    def decode(self, ids: bytes) -> str:
        table = self.words.bytes
        return b"".join([table[i] for i in np.frombuffer(ids, self.kind).tolist()]).decode("utf-8", "replace")


def _parts(texts: list[str | None], size: int = common.BLOCK):
    """Ranges of texts of about `size` characters together, or of one longer text."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text or "") > size:
            yield start, i
            start, held = i, 0
        held += len(text or "")
    if start < len(texts):
        yield start, len(texts)


def _encode(shared, decoded: bool):
    def run(batches):
        coder = Encoder(vocabulary(shared.value))
        for batch in batches:
            docs, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for a, b in _parts(texts):
                ids = coder.encode(texts[a:b])
                back = [coder.decode(x) if decoded else None for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(a, b - a), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(back, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"])
    return run


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def shared_file(spark: SparkSession, path: str | None = None):
    """A vocabulary file, checked, for all tasks."""
    path = path or default_path()
    if os.path.getsize(path) > FILE_BYTES:
        raise ValueError(f"{path} is larger than {FILE_BYTES} bytes")
    with open(path, "rb") as f:
        data = f.read()
    vocabulary(data)  # what is wrong with it shows here
    return spark.sparkContext.broadcast(data)


def encode(docs: DataFrame, path: str | None = None, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit numbers), and on request the text decoded from them."""
    shared = shared_file(docs.sparkSession, path)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _encode(shared, decoded), ENCODED)


def op13_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(common.table(spark, sf_dir, "documents"), decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
