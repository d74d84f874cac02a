"""Lines taken apart and cut in columns, against a parser that goes byte by byte."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tslines import session
from tslines.functions import lines
from tslines.operators import decode
from tslines.sources import messages


class Bad(Exception):
    pass


def token(buf, i, stops):
    """End of a token; a backslash takes the next byte with it."""
    while i < len(buf) and buf[i] not in stops:
        i += 2 if buf[i] == 92 else 1
    if i > len(buf):
        raise Bad
    return i


def said(raw):
    out, i = bytearray(), 0
    while i < len(raw):
        i += raw[i] == 92
        out.append(raw[i])
        i += 1
    return out.decode()


def whole(raw):
    body = raw[1:] if raw[:1] == b"-" else raw
    if not body or not all(48 <= c <= 57 for c in body):
        raise Bad
    return int(raw)


def bits(n):
    if not -2**63 <= n < 2**63:
        raise Bad
    return n


def bare(raw):
    if raw in (b"t", b"T", b"f", b"F", b"true", b"false"):
        return "boolean", chr(raw[0]).lower(), None
    kind = {105: "integer", 116: "timestamp_us", 110: "timestamp_ns"}.get(raw[-1]) if raw else None
    if kind:
        bits(whole(raw[:-1]))
        return kind, raw[:-1].decode(), None
    if raw.lstrip(b"-") in (b"NaN", b"Infinity") and raw[:2] != b"--":
        return "float", raw.decode(), float(raw)
    if not raw or set(raw) - set(b"0123456789.eE+-") or raw[-1] in b"eE+-":
        raise Bad
    try:
        return "float", raw.decode(), float(raw)
    except ValueError:
        raise Bad from None


def binary(buf, i):
    tag = buf[i]
    if tag == 16:
        return "float", None, struct.unpack_from("<d", buf, i + 1)[0], None, None, i + 9
    if tag == 14 and buf[i + 1] == 10 and 1 <= buf[i + 2] <= 32:
        dims = struct.unpack_from(f"<{buf[i + 2]}i", buf, i + 3)
        if min(dims) < 0:
            raise Bad
        at, n = i + 3 + 4 * len(dims), int(np.prod([float(d) for d in dims]))
        if at + 8 * n > len(buf):
            raise Bad
        return "array", None, None, list(struct.unpack_from(f"<{n}d", buf, at)), list(dims), at + 8 * n
    if tag == 23 and buf[i + 1] <= 76 and 1 <= buf[i + 2] <= 32:
        end = i + 3 + buf[i + 2]
        if end > len(buf):
            raise Bad
        n = int.from_bytes(buf[i + 3:end], "big", signed=True)
        digits = str(abs(n)).rjust(buf[i + 1] + 1, "0")
        cut = len(digits) - buf[i + 1]
        shown = digits[:cut] + ("." + digits[cut:] if buf[i + 1] else "")
        return "decimal", "-" * (n < 0) + shown, None, None, None, end
    raise Bad


def parse(buf, i=0, text=False, frame=False):
    """(row, end) of the line at `i`."""
    seps = b", " if text else b", \n"
    start, i = i, token(buf, i, seps)
    if i == start:
        raise Bad
    tbl, symbols, fields, at, unit = said(buf[start:i]), [], [], None, None

    def key(i):
        end = token(buf, i, seps + b"=")
        if end >= len(buf) or buf[end] != 61:
            raise Bad
        return said(buf[i:end]), end + 1

    def stamp(i):
        end = i
        while end < len(buf) and buf[end] in b"-0123456789tn":
            end += 1
        if end < len(buf) and not (frame and buf[end] == 10):
            return None
        raw = buf[i:end]
        body = raw[:-1] if raw[-1:] in (b"t", b"n") else raw
        try:
            return bits(whole(body)), "us" if raw[-1:] == b"t" else "ns", end
        except Bad:
            if body.lstrip(b"-").isdigit() and body.count(b"-") <= 1:
                raise
            return None

    while i < len(buf) and buf[i] == 44:
        name, i = key(i + 1)
        end = token(buf, i, seps)
        symbols.append((name, said(buf[i:end])))
        i = end
    if i < len(buf) and buf[i] == 32 and not stamp(i + 1):
        while True:
            name, i = key(i + 1)
            if i >= len(buf):
                raise Bad
            if buf[i] == 61 and not text:
                *value, i = binary(buf, i + 1)
            elif buf[i] == 34:
                end = token(buf, i + 1, b'"')
                if end >= len(buf):
                    raise Bad
                value, i = ("string", said(buf[i + 1:end]), None, None, None), end + 1
            else:
                end = token(buf, i, seps)
                value, i = (*bare(buf[i:end]), None, None), end
            fields.append((name, *value))
            if i >= len(buf) or buf[i] != 44:
                break
    if i < len(buf) and buf[i] == 32:
        found = stamp(i + 1)
        if not found:
            raise Bad
        at, unit, i = found
    if not (symbols or fields) or i < len(buf) and not (frame and buf[i] == 10):
        raise Bad
    return (tbl, symbols, fields, at, unit), i


def plain(buf, text):
    try:
        return parse(buf, 0, text)[0]
    except (Bad, IndexError, struct.error, UnicodeDecodeError):
        return None


def taken(cells, text):
    out = []
    for r in lines.take_apart(cells, text).to_pylist():
        if not r["ok"]:
            assert r["tbl"] is None and r["symbols"] == r["fields"] == [] and r["at"] is r["at_unit"] is None
            out.append(None)
            continue
        fields = [(f["name"], f["kind"], f["text"], *(() if text else (f["number"], f["numbers"], f["dims"])))
                  for f in r["fields"]]
        out.append((r["tbl"], [(s["name"], s["value"]) for s in r["symbols"]], fields, r["at"], r["at_unit"]))
    return out


def some(rng, text):
    word = lambda: "".join(rng.choice(["a", "B", "\\ ", "\\,", "\\=", "\\\\", "ß", "☃", '"', "1", "\\\n", "-"])
                           for _ in range(rng.randrange(1, 4)))
    quoted = lambda: "".join(rng.choice(["a", " ", ",", "=", '\\"', "\\\\", "\n", "é", "==", "\\\n"])
                             for _ in range(rng.randrange(5)))
    out = word().encode()
    for _ in range(rng.randrange(3)):
        out += f",{word()}={word()}".encode()
    values = ["1i", "-5i", "t", "F", "true", "12t", "-7n", "1.5", "-.5e3", "5.", "+2", "NaN", "-Infinity", "1e9",
              "9223372036854775807i", "-9223372036854775808i", "9223372036854775808i", "00000000000000000000001i",
              "99999999999999999999t", "1_0", "x", "--1i", "i", "1.5i", "inf", "0x1"]
    for k in range(rng.randrange(5)):
        out += (" " if not k else ",").encode() + word().encode() + b"="
        pick = rng.randrange(6)
        if pick < 2 or text and pick > 2:
            out += f'"{quoted()}"'.encode()
        elif pick == 2:
            out += rng.choice(values[:18] if rng.random() < .9 else values).encode()
        elif pick == 3:
            out += b"=\x10" + bytes(rng.choice(b'\n\\,"= \x01\xff') for _ in range(8))
        elif pick == 4:
            dims = [rng.randrange(3) for _ in range(rng.randrange(1, 4))]
            out += b"=\x0e\x0a" + bytes([len(dims)]) + struct.pack(f"<{len(dims)}i", *dims) + bytes(
                rng.choice(b"\n\\, \x40") for _ in range(8 * int(np.prod(dims))))
        else:
            width = rng.randrange(1, 33)
            out += b"=\x17" + bytes([rng.randrange(77), width]) + bytes(rng.randrange(256) for _ in range(width))
    if rng.random() < .6:
        out += rng.choice([b" 5", b" -5t", b" 77n", b" 9223372036854775808", b" 1x", b" ", b" 5 6"]
                          if rng.random() < .2 else [b" 5", b" -5t", b" 1700000000000000000n"])
    if rng.random() < .3:
        at = rng.randrange(len(out) + 1)
        out = out[:at] + rng.choice([b"", b" ", b",", b"=", b"\\", b'"', b"\n", b"\xff", b"=="]) + out[at + rng.randrange(2):]
    return out


@pytest.mark.parametrize("text", [False, True])
def test_lines_against_bytes(text, monkeypatch):
    rng = random.Random(5 + text)
    cells = [some(rng, text) for _ in range(4000)] + [b"", b"a", b"a,", b"a ", b"a b", b"a b=", b"a b==", b"\\", b"a\\"]
    if text:
        cells = [c for c in cells if plain(c, False) is not False and c.decode("utf-8", "ignore").encode() == c]
    want = [plain(c, text) for c in cells]
    if text:
        want = [w and (*w[:2], [f[:3] for f in w[2]], *w[3:]) for w in want]
    kind = pa.string() if text else pa.binary()
    for block in (lines.BLOCK, 300):
        monkeypatch.setattr(lines, "BLOCK", block)
        got = taken(pa.array(cells, kind), text)
        for c, g, w in zip(cells, got, want):
            assert repr(g) == repr(w), c
    assert 300 < sum(w is None for w in want) < 3000
    assert taken(pa.array([None, *cells[:3]], kind)[1:], text) == taken(pa.array(cells[:3], kind), text)
    assert taken(pa.array([None], kind), text) == [None] and taken(pa.array([], kind), text) == []


def plain_frames(data):
    """Lines one after the other; a malformed one goes to its first line end that is not escaped."""
    out, i = [], 0
    while i < len(data):
        try:
            end = parse(data, i, frame=True)[1]
            if end >= len(data):
                raise Bad
        except (Bad, IndexError, struct.error, UnicodeDecodeError):
            end = i
            while end < len(data) and data[end] != 10:
                end += 2 if data[end] == 92 else 1
            if end >= len(data):
                end = len(data) - (data[-1:] == b"\n")
        out.append((i, data[i:end]))
        i = end + 1
    return out


def well_formed(rng, n):
    out = []
    while len(out) < n:
        line = some(rng, False)
        if plain(line, False) and parse(line + b"\nz", frame=True)[1] == len(line):
            out.append(line)
    return out


@pytest.mark.parametrize("size", [40, 700, 1 << 20])
def test_payload_windows(size):
    rng = random.Random(6)
    good = well_formed(rng, 300)
    data = b"".join(x + b"\n" for x in good)
    got = [(a, data[a:b]) for part in lines.frames(np.frombuffer(data, np.uint8), size) for a, b in zip(*part)]
    assert [x for _, x in got] == good and got == plain_frames(data)
    for bad in (b"", b"no fields", b'a b="open', b"a b==\x10123", b"\\\n\\"):
        data = b"".join(x + b"\n" for x in [*good[:20], bad, *good[20:40]])
        parts = list(lines.frames(np.frombuffer(data, np.uint8), size))
        assert sum((b + 1 - a).sum() for a, b in parts) == len(data)
        assert [data[a:b] for part in parts for a, b in zip(*part)][:20] == good[:20]
    assert list(lines.frames(np.zeros(0, np.uint8))) == []


def test_bad_numbers_are_rejects(spark):
    rows = ["t x=1i 99999999999999999999", "t x=9999999999999999999i", "t x=9999999999999999999t 5", "t x=1i 5t",
            "t x=-9223372036854775808i -9223372036854775808", "t x=00000000000000000000000001i"]
    df = spark.createDataFrame([(r,) for r in rows], "line string")
    for got in (decode.text_lines(df, "line"), decode.binary_lines(
            df.select(F.col("line").cast("binary").alias("line")), "line")):
        assert [r["ok"] for r in got.collect()] == [False, False, False, True, True, True]


@pytest.mark.parametrize("split,head,window", [(300, 64, 128), (1000, 1 << 18, 1 << 20), (5000, 300, 500), (1 << 20, 64, 64)])
def test_message_files(spark, tmp_path, split, head, window):
    rng = random.Random(7)
    files = {"a": well_formed(rng, 400), "b": [], "c": well_formed(rng, 3), "d": well_formed(rng, 150)}
    # cells that look like lines, one of them longer than splits and heads
    fake = b"a b=1i\n" * 400
    files["d"][70:70] = [b'q s="' + fake + b'"', b"q v==\x0e\x0a\x01" + struct.pack("<i", 350) + fake, b"q w=1i"]
    files["c"] += [b'no "line', b"\\", b"c b=1i 5"]
    for name, own in files.items():
        (tmp_path / name).write_bytes(b"".join(x + b"\n" for x in own)[:None if name != "d" else -1])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = messages.read(spark, str(tmp_path), head, window).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name in files:
        got = sorted((r["at_byte"], bytes(r["line"])) for r in rows if r["file"].endswith("/" + name))
        assert got == plain_frames((tmp_path / name).read_bytes())


def test_messages_written_and_read(spark, tmp_path):
    raw = [b"t x==\x10" + struct.pack("<d", float(i)) + b"\n" for i in range(50)]
    df = spark.createDataFrame([(b"".join(raw[:20]),), (b"".join(raw[20:]),)], "payload binary")
    messages.write(df, f"{tmp_path}/m")
    got = decode.binary_lines(messages.read(spark, f"{tmp_path}/m")).select("ok", decode.field("x", "number"))
    assert sorted(map(tuple, got.collect())) == [(True, float(i)) for i in range(50)]
    messages.write(df.limit(0), f"{tmp_path}/none")
    assert messages.read(spark, f"{tmp_path}/none").count() == 0


def test_what_a_python_task_gets_is_bounded_by_bytes(spark):
    """Payloads are large rows, so a batch of many rows would be a large part of a task's input."""
    spark = session.configure(spark)
    lines = spark.range(0, 1200, 1, 1).select(F.encode(F.repeat(F.concat(
        F.lit("t x="), F.col("id").cast("string"), F.lit("i 1t\n")), 3000), "utf-8").alias("payload"))
    held = F.arrow_udf(lambda cells: pa.array([cells.nbytes] * len(cells)), "bigint")
    assert lines.select(held("payload").alias("n")).agg(F.max("n")).first()[0] < 12 << 20
    few = decode.split_binary(lines.limit(3)).groupBy("line").count()
    assert sorted(map(tuple, few.collect())) == [(bytearray(b"t x=%di 1t" % i), 3000) for i in range(3)]


def test_cells_are_looked_up_without_a_lambda(spark):
    """The first cell of a name, as compiled code; what is absent is null."""
    df = spark.createDataFrame([(x,) for x in (b"t,s=a,s=b x=1i,y=2i,x=3i", b"t y=5i", b"no line")], "line binary")
    got = decode.binary_lines(df, "line").select(
        decode.symbol("s"), decode.field("x"), decode.field("y", "kind"), decode.field("none", "number"))
    assert [tuple(r) for r in got.collect()] == [("a", "1", "integer", None), (None, None, "integer", None), (None,) * 4]
    assert "lambdafunction" not in got._jdf.queryExecution().executedPlan().toString()


def test_few_escapes_do_not_slow_all_cells(monkeypatch):
    """Backslashes in binary cells are none; only cells that hold an escape are taken byte by byte."""
    asked, plain_slices = [], lines.slices
    monkeypatch.setattr(lines, "slices", lambda data, a, b, without=None: asked.append(len(a)) or plain_slices(
        data, a, b, without))
    cells = [b"t,s=v x==\x10" + b"\\\\\\abcde" + b",y=1i 5t"] * 500 + [b't,s=v\\ w x="a\\"b",y=1i 5t'] * 2
    got = taken(pa.array(cells, pa.binary()), False)
    assert got == [plain(c, False) for c in cells] and got[-1][1] == [("s", "v w")] and got[-1][2][0][2] == 'a"b'
    assert max(asked) <= 2
