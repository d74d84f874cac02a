"""Line bytes per type and version, from the rules of the format."""

import datetime as dt
import re
import struct
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tslines.functions import binary
from tslines.operators import decode, validate
from tslines.operators.encode import encode
from tslines.plans import roles
from tslines.plans.roles import SERVER_TIME, Instant
from tslines.sources import tables


def lines(df, version, **how):
    how.setdefault("table", "m7")
    how.setdefault("at", SERVER_TIME)
    keep, strict = how.pop("keep", []), how.pop("strict", True)
    plan = roles.resolve(df.drop(*keep), version=version, **how)
    rows = encode(df, plan, *keep, strict=strict).collect()
    out = [r["line"].encode() if version == 1 else bytes(r["line"]) for r in rows]
    assert [r["n_bytes"] for r in rows] == [len(x) + 1 for x in out]
    return out


def f64(v, version):
    if version > 1:
        return b"==\x10" + struct.pack("<d", v)
    text = repr(v).replace("+", "")
    return b"=" + {"nan": "NaN", "inf": "Infinity", "-inf": "-Infinity"}.get(text, text).encode()


def bare(s):
    return re.sub(r"([ ,=\n\r\\])", r"\\\1", s).encode()


def quoted(s):
    return b'"' + re.sub(r'(["\n\r\\])', r"\\\1", s).encode() + b'"'


#: kind -> (Spark type, draw, bytes after the name)
KINDS = {
    "text": ("string", lambda g: draw_text(g), lambda v, _: b"=" + quoted(v)),
    "flag": ("boolean", lambda g: bool(g.integers(2)), lambda v, _: b"=t" if v else b"=f"),
    "small": ("int", lambda g: int(g.integers(-2**31, 2**31)), lambda v, _: b"=%di" % v),
    "large": ("bigint", lambda g: int(g.integers(-2**63, 2**63 - 1)), lambda v, _: b"=%di" % v),
    "real": ("double", lambda g: float(g.normal() * 10.0 ** g.integers(-9, 9)), lambda v, version: f64(v, version)),
    "instant": ("timestamp", lambda g: EPOCH + dt.timedelta(microseconds=int(g.integers(2**50))),
                lambda v, _: b"=%dt" % ((v - EPOCH) // dt.timedelta(microseconds=1))),
    "nanos": ("bigint", lambda g: int(g.integers(2**60)),
              lambda v, version: b"=%dt" % (v // 1000) if version == 1 else b"=%dn" % v),
}
EPOCH = dt.datetime(1970, 1, 1)
#: Characters of one to four bytes, and all that is escaped anywhere.
LETTERS = [chr(c) for c in (0x61, 0x7A, 0xDF, 0x3A9, 0x416, 0x5D0, 0x4E2D, 0xAC00, 0x1D11E, 0x1F41F)]
SPECIAL = list(' ,=\n\r\\"')


def draw_text(g, alphabet=None, least=0):
    return "".join(g.choice(alphabet or LETTERS + SPECIAL, int(g.integers(least, 9))))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("version", [1, 2, 3])
def test_random_layouts_follow_the_rules(spark, version, seed):
    """Columns of random kinds, names and order; each line is put together from the rules."""
    g = np.random.default_rng(100 * version + seed)
    kinds = [str(k) for k in g.permutation(list(KINDS) * 2)[:g.integers(3, 12)]]
    names = [f"{i}" + draw_text(g, LETTERS + [" ", "="]) + "x" for i in range(len(kinds))]
    symbol_name = "s" + draw_text(g, LETTERS + [" ", "="])
    rows = []
    for i in range(40):
        cells = [KINDS[k][1](g) if k == "flag" or g.random() < 0.8 else None for k in kinds]
        rows.append((i, draw_text(g, least=1) if g.random() < 0.7 else None, *cells))
    schema = ", ".join(["id int", f"`{symbol_name}` string"]
                       + [f"`{n}` {KINDS[k][0]}" for n, k in zip(names, kinds)])
    df = spark.createDataFrame(rows, schema).coalesce(1)
    for n, k in zip(names, kinds):
        df = roles.mark(df, n, unit="ns") if k == "nanos" else df
    want = []
    for _, symbol, *cells in rows:
        fields = [bare(n) + KINDS[k][2](c, version) for n, k, c in zip(names, kinds, cells) if c is not None]
        head = b"m7" + (b"," + bare(symbol_name) + b"=" + bare(symbol) if symbol is not None else b"")
        if fields or symbol is not None:
            want.append(head + (b" " + b",".join(fields) if fields else b""))
    assert lines(df, version, symbols=[symbol_name], keep=["id"]) == want


@pytest.mark.parametrize("version", [1, 2])
def test_designated_timestamp(spark, version):
    df = spark.createDataFrame([(1, dt.datetime(1970, 1, 1, 0, 0, 1), 1500), (2, None, None)],
                               "x int, us timestamp, ns bigint")
    df = roles.mark(df, "ns", unit="ns")
    us, ns = (b"1000000000", b"1500") if version == 1 else (b"1000000t", b"1500n")
    assert lines(df.drop("ns"), version, at="us") == [b"m7 x=1i " + us, b"m7 x=2i"]
    assert lines(df.drop("us"), version, at=-1) == [b"m7 x=1i " + ns, b"m7 x=2i"]
    fixed = b"5000" if version == 1 else b"5000n"
    assert lines(df.select("x"), version, at=Instant.micros(5))[0] == b"m7 x=1i " + fixed
    when = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    assert lines(df.select("x"), version, at=when)[0].split()[-1].startswith(b"0")


@pytest.mark.parametrize("version", [1, 2])
def test_floats(spark, version):
    """Powers of two and ten with both neighbours, random bit patterns, and what is not a number."""
    g = np.random.default_rng(7)
    edges = np.concatenate([2.0 ** np.arange(-1074, 1024, 37), 10.0 ** np.arange(-320, 309, 11)])
    values = np.concatenate([edges, np.nextafter(edges, 0), np.nextafter(edges, np.inf),
                             g.integers(0, 2**64, 400, dtype=np.uint64).view(np.float64)])
    values = np.concatenate([values, -values, [0.0, -0.0, np.nan, np.inf, -np.inf]]).tolist()
    df = spark.createDataFrame([(v,) for v in values], "f double").coalesce(1)
    assert lines(df, version) == [b"m7 f" + f64(v, version) for v in values]


def test_integer_limits(spark):
    df = spark.createDataFrame([(-2**63, 2**31 - 1, -128), (2**63 - 1, -2**31, 127)],
                               "a bigint, b int, c tinyint")
    assert lines(df, 1) == [b"m7 a=-9223372036854775808i,b=2147483647i,c=-128i",
                            b"m7 a=9223372036854775807i,b=-2147483648i,c=127i"]


@pytest.mark.parametrize("version", [1, 2])
def test_rows_with_nothing_to_write_are_left_out(spark, version):
    df = spark.createDataFrame([("a", None), (None, None), (None, 1)], "s string, x int")
    assert lines(df, version, symbols=["s"]) == [b"m7,s=a", b"m7 x=1i"]


def test_columns_follow_roles_not_input_order(spark):
    df = spark.createDataFrame([(1, "t1", "s1", "s2")], "x int, route string, a string, b string")
    assert lines(df, 1, table=None, table_col="route", symbols=["b", "a"]) == [
        b"t1,a=s1,b=s2 x=1i"]


def arr(a):
    a = np.asarray(a, dtype="<f8")
    return (b"==\x0e\x0a" + bytes([a.ndim]) + b"".join(struct.pack("<i", d) for d in a.shape)
            + a.tobytes())


def test_arrays(spark):
    rows = [([1.5, 2.5], [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]], [[[1.0], [2.0]]]),
            ([], [[7.0], [8.0]], [[[3.0, 4.0]], [[5.0, 6.0]]])]
    df = spark.createDataFrame(
        rows, "a array<double>, b array<array<double>>, c array<array<array<double>>>").coalesce(1)
    got = lines(df, 2)
    assert got == [b"m7 a" + arr(a) + b",b" + arr(b) + b",c" + arr(c) for a, b, c in rows]


def test_ragged_or_null_arrays_are_refused(spark):
    df = spark.createDataFrame([(1, [[1.0], [2.0, 3.0]]), (2, [[1.0, None]]), (3, None),
                                (4, [[9.0]])], "x int, m array<array<double>>").coalesce(1)
    assert lines(df, 2, strict=False) == [b"m7 x=3i", b"m7 x=4i,m" + arr([[9.0]])]
    with pytest.raises(Exception, match="column 'm'"):
        lines(df, 2)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("rows, schema, how, column", [
    ([(1, True), (2, None)], "x int, b boolean", {}, "b"),
    ([(1, Decimal(2**63 - 1)), (2, Decimal(2**63))], "x int, u decimal(20,0)", {}, "u"),
    ([(1, "fine"), (2, None)], "x int, r string", dict(table=None, table_col="r"), "r"),
    ([(1, "fine"), (2, "a/b")], "x int, r string", dict(table=None, table_col="r"), "r"),
])
def test_bad_cells_fail_or_are_set_aside(spark, version, rows, schema, how, column):
    df = spark.createDataFrame(rows, schema)
    if column == "u":
        df = roles.mark(df, "u", unsigned=True)
    with pytest.raises(Exception, match=f"column '{column}'"):
        lines(df, version, **how)
    kept = lines(df, version, strict=False, **how)
    assert len(kept) == 1 and b"x=1i" in kept[0]
    plan = roles.resolve(df, version=version, at=SERVER_TIME, **{"table": "m7", **how})
    assert [r["x"] for r in validate.rejects(df, plan, "x").collect()] == [2]


def dec(unscaled, scale, width):
    return b"==\x17" + bytes([scale, width]) + unscaled.to_bytes(width, "big", signed=True)


def test_decimals(spark):
    rows = [(Decimal("123.45"), Decimal("-0.0005"), Decimal("-12345678901234567890.123456")),
            (Decimal("-99999.99"), Decimal("9999999999.9999"), Decimal(10**32 - 1)),
            (None, None, None)]
    df = spark.createDataFrame(rows, "a decimal(7,2), b decimal(14,4), c decimal(38,6)")
    df = df.withColumn("n", F.lit(1)).coalesce(1)
    shift = lambda v, s: int(Fraction(v) * 10**s)
    want = [b"m7 a" + dec(shift(a, 2), 2, 4) + b",b" + dec(shift(b, 4), 4, 8)
            + b",c" + dec(shift(c, 6), 6, 16) + b",n=1i" for a, b, c in rows[:2]]
    assert lines(df, 3) == [*want, b"m7 n=1i"]


def test_wide_decimal_text(spark):
    """Numbers at and around every byte length up to 256 bits, at random scales."""
    g = np.random.default_rng(17)
    numbers = {0}
    for k in range(1, 33):
        edge = 2 ** (8 * k - 1)
        numbers |= {edge - 1, -edge, int(g.integers(1, 250)) * edge // 251}
        numbers |= {edge, -edge - 1} if k < 32 else set()
    cases = {}
    for n in numbers:
        places = int(g.integers(0, 77))
        digits = str(abs(n)).rjust(places + 1, "0")
        text = digits[:len(digits) - places] + ("." + digits[len(digits) - places:] if places else "")
        cases["-" * (n < 0) + text] = (n, places)
    df = roles.mark(spark.createDataFrame([(k,) for k in cases], "d string").coalesce(1),
                    "d", decimal_text=True)
    for line, (unscaled, scale) in zip(lines(df, 3), cases.values()):
        payload = line[len(b"m7 d==\x17"):]
        assert payload[0] == scale and payload[1] == len(payload) - 2 >= 2
        assert int.from_bytes(payload[2:], "big", signed=True) == unscaled
        assert payload[1] == 2 or not -2**(8 * payload[1] - 9) <= unscaled < 2**(8 * payload[1] - 9)
    beyond = [str(2**255), str(-2**255 - 1), "0." + "0" * 76 + "1", "", "7 8"]
    for values, left in ((beyond, 0), (["Infinity", "-Infinity", "NaN", None], 4)):
        some = roles.mark(spark.createDataFrame([(v,) for v in values], "d string"), "d", decimal_text=True)
        assert lines(some.withColumn("n", F.lit(1)), 3, strict=False) == [b"m7 n=1i"] * left


def test_random_rows_come_back(spark):
    rng = np.random.default_rng(11)
    alphabet = list('ab =,"\\\n\r\tß☃🚀t1i')
    text = lambda: "".join(rng.choice(alphabet, rng.integers(0, 12)))
    rows = [(i, text() or "x", text(), float(rng.normal()), bool(rng.random() < .5),
             None if rng.random() < .3 else int(rng.integers(-9, 9))) for i in range(400)]
    schema = "id int, s string, v string, f double, b boolean, n int"
    df = spark.createDataFrame(rows, schema).repartition(4)
    for version, read in ((1, decode.text_lines), (3, decode.binary_lines)):
        plan = roles.resolve(df, table="a b", symbols=["s"], at=Instant(7), version=version)
        back = read(encode(df, plan))
        number = decode.field("f") if version == 1 else decode.field("f", "number")
        got = back.select(
            decode.field("id").cast("int"), decode.symbol("s"), decode.field("v"),
            number.cast("double"), decode.field("b") == "t", decode.field("n").cast("int"),
            "ok", "tbl", "at").collect()
        assert sorted(tuple(r)[:6] for r in got) == sorted(rows)
        assert {tuple(r)[6:] for r in got} == {(True, "a b", 7)}


@pytest.mark.parametrize("bad", ["", "t", "t,s", "t x", "t x=", "t x=1x", "t x=1i,", " x=1i",
                                 "t x=1i 12q", 't x="a', "t x=1i 1 2", "t x=1i,y"])
def test_malformed_lines(spark, bad):
    df = spark.createDataFrame([(bad,)], "line string")
    assert not decode.text_lines(df).first()["ok"]
    assert not decode.binary_lines(df.select(F.col("line").cast("binary").alias("line"))).first()["ok"]


def test_payload_splitting(spark):
    texts = ['t,s=a\\\nb x=1i 5', 't x="p\\\nq",y=2i', "t x=1i"]
    df = spark.createDataFrame([("".join(x + "\n" for x in texts),)], "payload string")
    assert [r["line"] for r in decode.split_text(df).collect()] == texts
    raw = [b"t x==\x10" + struct.pack("<d", 2.5) + b",m" + arr([[10.0, 1e-9]]) + b" 5t",
           b"t d" + dec(2570, 1, 2) + b",s=\"\\\n\""]
    df = spark.createDataFrame([(b"".join(x + b"\n" for x in raw),)], "payload binary")
    assert [bytes(r["line"]) for r in decode.split_binary(df).collect()] == raw


def test_pandas_frames(spark):
    pdf = pd.DataFrame({
        "cat": pd.Series(["a", "b", None], dtype="category"),
        "f": [1.5, float("nan"), float("inf")],
        "n": pd.Series([1, None, 3], dtype="Int64"),
        "u": pd.Series([1, 2**64 - 1, 3], dtype="uint64"),
        "t": pd.to_datetime(["2024-01-01", None, "2024-01-02"]),
        "o": [1.0, None, float("nan")]})
    pdf["o"] = pd.Series([1.0, None, float("nan")], dtype=object)
    pdf.index.name = "named"
    df = tables.from_pandas(spark, pdf)
    with pytest.raises(Exception, match="column 'u'"):
        lines(df, 1, table=None, at="t")
    got = lines(df, 1, table=None, at="t", strict=False)
    assert got == [b"named,cat=a f=1.5,n=1i,u=1i,o=1.0 1704067200000000000",
                   b"named f=Infinity,n=3i,u=3i,o=NaN 1704153600000000000"]
    with pytest.raises(TypeError):
        tables.from_pandas(spark, pd.DataFrame({"c": pd.Series([1, 2], dtype="category")}))


def test_pandas_cells_of_several_dimensions_and_wide_decimals(spark):
    rng = np.random.default_rng(40)
    shapes = rng.normal(size=(3, 2, 4))
    wide = [Decimal(10) ** 50 + Decimal(rng.integers(10 ** 9).item()), None, Decimal(-3).scaleb(-30)]
    pdf = pd.DataFrame({"id": [1, 2, 3], "x": [shapes[0], None, shapes[2]], "d": wide})
    rows = {r["id"]: r for r in tables.from_pandas(spark, pdf).collect()}
    assert rows[1]["x"] == shapes[0].tolist() and rows[2]["x"] is None and rows[3]["x"] == shapes[2].tolist()
    assert [rows[i]["d"] and Decimal(rows[i]["d"]) for i in (1, 2, 3)] == wide
    got = lines(tables.from_pandas(spark, pdf), 3, table="t", at=SERVER_TIME)
    assert len(got) == 3


def test_long_rows(spark):
    cells = "id int, name string, s string, d double"
    kinds = ({"symbol": "s", "number": "d"}, {"side": "symbol", "price": "number"})
    long = spark.createDataFrame(
        [(1, "side", "up", None), (1, "price", None, 2.5), (2, "side", None, None), (3, "price", None, 0.0)], cells)
    wide = tables.from_events(long, "id", "name", *kinds)
    assert sorted(map(tuple, wide.collect()), key=str) == [(1, "up", 2.5), (3, None, 0.0)]
    assert wide.schema["side"].metadata[roles.SYMBOL]
    twice = long.unionByName(long.where("d = 0"))
    with pytest.raises(Exception, match="several values in row 3"):
        tables.from_events(twice, "id", "name", *kinds).collect()


def test_plain_decimal_texts_go_together(monkeypatch):
    """Only texts that Arrow would not read are taken one by one; the bytes are the same."""
    one, asked = binary._one_decimal, []
    plain = ["0", "-0.00", "+127", "128", "-128", "-32769.5", ".5", "-.25", "5.", "0" * 40 + ".10", "9" * 76,
             "-0." + "1" * 75, str(-(1 << 247)), str((1 << 247) + 1), str((1 << 248) - 1)]
    odd = ["1e5", "9" * 77, "0." + "0" * 76 + "1", "NaN", "x", "", "1.2.3", " 5", "5\n", "1_0"]
    cells = pa.array([*plain, None, *odd, *plain], pa.string())
    want = [one(v) for v in cells.to_pylist()]
    monkeypatch.setattr(binary, "_one_decimal", lambda v: asked.append(v) or one(v))
    assert binary._text_decimal(cells).to_pylist() == want
    assert binary._decimal_problem(cells).to_pylist() == [None] * (len(plain) + 1) + [
        None, "mantissa too large", "scale too large", None, "not a decimal", "not a decimal", "not a decimal",
        None, None, None] + [None] * len(plain)
    assert set(asked) <= {None, *odd}
    asked.clear()
    assert binary._text_decimal(cells[:5]).to_pylist() == want[:5] and binary._decimal_problem(cells[:5]).null_count == 5
    assert binary._text_decimal(cells[:0]).to_pylist() == [] and not asked
