"""Plan-time rules, names and reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tslines.functions import names
from tslines.operators import validate
from tslines.plans import roles
from tslines.plans.roles import SERVER_TIME, Instant, resolve


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [("t", "s", 1, dt.datetime(2024, 1, 1), 2.0)],
        "tab string, sym string, x int, ts timestamp, v double")


def test_indexes_and_names(df):
    plan = resolve(df, table_col=0, symbols=[-4], at=-2)
    assert [c[1:] for c in plan.describe()] == [
        ("tab", "table", "table"), ("sym", "symbol", "symbol"), ("x", "field", "integer"),
        ("v", "field", "float"), ("ts", "at", "timestamp")]


@pytest.mark.parametrize("how, error", [
    (dict(table="t", table_col="tab", at=SERVER_TIME), ValueError),
    (dict(at=SERVER_TIME), ValueError),
    (dict(table=5, at=SERVER_TIME), TypeError),
    (dict(table="a..b", at=SERVER_TIME), ValueError),
    (dict(table_col="x", at=SERVER_TIME), TypeError),
    (dict(table_col="none", at=SERVER_TIME), KeyError),
    (dict(table_col=9, at=SERVER_TIME), IndexError),
    (dict(table_col=-6, at=SERVER_TIME), IndexError),
    (dict(table_col=1.5, at=SERVER_TIME), TypeError),
    (dict(table="t", at=None), TypeError),
    (dict(table="t", at="x"), TypeError),
    (dict(table="t", at="none"), KeyError),
    (dict(table="t", at=dt.datetime(1960, 1, 1, tzinfo=dt.timezone.utc)), ValueError),
    (dict(table="t", at=SERVER_TIME, symbols="sym"), TypeError),
    (dict(table="t", at=SERVER_TIME, symbols=["x"]), TypeError),
    (dict(table="t", at="ts", symbols=["ts"]), ValueError),
    (dict(table_col="tab", at=SERVER_TIME, symbols=["tab"]), ValueError),
    (dict(table="t", at=SERVER_TIME, symbols=[1.5]), TypeError),
    (dict(table="t", at=SERVER_TIME, version=4), ValueError),
])
def test_bad_arguments(df, how, error):
    with pytest.raises(error):
        resolve(df, **how)


def test_at_is_required(df):
    with pytest.raises(TypeError):
        resolve(df, table="t")
    with pytest.raises(ValueError):
        Instant(-1)


@pytest.mark.parametrize("expr", [
    "cast('a' as binary)", "map('a', 1)", "struct(1)", "interval 1 day", "array('a')", "array(1)"])
def test_unsupported_types(spark, expr):
    with pytest.raises(TypeError):
        resolve(spark.range(1).select(F.expr(expr).alias("c")), table="t", at=SERVER_TIME)


def test_versions_and_dims(spark):
    one = spark.range(1)
    arrays = one.select(F.expr("array(1.5D)").alias("a"))
    decimals = one.select(F.expr("1.5").alias("d"))
    for df, least in ((arrays, 2), (decimals, 3)):
        for version in (1, 2, 3):
            if version < least:
                with pytest.raises(ValueError, match="version"):
                    resolve(df, table="t", at=SERVER_TIME, version=version)
            else:
                resolve(df, table="t", at=SERVER_TIME, version=version)
    deep = lambda n: one.select(F.expr("array(" * n + "1.5D" + ")" * n).alias("a"))
    resolve(deep(32), table="t", at=SERVER_TIME)
    with pytest.raises(TypeError):
        resolve(deep(33), table="t", at=SERVER_TIME)


def test_symbol_choices(df):
    flagged = roles.mark(df, "sym", symbol=True)
    pick = lambda d, s: [c.name for c in resolve(d, table="t", at=SERVER_TIME, symbols=s).symbols]
    assert pick(df, "auto") == [] and pick(flagged, "auto") == ["sym"]
    assert pick(df, True) == ["tab", "sym"] and pick(flagged, False) == []
    assert pick(df, ("sym", 0)) == ["tab", "sym"]


@pytest.mark.parametrize("name, table, column", [
    ("ok", True, True), ("a.b", True, False), ("a-b", True, False), (".a", False, False),
    ("a.", False, False), ("a..b", False, False), ("", False, False), ("a?b", False, False),
    ("a b", True, True), ("a=b", True, True), ("a\nb", False, False), ("a\x0fb", False, False),
    ("a\x10b", True, True), ("a\x7f", False, False), ("﻿a", False, False), ("é", True, True),
    ("x" * 127, True, True), ("é" * 64, False, False), ("a~", False, False), ("a%", False, False)])
def test_names(spark, name, table, column):
    row = spark.createDataFrame([(name,)], "n string").select(
        names.is_valid_name(F.col("n"), "table"), names.is_valid_name(F.col("n"), "column")).first()
    assert tuple(row) == (table, column)
    for kind, ok in (("table", table), ("column", column)):
        if ok:
            assert names.check_name(name, kind) == name
        else:
            with pytest.raises(ValueError):
                names.check_name(name, kind)


def test_strict_names_the_first_error(spark):
    df = spark.createDataFrame([(1, True, 2), (3, None, 4), (2, None, 1)], "id int, b boolean, n int")
    plan = resolve(df, table="t", at=SERVER_TIME)
    with pytest.raises(validate.RejectedRows, match=r"row \[2\], column 'b'"):
        validate.strict(df, plan, "id")
    good = df.filter("b")
    assert validate.strict(good, plan, "id") is good


def test_empty_input(spark):
    df = spark.createDataFrame([], "a int, b string")
    plan = resolve(df, table="t", at=SERVER_TIME)
    from tslines.operators.encode import encode
    assert encode(df, plan).count() == 0 and validate.rejects(df, plan).count() == 0
    assert roles.drop_empty(df, plan).cells == ()


def test_void_columns_vanish(spark):
    df = spark.createDataFrame([(1,)], "a int").withColumn("n", F.lit(None))
    assert [c.name for c in resolve(df, table="t", at=SERVER_TIME).cells] == ["a"]
