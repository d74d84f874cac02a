"""Tables in: Parquet, pandas frames, long event rows, synthetic load."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines import session
from tslines.plans import roles


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; nanosecond timestamps arrive as BIGINT (flag them with `roles.mark`)."""
    return session.configure(spark).read.parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return parquet(spark, f"{folder}/{name}.parquet")


def stream(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """The same table as a file stream; `maxFilesPerTrigger` and the like go in `options`."""
    schema = table(spark, folder, name).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .options(**options).parquet(folder))


def _has_decimals(series) -> bool:
    return series.dtype == object and series.map(lambda v: isinstance(v, Decimal)).any()


def _decimals(values: list):
    """One DECIMAL type where it holds all digits, else the text of each value."""
    import pyarrow as pa

    try:
        arr = pa.array(values)
    except pa.ArrowInvalid:
        arr = None
    if arr is not None and pa.types.is_decimal128(arr.type):
        return arr
    return pa.array([None if v is None else str(v) for v in values], pa.string())


def _arrow_column(series):
    """Arrow array of a pandas column that keeps NaN apart from null."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    if isinstance(series.dtype, pd.CategoricalDtype):
        if series.cat.categories.inferred_type != "string":
            raise TypeError(f"column {series.name!r}: categories must be strings")
        return pa.array(series.astype(object).where(series.notna(), None), pa.string())
    if isinstance(series.dtype, np.dtype) and series.dtype.kind == "f":
        if series.dtype.itemsize < 4:
            raise TypeError(f"column {series.name!r}: 16-bit floats cannot be written")
        return pa.array(series.to_numpy(), from_pandas=False)
    if isinstance(series.dtype, np.dtype) and series.dtype.kind == "u" and (
            series.dtype.itemsize == 8):
        return pa.array(series.to_numpy()).cast(pa.decimal128(20, 0))
    if series.dtype == object and series.map(lambda v: isinstance(v, float)).any():
        # NaN is a value next to floats, and a null next to anything else
        if series.map(lambda v: v is None or v is pd.NA or isinstance(v, float)).all():
            return pa.array([None if v is None or v is pd.NA else v for v in series], pa.float64())
        return pa.array([None if pd.isna(v) else v for v in series])
    if _has_decimals(series):
        return _decimals([None if pd.isna(v) else v for v in series])
    if series.dtype == object and series.map(lambda v: isinstance(v, np.ndarray) and v.ndim > 1).any():
        return pa.array([v.tolist() if isinstance(v, np.ndarray) else v for v in series])
    return pa.array(series)


def from_pandas(spark: SparkSession, pdf) -> DataFrame:
    """A pandas frame as a DataFrame: NaN stays NaN, null stays null.

    Categories become symbols under symbols='auto', a named index gives the
    default table, nanosecond columns become flagged BIGINT, decimals of more
    than 38 digits flagged text, arrays of several dimensions nested arrays.
    """
    import pandas as pd
    import pyarrow as pa

    session.configure(spark)
    arrays, meta = {}, {}
    for name in pdf.columns:
        arr = _arrow_column(pdf[name])
        if pa.types.is_timestamp(arr.type) and arr.type.unit == "ns":
            arr, meta[name] = arr.cast(pa.int64()), {roles.UNIT: "ns"}
        elif pa.types.is_timestamp(arr.type):
            arr = arr.cast(pa.timestamp("us", "UTC"))
        elif pa.types.is_uint64(arr.type):
            arr = arr.cast(pa.decimal128(20, 0))
        elif pa.types.is_unsigned_integer(arr.type):
            arr = arr.cast(pa.int64())
        elif pa.types.is_decimal256(arr.type):
            arr, meta[name] = arr.cast(pa.string()), {roles.WIDE: True}
        elif pa.types.is_string(arr.type) and _has_decimals(pdf[name]):
            meta[name] = {roles.WIDE: True}
        elif pa.types.is_float16(arr.type):
            raise TypeError(f"column {name!r}: 16-bit floats cannot be written")
        if isinstance(pdf[name].dtype, pd.CategoricalDtype):
            meta[name] = {roles.SYMBOL: True}
        if str(pdf[name].dtype).lower() == "uint64":
            meta[name] = {roles.UNSIGNED: True}
        arrays[str(name)] = arr
    df = spark.createDataFrame(pa.table(arrays))
    for name, extra in meta.items():
        df = roles.mark(df, name, **extra)
    if isinstance(pdf.index.name, str) and len(df.columns):
        df = roles.mark(df, df.columns[0], **{roles.TABLE: pdf.index.name})
    return df


def from_events(long: DataFrame, key: str, name: str, values: dict[str, str],
                columns: dict[str, str]) -> DataFrame:
    """Long rows (`key`, `name`, one value column per type) to one wide row per key.

    `columns` gives each output column the type group it takes its value from;
    a fixed list keeps the job to one pass, and columns of the group `symbol`
    are marked as symbols. Rows without any value drop out, null values count as
    absent. Two values of one column in a row are an error.
    """
    def cell(c: str, kind: str) -> Column:
        value = F.when(F.col(name) == c, F.col(values[kind]))
        twice = F.concat(F.lit(f"column {c!r} has several values in row "), F.col(key).cast("string"))
        return F.when(F.count(value) > 1, F.raise_error(twice)).otherwise(F.first(value, True)).alias(c)

    wide = long.groupBy(key).agg(*[cell(c, kind) for c, kind in columns.items()])
    for c, kind in columns.items():
        if kind == "symbol":
            wide = roles.mark(wide, c, **{roles.SYMBOL: True})
    return wide.filter(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull())


# First code points of the 1, 2, 3 and 4 byte ranges the text generator uses.
UNICODE_STARTS = (0x61, 0xE0, 0x4E00, 0x1F600)


def _mix(seed: int, salt: int) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(1 << 40))


def synthetic(spark: SparkSession, n: int, kind: str = "mixed", seed: int = 1,
              null_share: float = 0.0, partitions: int | None = None) -> DataFrame:
    """Deterministic load of `n` rows; every cell is a function of (row, seed)."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return fill(base, kind, seed, null_share)


def fill(base: DataFrame, kind: str = "mixed", seed: int = 1,
         null_share: float = 0.0) -> DataFrame:
    """Generated columns for rows that carry a BIGINT `id`; also for `rate` streams."""

    def maybe(c: Column, salt: int) -> Column:
        if not null_share:
            return c
        return F.when(F.pmod(_mix(seed, 100 + salt), F.lit(10_000)) >= int(null_share * 10_000), c)

    def word(salt: int) -> Column:
        return F.hex(_mix(seed, salt))

    if kind == "mixed":
        cols = {"col1": word(1), "col2": _mix(seed, 2), "col3": _mix(seed, 3) / 1000,
                "col4": _mix(seed, 4) / 7, "col5": F.concat(F.lit("c"), F.pmod(_mix(seed, 5), 100))}
    elif kind == "pairs":
        cols = {"a": word(1), "b": F.col("id")}
    elif kind == "escapes":
        cols = {f"col{i}": F.concat(F.lit("a=b c\\ "), word(i)) for i in range(1, 7)}
    elif kind == "unicode":
        cols = {f"col{i}": F.translate(word(i), "0123456789ABCDEF", "".join(
            chr(UNICODE_STARTS[j % 4] + j) for j in range(16))) for i in range(1, 6)}
    elif kind == "integers":
        cols = {f"col{i}": _mix(seed, i) for i in range(1, 7)}
    elif kind == "trades":
        cols = {"symbol": F.concat(F.lit("S"), F.pmod(_mix(seed, 1), 30)),
                "side": F.when(_mix(seed, 2) % 2 == 0, "buy").otherwise("sell"),
                "price": F.pmod(_mix(seed, 3), 1_000_000) / 100,
                "qty": F.pmod(_mix(seed, 4), 1000)}
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return base.select("id", *[maybe(c, i).alias(k) for i, (k, c) in enumerate(cols.items())])
