"""Column roles: which column is the table name, a symbol, a field, the instant."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import binary, names, numbers, times

# Metadata keys on input columns.
SYMBOL = "symbol"        # string column that counts as a symbol under symbols='auto'
UNIT = "unit"            # 'ns' on a BIGINT that holds nanoseconds
UNSIGNED = "unsigned"    # DECIMAL(20,0) that stands for an unsigned 64-bit integer
WIDE = "decimal_text"    # string column that holds decimals of up to 77 digits
TABLE = "table"          # default table name of the frame


class _ServerTime:
    def __repr__(self):
        return "SERVER_TIME"


SERVER_TIME = _ServerTime()

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
INSTANTS = (T.TimestampType, T.TimestampNTZType, T.DateType)


@dataclass(frozen=True)
class Cell:
    """One input column and what becomes of it."""

    name: str
    position: int
    dtype: T.DataType
    target: str
    unit: str = "us"

    @property
    def col(self) -> Column:
        return F.col("`" + self.name.replace("`", "``") + "`")

    def wire(self) -> Column:
        """The cell in its wire type."""
        c = self.col
        if self.target == "integer":
            return numbers.guarded_int(c) if isinstance(self.dtype, T.DecimalType) else (
                c.cast("bigint"))
        if self.target == "float":
            return c.cast("double")
        if self.target == "timestamp":
            return c.cast("bigint") if self.unit == "ns" else c.cast("timestamp")
        if self.target == "array":
            return c.cast(_double_array(self.dtype))
        return c

    def micros(self) -> Column:
        return times.nanos_to_micros(self.col) if self.unit == "ns" else times.micros(self.col)


@dataclass(frozen=True)
class Roles:
    """The ordered column plan: table, symbols, fields, instant."""

    symbols: tuple[Cell, ...]
    fields: tuple[Cell, ...]
    table: str | None = None
    table_cell: Cell | None = None
    at_cell: Cell | None = None
    at_nanos: int | None = None
    version: int = 2

    @property
    def cells(self) -> tuple[Cell, ...]:
        return self.symbols + self.fields

    @property
    def ordered(self) -> tuple[Cell, ...]:
        head = (self.table_cell,) if self.table_cell else ()
        tail = (self.at_cell,) if self.at_cell else ()
        return head + self.cells + tail

    def table_col(self) -> Column:
        return self.table_cell.col if self.table_cell else F.lit(self.table)

    def at_micros(self) -> Column:
        if self.at_cell:
            return self.at_cell.micros()
        return F.lit(None if self.at_nanos is None else self.at_nanos // 1000).cast("bigint")

    def without(self, dropped: set[str]) -> Roles:
        keep = lambda cells: tuple(c for c in cells if c.name not in dropped)
        return replace(self, symbols=keep(self.symbols), fields=keep(self.fields))

    def describe(self) -> list[tuple[int, str, str, str]]:
        """(line position, column, role, target) for reports."""
        out = []
        for i, cell in enumerate(self.ordered):
            role = ("table" if cell is self.table_cell else "at" if cell is self.at_cell
                    else "symbol" if cell in self.symbols else "field")
            out.append((i, cell.name, role, cell.target))
        return out


def _double_array(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_double_array(dtype.elementType))
    return T.DoubleType()


def target_of(field: T.StructField) -> tuple[str, str]:
    """(wire target, time unit) of a column that is used as a field."""
    dtype, meta = field.dataType, field.metadata or {}
    if isinstance(dtype, T.BooleanType):
        return "boolean", "us"
    if isinstance(dtype, T.LongType) and meta.get(UNIT) == "ns":
        return "timestamp", "ns"
    if isinstance(dtype, INTEGERS):
        return "integer", "us"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "float", "us"
    if isinstance(dtype, T.StringType):
        return ("decimal_text" if meta.get(WIDE) else "string"), "us"
    if isinstance(dtype, INSTANTS):
        return "timestamp", "us"
    if isinstance(dtype, T.DecimalType):
        return ("integer" if meta.get(UNSIGNED) else "decimal"), "us"
    if isinstance(dtype, T.ArrayType):
        leaf = dtype
        while isinstance(leaf, T.ArrayType):
            leaf = leaf.elementType
        dims = binary.array_dims(dtype)
        if isinstance(leaf, (T.DoubleType, T.FloatType)) and dims <= binary.MAX_DIMS:
            return "array", "us"
        raise TypeError(f"column {field.name!r}: only arrays of doubles with up to "
                        f"{binary.MAX_DIMS} dimensions can be written, not {dtype.simpleString()}")
    if isinstance(dtype, T.NullType):
        return "skip", "us"
    raise TypeError(f"column {field.name!r}: type {dtype.simpleString()} cannot be written")


def _locate(df: DataFrame, ref, argument: str) -> int:
    """Position of a column given by name or by (possibly negative) index."""
    if isinstance(ref, bool) or not isinstance(ref, (str, int)):
        raise TypeError(f"`{argument}` must be a column name or index, not {type(ref).__name__}")
    if isinstance(ref, str):
        if ref not in df.columns:
            raise KeyError(f"`{argument}`: there is no column {ref!r}")
        return df.columns.index(ref)
    n = len(df.columns)
    if not -n <= ref < n:
        raise IndexError(f"`{argument}`: index {ref} is out of range for {n} columns")
    return ref % n


def _need_strings(field: T.StructField, argument: str) -> None:
    if not isinstance(field.dataType, T.StringType):
        raise TypeError(f"`{argument}`: column {field.name!r} must hold strings, "
                        f"not {field.dataType.simpleString()}")


def resolve(
    df: DataFrame,
    *,
    at,
    table: str | None = None,
    table_col: str | int | None = None,
    symbols="auto",
    version: int = 2,
    max_name_bytes: int = names.MAX_NAME_BYTES,
) -> Roles:
    """Give every column of `df` its role and wire type, or say why that is impossible.

    `at` is a column (name or index), a datetime or integer of nanoseconds
    wrapped as `Instant`, or `SERVER_TIME`. `symbols` is 'auto' (columns
    flagged in their metadata), True (all strings), False, or a list.
    """
    if version not in (1, 2, 3):
        raise ValueError(f"protocol version must be 1, 2 or 3, not {version!r}")
    schema = df.schema.fields
    if len(set(df.columns)) != len(df.columns):
        raise ValueError("column names must be unique")
    roles = {}

    if table is not None and table_col is not None:
        raise ValueError("give either `table` or `table_col`, not both")
    if table is None and table_col is None:
        table = next((f.metadata[TABLE] for f in schema if f.metadata.get(TABLE)), None)
        if table is None:
            raise ValueError("give `table` or `table_col`")
    if table is not None:
        if not isinstance(table, str):
            raise TypeError("`table` must be a string")
        names.check_name(table, "table", max_name_bytes)
    else:
        pos = _locate(df, table_col, "table_col")
        _need_strings(schema[pos], "table_col")
        roles[pos] = "table"

    at_nanos = None
    if at is SERVER_TIME:
        pass
    elif at is None:
        raise TypeError("`at` must be a column, an instant or SERVER_TIME")
    elif isinstance(at, (dt.datetime, Instant)):
        at_nanos = times.instant_nanos(at.nanos if isinstance(at, Instant) else at)
    else:
        pos = _locate(df, at, "at")
        target, _ = target_of(schema[pos])
        if target != "timestamp":
            raise TypeError(f"`at`: column {schema[pos].name!r} must hold timestamps")
        roles[pos] = "at"

    if symbols == "auto" or symbols is True:
        for pos, field in enumerate(schema):
            text = isinstance(field.dataType, T.StringType)
            if pos not in roles and text and (symbols is True or field.metadata.get(SYMBOL)):
                roles[pos] = "symbol"
    elif symbols is not False:
        if not isinstance(symbols, (list, tuple)):
            raise TypeError("`symbols` must be 'auto', a bool, or a list of names or indices")
        for ref in symbols:
            pos = _locate(df, ref, "symbols")
            if roles.get(pos) in ("table", "at"):
                raise ValueError(f"`symbols`: column {schema[pos].name!r} already is the "
                                 f"{roles[pos]} column")
            _need_strings(schema[pos], "symbols")
            roles[pos] = "symbol"

    found = {"table": [], "symbol": [], "field": [], "at": []}
    for pos, field in enumerate(schema):
        role = roles.get(pos, "field")
        target, unit = target_of(field) if role in ("field", "at") else (role, "us")
        if target == "skip":
            continue
        if role in ("symbol", "field"):
            names.check_name(field.name, "column", max_name_bytes)
        need = {"array": 2, "decimal": 3, "decimal_text": 3}.get(target, 1)
        if version < need:
            raise ValueError(f"column {field.name!r}: protocol version {version} cannot carry "
                             f"{target}; version {need} can")
        found[role].append(Cell(field.name, pos, field.dataType, target, unit))
    return Roles(
        symbols=tuple(found["symbol"]),
        fields=tuple(found["field"]),
        table=table,
        table_cell=found["table"][0] if found["table"] else None,
        at_cell=found["at"][0] if found["at"] else None,
        at_nanos=at_nanos,
        version=version,
    )


@dataclass(frozen=True)
class Instant:
    """A fixed instant in nanoseconds, as opposed to a column index."""

    nanos: int

    def __post_init__(self):
        times.instant_nanos(self.nanos)

    @classmethod
    def micros(cls, value: int) -> Instant:
        return cls(value * 1000)

    @classmethod
    def now(cls) -> Instant:
        return cls(times.instant_nanos(dt.datetime.now(dt.timezone.utc)))


def mark(df: DataFrame, column: str, **metadata) -> DataFrame:
    """Attach role metadata to a column, e.g. `mark(df, 'side', symbol=True)`."""
    merged = {**(df.schema[column].metadata or {}), **metadata}
    return df.withMetadata(column, merged)


def map_types(df: DataFrame, roles: Roles, *keep: str) -> DataFrame:
    """One projection: `tbl`, symbols, fields in wire types, `at_us`."""
    cols = [F.col(k) for k in keep]
    cols.append(roles.table_col().alias("tbl"))
    cols += [cell.wire().alias(cell.name) for cell in roles.cells]
    cols.append(roles.at_micros().alias("at_us"))
    return df.select(*cols)


def drop_empty(df: DataFrame, roles: Roles) -> Roles:
    """Leave out columns whose every value is null; one aggregate over the input."""
    if not roles.cells:
        return roles
    # any value is enough, so `max(not null)` replaces a full count
    row = df.agg(*[F.max(c.col.isNotNull()).alias(str(i)) for i, c in enumerate(roles.cells)])
    seen = row.first()
    return roles.without({c.name for i, c in enumerate(roles.cells) if not seen[i]})
