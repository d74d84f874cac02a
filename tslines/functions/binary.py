"""Binary cells that need the raw bits of doubles.

Each function works on whole Arrow buffers: the bytes of a double column are
its value buffer, so no cell is touched in Python.
"""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Payload markers of the binary cells.
DOUBLE_TAG = 16
ARRAY_TAG = 14
ARRAY_ELEMENT_TAG = 10
DECIMAL_TAG = 23
MAX_DIMS = 32


def _fixed_to_binary(raw: np.ndarray, width: int, mask: np.ndarray | None) -> pa.Array:
    n = len(raw) // width if width else 0
    arr = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(raw)])
    if mask is not None and mask.any():
        arr = pc.if_else(pa.array(mask), pa.scalar(None, pa.binary(width)), arr)
    return arr.cast(pa.binary())


def _null_mask(arr: pa.Array) -> np.ndarray:
    return np.asarray(arr.is_null())


def _double_le(values: pa.Array) -> pa.Array:
    mask = _null_mask(values)
    raw = np.ascontiguousarray(values.fill_null(0.0).to_numpy(zero_copy_only=False), dtype="<f8")
    return _fixed_to_binary(raw.view(np.uint8), 8, mask)


double_le = F.arrow_udf(_double_le, T.BinaryType())


def _decimal_be(values: pa.Array) -> pa.Array:
    # Arrow keeps a 128-bit decimal as 16 little-endian bytes.
    raw = np.frombuffer(values.buffers()[1], dtype=np.uint8).reshape(-1, 16)
    raw = np.ascontiguousarray(raw[values.offset:values.offset + len(values), ::-1])
    return _fixed_to_binary(raw.ravel(), 16, _null_mask(values))


decimal_be = F.arrow_udf(_decimal_be, T.BinaryType())


def array_dims(dtype: T.DataType) -> int:
    dims = 0
    while isinstance(dtype, T.ArrayType):
        dims, dtype = dims + 1, dtype.elementType
    return dims


def _array_payload(values: pa.Array) -> pa.Array:
    """Header, dimension sizes and row-major values; ragged cells become NULL."""
    mask = _null_mask(values)
    starts, ends, ragged = np.arange(len(values)), np.arange(len(values)) + 1, mask.copy()
    sizes, level = [], values
    while pa.types.is_list(level.type) or pa.types.is_large_list(level.type):
        offsets = np.asarray(level.offsets, dtype=np.int64)
        lengths = np.diff(offsets)
        # One size per row at this depth: the first inner list stands for all.
        owners = np.repeat(np.arange(len(values)), ends - starts)
        if len(values):
            picked = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)]) if (
                sizes) else np.arange(len(values))
        else:
            picked = np.zeros(0, dtype=np.int64)
        size = np.zeros(len(values), dtype=np.int64)
        has = ends > starts
        size[has] = lengths[starts[has]]
        if len(picked):
            differs = lengths[picked] != size[owners]
            np.logical_or.at(ragged, owners[differs], True)
            inner_nulls = _null_mask(level)[picked]
            np.logical_or.at(ragged, owners[inner_nulls], True)
        sizes.append(size)
        new_starts, new_ends = np.zeros_like(starts), np.zeros_like(ends)
        new_starts[has], new_ends[has] = offsets[starts[has]], offsets[ends[has]]
        starts, ends = new_starts, new_ends
        # `values` ignores the slice offset, as do the absolute offsets above.
        level = level.values
    leaf_nulls = np.concatenate([[0], np.cumsum(_null_mask(level))])
    ragged |= (leaf_nulls[ends] - leaf_nulls[starts]) > 0
    ends = np.where(ragged, starts, ends)

    dims = len(sizes)
    head = np.zeros(len(values), dtype=np.dtype(
        [("tag", "u1"), ("element", "u1"), ("dims", "u1"), ("size", "<i4", (dims,))]))
    head["tag"], head["element"], head["dims"] = ARRAY_TAG, ARRAY_ELEMENT_TAG, dims
    head["size"] = np.stack(sizes, axis=1) if dims else 0
    leaf = np.ascontiguousarray(
        level.fill_null(0.0).to_numpy(zero_copy_only=False), dtype="<f8").view(np.uint8)
    width = head.dtype.itemsize
    lengths = (ends - starts) * 8
    out_offsets = np.concatenate([[0], np.cumsum(lengths + width)])
    out = np.empty(out_offsets[-1], dtype=np.uint8)
    head_at = (out_offsets[:-1, None] + np.arange(width)).ravel()
    out[head_at] = head.view(np.uint8)
    body = np.ones(len(out), dtype=bool)
    body[head_at] = False
    if len(values):
        keep = np.zeros(len(leaf) + 1, dtype=np.int64)
        np.add.at(keep, starts * 8, 1)
        np.add.at(keep, ends * 8, -1)
        out[body] = leaf[np.cumsum(keep[:-1]) > 0]
    arr = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(values),
        [None, pa.py_buffer(out_offsets.astype(np.int64)), pa.py_buffer(out)])
    if ragged.any():
        arr = pc.if_else(pa.array(ragged), pa.scalar(None, pa.large_binary()), arr)
    return arr.cast(pa.binary())


array_payload = F.arrow_udf(_array_payload, T.BinaryType())


def _one_decimal(text: str | None) -> bytes | None:
    """Scale byte, width byte and the shortest two's complement of at least two bytes."""
    if text is None:
        return None
    try:
        value = Decimal(text)
    except InvalidOperation:
        return None
    if not value.is_finite():
        return None
    sign, digits, exponent = value.as_tuple()
    number = int("".join(map(str, digits)) or "0") * 10 ** max(exponent, 0)
    number = -number if sign else number
    scale = max(-exponent, 0)
    # Bits of the magnitude plus a sign bit; ~n has the magnitude of a negative n.
    width = max(2, ((number if number >= 0 else ~number).bit_length() + 8) // 8)
    if scale > 76 or width > 32:
        return None
    return bytes([scale, width]) + number.to_bytes(width, "big", signed=True)


#: Decimals that Arrow reads as they are; its widest have 76 digits.
_PLAIN = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z"


def _plain_decimals(values: pa.Array) -> np.ndarray:
    """Which texts are digits with a sign and a point at most, and none too many."""
    size = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    plain = pc.fill_null(pc.match_substring_regex(values, _PLAIN), False).to_numpy(zero_copy_only=False)
    long = np.flatnonzero(plain & (size > 76))
    if len(long):
        digits = pc.utf8_ltrim(pc.replace_substring(values.take(pa.array(long)), ".", ""), "+-")
        plain = plain.copy()
        plain[long] = pc.binary_length(digits).to_numpy(zero_copy_only=False) <= 76
    return plain


def _written(text: pa.Array) -> pa.Array:
    """`_one_decimal` of plain texts, all together."""
    n = len(text)
    point = pc.find_substring(text, ".").to_numpy(zero_copy_only=False)
    size = pc.binary_length(text).to_numpy(zero_copy_only=False)
    scale = np.where(point < 0, 0, size - 1 - point)
    whole = pc.replace_substring(text, ".", "").cast(pa.decimal256(76, 0))
    # a 256-bit decimal is 32 little-endian bytes
    raw = np.frombuffer(whole.buffers()[1], np.uint8)[32 * whole.offset:32 * (whole.offset + n)]
    cells = np.zeros((n, 34), np.uint8)
    cells[:, 2:] = raw.reshape(n, 32)[:, ::-1]
    # the first byte that is not all sign, and whether it leaves a bit for the sign
    bits = cells[:, 2:] ^ np.where(cells[:, 2:3] >= 128, 255, 0).astype(np.uint8)
    first, row = np.where(bits.any(axis=1), (bits != 0).argmax(axis=1), 31), np.arange(n)
    width = np.maximum(32 - first + (bits[row, first] >= 128), 2)
    cells[row, 32 - width], cells[row, 33 - width] = scale, width
    ends = np.concatenate(([0], np.cumsum(width + 2))).astype(np.int32)
    out = cells[np.arange(34) >= (32 - width)[:, None]]
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _text_decimal(values: pa.Array) -> pa.Array:
    """Plain texts go together, others (exponents, too many digits, no numbers) one by one."""
    plain = _plain_decimals(values)
    if plain.all():
        return _written(values)
    rest = pa.array([_one_decimal(v) for v in values.filter(pa.array(~plain)).to_pylist()], pa.binary())
    at = np.argsort(np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain))))
    return pa.concat_arrays([_written(values.filter(pa.array(plain))), rest]).take(pa.array(at))


text_decimal = F.arrow_udf(_text_decimal, T.BinaryType())


def decimal_text_error(c: Column) -> Column:
    """NULL where `text_decimal` can write the text, or the value is elided."""
    return F.arrow_udf(_decimal_problem, T.StringType())(c)


def _decimal_problem(values: pa.Array) -> pa.Array:
    def problem(text):
        if text is None:
            return None
        try:
            value = Decimal(text)
        except InvalidOperation:
            return "not a decimal"
        if not value.is_finite() or _one_decimal(text) is not None:
            return None
        return "scale too large" if -value.as_tuple().exponent > 76 else "mantissa too large"

    # what is plain has 76 digits at most, so neither it nor its scale is too large
    odd = ~_plain_decimals(values) & ~_null_mask(values)
    if not odd.any():
        return pa.nulls(len(values), pa.string())
    found = pa.array([problem(v) for v in values.filter(pa.array(odd)).to_pylist()], pa.string())
    return pc.replace_with_mask(pa.nulls(len(values), pa.string()), pa.array(odd), found)
