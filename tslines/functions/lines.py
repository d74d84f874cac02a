"""Lines of the protocol, found and taken apart many at a time.

An index of a buffer says for every place where the next separator or quote that is
not escaped stands. All lines of a block then move from token to token together:
one step finds the next cell of every line that still has one, and a binary cell is
hopped over by its own length, so what its bytes look like does not matter. The
cells of all steps become Arrow columns by slicing the buffer; there is no loop
over lines or cells.

Whether a byte is escaped depends on the backslashes before it. The index counts
them over binary cells too, which is wrong only for the byte right after one; that
byte is always looked at itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tslines.functions.binary import ARRAY_ELEMENT_TAG, ARRAY_TAG, DECIMAL_TAG, DOUBLE_TAG, MAX_DIMS

#: Bytes that are indexed together; a longer line is a block of its own.
BLOCK = 1 << 19
#: Zero bytes behind a buffer, so that a look ahead stays inside.
_PAD = 160
KINDS = ("string", "boolean", "integer", "timestamp_us", "timestamp_ns", "float", "double", "array", "decimal")
_STRING, _BOOLEAN, _INTEGER, _MICROS, _NANOS, _FLOAT, _DOUBLE, _ARRAY, _DECIMAL, _BARE = range(10)
#: Kinds as they are shown; binary and text floats are one.
SHOWN = pa.array(["float" if k == "double" else k for k in KINDS])
_FLOAT_TEXT = r"^(?:-?(?:NaN|Infinity)|[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)$"
_LARGEST = "9223372036854775807"
#: The bits of a byte below each.
_BELOW = ((1 << np.arange(8)) - 1).astype(np.uint8)
_COMMA, _BLANK, _EQUALS, _END, _QUOTE, _BACK, _MINUS = 44, 32, 61, 10, 34, 92, 45


def slices(data: np.ndarray, a: np.ndarray, b: np.ndarray, without: np.ndarray | None = None) -> pa.Array:
    """The bytes [a, b) of every cell as one binary array, but for those marked in `without`."""
    size = b - a
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(ends[-1]) + np.repeat(a - ends[:-1], size)
    out = data[at]
    if without is not None:
        gone = without[at]
        if gone.any():
            out = out[~gone]
            ends = ends - np.concatenate(([0], np.cumsum(gone)))[ends]
    return pa.Array.from_buffers(pa.binary(), len(a), [
        None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)])


def _each(data: np.ndarray, kind: str, at: np.ndarray) -> np.ndarray:
    """The value of a fixed size that begins at each place, aligned or not."""
    kind = np.dtype(kind)
    return np.ndarray((len(data) - kind.itemsize + 1,), kind, data, 0, (1,))[at]


class Marks:
    """Marked places of a buffer: one bit a byte, and how many there are before every eight."""

    def __init__(self, mask: np.ndarray):
        self.n, self.mask = len(mask), mask
        # one byte more than needed, for the place behind the end
        self.bits = np.zeros(self.n // 8 + 1, np.uint8)
        packed = np.packbits(mask, bitorder="little")
        self.bits[:len(packed)] = packed
        self.before = np.zeros(len(self.bits), np.int64)
        np.cumsum(np.bitwise_count(self.bits[:-1]), out=self.before[1:])

    @cached_property
    def places(self):
        return np.append(np.flatnonzero(self.mask), self.n)

    def rank(self, at):
        """How many marked places there are before each one."""
        at = np.minimum(at, self.n)
        eight = at >> 3
        return self.before[eight] + np.bitwise_count(self.bits[eight] & _BELOW[at & 7])

    def next(self, at):
        """The next marked place, itself included; the end if there is none."""
        return self.places[self.rank(at)]


class Index:
    """Where separators, quotes and escapes of a buffer stand.

    `starts` are places where a line begins, whatever stands before. In text a
    line end is a byte like others, since each line is a value of its own.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, text: bool):
        self.n, self.text = len(data), text
        self.data = np.concatenate((data, np.zeros(_PAD, np.uint8)))
        self.escaping = self.escapes = None
        plain = np.ones(self.n, bool)
        back = np.flatnonzero(data == _BACK)
        if len(back):
            begins = np.zeros(self.n + 1, bool)
            begins[starts] = True
            first = np.concatenate(([True], np.diff(back) > 1)) | begins[back]
            place = np.arange(len(back))
            head = np.maximum.accumulate(np.where(first, place, 0))
            back = back[(place - head) % 2 == 0]
            self.escaping = np.zeros(self.n + _PAD, bool)
            self.escaping[back] = True
            self.escapes = back
            after = back[~begins[back + 1]] + 1
            plain[after[after < self.n]] = False
        bare = (data == _COMMA) | (data == _BLANK)
        if not text:
            bare |= data == _END
        bare &= plain
        self._bare = Marks(bare)
        self._key = Marks(bare | ((data == _EQUALS) & plain))
        self._quote = Marks((data == _QUOTE) & plain)
        self.ends = np.flatnonzero((data == _END) & plain)
        # a digit is less than ten after taking away a zero
        self._digits = Marks(data - np.uint8(48) < 10)

    def bare(self, at):
        """The next unescaped comma, blank or line end."""
        return self._bare.next(at)

    def key(self, at):
        """The same, or the next unescaped `=`."""
        return self._key.next(at)

    def quote(self, at):
        return self._quote.next(at)

    def open_escape(self, at):
        """Is the byte before `at` a backslash that escapes what would follow?"""
        return np.zeros(len(at), bool) if self.escaping is None else self.escaping[at - 1]

    def number(self, at, size: int):
        """Little-endian integer of `size` bytes, as int64."""
        out = np.zeros(len(at), np.int64)
        for i in range(size):
            out |= self.data[at + i].astype(np.int64) << (8 * i)
        return out

    def whole_number(self, a, b):
        """Is [a, b) an optional minus and digits?"""
        first = a + (self.data[a] == _MINUS)
        return (b > first) & (self._digits.rank(b) - self._digits.rank(first) == b - first)

    def gather(self, a, b, unescape: bool = True) -> pa.Array:
        """The bytes [a, b) of every cell as one binary array."""
        if unescape and self.escaping is not None:
            # mostly few cells hold an escape
            some = np.searchsorted(self.escapes, a) < np.searchsorted(self.escapes, b)
            if some.any():
                own = slices(self.data, a[some], b[some], self.escaping)
                return own if some.all() else pc.replace_with_mask(
                    self.gather(a, b, False), pa.array(some), own)
        # cells in the order of the buffer are every second one of a cut of the whole of it
        ends = np.empty(2 * len(a) + 1, np.int64)
        ends[:-1:2], ends[1::2], ends[-1] = a, b, self.n
        if len(a) == 0 or self.n > 1 << 30 or (ends[1:] < ends[:-1]).any():
            return slices(self.data, a, b)
        cut = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
            None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(self.data)])
        return cut.take(pa.array(np.arange(0, len(ends) - 1, 2)))


class Cells:
    """What a scan found: one entry per cell, in the order of lines and cells."""

    def __init__(self, steps: list[tuple], width: int):
        cols = [np.concatenate(c) for c in zip(*steps)] if steps else [np.zeros(0, np.int64)] * width
        order = np.argsort(cols[0], kind="stable")
        self.line, self.cols = cols[0][order], [c[order] for c in cols[1:]]

    def only(self, keep: np.ndarray) -> Cells:
        self.line, self.cols = self.line[keep], [c[keep] for c in self.cols]
        return self


class Scan:
    """Lines that begin at `start`, each at most up to `stop`.

    `end` is where a line ends, `ok` whether it is well formed up to there. With
    `frame` a line may end at a line end before `stop`, and `short` tells lines
    that would need bytes beyond it. Without, it has to end at `stop`.
    """

    def __init__(self, index: Index, start: np.ndarray, stop: np.ndarray, frame: bool = False,
                 keep: bool = True):
        self.index, self.stop, self.frame = index, stop, frame
        n, data = len(start), index.data
        self.ok, self.short = np.ones(n, bool), np.zeros(n, bool)
        self.cur = cur = start.astype(np.int64)
        self.table_start = start
        self.table_end = end = np.minimum(index.bare(cur), stop)
        self._drop(np.arange(n), (end <= cur) | self._torn(end, stop), end >= stop)
        cur[:] = np.where(self.ok, end, cur)
        self.filled = np.zeros(n, bool)
        symbols, fields = [], []

        at = np.flatnonzero(self.ok & (cur < stop) & (data[cur] == _COMMA))
        while len(at):
            at, name, name_end, value = self._named(at)
            end = np.minimum(index.bare(value), stop[at])
            torn = self._torn(end, stop[at])
            self._drop(at, torn, torn)
            symbols.append((at, name, name_end, value, end))
            self.filled[at] = True
            cur[at] = end
            at = at[~torn & (end < stop[at]) & (data[end] == _COMMA)]

        blank = self.ok & (cur < stop) & (data[cur] == _BLANK)
        at = np.flatnonzero(blank)
        at = at[~self._stamp(cur[at] + 1, stop[at])[0]]
        while len(at):
            at, name, name_end, value = self._named(at)
            good, short, kind, a, b, end, more = self._value(at, value)
            self._drop(at, ~good, short)
            at, name, name_end, kind, a, b, end, more = (
                x[good] for x in (at, name, name_end, kind, a, b, end, more))
            fields.append((at, name, name_end, kind, a, b, more))
            self.filled[at] = True
            cur[at] = end
            at = at[(end < stop[at]) & (data[end] == _COMMA)]

        at = np.flatnonzero(self.ok & (cur < stop) & (data[cur] == _BLANK))
        stamped, end = self._stamp(cur[at] + 1, stop[at])
        self._drop(at, ~stamped, end >= stop[at])
        self.stamped = at[stamped]
        self.stamp_start, self.stamp_end = cur[self.stamped] + 1, end[stamped]
        cur[self.stamped] = self.stamp_end
        done = cur == stop
        if frame:
            self.short |= self.ok & done
            done = (cur < stop) & (data[cur] == _END)
        self._drop(np.arange(n), self.ok & ~(done & self.filled), np.zeros(n, bool))
        self.end = cur
        if keep:
            self.symbols, self.fields = Cells(symbols, 5), Cells(fields, 7)

    def _drop(self, at, bad, short) -> None:
        self.ok[at[bad]] = False
        self.short[at[bad & short]] = True

    def _torn(self, end, stop):
        """Cells that end with the line, after a backslash that escapes nothing."""
        return (end == stop) & self.index.open_escape(end)

    def _named(self, at):
        """Lines at a separator: those with a key, where it is, and where its value begins."""
        name = self.cur[at] + 1
        end, stop = self.index.key(name), self.stop[at]
        good = (end < stop) & (self.index.data[end] == _EQUALS)
        self._drop(at, ~good, end >= stop)
        return at[good], name[good], end[good], end[good] + 1

    def _stamp(self, a, stop):
        """(is a timestamp up to the line's end, end)"""
        index = self.index
        end = np.minimum(index.bare(a), stop)
        last = index.data[np.maximum(end - 1, 0)]
        number_end = end - ((last == 116) | (last == 110))
        over = (end == stop) | (self.frame & (index.data[end] == _END))
        return over & index.whole_number(a, number_end), end

    def _value(self, at, v):
        """Kind, place and end of the values that begin at `v`."""
        index, stop, data = self.index, self.stop[at], self.index.data
        first = data[v]
        inside = v < stop
        kind = np.full(len(v), _BARE)
        a, b = v.copy(), np.minimum(index.bare(v), stop)
        end, more = b.copy(), np.zeros(len(v), np.int64)
        good = inside & (b > v) & ~self._torn(b, stop)
        short = ~inside | (b >= stop)
        quoted = np.flatnonzero(inside & (first == _QUOTE))
        if len(quoted):
            q = index.quote(v[quoted] + 1)
            kind[quoted], a[quoted], b[quoted], end[quoted] = _STRING, v[quoted] + 1, q, q + 1
            good[quoted] = q < stop[quoted]
            short[quoted] = ~good[quoted]
        marked = np.flatnonzero(inside & (first == _EQUALS)) if not index.text else ()
        if len(marked):
            p = np.minimum(v[marked] + 1, index.n)
            tag, limit = data[p], stop[marked]
            k = np.full(len(p), -1)
            x, y, z = p + 1, p + 1, np.zeros(len(p), np.int64)
            doubles = tag == DOUBLE_TAG
            k[doubles], y[doubles] = _DOUBLE, p[doubles] + 9
            d = np.flatnonzero(tag == DECIMAL_TAG)
            if len(d):
                width = data[p[d] + 2].astype(np.int64)
                z[d] = data[p[d] + 1]
                k[d] = np.where((width >= 1) & (width <= 32) & (z[d] <= 76), _DECIMAL, -1)
                x[d], y[d] = p[d] + 3, p[d] + 3 + width
            r = np.flatnonzero((tag == ARRAY_TAG) & (data[p + 1] == ARRAY_ELEMENT_TAG))
            if len(r):
                rank = data[p[r] + 2].astype(np.int64)
                fine = (rank >= 1) & (rank <= MAX_DIMS)
                count = np.ones(len(r), np.int64)
                for i in range(int(rank[fine].max(initial=0))):
                    has = fine & (rank > i)
                    size = index.number(np.minimum(p[r] + 3 + 4 * i, index.n), 4)
                    fine &= ~has | (size < 1 << 31)
                    count = np.where(has & fine, np.minimum(count * size, 1 << 31), count)
                k[r], z[r] = np.where(fine, _ARRAY, -1), rank
                x[r] = p[r] + 3 + 4 * rank
                y[r] = x[r] + 8 * count
            known = (k >= 0) & (y <= limit)
            # what is read past the end is zero, which no tag is
            short[marked] = (y > limit) | (p + 2 >= limit)
            good[marked], kind[marked], a[marked], b[marked] = known, k, x, y
            end[marked], more[marked] = y, z
        return good, short, kind, a, b, end, more


def _int64(text: pa.Array) -> pa.Array:
    """Which of these whole numbers have 64 bits; most are short and need no comparison."""
    digits = pc.utf8_ltrim(pc.utf8_ltrim(text, "-"), "0")
    size = pc.binary_length(digits)
    most = pc.if_else(pc.starts_with(text, "-"), _LARGEST[:-1] + "8", _LARGEST)
    return pc.or_(pc.less(size, 19), pc.and_(pc.equal(size, 19), pc.less_equal(digits, most)))


def _in_range(index: Index, a, b) -> np.ndarray:
    out = b - a <= 18
    if not out.all():
        long = np.flatnonzero(~out)
        out[long] = _int64(index.gather(a[long], b[long], False).cast(pa.string())).to_numpy(False)
    return out


def _valid(cells: pa.Array) -> np.ndarray:
    """Which cells are UTF-8; halves are looked at only where something is not."""
    try:
        cells.cast(pa.string())
        return np.ones(len(cells), bool)
    except pa.ArrowInvalid:
        half = len(cells) // 2
        return np.zeros(1, bool) if not half else np.concatenate(
            (_valid(cells[:half]), _valid(cells[half:])))


def _float(text: pa.Array) -> np.ndarray:
    text = pc.replace_substring_regex(text, r"^\+", "")
    return pc.cast(pc.replace_substring_regex(text, "Infinity", "inf"), pa.float64()).to_numpy(False)


def _pointed(text: pa.Array, scale: int) -> pa.Array:
    """Whole numbers as text, with a point `scale` digits from the right."""
    digits = pc.utf8_lpad(pc.utf8_ltrim(text, "-"), scale + 1, "0")
    return pc.binary_join_element_wise(
        pc.if_else(pc.starts_with(text, "-"), "-", ""), pc.binary_join_element_wise(
            pc.utf8_slice_codeunits(digits, 0, -scale), pc.utf8_slice_codeunits(digits, -scale), "."), "")


def _decimal(index: Index, a, b, scale) -> pa.Array:
    """Big-endian two's complement of up to 32 bytes, with a point `scale` digits from the right."""
    data = np.concatenate((np.zeros(32, np.uint8), index.data))
    # the 32 bytes up to the end of every cell, lowest first
    turned = _each(data, "V32", b).view(np.uint8).reshape(-1, 32)[:, ::-1]
    sign = np.where(index.data[a] >= 128, 255, 0).astype(np.uint8)
    wide = np.where(np.arange(32) < (b - a)[:, None], turned, sign[:, None])
    order, parts = [], []
    for s in np.unique(scale).tolist():
        at = np.flatnonzero(scale == s)
        whole, own = pa.py_buffer(np.ascontiguousarray(wide[at])), pa.decimal256(76, s)
        own = pa.Array.from_buffers(own, len(at), [None, whole]).cast(pa.string())
        # small numbers come with an exponent
        small = pc.match_substring(own, "E")
        if pc.any(small).as_py():
            text = pa.Array.from_buffers(pa.decimal256(76, 0), len(at), [None, whole]).cast(pa.string())
            own = pc.replace_with_mask(own, small, _pointed(text.filter(small), s))
        order.append(at)
        parts.append(own)
    if len(parts) == 1:
        return parts[0]
    back = np.argsort(np.concatenate(order), kind="stable")
    return pa.concat_arrays(parts).take(pa.array(back))


def _lists(size: np.ndarray, missing: np.ndarray, values: pa.Array) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array(missing))


def _block(data: np.ndarray, start: np.ndarray, stop: np.ndarray, text: bool) -> pa.Array:
    index = Index(data, start, text)
    scan = Scan(index, start, stop)
    symbols, fields, ok = scan.symbols, scan.fields, scan.ok
    name, name_end, kind, a, b, more = fields.cols

    # what bare values are
    bare = np.flatnonzero(kind == _BARE)
    if len(bare):
        x, y = a[bare], b[bare]
        last, own = index.data[y - 1], np.full(len(bare), _BARE)
        for byte, k in ((105, _INTEGER), (116, _MICROS), (110, _NANOS)):
            own[(last == byte) & (y - x > 1)] = k
        whole = own != _BARE
        good = ~whole | index.whole_number(x, y - 1)
        good[whole & good] = _in_range(index, x[whole & good], y[whole & good] - 1)
        rest = np.flatnonzero(~whole)
        raw = index.gather(x[rest], y[rest], False)
        fine = _valid(raw)
        raw = pc.if_else(pa.array(fine), raw, pa.scalar(b"?", pa.binary())).cast(pa.string())
        truth = pc.is_in(raw, pa.array(["t", "f", "T", "F", "true", "false"])).to_numpy(False)
        number = pc.match_substring_regex(raw, _FLOAT_TEXT).to_numpy(False)
        own[rest] = np.where(truth, _BOOLEAN, np.where(number, _FLOAT, _BARE))
        good[rest] = truth | number
        kind[bare] = np.where(good, own, _FLOAT)
        b[bare] = np.where(whole, y - 1, y)
        ok[fields.line[bare[~good]]] = False
    # timestamps of 64 bits
    unit = index.data[scan.stamp_end - 1]
    stamp_end = scan.stamp_end - ((unit == 116) | (unit == 110))
    fits = _in_range(index, scan.stamp_start, stamp_end)
    ok[scan.stamped[~fits]] = False

    # text that is not UTF-8
    tables = index.gather(scan.table_start, np.where(ok, scan.table_end, scan.table_start))
    ok &= _valid(tables)
    lines = len(start)

    def strings(x, y):
        return index.gather(x, y).cast(pa.string())

    def shown_texts():
        """Texts of the cells that are shown as they stand; the place of others is empty."""
        return strings(a, np.where(kind <= _FLOAT, b, a))

    def texts():
        return strings(name, name_end), shown_texts(), strings(*symbols.cols[:2]), strings(*symbols.cols[2:])

    try:
        # mostly all of it is
        names, held, keys, values = texts()
        whole = bool(ok.all())
    except pa.ArrowInvalid:
        whole = False
    if not whole:
        if not text:
            quoted = np.flatnonzero(kind == _STRING)
            for line, x, y in ((fields.line, name, name_end), (fields.line[quoted], a[quoted], b[quoted]),
                               (symbols.line, *symbols.cols[:2]), (symbols.line, *symbols.cols[2:])):
                ok[line[~_valid(index.gather(x, y))]] = False
        symbols.only(ok[symbols.line])
        fields.only(ok[fields.line])
        name, name_end, kind, a, b, more = fields.cols
        names, held, keys, values = texts()

    def ends(cells):
        return pa.array(np.searchsorted(cells.line, np.arange(lines + 1)).astype(np.int32))

    shown = kind <= _FLOAT
    held = pc.if_else(pa.array(shown | (kind == _DECIMAL)), held, pa.scalar(None, pa.string()))
    truth = kind == _BOOLEAN
    if truth.any():
        held = pc.replace_with_mask(held, pa.array(truth), pc.utf8_lower(
            pc.utf8_slice_codeunits(held.filter(pa.array(truth)), 0, 1)))
    exact = kind == _DECIMAL
    if exact.any():
        held = pc.replace_with_mask(held, pa.array(exact), _decimal(index, a[exact], b[exact], more[exact]))
    parts = {"name": names, "kind": SHOWN.take(pa.array(kind)), "text": held}
    if not text:
        double, bare, arrays = kind == _DOUBLE, kind == _FLOAT, kind == _ARRAY
        number = np.zeros(len(kind))
        number[double] = _each(index.data, "<f8", a[double])
        if bare.any():
            number[bare] = _float(held.filter(pa.array(bare)))
        parts["number"] = pa.array(number, mask=~(double | bare))
        size = np.where(arrays, (b - a) // 8, 0)
        cells = slices(index.data, a[arrays], b[arrays])
        parts["numbers"] = _lists(size, ~arrays, pa.array(
            np.frombuffer(cells.buffers()[2], "<f8") if arrays.any() else np.zeros(0)))
        rank = np.where(arrays, more, 0)
        place = np.repeat(a - 4 * rank, rank) + 4 * (np.arange(rank.sum())
                                                      - np.repeat(np.cumsum(rank) - rank, rank))
        parts["dims"] = _lists(rank, ~arrays, pa.array(index.number(place, 4).astype(np.int32)))
    found = pa.StructArray.from_arrays(list(parts.values()), list(parts))
    pairs = pa.StructArray.from_arrays([keys, values], ["name", "value"])

    at = np.zeros(lines, np.int64)
    timed = np.zeros(lines, bool)
    keep = ok[scan.stamped]
    stamped = scan.stamped[keep]
    timed[stamped] = True
    at[stamped] = pc.cast(index.gather(scan.stamp_start[keep], stamp_end[keep], False).cast(pa.string()),
                          pa.int64()).to_numpy(False)
    micros = np.zeros(lines, bool)
    micros[stamped] = unit[keep] == 116
    units = pc.if_else(pa.array(micros), "us", "ns")
    none = pa.scalar(None, pa.string())
    return pa.StructArray.from_arrays(
        [pc.if_else(pa.array(ok), pc.if_else(pa.array(ok), tables, b"").cast(pa.string()), none),
         pa.ListArray.from_arrays(ends(symbols), pairs), pa.ListArray.from_arrays(ends(fields), found),
         pa.array(at, mask=~timed), pc.if_else(pa.array(timed), units, none), pa.array(ok)],
        ["tbl", "symbols", "fields", "at", "at_unit", "ok"])


def _bytes(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings or binary values, and where each begins."""
    cells = cells.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset:cells.offset + len(cells) + 1]
    if cells.buffers()[2] is None:
        return np.zeros(0, np.uint8), ends
    return np.frombuffer(cells.buffers()[2], np.uint8), ends


def take_apart(cells: pa.Array, text: bool) -> pa.Array:
    """Table, symbols, fields and instant of every line; `ok` is false for what is no line."""
    data, ends = _bytes(cells)
    out, first = [], 0
    while first < len(cells) or not out:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK, "right")) - 1)
        last = min(last, len(cells))
        base = ends[first:last + 1] - ends[first] if len(cells) else np.zeros(1, np.int64)
        part = data[ends[first]:ends[last]] if len(cells) else data
        out.append(_block(part, base[:-1], base[1:], text))
        first = last
    return out[0] if len(out) == 1 else pa.concat_arrays(out)


def line_ends(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lines that begin at `start` end (at a line end), and which need bytes beyond `data`.

    A malformed line ends at its first line end that is not escaped.
    """
    index = Index(data, np.zeros(0, np.int64), False)
    scan = Scan(index, start, np.full(len(start), len(data)), frame=True, keep=False)
    end, short = scan.end.copy(), scan.short
    broken = np.flatnonzero(~scan.ok & ~short)
    plain = np.append(index.ends, len(data))
    end[broken] = plain[np.searchsorted(index.ends, start[broken])]
    return end, short | (end >= len(data))


def candidates(data: np.ndarray) -> np.ndarray:
    """Where a line may begin: after every byte of a line end, be it one or part of a cell."""
    return np.flatnonzero(data == _END) + 1


def chain(first: int, start: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Which of the places `start` are reached from number `first`, by pointer doubling.

    `following` is the number of the next place, or len(start) where the chain leaves.
    """
    n = len(start)
    reached = np.zeros(n + 1, bool)
    reached[first] = True
    jump = np.append(following, n)
    while True:
        before = reached.sum()
        reached[jump[np.flatnonzero(reached)]] = True
        if reached.sum() == before and (jump == jump[jump]).all():
            return reached[:n]
        jump = jump[jump]


def frames(data: np.ndarray, size: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the lines of a payload, from windows of bounded size."""
    begin, window = 0, size
    while begin < len(data):
        part = data[begin:begin + window]
        last = begin + window >= len(data)
        if last and part[-1] != _END:
            part = np.append(part, np.uint8(_END))
        start = np.concatenate(([0], candidates(part)))
        start = start[start < len(part)]
        end, short = line_ends(part, start)
        if last:
            # nothing follows: a line that would go on ends here
            end, short = np.where(short, len(part) - 1, end), np.zeros(len(start), bool)
        if short[0]:
            window *= 2
            continue
        following = np.where(short, len(start), np.searchsorted(start, end + 1))
        mine = np.flatnonzero(chain(0, start, following))
        more = mine[short[mine]]
        mine = mine[~short[mine]]
        yield begin + start[mine], begin + end[mine]
        begin += int(start[more[0]]) if len(more) else int(end[mine[-1]]) + 1
        window = size


def split(payloads: pa.Array) -> pa.Array:
    """The lines of every payload."""
    data, ends = _bytes(payloads)
    out, counts = [], []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        own = data[a:b]
        found = [slices(own, *w) for w in frames(own)]
        counts.append(sum(map(len, found)))
        out += found
    values = pa.concat_arrays(out) if out else pa.array([], pa.binary())
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), values)
