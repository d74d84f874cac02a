"""Name rules for tables and columns, as column predicates and driver-side checks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_NAME_BYTES = 127

# Characters a table or column name must not contain.
FORBIDDEN = r"""?,'"\/:)(+*%~""" + "\r\n"
FORBIDDEN_RANGES = ((0x0000, 0x000F), (0x007F, 0x007F), (0xFEFF, 0xFEFF))
COLUMN_ONLY = ".-"


def _char_class(extra: str = "") -> str:
    listed = "".join(f"\\x{{{ord(c):x}}}" for c in FORBIDDEN + extra)
    ranges = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in FORBIDDEN_RANGES)
    return f"[{listed}{ranges}]"


def name_error(c: Column, kind: str = "table", max_bytes: int = MAX_NAME_BYTES) -> Column:
    """NULL for a valid name, else the broken rule."""
    rules = F.when(c.isNull(), F.lit("null name"))
    rules = rules.when(c == "", F.lit("empty name"))
    rules = rules.when(F.octet_length(c) > max_bytes, F.lit("name too long"))
    if kind == "table":
        rules = rules.when(c.rlike(_char_class()), F.lit("forbidden character"))
        rules = rules.when(
            c.startswith(".") | c.endswith(".") | c.contains(".."), F.lit("misplaced dot")
        )
    else:
        rules = rules.when(c.rlike(_char_class(COLUMN_ONLY)), F.lit("forbidden character"))
    return rules


def is_valid_name(c: Column, kind: str = "table", max_bytes: int = MAX_NAME_BYTES) -> Column:
    return name_error(c, kind, max_bytes).isNull()


def check_name(name: str, kind: str = "table", max_bytes: int = MAX_NAME_BYTES) -> str:
    """Plan-time form of `name_error` for constant names."""
    bad = set(FORBIDDEN) | set(COLUMN_ONLY if kind == "column" else "")
    if not name:
        raise ValueError(f"a {kind} name must not be empty")
    if len(name.encode()) > max_bytes:
        raise ValueError(f"{kind} name {name!r} is longer than {max_bytes} bytes")
    for pos, ch in enumerate(name):
        if ch in bad or any(a <= ord(ch) <= b for a, b in FORBIDDEN_RANGES):
            raise ValueError(f"{kind} name {name!r} has forbidden character {ch!r} at {pos}")
    if kind == "table" and re.search(r"^\.|\.$|\.\.", name):
        raise ValueError(f"table name {name!r} has a misplaced dot")
    return name
