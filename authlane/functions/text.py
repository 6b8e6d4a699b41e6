"""Blank-aware string helpers: '' means absent throughout the data model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: the characters that count as white space around a text.
WHITESPACE = " \t\n\r\x0b\x0c\x85\xa0"


def strip(c: Column) -> Column:
    """Trim all white space; the plain trim takes spaces only."""
    return F.trim(c, F.lit(WHITESPACE))


def null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_nonblank(*cols: Column, default: str | Column = "") -> Column:
    """First value that is neither NULL nor '', else ``default``."""
    last = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(*[null_if_blank(c) for c in cols], last)


def field(key: str, fields: str | Column = "fields") -> Column:
    """Map lookup where a missing key reads as ''."""
    m = F.col(fields) if isinstance(fields, str) else fields
    return F.coalesce(m[key], F.lit(""))


def mentions(c: Column, needle: str) -> Column:
    """Case-insensitive substring test."""
    return F.contains(F.lower(c), F.lit(needle.lower()))


def fields_text(fields: str | Column = "fields") -> Column:
    """Map rendered as sorted ``key=value`` lines, for comparing and hashing maps."""
    m = F.col(fields) if isinstance(fields, str) else fields
    lines = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(lines), "\n")


def sql_text(value: str) -> str:
    """A string literal for a SQL expression."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
