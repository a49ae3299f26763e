"""Expressions on decoded fields: lookup key, merge, null test, JSON paths, typed reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimweave.functions.text import empty_fields, is_blank

STAMP_FORMAT = "yyyyMMdd HH:mm:ss"


def lookup_key(fields: Column, left_field: str, key_expr: str) -> Column:
    """Key text from one field of a map; a missing field is formatted as `null`."""
    return format_key(F.element_at(fields, F.lit(left_field)), key_expr)


def format_key(value: Column, key_expr: str) -> Column:
    """Key text from a value; NULL is formatted as `null`."""
    return F.format_string(key_expr, value)


def merge(source: Column, dim: Column) -> Column:
    """Dimension fields over source fields: the dimension wins, in the source's position."""
    return F.map_concat(source, F.coalesce(dim, empty_fields()))


def is_null_text(value: Column) -> Column:
    return is_blank(value)


def is_null_hash(value: Column) -> Column:
    return value.isNull() | (F.size(value) == 0)


def json_path(document: Column, path: str, default: str | None = None) -> Column:
    """Text at a dotted path of a JSON column, containers as JSON text, else the default."""
    steps = [step for step in path.split(".") if step]
    if any("'" in step for step in steps):
        raise ValueError("quotes are not supported in a JSON path")
    if not steps:
        return F.lit(default).cast("string")
    found = F.get_json_object(document, "$" + "".join(f"['{step}']" for step in steps))
    return F.coalesce(found, F.lit(default).cast("string"))


def parse_int(text: Column) -> Column:
    """32-bit integer, NULL where the text is not one (no blanks, no decimals)."""
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("int"))


def parse_stamp(text: Column, pattern: str = STAMP_FORMAT) -> Column:
    """Timestamp, NULL where the text does not follow the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def draw(number: Column, salt: str, bound: int) -> Column:
    """Repeatable pseudo-random integer in [0, bound) derived from a number and a salt."""
    if not 0 < bound <= 1 << 32:
        raise ValueError("bound must be from 1 to 2**32, a draw has 32 bits")
    digest = F.md5(F.concat(number.cast("string"), F.lit("-" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(bound)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def floor_to(number: Column, width: int) -> Column:
    """Largest multiple of `width` not above the number, in integer arithmetic."""
    return number - F.pmod(number, F.lit(width).cast("bigint"))
