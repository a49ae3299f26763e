"""Dimension tables: string-valued and hash-valued, one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def string_dim(
    frame: DataFrame,
    key: str | Column,
    value: str | Column,
    latest_by: str | Column | None = None,
) -> DataFrame:
    """`(dim_key, dim_value)` rows; with `latest_by` the newest value of each key, of equal ones the greatest.

    Rows without a time come before all others."""
    rows = frame.select(_column(key).alias("dim_key"), _column(value).alias("dim_value"),
                        *([_column(latest_by).alias("__at")] if latest_by is not None else []))
    rows = rows.where("dim_key IS NOT NULL")
    if latest_by is None:
        return rows
    return rows.groupBy("dim_key").agg(F.max_by("dim_value", F.struct("__at", "dim_value")).alias("dim_value"))


def hash_dim(
    frame: DataFrame,
    key: str | Column,
    field: str | Column,
    value: str | Column,
    latest_by: str | Column | None = None,
) -> DataFrame:
    """`(dim_key, dim_fields)` folded from one row per field, fields in name order.

    Repeated fields are reduced first, on (key, field) and before the shuffle, so what is
    gathered per key is no more than the fields of the resulting map.  Of equal times the greatest
    value counts.
    """
    order = _column(latest_by) if latest_by is not None else _column(value)
    rows = frame.select(
        _column(key).alias("dim_key"),
        _column(field).alias("field"),
        _column(value).alias("value"),
        order.alias("__at"),
    ).where("dim_key IS NOT NULL AND field IS NOT NULL")
    fields = rows.groupBy("dim_key", "field").agg(F.max_by("value", F.struct("__at", "value")).alias("value"))
    return fields.groupBy("dim_key").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias(
            "dim_fields"
        )
    )


def duplicate_keys(dim: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their counts; empty for a sound dimension."""
    return dim.groupBy("dim_key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_unique(dim: DataFrame) -> DataFrame:
    """The dimension itself, or ValueError where a key repeats (runs a job)."""
    repeated = duplicate_keys(dim).select("dim_key").take(1)
    if repeated:
        raise ValueError(f"dimension key occurs more than once: {repeated[0][0]!r}")
    return dim
