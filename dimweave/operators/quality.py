"""Throughput, lookup statistics and checks of enriched lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dimweave.functions.fields import parse_int, parse_stamp
from dimweave.functions.text import KeyValue
from dimweave.session import configure

# Seconds allowed on top of the staleness bound, and the bound for cold keys.
HOT_GRACE, COLD_GRACE, COLD_TTL = 6, 12, 900


def throughput(
    frame: DataFrame,
    ts: str = "ts",
    message: str = "line",
    order: Sequence[str] = ("ts",),
    width: str = "10 seconds",
) -> DataFrame:
    """Records per aligned window of event time, with the first message of the window."""
    configure(frame.sparkSession)
    return (
        frame.groupBy(F.window(ts, width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min_by(message, F.struct(*order)).alias("message"),
        )
        .select(F.col("w.start").cast("timestamp").alias("window_start"), "records", "message")
    )


def check_lines(
    frame: DataFrame,
    key_column: str,
    bound: int,
    ttl: int,
    as_of: Column,
    line: str = "line",
) -> DataFrame:
    """Add `violation`: NULL, `key_mismatch`, `unparseable` or `stale`.

    The key must equal the `id` field (both missing counts as equal).  Keys in the first
    hundredth of `bound` are hot and may be `ttl` seconds old, others 900, plus a grace.
    """
    configure(frame.sparkSession)
    fields = frame.withColumn("__f", KeyValue().decode(F.col(line)))
    read = fields.withColumns(
        {
            "__key": F.col("__f")[key_column],
            "__id": F.col("__f")["id"],
            "__update": F.col("__f")["update_time"],
        }
    )
    number, updated = parse_int(F.col("__id")), parse_stamp(F.col("__update"))
    allowed = F.when(number < bound // 100, F.lit(ttl + HOT_GRACE)).otherwise(
        F.lit(COLD_TTL + COLD_GRACE)
    )
    age = F.unix_millis(as_of.cast("timestamp")) - F.unix_millis(updated)
    violation = (
        F.when(~F.col("__key").eqNullSafe(F.col("__id")), F.lit("key_mismatch"))
        .when(number.isNull() | updated.isNull(), F.lit("unparseable"))
        .when(age > allowed * 1000, F.lit("stale"))
    )
    return read.withColumn("violation", violation).drop("__f", "__key", "__id", "__update")


def error_counts(checked: DataFrame, ts: str = "ts", width: str = "10 seconds") -> DataFrame:
    """Records and violations per window of a frame from `check_lines`."""
    configure(checked.sparkSession)
    return (
        checked.groupBy(F.window(ts, width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count("violation").alias("errors"),
        )
        .select(F.col("w.start").cast("timestamp").alias("window_start"), "records", "errors")
    )


def lookup_stats(
    frame: DataFrame, batch: Column, key: str = "dim_key", value: str = "dim_value"
) -> DataFrame:
    """Per batch: rows, distinct keys, fetches saved by asking once per key, hits and misses."""
    configure(frame.sparkSession)
    # Counting per (batch, key) first keeps a hot key from travelling row by row.
    per_key = frame.groupBy(batch.alias("batch"), F.col(key).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("hit")
    )
    return per_key.groupBy("batch").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.sum("n") - F.count(F.lit(1))).alias("fetches_saved"),
        F.sum("hit").alias("matched"),
        (F.sum("n") - F.sum("hit")).alias("missed"),
    )


def observed(
    frame: DataFrame, name: str, value: str = "dim_value"
) -> tuple[DataFrame, Observation]:
    """Count rows, hits and misses while the frame is used, without a job of their own."""
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows"), F.count(value).alias("matched")]
    counts.append((F.count(F.lit(1)) - F.count(value)).alias("missed"))
    return frame.observe(seen, *counts), seen
