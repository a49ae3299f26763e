"""Synthetic input lines, derived from the integers of any DataFrame.

Draws are hashes of the number, so a line is the same on every run and on every engine.  Each
generator is a plain projection: no shuffle, and as parallel as its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.functions.fields import draw


def numbers(spark: SparkSession, count: int, partitions: int | None = None) -> DataFrame:
    """Numbers 0 to count - 1 in a column `id`."""
    return spark.range(0, count, 1, partitions) if partitions else spark.range(count)


def number_stream(spark: SparkSession, rows_per_batch: int, partitions: int = 1) -> DataFrame:
    """Endless numbers in a column `id`, a fixed count per micro-batch."""
    stream = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("numPartitions", partitions)
        .load()
    )
    return stream.select(F.col("value").alias("id"), F.col("timestamp").alias("ts"))


def _modulo(number: Column, bound: int) -> Column:
    if bound < 1:
        raise ValueError("bound must be positive")
    return F.pmod(number, F.lit(bound).cast("bigint"))


def _with_age(key: Column, number: Column) -> Column:
    return F.concat_ws(
        "|", key.cast("string"), draw(number, "age", 100).cast("string"), F.lit("CN")
    )


def sequential_kv(number: Column, key_column: str, bound: int) -> Column:
    """`<key_column>=<n mod bound>`."""
    return F.concat(F.lit(key_column + "="), _modulo(number, bound).cast("string"))


def sequential_text(number: Column, bound: int) -> Column:
    """`<n mod bound>|<0-99>|CN`."""
    return _with_age(_modulo(number, bound), number)


def skewed_key(number: Column, bound: int) -> Column:
    """Key in [0, bound): near a third of all draws fall on the first hundredth of the keys."""
    if bound < 100:
        raise ValueError("bound must be at least 100")
    share = draw(number, "class", 100)
    # The shares of draws and the bands of keys they fall into.
    return (
        F.when(share < 25, draw(number, "key", bound // 100))
        .when(share < 40, draw(number, "key", bound * 5 // 100))
        .when(share < 65, draw(number, "key", bound // 10))
        .when(share < 90, bound // 10 + draw(number, "key", bound * 2 // 10))
        .otherwise(bound * 3 // 10 + draw(number, "key", bound * 7 // 10))
    )


def skewed_text(number: Column, bound: int) -> Column:
    """`<skewed key>|<0-99>|CN`."""
    return _with_age(skewed_key(number, bound), number)
