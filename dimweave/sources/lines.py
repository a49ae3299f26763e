"""Line input: any text source with one string column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch of text lines in a column `line`."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of text lines; `files_per_batch` bounds a micro-batch."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).withColumnRenamed("value", "line")


def as_lines(frame: DataFrame, column: str = "value") -> DataFrame:
    """The string or binary `value` of a socket, message-queue or other source as `line`.

    Bytes stay bytes: a lookup decodes them by the charset of its format."""
    kind = frame.schema[column].dataType.typeName()
    value = F.col(column) if kind == "binary" else F.col(column).cast("string")
    return frame.withColumn("line", value).drop(*([column] if column != "line" else []))


def stream_table(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the rows of a parquet table, be it a folder or a single file."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A file source insists on a folder unless its path is a pattern.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
