"""Written intermediate tables, and columns handed to Arrow functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dimweave.session import fresh_folder

OUT_ROWS = 20_000
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder of the cluster and read it back.

    This cuts the lineage: an executor that is lost later costs no recomputation of what went
    before, and whatever depends on chance or order is decided once.
    """
    path = fresh_folder(frame.sparkSession, f"llm-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def remove(frame: DataFrame) -> None:
    """Delete the files of a materialized frame that nothing reads any more."""
    spark = frame.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of BATCH_ROWS rows, unless the session sets a number.

    Spark's default of 10 000 rows counts on narrow ones; a batch of whole texts is held several
    times over, by the executor and by Python.  No result depends on the setting."""
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def map_rows(
    frame: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[list[tuple]]],
    schema: str,
) -> DataFrame:
    """Arrow batches in, lists of rows out; the rows are put into batches of `schema`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    small_batches(frame.sparkSession)
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in function(batches):
            for at in range(0, len(rows), OUT_ROWS):
                columns = list(zip(*rows[at : at + OUT_ROWS], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return frame.mapInArrow(run, struct)
