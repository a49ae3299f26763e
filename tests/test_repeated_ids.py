"""Samples of events whose numbers repeat, against their SQL."""

import os

import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """The small tables, each event once more under the same number with another user."""
    folder = tmp_path_factory.mktemp("repeated")
    for name in oracle.TABLES:
        if name != "events":
            os.symlink(f"{SF}/{name}.parquet", folder / f"{name}.parquet")
    events = spark.read.parquet(f"{SF}/events.parquet")
    twice = events.union(events.withColumn("user_id", F.col("user_id") + 1000))
    twice.toPandas().to_parquet(folder / "events.parquet", coerce_timestamps="us")
    return str(folder)


@pytest.mark.parametrize("name", ["sample_greedy", "sample_greedy_by_number", "stream_sample_greedy"])
def test_sample(spark, repeated, name):
    rows, difference = oracle.compare(
        oracle.connect(repeated), entry.queries()[name](spark, repeated), entry.oracle_sql()[name]
    )
    assert difference is None
    assert rows > 0
