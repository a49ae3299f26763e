from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from dimweave.operators import check_lines, error_counts, throughput

NOW = datetime(2021, 4, 28, 12, 0, tzinfo=UTC)


def stamp(age):
    return (NOW - timedelta(seconds=age)).strftime("%Y%m%d %H:%M:%S")


def test_throughput(spark):
    rows = [(9.9, 2, "b"), (0.0, 1, "a"), (10.0, 4, "d"), (9.9, 3, "c"), (35.0, 5, None)]
    frame = spark.createDataFrame(
        [(NOW + timedelta(seconds=s), i, m) for s, i, m in rows], "ts timestamp, i int, line string"
    )
    got = throughput(frame, order=("ts", "i")).orderBy("window_start").collect()
    assert [(r["records"], r["message"]) for r in got] == [(3, "a"), (1, "d"), (1, None)]
    plain = throughput(frame.withColumn("ts", F.col("ts").cast("timestamp_ntz")), order=("i",))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, got))


def test_checks(spark):
    cases = {
        f"mykey=7|id=7|update_time={stamp(306)}": None,
        f"mykey=7|id=7|update_time={stamp(307)}": "stale",
        f"mykey=999|id=999|update_time={stamp(307)}": "stale",
        f"mykey=1000|id=1000|update_time={stamp(912)}": None,
        f"mykey=1000|id=1000|update_time={stamp(913)}": "stale",
        f"mykey=7|id=8|update_time={stamp(0)}": "key_mismatch",
        f"mykey=7|update_time={stamp(0)}": "key_mismatch",
        f"id=7|update_time={stamp(0)}": "key_mismatch",
        f"update_time={stamp(0)}": "unparseable",
        "mykey=7|id=7": "unparseable",
        "mykey=7|id=7|update_time=yesterday": "unparseable",
        f"mykey=x|id=x|update_time={stamp(0)}": "unparseable",
        "": "unparseable",
    }
    frame = spark.createDataFrame([(c,) for c in cases], "line string")
    got = check_lines(frame, "mykey", 100_000, 300, F.lit(NOW))
    assert got.columns == ["line", "violation"]
    assert {r["line"]: r["violation"] for r in got.collect()} == cases


def test_error_counts(spark):
    rows = [(0, None), (3, "stale"), (9, "stale"), (10, None), (21, "key_mismatch")]
    frame = spark.createDataFrame(
        [(NOW + timedelta(seconds=s), v) for s, v in rows], "ts timestamp, violation string"
    )
    got = error_counts(frame).orderBy("window_start").collect()
    assert [(r["records"], r["errors"]) for r in got] == [(3, 2), (1, 0), (1, 1)]
