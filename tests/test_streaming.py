import os
import sys
import time
from datetime import UTC, datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from dimweave import Lookup, lookup_join
from dimweave.operators import (
    LookupOptions,
    check_lines,
    error_counts,
    sample_every_n,
    sample_greedy,
    throughput,
)
from dimweave.sources import number_stream, read_lines, stream_lines, stream_table
from dimweave.streaming import (
    AgingDim,
    StreamSampleEveryN,
    StreamSampleGreedy,
    StreamTotals,
    StreamWindows,
    dropped_rows,
    enrich_stream,
    lookup_totals,
    parquet_sink,
    stream_error_counts,
    stream_sample_greedy,
    stream_throughput,
    text_sink,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOOKUP = Lookup(left_field="u", key_expr="k%s")
START = datetime(2024, 1, 1, tzinfo=UTC)


def drain(frame, path, checkpoint):
    writer = frame.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(path).awaitTermination()


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return {n: str(tmp_path / n) for n in ("in", "out", "checkpoint", "dim")}


def add_lines(folders, name, lines):
    with open(os.path.join(folders["in"], name), "w") as f:
        f.write("".join(line + "\n" for line in lines))


def dim_of(spark, **values):
    return spark.createDataFrame(list(values.items()), "dim_key string, dim_value string")


def test_stream_equals_batch(spark, folders):
    for n in range(4):
        add_lines(folders, f"{n}.txt", [f"u={i}|n={n}" for i in range(n, n + 9)] + ["", "junk"])
    dim = dim_of(spark, k1="v=1", k5="v=5")
    running = enrich_stream(
        stream_lines(spark, folders["in"], files_per_batch=1),
        lambda: dim,
        parquet_sink(folders["out"]),
        folders["checkpoint"],
        LOOKUP,
        trigger=None,
    ).start()
    running.awaitTermination()
    got = spark.read.parquet(folders["out"])
    assert got.select("batch").distinct().count() == 4
    want = lookup_join(read_lines(spark, folders["in"]), dim, LOOKUP)
    assert sorted(r[0] for r in got.select("enriched").collect()) == sorted(
        r[0] for r in want.collect()
    )


def test_restart_takes_only_new_files(spark, folders):
    def run():
        enrich_stream(
            stream_lines(spark, folders["in"]),
            lambda: dim_of(spark, k1="v=1"),
            text_sink(folders["out"]),
            folders["checkpoint"],
            LOOKUP,
            trigger=None,
            name="restarted",
        ).start().awaitTermination()
        return sorted(r["value"] for r in spark.read.text(folders["out"]).collect())

    add_lines(folders, "0.txt", ["u=1", "u=2"])
    assert run() == ["u=1|v=1", "u=2"]
    add_lines(folders, "1.txt", ["u=3"])
    assert run() == ["u=1|v=1", "u=2", "u=3"]


def test_repeated_batch_replaces_its_output(spark, folders):
    sink = parquet_sink(folders["out"])
    for value in ("first", "again"):
        sink(spark.createDataFrame([(value,)], "enriched string"), 7)
    assert [tuple(r) for r in spark.read.parquet(folders["out"]).collect()] == [("again", 7)]


def test_aging_dimension(spark, folders):
    now = [0.0]

    def put(value):
        dim_of(spark, k1=value).write.mode("overwrite").parquet(folders["dim"])

    def value(dim):
        return dim.current().first()["dim_value"]

    def load():
        spark.catalog.refreshByPath(folders["dim"])
        return spark.read.parquet(folders["dim"])

    aging = AgingDim(load, ttl=10, clock=lambda: now[0])
    put("a")
    assert value(aging) == "a"
    put("b")
    now[0] = 9.9
    assert value(aging) == "a"
    now[0] = 10.0
    assert value(aging) == "b"
    put("c")
    now[0] = 25.0
    assert value(aging) == "c"
    assert aging.loads == 3
    live = AgingDim(load)
    put("d")
    assert value(live) == "d"
    assert AgingDim(load, refresh="hour").ttl == 300


def test_dimension_is_reread_between_batches(spark, folders):
    now = [0.0]
    values = iter(["old", "new", "newest"])
    aging = AgingDim(lambda: dim_of(spark, k1="v=" + next(values)), ttl=10, clock=lambda: now[0])
    out = parquet_sink(folders["out"])

    def sink(batch, batch_id):
        out(batch, batch_id)
        now[0] += 6

    for n in range(4):
        add_lines(folders, f"{n}.txt", [f"u=1|n={n}"])
    enrich_stream(
        stream_lines(spark, folders["in"], 1), aging, sink, folders["checkpoint"], LOOKUP,
        trigger=None,
    ).start().awaitTermination()
    got = spark.read.parquet(folders["out"]).orderBy("batch").collect()
    assert [r["enriched"].split("v=")[1] for r in got] == ["old", "old", "new", "new"]


def test_static_join_on_a_stream(spark, folders):
    add_lines(folders, "0.txt", ["u=1", "u=2"])
    joined = lookup_join(stream_lines(spark, folders["in"]), dim_of(spark, k1="v=1"), LOOKUP)
    drain(joined, folders["out"], folders["checkpoint"])
    got = spark.read.parquet(folders["out"]).collect()
    assert sorted(r["enriched"] for r in got) == ["u=1|v=1", "u=2"]


def events(spark, folders, rows):
    frame = spark.createDataFrame(
        [(START + timedelta(milliseconds=t), k, i) for i, (t, k) in enumerate(rows)],
        "ts timestamp, k string, i int",
    )
    frame = frame.withColumn("line", F.concat(F.lit("mykey="), "i", F.lit("|id=1")))
    frame.coalesce(1).write.mode("append").parquet(folders["in"])
    return frame


def test_throughput_of_closed_windows(spark, folders):
    rows = [(t * 700, "a") for t in range(100)]
    frame = events(spark, folders, rows)
    stream = stream_table(spark, folders["in"])
    drain(stream_throughput(stream, order=("ts", "i"), late="0 seconds"), folders["out"], folders["checkpoint"])
    closed = START + timedelta(milliseconds=99 * 700 - 10_000)
    want = throughput(frame, order=("ts", "i")).where(F.col("window_start") <= F.lit(closed))
    assert want.count() == 6
    got = spark.read.parquet(folders["out"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_error_counts_of_closed_windows(spark, folders):
    frame = events(spark, folders, [(t * 700, "a") for t in range(100)])

    def check(f):
        return check_lines(f, "mykey", 1000, 30, F.lit(START))

    stream = check(stream_table(spark, folders["in"]))
    drain(stream_error_counts(stream, late="0 seconds"), folders["out"], folders["checkpoint"])
    got = sorted(map(tuple, spark.read.parquet(folders["out"]).collect()))
    assert got == sorted(map(tuple, error_counts(check(frame)).collect()))[: len(got)]
    assert len(got) == 6


def test_greedy_sample_keeps_its_state(spark, folders):
    rows = [((t * 37) % 5000 + 5000 * part, "ab"[t % 2]) for part in range(3) for t in range(90)]
    frames = [events(spark, folders, rows[n : n + 90]) for n in (0, 90, 180)]
    whole = frames[0].union(frames[1]).union(frames[2])
    stream = stream_table(spark, folders["in"], files_per_batch=1)
    drain(
        stream_sample_greedy(stream, ["k"], "ts", 400), folders["out"], folders["checkpoint"]
    )
    got = spark.read.parquet(folders["out"])
    want = sample_greedy(whole, ["k"], "ts", 400, ["ts", "i"]).select(
        "k", F.unix_millis("ts").alias("tick")
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_number_stream(spark, folders):
    stream = number_stream(spark, 10)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", folders["checkpoint"])
    running = writer.start(folders["out"])
    try:
        until = time.monotonic() + 60
        while time.monotonic() < until and not (running.lastProgress or {}).get("numInputRows"):
            time.sleep(0.2)
    finally:
        running.stop()
    ids = sorted(r["id"] for r in spark.read.parquet(folders["out"]).collect())
    assert ids[:10] == list(range(10))


class CountedStore:
    def __init__(self, folder):
        self.folder = folder

    def get_many(self, keys):
        with open(f"{self.folder}/asked.txt", "a") as f:
            f.write("".join(k + "\n" for k in keys))
        return {k: "v=" + k for k in keys if k != "k9"}


def keyed_run(spark, folders, now, files, **options):
    """Enriched lines and the keys asked for, one micro-batch for each new file."""
    path = folders["asked"]

    def open_store():
        return CountedStore(path)

    for name, users in files:
        add_lines(folders, name, [f"u={u}" for u in users])
        enrich_stream(
            stream_lines(spark, folders["in"]), None, parquet_sink(folders["out"]),
            folders["checkpoint"], LOOKUP, trigger=None, open_store=open_store, clock=lambda: now[0],
            **options,
        ).start().awaitTermination()
        now[0] += 6
    with open(f"{path}/asked.txt") as f:
        return sorted(f.read().split())


@pytest.mark.parametrize("negative", [True, False])
def test_answers_are_remembered_by_key(spark, folders, tmp_path, negative):
    """k1 is asked at 0 and again at 12, when its answer is 10 s old; k2 at 6 only; the miss k9
    like k1, or every time.  Each micro-batch is a restart of its own."""
    (tmp_path / "asked").mkdir()
    folders["asked"] = str(tmp_path / "asked")
    files = [("0", [1, 9, 1]), ("1", [1, 2, 9]), ("2", [1, 2, 9])]
    asked = keyed_run(spark, folders, [100.0], files, ttl=10, negative_cache=negative)
    assert asked == sorted(["k1", "k9", "k2", "k1", "k9"] + ([] if negative else ["k9"]))
    got = spark.read.parquet(folders["out"])
    want = [f"u={u}" + ("" if u == 9 else f"|v=k{u}") for _, users in files for u in users]
    assert sorted(r["enriched"] for r in got.collect()) == sorted(want)
    # the answers of the first micro-batch have aged and are gone
    assert sorted(os.listdir(folders["checkpoint"] + "-answers")) == ["1-106000", "2-112000"]


def test_options_of_a_stream(spark, folders, tmp_path):
    (tmp_path / "asked").mkdir()
    folders["asked"] = str(tmp_path / "asked")
    given = LookupOptions(LOOKUP, ttl=100, negative_cache=True, batch_size=2, min_batch_ms=10)
    for name in ("0", "1"):
        add_lines(folders, name, ["u=1", "u=2"])
    path = folders["asked"]
    enrich_stream(
        stream_lines(spark, folders["in"], 1), None, parquet_sink(folders["out"]),
        folders["checkpoint"], given, trigger=None, open_store=lambda: CountedStore(path),
    ).start().awaitTermination()
    with open(f"{path}/asked.txt") as f:
        assert sorted(f.read().split()) == ["k1", "k2"]
    assert spark.read.parquet(folders["out"]).count() == 4


def feed(stream, sink, folders):
    writer = stream.writeStream.foreachBatch(sink)
    writer = writer.option("checkpointLocation", folders["checkpoint"])
    writer.trigger(availableNow=True).start().awaitTermination()


def test_every_n_of_a_stream_and_after_a_restart(spark, folders):
    """Two micro-batches, a restart with a new sink, then one repeated and two more."""
    frames = []
    stream = stream_table
    for part in range(4):
        ids = spark.range(part * 100, part * 100 + 95).withColumn("k", F.col("id") % 3)
        frames.append(ids)
        ids.coalesce(1).write.mode("append").parquet(folders["in"])
        if part % 2:
            sink = StreamSampleEveryN(folders["out"], "id", 10, ["k"])
            feed(stream(spark, folders["in"], 1), sink, folders)
    sink(frames[3], 3)  # as after a failure
    whole = frames[0].union(frames[1]).union(frames[2]).union(frames[3])
    want = sample_every_n(whole, "id", 10, ["k"])
    got = sink.sample(spark).collect()
    assert len(got) == 36 and sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("late_ms", [20_000, 300])
def test_greedy_sample_of_records(spark, folders, late_ms):
    """Records out of order over three micro-batches.  With enough patience nothing is late; else
    what was not late is sampled as if it were all there is."""
    rows = [((t * 37) % 5000 + 2500 * part, "ab"[t % 2]) for part in range(3) for t in range(90)]
    frames = [events(spark, folders, rows[n : n + 90]) for n in (0, 90, 180)]
    sink = StreamSampleGreedy(folders["out"], ["k"], "ts", 400, ["ts", "i"], late_ms=late_ms)
    stream = stream_table(spark, folders["in"], files_per_batch=1)
    feed(stream, sink, folders)
    sink.finish(spark)
    late = sink.late(spark)
    whole = frames[0].union(frames[1]).union(frames[2])
    assert (late.count() > 0) == (late_ms == 300)
    on_time = whole.exceptAll(late.select(*whole.columns))
    want = sample_greedy(on_time, ["k"], "ts", 400, ["ts", "i"])
    got = sink.sample(spark).select(*whole.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_greedy_sample_sets_records_without_time_aside(spark, folders):
    frame = spark.createDataFrame(
        [(None, "a", 1), (START, "a", 2), (START, None, 3), (START, None, 4)], "ts timestamp, k string, i int"
    )
    sink = StreamSampleGreedy(folders["out"], ["k"], "ts", 1000, ["ts", "i"], late_ms=0)
    sink(frame, 0)
    sink(frame.where("false"), 1)
    sink.finish(spark)
    assert sorted(r["i"] for r in sink.sample(spark).collect()) == [2, 3]
    assert [r["i"] for r in sink.late(spark).collect()] == [1]


def test_windows_are_corrected_by_late_records(spark, folders):
    frames = [
        events(spark, folders, [(t * 700 + start, "a") for t in range(30)])
        for start in (60_000, 0, 40_000)
    ]

    def check(f):
        return check_lines(f, "mykey", 1000, 30, F.lit(START))

    sink = StreamWindows(folders["out"], late_ms=5_000)
    for n, frame in enumerate([*frames, frames[2]]):
        sink(check(frame), min(n, 2))  # the last one again, as after a failure
    whole = check(frames[0].union(frames[1]).union(frames[2]))
    assert sorted(map(tuple, sink.windows(spark).collect())) == sorted(
        map(tuple, error_counts(whole).collect())
    )
    # newest is 80.3 s; windows that end at 75.3 s or before are closed for later micro-batches
    late = sorted(millis(r["ts"]) for r in sink.late(spark).collect())
    assert late == sorted([t * 700 for t in range(30)] + [t * 700 + 40_000 for t in range(30)])


def millis(ts):
    return round((ts.replace(tzinfo=UTC) - START).total_seconds() * 1000)


def test_lookup_statistics_of_a_stream(spark, folders, tmp_path):
    for n in range(3):
        add_lines(folders, f"{n}.txt", [f"u={i}" for i in range(n + 1)] + ["junk"])
    told = str(tmp_path / "told")
    for how, rows in (("left", 6), ("inner", 6)):
        enrich_stream(
            stream_lines(spark, folders["in"], 1), lambda: dim_of(spark, k1="v=1"),
            parquet_sink(folders["out"] + how), folders["checkpoint"] + how, trigger=None,
            statistics=told + how, left_field="u", key_expr="k%s", how=how,
        ).start().awaitTermination()
        assert lookup_totals(spark, told + how).first().asDict() == {
            "batches": 3, "rows": rows, "matched": 2, "missed": 4,
        }


def test_totals_beyond_the_last_reports(spark, folders, conf):
    conf("spark.sql.streaming.numRecentProgressUpdates", "1")
    for start in (60_000, 0, 50_000):
        events(spark, folders, [(t * 700 + start, "a") for t in range(30)])
        time.sleep(0.05)
    totals = StreamTotals()
    spark.streams.addListener(totals)
    try:
        stream = stream_throughput(
            stream_table(spark, folders["in"], 1), order=("ts", "i"), late="0 seconds"
        )
        writer = stream.writeStream.format("parquet").option("checkpointLocation", folders["checkpoint"])
        query = writer.trigger(availableNow=True).start(folders["out"])
        query.awaitTermination()
        until = time.monotonic() + 30
        while totals.of(query)["rows"] < 90 and time.monotonic() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(totals)
    assert totals.of(query)["rows"] == 90
    # all windows of the second file and those up to 70 s of the third were closed
    assert totals.of(query)["dropped"] >= 3 > dropped_rows(query)


def test_ready_snapshot_is_neither_decoded_nor_exchanged(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    now, values = [0.0], iter(["a", "b"])
    aging = AgingDim(
        lambda: dim_of(spark, k1="v=" + next(values), k2="v=z|w=1"), ttl=10, clock=lambda: now[0]
    )
    lines = spark.createDataFrame([("u=1",), ("u=2",), ("u=3",), ("u=1",)], "line string")

    def enriched():
        return lookup_join(lines, None, LOOKUP, entries=aging.ready(LOOKUP))

    def rows():
        return sorted(r["enriched"] for r in enriched().collect())

    assert rows() == ["u=1|v=a", "u=1|v=a", "u=2|v=z|w=1", "u=3"]
    assert aging.ready(LOOKUP) is aging.ready(LOOKUP)
    now[0] = 11.0
    assert rows() == ["u=1|v=b", "u=1|v=b", "u=2|v=z|w=1", "u=3"] and aging.loads == 2
    plan = enriched()._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan parquet" in line)
    assert "Bucketed: true" in plan[scan]
    depth = len(plan[scan]) - len(plan[scan].lstrip(" :+-*()0123456789"))
    above = []  # from the scan up to the join with the keys
    for line in reversed(plan[:scan]):
        indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if indent < depth:
            above.append(line)
            depth = indent
        if "SortMergeJoin" in line:
            break
    assert not [line for line in above if "Exchange" in line or "from_entries" in line]
