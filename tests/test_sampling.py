import random
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimweave.operators import (
    sample_bucketed,
    sample_every_n,
    sample_every_n_per_task,
    sample_greedy,
    sample_hashed,
    sampling,
)

EPOCH = datetime(2024, 1, 1, tzinfo=UTC)


def greedy(times, interval):
    chosen, last = [], None
    for t in sorted(times):
        if last is None or t - last >= interval:
            chosen.append(t)
            last = t
    return chosen


def by_segments(times, interval, width):
    """The parts of the distributed sample, put together in one process."""
    times = np.unique(np.array(times, dtype=np.int64))
    parts = {s: times[times - times % width == s] for s in np.unique(times - times % width)}
    runs = [
        {"__segment": np.full(len(r["first"]), s)} | r
        for s, p in parts.items()
        for r in [sampling.segment_runs(p, int(s), interval)]
    ]
    columns = {c: np.concatenate([r[c] for r in runs]) for c in runs[0]}
    entering = sampling.follow_segments(columns, interval)
    chosen = []
    for s, e in zip(entering["__segment"], entering["__t"], strict=True):
        chosen.extend(sampling.emit_segment(parts[s], int(e), interval))
    return chosen, sum(len(r["first"]) for r in runs)


@pytest.mark.parametrize("seed", range(60))
def test_segments_give_the_greedy_choice(seed):
    rng = random.Random(seed)
    span, count = rng.choice([(400, 380), (2000, 300), (20_000, 200), (900, 20)])
    times = [rng.randrange(-span, span) for _ in range(count)]
    for interval in (1, 2, 7, 50, 333):
        for many in (2, 3, 8):
            assert by_segments(times, interval, interval * many)[0] == greedy(
                set(times), interval
            )


def test_full_grid_of_ticks_stays_small():
    """Chains over gapless ticks never meet; a run sums them up all the same."""
    times = list(range(5000))
    chosen, runs = by_segments(times, 50, 400)
    assert chosen == list(range(0, 5000, 50))
    assert runs < 60


@pytest.mark.parametrize("keys", [["k"], ["k", "n"], []])
def test_greedy_frame(spark, keys, monkeypatch):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        k = rng.choice(["hot", "hot", "b", None])
        n = rng.choice([1, 2])
        micros = rng.randrange(60_000_000)
        rows.append((i, k, n, EPOCH + timedelta(microseconds=micros)))
    frame = spark.createDataFrame(rows, "i int, k string, n int, ts timestamp").repartition(4)
    monkeypatch.setattr(sampling, "MIN_SEGMENT_MS", 1)
    got = sample_greedy(frame, keys, "ts", 700, ["ts", "i"])
    assert got.columns == frame.columns

    groups = {}
    for i, k, n, ts in rows:
        key = tuple({"k": k, "n": n}[c] for c in keys)
        groups.setdefault(key, []).append((ts, i))
    want = []
    for members in groups.values():
        last = None
        for ts, i in sorted(members):
            tick = int((ts - EPOCH) / timedelta(milliseconds=1))
            if last is None or tick - last >= 700:
                want.append(i)
                last = tick
    assert sorted(r["i"] for r in got.collect()) == sorted(want)


def test_bucketed(spark):
    frame = spark.range(1000).select(
        "id", (F.col("id") % 3).alias("k"), F.timestamp_millis(F.col("id") * 10).alias("ts")
    )
    got = sample_bucketed(frame, ["k"], "ts", 1000, ["ts", "id"])
    assert sorted(r["id"] for r in got.collect()) == sorted(
        min(i for i in range(b * 100, b * 100 + 100) if i % 3 == k)
        for b in range(10) for k in range(3)
    )


def test_interval_must_be_positive(spark):
    frame = spark.range(1).select("id", F.timestamp_millis("id").alias("ts"))
    with pytest.raises(ValueError):
        sample_greedy(frame, ["id"], "ts", 0, ["id"])


@pytest.mark.parametrize("width", [7, 100, 10**6])
def test_every_n(spark, width):
    rng = random.Random(1)
    ids = rng.sample(range(-2000, 4000), 1500)
    rows = [(i, rng.choice(["a", "a", "b", None])) for i in ids]
    frame = spark.createDataFrame(rows, "id bigint, k string").repartition(5)
    got = sorted(r["id"] for r in sample_every_n(frame, "id", 10, ["k"], width).collect())
    want = []
    for k in ("a", "b", None):
        want += sorted(i for i, b in rows if b == k)[9::10]
    assert got == sorted(want)
    whole = sample_every_n(frame, "id", 10, width=width)
    assert whole.columns == ["id", "k"]
    assert sorted(r["id"] for r in whole.collect()) == sorted(ids)[9::10]


def test_every_n_per_task(spark):
    frame = spark.range(0, 1000, 1, 4)
    got = sorted(r["id"] for r in sample_every_n_per_task(frame, 100).collect())
    assert got == [b + o for b in (0, 250, 500, 750) for o in (99, 199)]


def test_hashed(spark):
    got = sample_hashed(spark.range(100_000), "id", 100)
    assert 850 < got.count() < 1150
    assert sorted(got.collect()) == sorted(sample_hashed(spark.range(100_000), "id", 100).collect())


def test_greedy_large_numbers_null_keys_and_null_times(spark):
    big = 1 << 60
    rows = [
        (i, key, EPOCH + timedelta(seconds=t))
        for i, (key, t) in enumerate((k, t) for k in (big + 1, big + 2, None) for t in (0, 1, 5))
    ]
    rows += [(20, big + 1, None), (21, big + 1, None), (22, None, None)]
    frame = spark.createDataFrame(rows, "i int, k bigint, ts timestamp").coalesce(1)
    got = sample_greedy(frame, ["k"], "ts", 3000, ["ts", "i"]).collect()
    assert sorted(r.i for r in got) == [0, 2, 3, 5, 6, 8, 20, 22]
    assert {r.k for r in got} == {big + 1, big + 2, None}


@pytest.mark.parametrize("buckets", [[], ["k"]])
def test_every_n_by_ranges_of_hashed_numbers(spark, buckets):
    """Orders all over the long integers, a third of the rows in one bucket, some without one."""
    frame = spark.range(0, 6000, 1, 5).select(
        F.xxhash64("id").alias("id"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 != 0, (F.col("id") % 5).cast("string")).alias("k"),
        "id",
    ).toDF("id", "k", "number")
    rows, want = {}, []
    for r in sorted(frame.collect()):
        rows.setdefault(r["k"] if buckets else None, []).append(r["id"])
    for ids in rows.values():
        want += ids[9::10]
    sampled = sample_every_n(frame, "id", 10, buckets)
    assert sorted(r["id"] for r in sampled.collect()) == sorted(want)
    if not buckets:
        plan = sampled._jdf.queryExecution().optimizedPlan().toString()
        assert "Window [" in plan and "windowspecdefinition(__cell" in plan
        assert not [p for p in plan.splitlines() if "windowspecdefinition(id" in p]


def test_every_n_goes_on_from_counts(spark):
    frame = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(40)], "id long, k string")
    counted = spark.createDataFrame([("a", 7), ("z", 3)], "k string, counted long")
    got = sample_every_n(frame, "id", 10, ["k"], counted=counted).collect()
    assert sorted(tuple(r) for r in got) == [(4, "a"), (19, "b"), (24, "a"), (39, "b")]
    alone = sample_every_n(frame, "id", 10, counted=spark.createDataFrame([(5,)], "counted long"))
    assert sorted(r["id"] for r in alone.collect()) == [4, 14, 24, 34]
    assert sample_every_n(frame.where("false"), "id", 10).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_composed_segments_act_as_one(seed):
    """Dense and sparse times: entering the composition leaves as following the segments does."""
    chance = np.random.default_rng(seed)
    interval, width = 5, 40
    for _ in range(60):
        count = int(chance.choice([3, 20, 100, 300]))
        times = np.unique(chance.integers(0, 400, count))
        starts = np.unique(times - times % width)
        parts = []
        for s in starts:
            runs = sampling.segment_runs(times[times - times % width == s], int(s), interval)
            parts.append(runs | {"__segment": np.full(len(runs["first"]), s)})
        whole = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        one = sampling.compose_segments(whole, interval)
        for emitted in [-(10**9), *range(int(starts[0]) - interval - 3, int(starts[0]))]:
            want = emitted
            for t in times.tolist():
                if t >= want + interval:
                    want = t
            alone = {c: v for c, v in one.items()} | {"__segment": np.zeros(len(one["first"]), int)}
            ahead = {c: np.append(alone[c], 10**9 if c == "__segment" else 10**10) for c in alone}
            got = sampling.follow_segments(ahead, interval, emitted)["__t"][-1]
            assert got == want


def test_greedy_over_a_tree_of_segments(spark, monkeypatch):
    """Fan and segments so small that the tree has several levels, with a third of the rows in one
    key; the answer is that of the plain chain."""
    monkeypatch.setattr(sampling, "FAN", 3)
    monkeypatch.setattr(sampling, "MIN_SEGMENT_MS", 1)
    chance = np.random.default_rng(1)
    rows = [(int(t), "hot" if i % 3 == 0 else f"k{i % 5}", i)
            for i, t in enumerate(chance.integers(0, 6000, 1500))]
    frame = spark.createDataFrame(rows, "ms long, k string, i long").select(
        F.timestamp_millis("ms").alias("ts"), "k", "i"
    )
    want, last = [], {}
    for t, k, i in sorted(rows):
        if t >= last.get(k, -(10**9)) + 20:
            last[k] = t
            want.append(i)
    got = sample_greedy(frame, ["k"], "ts", 20, ["ts", "i"])
    assert sorted(r["i"] for r in got.collect()) == sorted(want)
