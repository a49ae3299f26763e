import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dimweave import Lookup, fresh_lookup_join
from dimweave.operators import resolve_ttl
from dimweave.operators.freshness import as_of_by_range

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
START = datetime(2024, 1, 1, tzinfo=UTC)
LOOKUP = Lookup(left_field="u", key_expr="k%s")


def at(micros):
    return EPOCH + timedelta(microseconds=micros)


def as_of(versions, key, micros):
    """Value of the last version up to a time; None for no version and for a deletion."""
    past = [(t, v) for k, t, v in versions if k == key and t <= micros]
    return max(past, key=lambda p: p[0])[1] if past else None


def expected(events, versions, ttl, negative_cache):
    out = []
    for i, key, t in events:
        value = as_of(versions, f"k{key}", t if ttl is None else t - t % (ttl * 1_000_000))
        if value is None and not negative_cache:
            value = as_of(versions, f"k{key}", t)
        out.append((i, f"u={key}" + (f"|{value}" if value else "")))
    return sorted(out)


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    span = 40_000_000
    events = [(i, rng.randrange(6), rng.randrange(-span, span)) for i in range(600)]
    times = {}
    versions = []
    for n in range(120):
        key, t = f"k{rng.randrange(5)}", rng.randrange(-span, span)
        if n % 4 == 0:
            t -= t % 1_000_000
        if (key, t) in times:
            continue
        times[key, t] = n
        versions.append((key, t, None if n % 7 == 0 else f"v={n}"))
    events += [(600 + n, int(k[1:]), t) for n, (k, t, _) in enumerate(versions)]
    frame = spark.createDataFrame(
        [(i, f"u={k}", at(t)) for i, k, t in events], "id int, line string, ts timestamp"
    )
    dim = spark.createDataFrame(
        [(k, at(t), v) for k, t, v in versions],
        "dim_key string, effective_ts timestamp, dim_value string",
    )
    return events, versions, frame, dim


@pytest.mark.parametrize("ttl", [None, 1, 3, 15])
@pytest.mark.parametrize("negative_cache", [True, False])
def test_against_model(world, ttl, negative_cache):
    events, versions, frame, dim = world
    for grid in (2, 3600):
        got = fresh_lookup_join(
            frame, dim, LOOKUP, ttl=ttl, negative_cache=negative_cache, grid=grid
        ).select("id", "enriched")
        assert sorted(map(tuple, got.collect())) == expected(
            events, versions, ttl, negative_cache or ttl is None
        )


def test_inner_and_blank_row(world):
    events, versions, frame, dim = world
    left = expected(events, versions, 3, True)
    options = {"left_field": "u", "key_expr": "k%s"}
    inner = fresh_lookup_join(frame, dim, how="inner", ttl=3, **options)
    assert sorted(map(tuple, inner.select("id", "enriched").collect())) == [
        r for r in left if "|" in r[1]
    ]
    blank = fresh_lookup_join(frame, dim, on_miss="blank_row", ttl=3, **options)
    assert sorted(map(tuple, blank.select("id", "enriched").collect())) == [
        (i, t if "|" in t else "") for i, t in left
    ]


def test_hash_versions(spark):
    lines = spark.createDataFrame([("u=1", at(5_000_000))], "line string, ts timestamp")
    dim = spark.createDataFrame(
        [("k1", at(0), {"a": "1"}), ("k1", at(4_000_000), {"a": "2"})],
        "dim_key string, effective_ts timestamp, dim_fields map<string,string>",
    )
    lookup = Lookup(left_field="u", key_expr="k%s", dim_kind="hash")
    assert fresh_lookup_join(lines, dim, lookup, ttl=3).first()["enriched"] == "u=1|a=1"
    assert fresh_lookup_join(lines, dim, lookup).first()["enriched"] == "u=1|a=2"


def test_resolve_ttl():
    named = [resolve_ttl(refresh=r) for r in ("minute", "HOUR", "Day", "random", "always")]
    assert named == [15, 300, 1800, None, None]
    assert resolve_ttl(7, "day") == 7
    assert resolve_ttl(0, "day") is None and resolve_ttl() is None
    for bad in ({"ttl": -1}, {"refresh": "weekly"}):
        with pytest.raises(ValueError):
            resolve_ttl(**bad)


def test_one_key_with_many_versions_in_one_cell(spark):
    """Lines and versions of a cell are put in order, not paired."""
    start = "timestamp_seconds(1700000000)"
    lines = spark.range(40_000).selectExpr(
        "concat('u=1|i=', id) AS line", f"{start} + make_dt_interval(0, 0, 0, id / 1000) AS ts"
    )
    versions = spark.range(20_000).selectExpr(
        "'tp_1' AS dim_key",
        f"{start} + make_dt_interval(0, 0, 0, id / 500) AS effective_ts",
        "concat('v=', id) AS dim_value",
    )
    found = fresh_lookup_join(lines, versions, left_field="u", key_expr="tp_%s")
    rows = [dict(p.split("=") for p in r.enriched.split("|")) for r in found.collect()]
    assert len(rows) == 40_000
    assert all(int(r["v"]) == int(r["i"]) // 2 for r in rows)


@pytest.mark.parametrize(
    "options", [{}, {"ttl": 7}, {"ttl": 7, "negative_cache": False}, {"how": "inner"}]
)
def test_by_range_equals_windows(spark, conf, options):
    """One key has most versions and lines, and is dealt to several ranges; keys come and go."""
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "7")
    chance = random.Random(5)
    users = ["hot"] * 6 + [f"u{i}" for i in range(9)]
    versions = [
        (f"k{chance.choice(users)}", START + timedelta(seconds=chance.randrange(400)),
         chance.choice([None, "v=1", f"v={n}"]))
        for n in range(300)
    ]
    versions = list({v[:2]: v for v in versions}.values())
    lines = [(n, START + timedelta(seconds=chance.randrange(-20, 420)), f"u={chance.choice(users)}|n={n}")
             for n in range(400)]
    left = spark.createDataFrame(lines, "n int, ts timestamp, line string").repartition(4)
    right = spark.createDataFrame(
        versions, "dim_key string, effective_ts timestamp, dim_value string"
    ).repartition(3)
    how = {"left_field": "u", "key_expr": "k%s"} | {k: v for k, v in options.items() if k == "how"}
    rest = {k: v for k, v in options.items() if k != "how"}
    want, got = (
        fresh_lookup_join(left, right, Lookup(**how), by_range=b, **rest).select("n", "enriched")
        for b in (False, True)
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_long_history_is_split_over_tasks(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "5")
    versions = spark.range(0, 50_000, 1, 4).select(
        F.lit("k1").alias("dim_key"), (F.col("id") * 2).alias("__at"),
        F.struct(F.struct(F.lit(None).cast("map<string,string>").alias("fields"),
                          F.col("id").cast("string").alias("text")).alias("__dim")).alias("__seen"),
    )
    wanted = spark.range(0, 1000, 1, 2).select(F.lit("k1").alias("dim_key"), (F.col("id") * 97 + 1).alias("__at"))
    got = as_of_by_range(wanted, versions)
    assert all(r["__seen"]["__dim"]["text"] == str(r["__at"] // 2) for r in got.collect())
    files = [f for f in got.inputFiles() if "as-of" in f]
    sizes = [spark.read.parquet(f).count() for f in files]
    assert len(sizes) == 5 and max(sizes) < 20_000
