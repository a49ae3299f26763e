"""Shapes of the plans that the work at scale depends on."""

import re

import pytest
from pyspark.sql import functions as F

from dimweave import Lookup, fresh_lookup_join, lookup_join, raw_lookup
from dimweave.operators import sample_every_n, throughput
from dimweave.plans import fixtures as fx
from dimweave.sources import hash_dim, string_dim

SF = "/root/testdata/sf0.001"
KEYED = {"left_field": "u", "key_expr": "k%s"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan_of(frame).split("Initial Plan")[0]


def exchanges(frame):
    """Exchanges of rows, broadcasts aside."""
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|single|round)", plan_of(frame)))


@pytest.fixture
def shuffled(conf):
    """Small thresholds: nothing is broadcast and a hot key counts as skewed."""
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }.items():
        conf(name, value)


@pytest.fixture(scope="module")
def hot(spark):
    """Lines of which every third has the same key, and a dimension."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    lines = spark.range(0, 60_000, 1, 8).select(
        "id",
        F.timestamp_seconds(F.lit(1704067200)).alias("ts"),
        F.concat(F.lit("u="), key, F.lit("|pad="), F.md5(F.col("id").cast("string"))).alias("line"),
        F.concat(F.lit("k"), key).alias("raw"),
    )
    dim = spark.range(0, 5000, 1, 4).select(
        F.concat(F.lit("k"), F.col("id")).alias("k"), F.concat(F.lit("n="), F.col("id")).alias("v")
    )
    return lines, dim


def skew_cases(lines, dim):
    plain = string_dim(dim, "k", "v")
    versions = plain.withColumn("effective_ts", F.timestamp_seconds(F.lit(1700000000)))
    folded = hash_dim(dim.withColumn("f", F.lit("n")), "k", "f", "v")
    return {
        "left": lambda: lookup_join(lines, plain, **KEYED),
        "inner": lambda: lookup_join(lines, plain, how="inner", **KEYED),
        "latest": lambda: lookup_join(lines, string_dim(dim, "k", "v", "v"), **KEYED),
        "hash": lambda: lookup_join(lines, folded, dim_kind="hash", **KEYED),
        "dedup": lambda: lookup_join(lines, plain, dedup=True, **KEYED),
        "raw": lambda: raw_lookup(lines.select("id", F.col("raw").alias("line")), plain),
        "ttl": lambda: fresh_lookup_join(lines, versions, Lookup(**KEYED), ttl=3600),
        "live": lambda: fresh_lookup_join(lines, versions, Lookup(**KEYED)),
        "no negative": lambda: fresh_lookup_join(
            lines, versions, Lookup(**KEYED), ttl=3600, negative_cache=False
        ),
    }


@pytest.mark.parametrize(
    "case", ["left", "inner", "latest", "hash", "dedup", "raw", "ttl", "live", "no negative"]
)
def test_hot_keys_are_split(shuffled, hot, case):
    frame = skew_cases(*hot)[case]()
    plan = final_plan(frame)
    assert "skew=true" in plan
    assert frame.count() == 60_000


def test_small_dimensions_are_broadcast_without_a_hint(spark):
    frame = lookup_join(
        fx.source_kv(spark, SF), fx.supplier_kv(spark, SF), left_field="user_id", key_expr="tp_%s"
    )
    assert "BroadcastHashJoin" in final_plan(frame)
    logical = frame._jdf.queryExecution().logical().toString()
    assert "Hint" not in logical


def test_lines_are_decoded_once(spark):
    frame = lookup_join(
        fx.source_kv(spark, SF), fx.supplier_kv(spark, SF), left_field="user_id", key_expr="tp_%s"
    ).select("event_id", "enriched")
    plan = plan_of(frame)
    # Once for the line, once for the dimension.
    assert plan.count("map_from_entries") == 2
    assert "Filter" in plan and "map_from_entries" not in "".join(
        line for line in plan.splitlines() if "Filter" in line
    )


def test_only_needed_columns_are_read(spark):
    frame = lookup_join(
        fx.source_kv(spark, SF), fx.supplier_kv(spark, SF), left_field="user_id", key_expr="tp_%s"
    ).select("event_id", "enriched")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(frame))
    assert sorted(re.sub(r":\w+", "", s) for s in schemas) == [
        "event_id,user_id,event_type", "s_suppkey,s_name,s_nationkey",
    ]


def test_source_filters_reach_the_scan(spark):
    events = fx.table(spark, SF, "events").where("event_id < 5")
    lines = events.select("event_id", F.concat(F.lit("u="), F.col("user_id")).alias("line"))
    frame = lookup_join(lines, fx.supplier_kv(spark, SF), **KEYED)
    assert "LessThan(event_id,5)" in plan_of(frame)


def test_filters_on_passed_columns_move_below_the_lookup(spark):
    events = fx.table(spark, SF, "events")
    lines = events.select("event_id", F.concat(F.lit("u="), F.col("user_id")).alias("line"))
    frame = lookup_join(lines, fx.supplier_kv(spark, SF), **KEYED).where("event_id < 5")
    assert "LessThan(event_id,5)" in plan_of(frame)


def test_exchanges(spark):
    events = fx.table(spark, SF, "events").withColumn("line", F.col("event_type"))
    assert exchanges(throughput(events)) == 1
    # Counts per cell, their running sum, and the records once.
    assert exchanges(sample_every_n(events, "event_id", 10, ["event_type"])) == 3
    lines = events.select("event_id", F.concat(F.lit("u="), F.col("user_id")).alias("line"))
    assert exchanges(lookup_join(lines, fx.supplier_kv(spark, SF), **KEYED)) == 0


def test_throughput_is_reduced_before_the_exchange(spark):
    events = fx.table(spark, SF, "events").withColumn("line", F.col("event_type"))
    assert "partial_count" in plan_of(throughput(events))
