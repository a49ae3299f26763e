"""Text lines and dimensions derived from whole tables, the inputs of the registered queries.

Text is built from integers and strings only, since engines format doubles differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.functions import Delimited
from dimweave.sources import hash_dim, string_dim

LINE_FORMAT = Delimited.of("partkey", "returnflag", "gap", "status")
REGEX_FORMAT = Delimited.of("head", "tail", separator="[0-9]", regex_fallback=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: str | Column) -> Column:
    """Concatenation: strings are literals, columns are cast to text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _events(spark: SparkSession, sf_dir: str, line: Column) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", line.alias("line"))


def source_kv(spark, sf_dir):
    line = _text("user_id=", F.col("user_id"), "|event_type=", F.col("event_type"))
    return _events(spark, sf_dir, line)


def source_dirty(spark, sf_dir):
    """Empty tokens, tokens without a field, an empty value and a repeated field."""
    line = _text(
        "|user_id=", F.col("user_id"), "||event_type=", F.col("event_type"),
        "|junk|=x|flag=|user_id=", F.col("user_id") + 1,
    )
    return _events(spark, sf_dir, line)


def source_null_key(spark, sf_dir):
    """The key field is missing from error events."""
    kind = _text("event_type=", F.col("event_type"))
    full = _text("user_id=", F.col("user_id"), "|event_type=", F.col("event_type"))
    return _events(spark, sf_dir, F.when(F.col("event_type") == "error", kind).otherwise(full))


def source_junk(spark, sf_dir):
    """Error events cannot be decoded, signups are blank."""
    line = (
        F.when(F.col("event_type") == "error", F.lit("junk"))
        .when(F.col("event_type") == "signup", F.lit(" \t"))
        .otherwise(_text("user_id=", F.col("user_id")))
    )
    return _events(spark, sf_dir, line)


def source_delimited(spark, sf_dir):
    """First lines of an order are short, second ones have a token too many."""
    head = _text(F.col("l_partkey"), "|", F.col("l_returnflag"))
    full = _text(head, "||", F.col("l_linestatus"))
    line = (
        F.when(F.col("l_linenumber") == 1, head)
        .when(F.col("l_linenumber") == 2, _text(full, "|extra"))
        .otherwise(full)
    )
    items = table(spark, sf_dir, "lineitem")
    return items.select("l_orderkey", "l_linenumber", line.alias("line"))


def supplier_kv(spark, sf_dir):
    """Suppliers by number; users beyond the last supplier are misses."""
    value = _text("s_name=", F.col("s_name"), "|s_nationkey=", F.col("s_nationkey"))
    return string_dim(
        table(spark, sf_dir, "supplier"), _text("tp_", F.col("s_suppkey")), value
    )


def supplier_kv_blank(spark, sf_dir):
    """As `supplier_kv`, with a blank value for low nation numbers."""
    value = _text("s_name=", F.col("s_name"), "|s_nationkey=", F.col("s_nationkey"))
    return string_dim(
        table(spark, sf_dir, "supplier"),
        _text("tp_", F.col("s_suppkey")),
        F.when(F.col("s_nationkey") < 8, F.lit("")).otherwise(value),
    )


def supplier_kv_collide(spark, sf_dir):
    """A dimension field that bears the name of a source field."""
    value = _text("s_name=", F.col("s_name"), "|event_type=nation ", F.col("s_nationkey"))
    return string_dim(
        table(spark, sf_dir, "supplier"), _text("tp_", F.col("s_suppkey")), value
    )


def supplier_hash(spark, sf_dir):
    """The same suppliers as one row per field."""
    names = ("s_name", "s_nationkey", "s_suppkey")
    fields = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("value"))
                for n in names
            ]
        )
    )
    rows = table(spark, sf_dir, "supplier").select(
        _text("bh_", F.col("s_suppkey")).alias("key"), fields.alias("f")
    )
    return hash_dim(rows, "key", F.col("f.field"), F.col("f.value"))


def part_kv(spark, sf_dir):
    value = _text("p_name=", F.col("p_name"), "|p_brand=", F.col("p_brand"))
    return string_dim(table(spark, sf_dir, "part"), _text("th_", F.col("p_partkey")), value)


def customer_raw(spark, sf_dir):
    """Raw values by customer: blank for buildings, none for machinery."""
    value = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(""))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(None))
        .otherwise(F.col("c_name"))
    )
    return string_dim(table(spark, sf_dir, "customer"), _text("c", F.col("c_custkey")), value)


def orders_raw(spark, sf_dir):
    """Customer keys as whole lines, blank for orders of low priority."""
    line = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" ")).otherwise(
        _text("c", F.col("o_custkey"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", line.alias("line"))


def customer_versions(spark, sf_dir):
    """Ten versions of each customer, three days apart, from differing days and times on."""
    day, second = F.col("c_custkey") % 5, (F.col("c_custkey") * 7919) % 86400
    start = F.lit(1704067200) + day * 86400 + second
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", start.alias("start"),
        F.explode(F.sequence(F.lit(0), F.lit(9))).alias("version"),
    )
    return rows.select(
        _text("tp_", F.col("c_custkey")).alias("dim_key"),
        F.timestamp_seconds(F.col("start") + F.col("version") * 259200).alias("effective_ts"),
        _text("c_name=", F.col("c_name"), "|version=", F.col("version")).alias("dim_value"),
    )


def checked_lines(spark, sf_dir):
    """Enriched lines as a checker sees them, some with a wrong id, old, or without a time."""
    ident = F.col("user_id") + F.when(F.col("event_type") == "error", 1).otherwise(0)
    updated = F.date_format(
        F.timestamp_seconds(
            F.unix_seconds(F.col("ts").cast("timestamp")) - F.col("event_id") % 1800
        ),
        "yyyyMMdd HH:mm:ss",
    )
    stamp = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(updated)
    line = _text("mykey=", F.col("user_id"), "|id=", ident, "|update_time=", stamp)
    return table(spark, sf_dir, "events").select("event_id", "ts", line.alias("line"))
