import pytest
from pyspark.sql import functions as F

from dimweave import Delimited, KeyValue, Lookup, lookup_join, raw_lookup
from dimweave.operators import (
    decodable,
    drop_blank_lines,
    join_type,
    lookup_stats,
    observed,
    rejects,
)
from dimweave.sources import (
    as_lines,
    duplicate_keys,
    hash_dim,
    numbers,
    read_lines,
    require_unique,
    sequential_kv,
    sequential_text,
    skewed_key,
    skewed_text,
    string_dim,
)

KEYED = {"left_field": "u", "key_expr": "tp_%s"}


def texts(frame, column="enriched"):
    return sorted(r[column] for r in frame.collect())


@pytest.fixture(scope="module")
def lines(spark):
    rows = ["u=1|e=a", "u=2|e=b", "u=3|e=c", "u=9|e=d", "e=nokey", "junk", "", None]
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, line string")


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("tp_1", "n=one"), ("tp_2", ""), ("tp_3", "junk"), ("tp_4", None), ("tp_5", "n=5")]
    return spark.createDataFrame(rows, "dim_key string, dim_value string")


@pytest.fixture(scope="module")
def hashes(spark):
    rows = [("tp_1", {"e": "over", "n": "one"}), ("tp_2", {}), ("tp_3", None)]
    return spark.createDataFrame(rows, "dim_key string, dim_fields map<string,string>")


def test_left(lines, dim):
    got = lookup_join(lines, dim, **KEYED)
    assert got.columns == ["id", "enriched"]
    assert texts(got) == ["e=nokey", "u=1|e=a|n=one", "u=2|e=b", "u=3|e=c", "u=9|e=d"]


def test_missing_key_is_looked_up_as_null(spark, lines):
    dim = spark.createDataFrame([("tp_null", "n=none")], "dim_key string, dim_value string")
    assert texts(lookup_join(lines, dim, how="inner", **KEYED)) == ["e=nokey|n=none"]


def test_inner(lines, dim):
    got = lookup_join(lines, dim, how="INNER_JOIN", **KEYED)
    assert texts(got) == ["u=1|e=a|n=one", "u=3|e=c"]
    kept = lookup_join(lines, dim, how="inner", blank_is_miss=False, **KEYED)
    assert texts(kept) == ["u=1|e=a|n=one", "u=2|e=b", "u=3|e=c"]


def test_blank_row_on_miss(lines, dim):
    got = lookup_join(lines, dim, on_miss="blank_row", **KEYED)
    assert texts(got) == ["", "", "u=1|e=a|n=one", "u=2|e=b", "u=3|e=c"]


def test_hash(lines, hashes):
    kind = KEYED | {"dim_kind": "hash"}
    left = ["e=nokey", "u=1|e=over|n=one", "u=2|e=b", "u=3|e=c", "u=9|e=d"]
    assert texts(lookup_join(lines, hashes, **kind)) == left
    assert texts(lookup_join(lines, hashes, on_miss="blank_row", **kind)) == left
    assert texts(lookup_join(lines, hashes, how="inner", **kind)) == ["u=1|e=over|n=one"]


def test_dedup_gives_the_same_rows(lines, dim):
    for how in ("left", "inner"):
        plain = texts(lookup_join(lines, dim, how=how, **KEYED))
        assert texts(lookup_join(lines, dim, how=how, dedup=True, **KEYED)) == plain


def test_other_formats(spark):
    lines = spark.createDataFrame([("7,x",), ("8",)], "line string")
    dim = spark.createDataFrame([("k7", "a:1;b:2")], "dim_key string, dim_value string")
    got = lookup_join(
        lines, dim, decode=Delimited.of("id", "v", separator=","), left_field="id",
        key_expr="k%s", dim_separator1=";", dim_separator2=":",
    )
    assert texts(got) == ["id=7|v=x|a=1|b=2", "id=8"]


def test_binary_lines(spark, dim):
    lines = spark.createDataFrame([(bytearray(b"u=1"),), (bytearray(b"\xff"),)], "line binary")
    assert texts(lookup_join(lines, dim, **KEYED)) == ["u=1|n=one"]
    unknown = KeyValue(encoding="no-such-charset")
    with pytest.raises(ValueError, match="unknown charset"):
        lookup_join(lines, dim, decode=unknown, **KEYED)


def test_raw(spark):
    lines = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("  ",), (None,)], "line string")
    dim = spark.createDataFrame(
        [("a", "1"), ("b", ""), ("c", None), ("  ", "x")], "dim_key string, dim_value string"
    )
    assert texts(raw_lookup(lines, dim)) == ["key=a&value=1", "key=b&value="]


def test_join_type():
    assert [join_type(t) for t in ("left_join", "Left", "INNER_join")] == ["left", "left", "inner"]
    for bad in ("", "outer", None, "right_join"):
        with pytest.raises(ValueError):
            join_type(bad)


def test_lookup_settings():
    for bad in (
        {"dim_kind": "list"}, {"how": "full"}, {"on_miss": "ignore"}, {"decode": "csv"},
        {"left_field": ""}, {"key_expr": ""},
    ):
        with pytest.raises(ValueError):
            Lookup(**(KEYED | bad))


def test_filters(lines):
    assert drop_blank_lines(lines).count() == 6
    assert decodable(lines, "kv").count() == 5
    assert sorted(r["id"] for r in rejects(lines, "kv").collect()) == [5, 6, 7]


def test_string_dim(spark):
    rows = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 2), ("b", "x", 1), (None, "y", 1)],
        "k string, v string, at int",
    )
    assert sorted(map(tuple, string_dim(rows, "k", "v", latest_by="at").collect())) == [
        ("a", "new"), ("b", "x"),
    ]
    plain = string_dim(rows, "k", "v")
    assert [tuple(r) for r in duplicate_keys(plain).collect()] == [("a", 2)]
    with pytest.raises(ValueError):
        require_unique(plain)
    assert require_unique(string_dim(rows, "k", "v", "at")).count() == 2


def test_hash_dim(spark):
    rows = spark.createDataFrame(
        [("a", "z", "1", 1), ("a", "b", "old", 1), ("a", "b", "new", 2), ("c", "x", "y", 1)],
        "k string, f string, v string, at int",
    )
    got = hash_dim(rows, "k", "f", "v", latest_by="at")
    shown = got.select("dim_key", F.to_json("dim_fields")).collect()
    assert sorted(map(tuple, shown)) == [
        ("a", '{"b":"new","z":"1"}'), ("c", '{"x":"y"}'),
    ]


def test_lookup_stats(spark):
    rows = [(0, "a", "1"), (0, "a", "1"), (0, "b", None), (1, "a", "1")]
    frame = spark.createDataFrame(rows, "batch int, dim_key string, dim_value string")
    got = sorted(map(tuple, lookup_stats(frame, F.col("batch")).collect()))
    assert got == [(0, 3, 2, 1, 2, 1), (1, 1, 1, 0, 1, 0)]
    watched, seen = observed(frame, "lookups")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 4, "matched": 3, "missed": 1}


def test_generators(spark):
    ids = numbers(spark, 1000, 4)
    assert ids.rdd.getNumPartitions() == 4
    got = ids.select(
        sequential_kv(F.col("id"), "mykey", 10).alias("kv"),
        sequential_text(F.col("id"), 7).alias("text"),
        skewed_text(F.col("id"), 100).alias("skewed"),
    ).collect()
    assert [r["kv"] for r in got[:12]] == [f"mykey={n % 10}" for n in range(12)]
    for n, row in enumerate(got):
        key, age, country = row["text"].split("|")
        assert (int(key), country) == (n % 7, "CN") and 0 <= int(age) < 100
        key, age, country = row["skewed"].split("|")
        assert 0 <= int(key) < 100 and 0 <= int(age) < 100 and country == "CN"
    with pytest.raises(ValueError):
        skewed_key(F.col("id"), 99)
    with pytest.raises(ValueError):
        sequential_kv(F.col("id"), "k", 0)


def test_skew_shares(spark):
    """The shares of the draw: 25 + 15/5 + 25/10 percent on the first hundredth, and so on."""
    keys = numbers(spark, 200_000).select(skewed_key(F.col("id"), 10_000).alias("k"))
    share = [
        r["n"] / 200_000
        for r in keys.groupBy(
            F.when(F.col("k") < 100, 0).when(F.col("k") < 500, 1).when(F.col("k") < 1000, 2)
            .when(F.col("k") < 3000, 3).otherwise(4).alias("band")
        ).agg(F.count("*").alias("n")).orderBy("band").collect()
    ]
    assert share == pytest.approx([0.305, 0.22, 0.125, 0.25, 0.10], abs=0.006)


def test_line_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x=1\ny=2\n")
    frame = read_lines(spark, str(tmp_path))
    assert texts(frame, "line") == ["x=1", "y=2"]
    messages = spark.createDataFrame([(bytearray(b"k=v"), 1)], "value binary, offset int")
    assert as_lines(messages).select("line", "offset").first() == (b"k=v", 1)


def test_bytes_are_decoded_by_the_charset_of_the_format(spark):
    data = [bytearray("u=1|名=中文".encode("gbk")), bytearray(b"u=2|x=\xff\xff")]
    lines = as_lines(spark.createDataFrame([(d,) for d in data], "value binary"))
    dim = string_dim(spark.createDataFrame([("tp_1", "a=b")], "k string, v string"), "k", "v")
    found = lookup_join(lines, dim, decode=KeyValue(encoding="GBK"), **KEYED)
    assert texts(found, "enriched") == ["u=1|名=中文|a=b", "u=2|x=��"]


@pytest.mark.parametrize("name", ["enriched", "dim_key", "dim_value"])
def test_columns_are_not_overwritten(spark, dim, name):
    lines = spark.createDataFrame([("u=1", "x")], f"line string, {name} string")
    with pytest.raises(ValueError, match=name):
        lookup_join(lines, dim, **KEYED)


def test_keys_that_repeat(spark):
    lines = spark.createDataFrame([("u=1",), ("u=2",), ("u=3",)], "line string")
    rows = [("k1", "n=old", 1), ("k1", "n=new", 2), ("k1", "n=older", 0), ("k2", "n=a", 5),
            ("k2", "n=b", 5), ("k4", "n=x", None)]
    dim = spark.createDataFrame(rows, "dim_key string, dim_value string, updated int")
    keyed = {"left_field": "u", "key_expr": "k%s"}
    got = lookup_join(lines, dim, unique="latest", **keyed)
    assert sorted(r[0] for r in got.collect()) == ["u=1|n=new", "u=2|n=b", "u=3"]
    with pytest.raises(Exception, match="occurs more than once: k[12]"):
        lookup_join(lines, dim, unique="fail", **keyed).collect()
    once = dim.where("updated = 2 OR dim_key = 'k4'")
    got = lookup_join(lines, once, unique="fail", **keyed)
    assert sorted(r[0] for r in got.collect()) == ["u=1|n=new", "u=2", "u=3"]
    with pytest.raises(ValueError):
        lookup_join(lines, dim, unique="first", **keyed)
    maps = dim.selectExpr("dim_key", "map('f', dim_value) AS dim_fields", "updated")
    got = lookup_join(lines, maps, unique="latest", dim_kind="hash", **keyed)
    assert sorted(r[0] for r in got.collect()) == ["u=1|f=n=new", "u=2|f=n=b", "u=3"]
