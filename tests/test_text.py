import base64
import json

import model
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimweave.functions import (
    Delimited,
    KeyValue,
    decode_bytes,
    is_blank,
    json_path,
    lookup_key,
    merge,
    parse_int,
    parse_stamp,
    render,
    render_pair,
    split_tokens,
)
from dimweave.functions.fields import draw, is_null_hash, is_null_text
from dimweave.functions.text import parse_descriptor

FEW = settings(
    max_examples=4,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
LINES = st.lists(
    st.one_of(st.none(), st.text(alphabet="ab=|;: \t\u3000\u00a0x1", max_size=14)),
    min_size=60,
    max_size=120,
)


def test_blank(column):
    values = [None, "", " ", "\t", "\n", "\r\n \x1c", "\u3000", "\u00a0", "\u2007", "\u0085"]
    values.append(" x")
    assert column(values, is_blank) == [model.blank(v) for v in values]
    assert [model.blank(v) for v in values] == [True] * 7 + [False] * 4


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("a=1|b=|=x|noeq||c=p=q|a=2| |", "a=2|b=|c=p=q"),
        ("", ""),
        ("junk", ""),
        (None, ""),
        ("=", ""),
        ("==x", ""),
        ("a=", "a="),
        ("b=1|a=2|b=3", "b=3|a=2"),
    ],
)
def test_kv_decode(column, line, expected):
    assert column([line], lambda x: render(KeyValue().decode(x))) == [expected]


def test_kv_separators(column):
    fmt = KeyValue("|;", ":=")
    lines = ["a:=1;b:=2|c:=", ":=x", "a:b", "a::=b", "a:=b:=c"]
    assert column(lines, lambda x: render(fmt.decode(x))) == [
        "a=1|b=2|c=", "", "", "a:=b", "a=b:=c",
    ]
    awkward = KeyValue("]^-\\", "$")
    assert column(["a$1]b$2^c$3-d$4\\e$5"], lambda x: render(awkward.decode(x))) == [
        "a=1|b=2|c=3|d=4|e=5"
    ]
    for bad in ("", " ", "\u3000"):
        with pytest.raises(ValueError):
            KeyValue(pair_separators=bad)
        with pytest.raises(ValueError):
            KeyValue(field_separator=bad)


@FEW
@given(LINES)
def test_kv_against_model(column, lines):
    for fmt in (KeyValue(), KeyValue(";|", ":"), KeyValue("|", "=:"), KeyValue("=", "=")):
        want = [model.decode_kv(v, fmt.pair_separators, fmt.field_separator) for v in lines]
        assert column(lines, lambda x, f=fmt: render(f.decode(x))) == [
            model.render(m) for m in want
        ]
        assert column(lines, fmt.accepts) == [bool(m) for m in want]
        assert column(lines, lambda x, f=fmt: f.field(x, "a")) == [m.get("a") for m in want]


@FEW
@given(LINES)
def test_delimited_against_model(column, lines):
    for names, separator in (
        (["p", "q", "r"], "|"),
        (["p", None, "q"], "|;"),
        ([None, "p"], "="),
        (["p", "q"], None),
        (["p", "p"], "|"),
    ):
        fields = tuple((n, i) for i, n in enumerate(names) if n is not None)
        fmt = Delimited(fields, separator)
        want = [model.decode_delimited(v, names, separator) for v in lines]
        assert column(lines, lambda x, f=fmt: render(f.decode(x))) == [
            model.render(m) for m in want
        ]
        assert column(lines, fmt.accepts) == [bool(m) for m in want]
        assert column(lines, lambda x, f=fmt: f.field(x, "p")) == [m.get("p") for m in want]


@FEW
@given(LINES)
def test_split_against_model(column, lines):
    for separators in ("|", "|=", ":", None):
        got = column(lines, lambda x, s=separators: split_tokens(x, s))
        assert got == [model.split(v, separators) for v in lines]


def test_split_tokens(column):
    assert column(["|a||b|", ""], split_tokens) == [["", "a", "", "b", ""], []]
    assert column(["a||b"], lambda x: split_tokens(x, "||")) == [["a", "", "b"]]


def test_delimited_cases(column):
    fmt = Delimited.of("userId", "age", "country")
    lines = ["1|2|3", "1|2", "1||3", "1|2|3|4", "abc", " ", "1|"]
    assert column(lines, lambda x: render(fmt.decode(x))) == [
        "userId=1|age=2|country=3", "userId=1|age=2", "userId=1|age=|country=3",
        "userId=1|age=2|country=3", "userId=abc", "", "userId=1|age=",
    ]
    fallback = Delimited.of("userId", "age", "country", regex_fallback=True)
    assert column(["abc", "1|2", "abcd"], lambda x: render(fallback.decode(x))) == [
        "userId=a|age=b|country=c", "userId=1|age=2", "userId=a|age=b|country=c",
    ]
    gone = Delimited.of("a", separator="[0-9]", regex_fallback=True)
    assert column(["34", "x3"], gone.accepts) == [False, True]


def test_delimited_columns(spark):
    fmt = Delimited.of("a", "b", "c")
    frame = spark.createDataFrame([("1|2",), ("1||3",), (None,)], "line string")
    rows = frame.select(*fmt.columns(F.col("line"))).collect()
    assert [tuple(r) for r in rows] == [("1", "2", None), ("1", "", "3"), (None, None, None)]


def test_thirty_fields(column):
    """An invented line: empty runs, JSON, a link and pairs within fields."""
    values = {
        "station": "harbour 7",
        "measured": "2023-11-05 06:30:00",
        "sensor": "wind=north&gust=yes",
        "serial": "7f-000-21",
        "operator": "",
        "remark": "",
        "speed": "12.75",
        "direction": "NNW",
        "link": "https://weather.example.com/show?station=7&unit=ms",
        "report": '{"levels":[{"height":10,"speed":12.75},{"height":50,"speed":15}]}',
        "pairs": "low=3#high=19",
        "tags": "coast#storm#night",
    }
    values |= {f"hour_{h:02d}": "" for h in range(12)}
    values |= {f"check_{c}": str(n) for n, c in enumerate("abcdef")}
    assert len(values) == 30
    descriptor = {
        "encoding": "UTF-8",
        "separator": "|",
        "schema": [{"fieldKey": k, "fieldIndex": i} for i, k in enumerate(values)],
    }
    encoded = base64.b64encode(json.dumps(descriptor).encode()).decode()
    fmt = Delimited.from_descriptor(encoded)
    line = "|".join(values.values())
    assert column([line], fmt.decode) == [values]
    assert column([line], lambda x: F.size(fmt.decode(x))) == [30]


def test_descriptors():
    text = (
        '{"sourceType":"X","separator":",","schema":[{"fieldKey":"b","fieldName":"n",'
        '"fieldType":1,"fieldIndex":2},{"fieldKey":"a","fieldIndex":0}],"other":1}'
    )
    fmt = Delimited.from_descriptor(text)
    assert (fmt.fields, fmt.separator) == ((("b", 2), ("a", 0)), ",")
    assert Delimited.from_descriptor(text.replace('"', '\\"')) == fmt
    assert KeyValue.from_descriptor("{}") == KeyValue()
    assert KeyValue.from_descriptor('{"separator1":"&","separator2":":"}') == KeyValue("&", ":")
    assert parse_descriptor('{\\"a\\":\\"\\u0041\\"}') == {"a": "A"}
    for bad in ("not a descriptor", "[1]", base64.b64encode(b"nothing").decode()):
        with pytest.raises(ValueError):
            parse_descriptor(bad)
    with pytest.raises(ValueError):
        Delimited.from_descriptor('{"schema":[]}')
    with pytest.raises(ValueError):
        Delimited((("a", 1001),))


def test_bytes(column):
    data = ["é|x".encode(), b"a\xffb", None]
    assert column(data, decode_bytes, "binary") == ["é|x", "a�b", None]
    assert column(["中文".encode("gbk")], lambda x: decode_bytes(x, "GBK"), "binary") == ["中文"]
    for name in ("no-such-charset", "rot13", "not a name"):
        with pytest.raises(ValueError, match="unknown charset"):
            column([b"abc"], lambda x, name=name: decode_bytes(x, name), "binary")


def test_render(column):
    maps = [{"a": "1", "b": None}, {}, {"x|": "="}]
    assert column(maps, render, "map<string,string>") == ["a=1|b=null", "", "x|=="]
    assert column(["k"], lambda x: render_pair(x, F.lit(""))) == ["key=k&value="]


def test_merge(spark):
    frame = spark.sql("SELECT map('a','1','b','2') s, map('c','3','a','9') d, null n")
    merged = frame.select(
        render(merge(F.col("s"), F.col("d"))).alias("m"),
        render(merge(F.col("s"), F.col("n").cast("map<string,string>"))).alias("k"),
    ).first()
    assert tuple(merged) == ("a=9|b=2|c=3", "a=1|b=2")


def test_lookup_key(column):
    maps = [{"u": "7"}, {"v": "1"}, {"u": ""}]
    kind = "map<string,string>"
    assert column(maps, lambda x: lookup_key(x, "u", "tp_%s"), kind) == ["tp_7", "tp_null", "tp_"]
    assert column(maps[:1], lambda x: lookup_key(x, "u", "%1$s-%1$s"), kind) == ["7-7"]


def test_null_results(column):
    assert column([None, "", " ", "x"], is_null_text) == [True, True, True, False]
    assert column([None, {}, {"a": ""}], is_null_hash, "map<string,string>") == [
        True, True, False,
    ]


def test_json_path(column):
    docs = ['{"a":{"b":1,"c":[1,2],"d":null,"e":"t"}}', "nonsense", None]
    for path, want in {
        "a.b": ["1", "z", "z"], "a.c": ["[1,2]", "z", "z"], "a.d": ["z", "z", "z"],
        "a.e": ["t", "z", "z"], "a.x.y": ["z", "z", "z"], "": ["z", "z", "z"],
    }.items():
        assert column(docs, lambda x, p=path: json_path(x, p, "z")) == want
    with pytest.raises(ValueError):
        json_path(F.col("x"), "it's")


def test_typed_reads(column):
    numbers = ["7", "-3", "+4", "", " 5", "5.0", "x", None, "99999999999"]
    assert column(numbers, parse_int) == [7, -3, 4] + [None] * 6
    stamps = ["20210428 12:00:00", "2021-04-28", "", None]
    got = column(stamps, lambda x: parse_stamp(x).cast("string"))
    assert got == ["2021-04-28 12:00:00", None, None, None]


def test_draw(column):
    import hashlib

    values = list(range(50))
    want = [int(hashlib.md5(f"{v}-s".encode()).hexdigest()[:8], 16) % 97 for v in values]
    assert column(values, lambda x: draw(x, "s", 97), "bigint") == want
