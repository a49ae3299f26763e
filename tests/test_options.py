import pytest

from dimweave import Delimited, KeyValue, from_options

BASE = {
    "source.schema.type": "MQ_KV",
    "source.schema.content": "{}",
    "dim.schema.type": "string",
    "joinRule.leftFields": "mykey",
    "joinRule.rightFields": "tp_%s",
}


def test_defaults():
    got = from_options(BASE)
    lookup = got.lookup
    assert (lookup.left_field, lookup.key_expr, lookup.join) == ("mykey", "tp_%s", "left")
    assert (lookup.decode, lookup.dim_kind) == (KeyValue(), "kv")
    assert (got.ttl, got.negative_cache) == (None, True)
    assert (got.batch_size, got.min_batch_ms) == (2000, 1000)


def test_older_names():
    got = from_options(
        {
            "sourceSchemaType": "MQ_TEXT",
            "sourceSchemaContent": '{"schema":[{"fieldKey":"a","fieldIndex":0}]}',
            "dataSchema": "hash",
            "joinRuleType": "Inner_Join",
            "joinRuleLeftFields": " a,b ",
            "joinRuleRightFields": "th_%s,other",
            "cacheType": "local",
            "cacheExpireAfterWrite": "20",
            "cacheNullable": "false",
            "batchSize": "5",
            "minBatchTime": "7",
        }
    )
    assert got.lookup.decode == Delimited.of("a")
    assert (got.lookup.dim_kind, got.lookup.join) == ("hash", "inner")
    assert (got.lookup.left_field, got.lookup.key_expr) == ("a", "th_%s")
    assert (got.ttl, got.negative_cache) == (20, False)
    assert (got.batch_size, got.min_batch_ms) == (5, 7)


@pytest.mark.parametrize(
    ("cache", "ttl"),
    [
        ({"cachePolicy.type": "local", "cachePolicy.dimUpdatePolicy": "minute"}, 15),
        ({"cachePolicy.type": "local", "cachePolicy.dimUpdatePolicy": "HOUR"}, 300),
        ({"cachePolicy.type": "local", "cachePolicy.dimUpdatePolicy": "day"}, 1800),
        ({"cachePolicy.type": "local", "cachePolicy.dimUpdatePolicy": "RANDOM"}, None),
        ({"cachePolicy.type": "local", "cachePolicy.dimUpdatePolicy": "odd"}, None),
        ({"cachePolicy.type": "Local", "cachePolicy.expireAfterWrite": "9"}, None),
        (
            {
                "cachePolicy.type": "local", "cachePolicy.expireAfterWrite": "9",
                "cachePolicy.dimUpdatePolicy": "day",
            },
            9,
        ),
    ],
)
def test_staleness(cache, ttl):
    assert from_options(BASE | cache).ttl == ttl


def test_dimension_separators():
    got = from_options(BASE | {"dim.schema.content": '{"separator1":";","separator2":":"}'})
    assert (got.lookup.dim_separator1, got.lookup.dim_separator2) == (";", ":")


@pytest.mark.parametrize(
    "bad",
    [
        {"source.schema.type": "CSV"},
        {"source.schema.content": " "},
        {"dim.schema.type": ""},
        {"dim.schema.type": "list"},
        {"joinRule.leftFields": " "},
        {"joinRule.type": "outer"},
        {"cachePolicy.type": "local"},
        {"cachePolicy.type": "local", "cachePolicy.expireAfterWrite": "-1"},
    ],
)
def test_refusals(bad):
    with pytest.raises(ValueError):
        from_options(BASE | bad)
