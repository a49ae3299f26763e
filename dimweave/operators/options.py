"""Settings of a lookup from a mapping of dotted option names or their older aliases."""

from __future__ import annotations

from collections.abc import Mapping

from dimweave.functions.text import Delimited, KeyValue
from dimweave.operators.freshness import REFRESH_SECONDS
from dimweave.operators.lookup import Lookup, LookupOptions

# Option name, older alias.
ALIASES = {
    "source.schema.type": "sourceSchemaType",
    "source.schema.content": "sourceSchemaContent",
    "dim.schema.type": "dataSchema",
    "dim.schema.content": "dataSchemaDesc",
    "joinRule.type": "joinRuleType",
    "joinRule.leftFields": "joinRuleLeftFields",
    "joinRule.rightFields": "joinRuleRightFields",
    "cachePolicy.type": "cacheType",
    "cachePolicy.expireAfterWrite": "cacheExpireAfterWrite",
    "cachePolicy.dimUpdatePolicy": "cacheDimUpdatePolicy",
    "cachePolicy.nullable": "cacheNullable",
}


def _get(options: Mapping[str, str], name: str, default: str | None = None) -> str | None:
    for key in (name, ALIASES[name]):
        value = options.get(key)
        if value is not None and value.strip():
            return value
    return default


def _ttl(options: Mapping[str, str]) -> int | None:
    """Caching is off unless its type is `local`; then a TTL or an update policy is needed."""
    if _get(options, "cachePolicy.type") != "local":
        return None
    seconds = _get(options, "cachePolicy.expireAfterWrite")
    if seconds is not None:
        if int(seconds) < 0:
            raise ValueError("cachePolicy.expireAfterWrite must not be negative")
        return int(seconds) or None
    policy = _get(options, "cachePolicy.dimUpdatePolicy")
    if policy is None:
        raise ValueError("a local cache needs expireAfterWrite or dimUpdatePolicy")
    return REFRESH_SECONDS.get(policy.lower())


def from_options(options: Mapping[str, str]) -> LookupOptions:
    source_type = _get(options, "source.schema.type")
    content = _get(options, "source.schema.content")
    if content is None:
        raise ValueError("source.schema.content is required")
    if source_type == "MQ_KV":
        decode = KeyValue.from_descriptor(content)
    elif source_type == "MQ_TEXT":
        decode = Delimited.from_descriptor(content)
    else:
        raise ValueError(f"unsupported source.schema.type: {source_type}")

    dim_type = (_get(options, "dim.schema.type") or "").rsplit(".", 1)[-1]
    kinds = {"string": "kv", "kv_text": "kv", "hash": "hash"}
    if dim_type not in kinds:
        raise ValueError("dim.schema.type must be string or hash")
    dim_text = KeyValue.from_descriptor(_get(options, "dim.schema.content", "{}"))

    left, right = _get(options, "joinRule.leftFields"), _get(options, "joinRule.rightFields")
    if left is None or right is None:
        raise ValueError("joinRule.leftFields and joinRule.rightFields are required")
    # Only the first of several fields takes part in a lookup.
    lookup = Lookup(
        left_field=left.strip().split(",")[0],
        key_expr=right.strip().split(",")[0],
        decode=decode,
        dim_kind=kinds[dim_type],
        how=_get(options, "joinRule.type", "left_join"),
        dim_separator1=dim_text.pair_separators,
        dim_separator2=dim_text.field_separator,
    )
    nullable = _get(options, "cachePolicy.nullable", "true")
    return LookupOptions(
        lookup=lookup,
        ttl=_ttl(options),
        negative_cache=nullable.strip().lower() == "true",
        batch_size=int(options.get("batchSize", "2000")),
        min_batch_ms=int(options.get("minBatchTime", "1000")),
    )
