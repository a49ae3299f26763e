from dimweave.functions.fields import (
    draw,
    is_null_hash,
    is_null_text,
    json_path,
    lookup_key,
    merge,
    parse_int,
    parse_stamp,
)
from dimweave.functions.text import (
    Delimited,
    KeyValue,
    decode_bytes,
    is_blank,
    render,
    render_pair,
    split_tokens,
)

__all__ = [
    "Delimited",
    "KeyValue",
    "decode_bytes",
    "draw",
    "is_blank",
    "is_null_hash",
    "is_null_text",
    "json_path",
    "lookup_key",
    "merge",
    "parse_int",
    "parse_stamp",
    "render",
    "render_pair",
    "split_tokens",
]
