from dimweave.sources.dims import duplicate_keys, hash_dim, require_unique, string_dim
from dimweave.sources.generators import (
    number_stream,
    numbers,
    sequential_kv,
    sequential_text,
    skewed_key,
    skewed_text,
)
from dimweave.sources.lines import as_lines, read_lines, stream_lines, stream_table

__all__ = [
    "as_lines",
    "duplicate_keys",
    "hash_dim",
    "number_stream",
    "numbers",
    "read_lines",
    "require_unique",
    "sequential_kv",
    "sequential_text",
    "skewed_key",
    "skewed_text",
    "stream_lines",
    "stream_table",
    "string_dim",
]
