"""Enrichment of text records with dimension data, on Spark tables and streams."""

from dimweave.functions import Delimited, KeyValue
from dimweave.operators import (
    Lookup,
    external_lookup_join,
    fresh_lookup_join,
    from_options,
    lookup_join,
    raw_lookup,
)
from dimweave.session import configure

__all__ = [
    "Delimited",
    "KeyValue",
    "Lookup",
    "configure",
    "external_lookup_join",
    "fresh_lookup_join",
    "from_options",
    "lookup_join",
    "raw_lookup",
]
