from dimweave.operators.external import Overlap, external_lookup_join, fetch
from dimweave.operators.freshness import fresh_lookup_join, resolve_ttl
from dimweave.operators.lookup import (
    Lookup,
    LookupOptions,
    decodable,
    drop_blank_lines,
    join_type,
    lookup_join,
    raw_lookup,
    rejects,
)
from dimweave.operators.options import from_options
from dimweave.operators.quality import (
    check_lines,
    error_counts,
    lookup_stats,
    observed,
    throughput,
)
from dimweave.operators.sampling import (
    sample_bucketed,
    sample_every_n,
    sample_every_n_per_task,
    sample_greedy,
    sample_hashed,
)

__all__ = [
    "Lookup",
    "LookupOptions",
    "Overlap",
    "check_lines",
    "decodable",
    "drop_blank_lines",
    "error_counts",
    "external_lookup_join",
    "fetch",
    "fresh_lookup_join",
    "from_options",
    "join_type",
    "lookup_join",
    "lookup_stats",
    "observed",
    "raw_lookup",
    "rejects",
    "resolve_ttl",
    "sample_bucketed",
    "sample_every_n",
    "sample_every_n_per_task",
    "sample_greedy",
    "sample_hashed",
    "throughput",
]
