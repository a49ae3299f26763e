from dimweave.streaming.carried import StreamSampleEveryN, StreamSampleGreedy, StreamWindows
from dimweave.streaming.enrich import (
    AgingDim,
    Remembered,
    enrich_stream,
    lookup_totals,
    parquet_sink,
    text_sink,
)
from dimweave.streaming.metrics import (
    StreamTotals,
    dropped_rows,
    latest_windows,
    stream_error_counts,
    stream_sample_greedy,
    stream_throughput,
)

__all__ = [
    "AgingDim",
    "Remembered",
    "StreamSampleEveryN",
    "StreamSampleGreedy",
    "StreamTotals",
    "StreamWindows",
    "dropped_rows",
    "enrich_stream",
    "latest_windows",
    "lookup_totals",
    "parquet_sink",
    "stream_error_counts",
    "stream_sample_greedy",
    "stream_throughput",
    "text_sink",
]
