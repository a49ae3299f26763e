"""Streaming throughput, checks and rate-limited samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dimweave.operators.quality import error_counts, throughput
from dimweave.operators.sampling import emit_segment
from dimweave.session import configure


def stream_throughput(
    stream: DataFrame,
    ts: str = "ts",
    message: str = "line",
    order: Sequence[str] = ("ts",),
    width: str = "10 seconds",
    *,
    late: str,
) -> DataFrame:
    """`throughput` of a stream.

    `late` says how far a record may lag behind the newest one of earlier micro-batches; what lags
    more is dropped and counted (`dropped_rows`), so it has no default.  In append mode a window is
    emitted when the watermark has passed it, and the last ones stay open; in update mode every
    micro-batch gives the windows it touched, of which `latest_windows` takes the last.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return throughput(timed, ts, message, order, width)


def stream_error_counts(
    checked: DataFrame, ts: str = "ts", width: str = "10 seconds", *, late: str
) -> DataFrame:
    """`error_counts` of a stream from `check_lines`; `late` as for `stream_throughput`."""
    timed = checked.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return error_counts(timed, ts, width)


def latest_windows(written: DataFrame, window: str = "window_start") -> DataFrame:
    """Each window as the last micro-batch gave it, from the folders of `parquet_sink`."""
    others = [c for c in written.columns if c not in (window, "batch")]
    last = F.max_by(F.struct(*others), "batch").alias("__last")
    return written.groupBy(window).agg(last).select(window, "__last.*")


class StreamTotals(StreamingQueryListener):
    """Totals of the streams of a session from the time it is added (`spark.streams.addListener`).

    `of(query)` gives micro-batches, input rows and rows dropped by watermarks, over all reports and
    not only the last hundred that a query holds, and after the query has ended.  A micro-batch that
    is reported again counts once.
    """

    def __init__(self) -> None:
        self._seen: dict[str, dict[int, tuple[int, int]]] = {}
        self._sums: dict[str, tuple[int, int, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        query, batch = str(progress.id), progress.batchId
        held = self._seen.setdefault(query, {})
        rows, lost = held.get(batch, (0, 0))
        now = max(rows, progress.numInputRows), max(lost, dropped)
        held[batch] = now
        batches, all_rows, all_lost = self._sums.get(query, (0, 0, 0))
        self._sums[query] = (
            batches + (rows == lost == 0 and now != (0, 0)), all_rows + now[0] - rows,
            all_lost + now[1] - lost,
        )
        for old in [b for b in held if b < batch - 1]:  # cannot be reported again
            del held[old]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> dict[str, int]:
        batches, rows, dropped = self._sums.get(str(query.id), (0, 0, 0))
        return {"batches": batches, "rows": rows, "dropped": dropped}


def dropped_rows(query: StreamingQuery) -> int:
    """Rows the watermark has dropped, over the progress reports that the query still holds;
    `StreamTotals` counts them all."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def stream_sample_greedy(
    stream: DataFrame, keys: Sequence[str], ts: str, interval_ms: int
) -> DataFrame:
    """Times at which `sample_greedy` emits, by key, for records that arrive in time order.

    The state of a key is the time emitted last.  Per micro-batch only the key and time
    columns reach Python; the rate limit of the source bounds what one key brings.
    """
    configure(stream.sparkSession)
    keys = list(keys)

    def emit(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        times = np.unique(np.concatenate([b["tick"].unique() for b in batches]))
        emitted = state.get[0] if state.exists else -(1 << 62)
        chosen = emit_segment(times, emitted, interval_ms)
        if len(chosen):
            state.update((int(chosen[-1]),))
        out = pd.DataFrame({"tick": chosen})
        for name, value in zip(keys, key, strict=True):
            out[name] = value
        yield out[[*keys, "tick"]]

    fields = [stream.schema[k] for k in keys]
    ticks = stream.select(*keys, F.unix_millis(F.col(ts).cast("timestamp")).alias("tick"))
    return ticks.groupBy(*keys).applyInPandasWithState(
        emit,
        T.StructType([*fields, T.StructField("tick", T.LongType())]),
        T.StructType([T.StructField("emitted", T.LongType())]),
        "append",
        GroupStateTimeout.NoTimeout,
    )
