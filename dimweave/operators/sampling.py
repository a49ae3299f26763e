"""Sampling of records: rate-limited (greedy and bucketed) and one in n.

The greedy sample is a chain: each emitted record decides which one may come next.  It is
computed without gathering a key in one task.  Time is cut into segments of several intervals;
each (key, segment) is summed up as a map from "earliest allowed time" to "last emitted time".
Maps of `FAN` consecutive segments are composed into one, and so on up a tree, until a key has no
more than `FAN` of them; these are followed one by one, then those below each of them, down to the
segments, and each segment emits on its own.  So a task sees at most `FAN` maps of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.functions.fields import draw, floor_to, micros
from dimweave.operators.grouped import map_groups
from dimweave.session import configure, fresh_folder

_SEGMENT, _T = "__segment", "__t"
_RUN = ("first", "last", "leave", "step")
_NEVER = np.iinfo(np.int64).min // 2
MIN_SEGMENT_MS = 600_000
MIN_SEGMENT_INTERVALS = 8
FAN = 256
_LEAD = np.iinfo(np.int64).min  # sorts before any segment
_EVER = np.iinfo(np.int64).max // 2


def _segment_width(interval_ms: int) -> int:
    if interval_ms < 1:
        raise ValueError("interval must be at least one millisecond")
    return interval_ms * max(MIN_SEGMENT_INTERVALS, -(-MIN_SEGMENT_MS // interval_ms))


def _chain_exits(times: np.ndarray, interval: int) -> np.ndarray:
    """For each record the last one emitted in the segment if that record is emitted."""
    following = np.searchsorted(times, times + interval, side="left")
    jump = np.where(following < len(times), following, np.arange(len(times)))
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return times[jump]
        jump = further


def segment_runs(times: np.ndarray, start: int, interval: int) -> dict[str, np.ndarray]:
    """Runs `(first, last, leave, step)` of the records a chain may enter the segment at.

    Entering within a run with step 0 leaves at `leave`; with step 1 the run covers every
    millisecond from first to last, and leaving is shifted as entering is.
    """
    entries = times[: np.searchsorted(times, start + interval, side="left") + 1]
    leave = _chain_exits(times, interval)[: len(entries)]
    step_in, step_out = np.diff(entries), np.diff(leave)
    # 0: chains have met, 1: neighbours moving alike, 2: a new run begins.
    kind = np.where(step_out == 0, 0, np.where((step_in == 1) & (step_out == 1), 1, 2))
    turns = np.concatenate([[False], kind[1:] != kind[:-1]]) if len(kind) else kind
    first = np.flatnonzero(np.concatenate([[True], (kind == 2) | turns]))
    last = np.append(first[1:], len(entries)) - 1
    step = np.where(last > first, np.append(kind, 0)[first], 0)
    return {"first": entries[first], "last": entries[last], "leave": leave[first], "step": step}


def compose_segments(runs: dict[str, np.ndarray], interval: int) -> dict[str, np.ndarray]:
    """The ordered runs of consecutive segments as runs of all of them together."""
    _, starts = np.unique(runs[_SEGMENT], return_index=True)
    ends = [*starts[1:], len(runs[_SEGMENT])]
    parts = [
        tuple(runs[c][a:b] for c in _RUN) for a, b in zip(starts.tolist(), ends, strict=True)
    ]
    if len(parts) == 1:
        return {c: runs[c] for c in _RUN}
    exits: dict[tuple[int, int], int] = {}

    def after(emitted: int, k: int) -> int:
        """The time emitted last after segments k and on, if `emitted` was before them."""
        if (emitted, k) in exits:
            return exits[emitted, k]
        now = emitted
        for first, last, leave, step in parts[k:]:
            at = np.searchsorted(last, now + interval, side="left")
            if at < len(last):
                now = int(leave[at] + step[at] * max(0, now + interval - first[at]))
        exits[emitted, k] = now
        return now

    found = []
    for row in zip(*parts[0], strict=True):
        first, last, leave, step = map(int, row)
        todo = [(first, last, leave, step, 1)]
        while todo:
            low, high, out, step, k = todo.pop()
            if not step or low == high:
                found.append((low, high, after(out, k), 0))
            elif k == len(parts):
                found.append((low, high, out, 1))
            else:
                todo += _through(low, high, out, interval, parts[k], k + 1)
    # A time after the first segment's entries enters the next one at its first record.
    found.sort()
    found.append((found[-1][1] + 1, _EVER, after(_NEVER, 1), 0))
    merged = [found[0]]
    for low, high, out, step in found[1:]:
        if not step and not merged[-1][3] and out == merged[-1][2]:
            merged[-1] = (merged[-1][0], high, out, 0)
        else:
            merged.append((low, high, out, step))
    columns = np.array(merged, dtype=np.int64).T
    return dict(zip(_RUN, columns, strict=True))


def _through(low: int, high: int, out: int, interval: int, part: tuple, k: int) -> list[tuple]:
    """Pieces of a run whose exits move as its entries do, on the far side of one more segment."""
    first, last, leave, step = part
    begin = now = out + interval
    end = begin + high - low
    at = int(np.searchsorted(last, now, side="left"))
    pieces = []

    def piece(upto: int, emitted: int, slope: int) -> None:
        nonlocal now
        pieces.append((low + now - begin, low + upto - begin, emitted, slope, k))
        now = upto + 1

    while now <= end:
        if at == len(last):
            piece(end, now - interval, 1)
            break
        if now <= first[at]:
            piece(min(int(first[at]), end), int(leave[at]), 0)
        if now <= min(int(last[at]), end):
            shift = int(step[at]) * (now - int(first[at]))
            piece(min(int(last[at]), end), int(leave[at]) + shift, int(step[at]))
        at += 1
    return pieces


def follow_segments(
    runs: dict[str, np.ndarray], interval: int, emitted: int = _NEVER
) -> dict[str, np.ndarray]:
    """Last emitted time before each segment, from the ordered runs of one key."""
    segments, starts = np.unique(runs[_SEGMENT], return_index=True)
    first, last, leave, step = (runs[c] for c in ("first", "last", "leave", "step"))
    ends = np.append(starts[1:], len(first))
    entering = np.empty(len(segments), dtype=np.int64)
    for i, (lo, hi) in enumerate(zip(starts, ends, strict=True)):
        entering[i] = emitted
        allowed = emitted + interval
        at = lo + np.searchsorted(last[lo:hi], allowed, side="left")
        if at < hi:
            emitted = leave[at] + step[at] * max(0, allowed - first[at])
    return {_SEGMENT: segments, _T: entering}


def emit_segment(times: np.ndarray, emitted: int, interval: int) -> np.ndarray:
    """Greedy choice within sorted times, given the time emitted last."""
    chosen = []
    at = np.searchsorted(times, emitted + interval, side="left")
    while at < len(times):
        chosen.append(times[at])
        at = np.searchsorted(times, times[at] + interval, side="left")
    return np.array(chosen, dtype=np.int64)


def sample_greedy(
    frame: DataFrame, keys: Sequence[str], ts: str, interval_ms: int, order: Sequence[str]
) -> DataFrame:
    """Records emitted when at least `interval_ms` passed since the last one of their key.

    The clock has milliseconds, so of equal ones only the first can be emitted, the first by
    `order`.  That reduction runs before the shuffle and bounds what a segment can hold.

    Records without a time are one interval of their own, as in `sample_bucketed`.  Python sees
    keys as two hashes that are never NULL, since numbers next to NULLs would turn into doubles.
    """
    configure(frame.sparkSession)
    names = list(keys)
    values = [x for k in names for x in (F.col(k).isNull(), F.col(k))] or [F.lit(0)]
    keys = ["__k0", "__k1"]
    codes = [F.xxhash64(*values), F.hash(F.lit(1), *values).cast("bigint")]
    width = _segment_width(interval_ms)
    timed = frame.withColumns(
        {_T: F.unix_millis(F.col(ts).cast("timestamp"))} | dict(zip(keys, codes, strict=True))
    )
    ticks = timed.where(F.col(_T).isNotNull()).select(*keys, _T).distinct()
    ticks = ticks.withColumn(_SEGMENT, floor_to(F.col(_T), width))

    longs = {c: T.StructField(c, T.LongType()) for c in (_SEGMENT, _T, *_RUN)}

    def runs(group: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        times = group[_T]
        return segment_runs(times, int(times[0] - times[0] % width), interval_ms)

    def follow(group: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        if group[_SEGMENT][0] != _LEAD:
            return follow_segments(group, interval_ms)
        emitted = int(group["first"][0])
        return follow_segments({c: v[1:] for c, v in group.items()}, interval_ms, emitted)

    def compose(group: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return compose_segments(group, interval_ms)

    def emit(group: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        # The time emitted last sorts before the times of the segment itself.
        return {_T: emit_segment(group[_T][1:], int(group[_T][0]), interval_ms)}

    summary = map_groups(ticks, [*keys, _SEGMENT], [_T], runs, [longs[c] for c in _RUN])
    # A segment's name is its start; a composed one has that of the first it may hold.
    levels, span = [summary], width
    least, most = timed.agg(F.min(_T), F.max(_T)).first()  # one row
    while least is not None and (most - least) // span >= FAN:
        span *= FAN
        above = floor_to(F.col(_SEGMENT), span)
        levels[-1] = _written(levels[-1].withColumn("__above", above))
        higher = map_groups(
            levels[-1], [*keys, "__above"], [_SEGMENT, "first"], compose, [longs[c] for c in _RUN]
        )
        levels.append(higher.withColumnRenamed("__above", _SEGMENT))
    out = [longs[_SEGMENT], longs[_T]]
    entering = map_groups(levels.pop(), keys, [_SEGMENT, "first"], follow, out)
    while levels:
        lead = entering.select(
            *keys, F.col(_SEGMENT).alias("__above"), F.lit(_LEAD).alias(_SEGMENT),
            F.col(_T).alias("first"), *[F.lit(0).cast("long").alias(c) for c in _RUN[1:]],
        )
        led = levels.pop().unionByName(lead)
        entering = map_groups(led, [*keys, "__above"], [_SEGMENT, "first"], follow, out)
        entering = entering.drop("__above")
    chosen = map_groups(
        ticks.unionByName(entering), [*keys, _SEGMENT], [_T], emit, [longs[_T]]
    )
    groups = [F.col(k) for k in names] or [F.lit("")]
    untimed = _first_per(frame.where(F.col(ts).isNull()), groups, order)
    picked = _first_of_each(timed, chosen, [*keys, _T], order).drop(_T, *keys)
    return picked.unionByName(untimed)


def _semi_join(frame: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows of `frame` whose values in `on` are among those of `wanted`; NULL equals NULL."""
    wanted = wanted.select(*[F.col(c).alias(f"__w{i}") for i, c in enumerate(on)])
    same = None
    for i, c in enumerate(on):
        equal = F.col(c).eqNullSafe(F.col(f"__w{i}"))
        same = equal if same is None else same & equal
    return frame.join(wanted, same, "left_semi")


def _first_of_each(
    frame: DataFrame, wanted: DataFrame, on: list[str], order: Sequence[str]
) -> DataFrame:
    """Of the rows of `frame` with the wanted values in `on`, the first per value by `order`.

    The comparison is null-safe: a NULL key is a key of its own.
    """
    hits = _semi_join(frame, wanted, on)
    return _first_per(hits, [F.col(c).alias(f"__w{i}") for i, c in enumerate(on)], order)


def _first_per(frame: DataFrame, groups: list[Column], order: Sequence[str]) -> DataFrame:
    row = F.struct(*frame.columns)
    first = frame.groupBy(*groups).agg(F.min_by(row, F.struct(*order)).alias("__row"))
    return first.select("__row.*")


def sample_bucketed(
    frame: DataFrame, keys: Sequence[str], ts: str, interval_ms: int, order: Sequence[str]
) -> DataFrame:
    """The first record of each key in each aligned interval; partial aggregation only."""
    configure(frame.sparkSession)
    bucket = floor_to(micros(F.col(ts)), interval_ms * 1000).alias("__bucket")
    return _first_per(frame, [*[F.col(k) for k in keys], bucket], order)


def sample_every_n(
    frame: DataFrame,
    order: str,
    every: int = 1000,
    buckets: Sequence[str] = (),
    width: int | None = None,
    *,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Every n-th record by the column `order`, counted per bucket.

    The orders are partitioned by range, whatever their values, and each range is numbered on its
    own; it gets its offset from the counts of the ranges before.  So no bucket, and no table without
    buckets, is numbered by one task.  With `width` the ranges are cells of so many consecutive
    integers, which spares writing the orders down where these are dense.

    `order` must be unique within a bucket and not NULL.  Only these columns are shuffled and
    numbered; the records themselves are picked by a semi-join with what was chosen.  `counted` has
    the number of earlier records of each bucket.
    """
    configure(frame.sparkSession)
    buckets = list(buckets)
    rows = frame.select(*dict.fromkeys([*buckets, order]))
    if width is None:
        rows = _in_ranges(rows, order)
    else:
        rows = rows.withColumn("__cell", floor_to(F.col(order).cast("bigint"), width))
    offsets = _offsets(rows, buckets, few=width is None)
    if counted is not None:
        earlier = {b: f"__c{i}" for i, b in enumerate(buckets)}
        same = F.lit(True)
        for mine, other in earlier.items():
            same = same & F.col(mine).eqNullSafe(F.col(other))
        # one row without buckets, else one for each bucket
        more = F.coalesce("counted", F.lit(0))
        offsets = offsets.join(counted.withColumnsRenamed(earlier), same, "left").select(
            *buckets, "__cell", (F.col("__before") + more).alias("__before")
        )
    # The offset of a cell enters the numbering as a row ahead of the cell's own, so that the
    # records are shuffled once.
    cell = Window.partitionBy(*buckets, "__cell").orderBy(F.col(order).asc_nulls_first())
    numbered = rows.unionByName(offsets, allowMissingColumns=True).withColumns(
        {"__number": F.first("__before").over(cell) + F.row_number().over(cell) - 1}
    )
    chosen = numbered.where(F.col("__before").isNull() & (F.col("__number") % every == 0))
    return _semi_join(frame, chosen, [*buckets, order])


def _written(frame: DataFrame) -> DataFrame:
    """The frame as a table below the shared folder, read by more than one part of a plan."""
    path = fresh_folder(frame.sparkSession, "written")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _in_ranges(rows: DataFrame, order: str) -> DataFrame:
    """The rows with the number of their range of `order`; written, because another run might draw
    the ranges elsewhere."""
    place = F.spark_partition_id().cast("bigint")
    return _written(rows.repartitionByRange(order).withColumn("__cell", place))


def _offsets(rows: DataFrame, buckets: list[str], few: bool) -> DataFrame:
    """How many rows of a bucket the cells before hold; `few` says that cells are ranges."""
    counts = rows.groupBy(*buckets, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    if few and not buckets:
        total, before = 0, []
        for place, n in sorted(tuple(r) for r in counts.collect()):  # one row for each range
            before.append((place, total))
            total += n
        return rows.sparkSession.createDataFrame(before, "__cell long, __before long")
    earlier = Window.partitionBy(*buckets).orderBy("__cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    return counts.select(*buckets, "__cell", before)


def sample_every_n_per_task(frame: DataFrame, every: int = 1000) -> DataFrame:
    """Every n-th record of each task, by a counter per task: no shuffle at all.

    Which records those are depends on how the input is split.
    """
    configure(frame.sparkSession)
    counter = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        frame.withColumn("__count", counter).where(F.col("__count") % every == 0).drop("__count")
    )


def sample_hashed(frame: DataFrame, number: str, every: int = 1000) -> DataFrame:
    """Near one in n records, chosen by a hash of an integer column: stateless, for streams."""
    configure(frame.sparkSession)
    return frame.where(draw(F.col(number), "sample", every) == 0)
