"""Lookups with bounded staleness against a dimension that changes over time.

A versioned dimension holds `(dim_key, effective_ts, dim_value or dim_fields)`.  A value may be
reused for `ttl` seconds, on aligned intervals: a line at time t sees the version that was
current at the last multiple of `ttl` up to t.  Age is bounded by `ttl` as with a per-key expiry
counted from the first fetch, and unlike that the result does not depend on arrival order.

How it scales.  All lines of one key within one interval get the same answer, so the as-of step
runs on distinct (key, interval) pairs and on one version per (key, interval), both reduced
before they are shuffled.  What one task sees of a key is bounded by the number of intervals
in the data, not by its rows.  Lines then join the result on (key, interval), a side with one
row per pair, where skew handling may split a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.functions.fields import floor_to, micros
from dimweave.operators.lookup import _DIM, _KEY, Lookup, LookupOptions, as_lookup, join_unique
from dimweave.session import configure, fresh_folder

# Seconds a value may be reused when only its update rhythm is known.
REFRESH_SECONDS = {"minute": 15, "hour": 300, "day": 1800, "random": None, "always": None}

_AT, _CELL, _SEEN = "__at", "__cell", "__seen"


def resolve_ttl(ttl: int | None = None, refresh: str | None = None) -> int | None:
    """Seconds a value may be reused, None for a live lookup; `ttl` wins over `refresh`."""
    if ttl is not None:
        if ttl < 0:
            raise ValueError("ttl must not be negative")
        return ttl or None
    if refresh is None:
        return None
    try:
        return REFRESH_SECONDS[refresh.lower()]
    except KeyError:
        raise ValueError(f"refresh must be one of {sorted(REFRESH_SECONDS)}") from None


def staleness(
    lookup: Lookup | LookupOptions | None,
    ttl: int | None,
    refresh: str | None,
    negative_cache: bool | None,
) -> tuple[int | None, bool]:
    """Seconds a value may be reused, and whether a miss is; what is given wins over the options."""
    seconds = resolve_ttl(ttl, refresh)
    if isinstance(lookup, LookupOptions):
        if ttl is None and refresh is None:
            seconds = lookup.ttl
        if negative_cache is None:
            negative_cache = lookup.negative_cache
    return seconds, negative_cache is not False


def _carried(cells: DataFrame, versions: DataFrame, width: int) -> DataFrame:
    """For each (key, cell start) of `cells` the version current at that time, or NULL."""
    visible = F.col(_AT) + F.pmod(-F.col(_AT), F.lit(width).cast("bigint"))
    newest = (
        versions.withColumn(_CELL, visible)
        .groupBy(_KEY, _CELL)
        .agg(F.max_by(_SEEN, F.struct(_AT, F.col(_SEEN)[_DIM]["text"])).alias(_SEEN))
        .withColumn("__wanted", F.lit(0))
    )
    wanted = cells.withColumn(_SEEN, F.lit(None).cast(newest.schema[_SEEN].dataType)).withColumn(
        "__wanted", F.lit(1)
    )
    history = (
        Window.partitionBy(_KEY)
        .orderBy(_CELL, "__wanted")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        newest.unionByName(wanted)
        .withColumn(_SEEN, F.last(_SEEN, ignorenulls=True).over(history))
        .where("__wanted = 1")
        .drop("__wanted")
    )


def _as_of(
    wanted: DataFrame, carried: DataFrame, versions: DataFrame, width: int, only_misses: bool
) -> DataFrame:
    """For each distinct (key, time) of `wanted` the version current at that time.

    The version carried into a cell, those that start within it and the wanted times are one
    sequence, in which every time takes the last version before it.  With `only_misses` a value
    carried in stays for the whole cell."""
    inside = versions.withColumn(_CELL, floor_to(F.col(_AT), width)).where(
        F.col(_CELL) < F.col(_AT)
    )
    columns = [_KEY, _CELL, _AT, _SEEN]
    nothing = F.lit(None).cast(versions.schema[_SEEN].dataType)
    points = (
        carried.withColumn(_AT, F.col(_CELL)).select(*columns, F.lit(0).alias("__turn"))
        .unionByName(inside.select(*columns, F.lit(1).alias("__turn")))
        .unionByName(
            wanted.withColumn(_SEEN, nothing).select(*columns, F.lit(2).alias("__turn"))
        )
    )
    so_far = (
        Window.partitionBy(_KEY, _CELL)
        .orderBy(_AT, "__turn")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = F.last(_SEEN, ignorenulls=True).over(so_far)
    if only_misses:
        # the carried row is the first of its cell
        start = F.first(_SEEN).over(so_far)
        seen = F.when(start[_DIM].isNotNull(), start).otherwise(seen)
    return points.withColumn(_SEEN, seen).where("__turn = 2").select(_KEY, _AT, _SEEN)


def as_of_by_range(wanted: DataFrame, versions: DataFrame) -> DataFrame:
    """For each distinct (key, time) of `wanted` the version current at that time, if any.

    Versions and wanted times are sorted over ranges.  A range starts in the middle of a key's history
    at most once, and then takes the last version of that key from the ranges before, of which one
    row each is looked at."""
    place = F.col(_SEEN)[_DIM]["text"]
    one = versions.groupBy(_KEY, _AT).agg(F.max_by(_SEEN, F.struct(place)).alias(_SEEN))
    nothing = F.lit(None).cast(one.schema[_SEEN].dataType)
    rows = one.withColumn("__turn", F.lit(0)).unionByName(
        wanted.select(_KEY, _AT, nothing.alias(_SEEN), F.lit(1).alias("__turn"))
    )
    spark, path = rows.sparkSession, fresh_folder(wanted.sparkSession, "as-of")
    # Written, because another run might draw the ranges elsewhere.
    placed = rows.repartitionByRange(_KEY, _AT, "__turn").withColumn("__range", F.spark_partition_id())
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)

    ends = placed.groupBy("__range").agg(F.min(_KEY).alias("__low"), F.max(_KEY).alias("__top"))
    top = ends.select(F.col("__range").alias("__r"), F.col("__top"))
    same = (F.col("__range") == F.col("__r")) & (F.col(_KEY) == F.col("__top"))
    last = (
        placed.where("__turn = 0").join(top, same).groupBy("__r", "__top")
        .agg(F.max_by(_SEEN, _AT).alias("__last"))
    )
    earlier = (F.col("__low") == F.col("__top")) & (F.col("__r") < F.col("__range"))
    brought = (
        ends.select("__range", "__low").join(last, earlier)
        .groupBy(F.col("__range").alias("__into"), "__low")
        .agg(F.max_by("__last", "__r").alias("__last"))
    )
    before = Window.partitionBy("__range", _KEY).orderBy(_AT, "__turn").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    own = placed.withColumn(_SEEN, F.last(_SEEN, ignorenulls=True).over(before)).where("__turn = 1")
    into = (F.col("__range") == F.col("__into")) & (F.col(_KEY) == F.col("__low"))
    return own.join(brought, into, "left").select(
        _KEY, _AT, F.coalesce(_SEEN, "__last").alias(_SEEN)
    )


def _found_by_range(lines, history, lookup, at, width, seconds, negative_cache) -> DataFrame:
    """The lines with their entry, from `as_of_by_range` at the starts of intervals, the lines' own
    times, or both."""
    start = floor_to(at, width)
    found = lookup.keyed(lines).withColumn(_AT, at).withColumn(_CELL, start)
    seen = F.lit(None)
    if seconds is not None:
        cells = as_of_by_range(lookup.keys(lines, **{_AT: start}), history)
        cells = cells.withColumnsRenamed({_AT: _CELL, _SEEN: "__at_start"})
        found = join_unique(found, cells, [_KEY, _CELL], "left")
        seen = F.col("__at_start")[_DIM]
    if seconds is None or not negative_cache:
        times = as_of_by_range(lookup.keys(lines, **{_AT: at}), history)
        found = join_unique(found, times, [_KEY, _AT], "left")
        seen = F.coalesce(seen, F.col(_SEEN)[_DIM]) if seconds is not None else F.col(_SEEN)[_DIM]
    return found.withColumn(_DIM, seen).drop(_SEEN, _AT, _CELL, "__at_start")


def fresh_lookup_join(
    lines: DataFrame,
    versions: DataFrame,
    lookup: Lookup | LookupOptions | None = None,
    *,
    ts: str = "ts",
    ttl: int | None = None,
    refresh: str | None = None,
    negative_cache: bool | None = None,
    grid: int = 60,
    by_range: bool = False,
    **options,
) -> DataFrame:
    """Enrich each line with the dimension value its time and the staleness bound allow.

    `negative_cache=False` lets a miss at the start of the interval be looked up again at the
    line's own time.  Without `ttl` and `refresh` every line sees the version of its own time;
    `grid` (seconds) is then only the width of the internal intervals: the distinct times and
    the versions that one key brings within it are put in order by one task.  A NULL value in
    `versions` deletes the key from that time on.  `(dim_key, effective_ts)` should be unique.

    With `by_range` the versions and times of a key are dealt out by ranges of (key, time), and each
    range gets the version that was current before it, so that not even the history of one key has to
    fit in a task; it costs writing keys, times and versions once.

    Of `LookupOptions` the staleness bound and negative caching (on by default) count where they are
    not given here.
    """
    configure(lines.sparkSession)
    seconds, negative_cache = staleness(lookup, ttl, refresh, negative_cache)
    lookup = as_lookup(lookup, options)
    width = (seconds or grid) * 1_000_000

    # Versions are aggregated by sorting them: dealt out first, so that no task sorts a whole file.
    raw = versions.select(_KEY, micros(F.col("effective_ts")).alias(_AT), lookup.stored)
    history = lookup.with_entry(raw.repartition(_KEY, _AT)).select(
        _KEY, _AT, F.struct(_DIM).alias(_SEEN)
    )
    at = micros(F.col(ts))
    if by_range:
        found = _found_by_range(lines, history, lookup, at, width, seconds, negative_cache)
        if lookup.miss == "drop":
            found = found.where(F.col(_DIM).isNotNull())
        return lookup.emit(found)
    cells = lookup.keys(lines, **{_CELL: floor_to(at, width)})
    carried = _carried(cells, history, width)
    keyed = lookup.keyed(lines).withColumn(_AT, at).withColumn(_CELL, floor_to(at, width))

    if seconds is not None and negative_cache:
        found = join_unique(keyed, carried, [_KEY, _CELL], "left")
    else:
        wanted = lookup.keys(lines, **{_AT: at, _CELL: floor_to(at, width)})
        current = _as_of(wanted, carried, history, width, only_misses=seconds is not None)
        found = join_unique(keyed, current, [_KEY, _AT], "left")
    found = found.withColumn(_DIM, F.col(_SEEN)[_DIM]).drop(_SEEN, _AT, _CELL)
    if lookup.miss == "drop":
        found = found.where(F.col(_DIM).isNotNull())
    return lookup.emit(found)
