"""Lookups against a live store through a user-supplied client.

The client is opened once per task and asked for batches of keys, one request after the other or
(`in_flight`) many at a time.  Only the key column crosses to Python; every other column stays in
the JVM.
"""

from __future__ import annotations

import asyncio
import inspect
import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.operators.lookup import _DIM, _KEY, Lookup, LookupOptions, as_lookup, join_unique
from dimweave.session import configure

BATCH_SIZE = 2000
ON_ERROR = ("fail", "miss")
GetMany = Callable[[Sequence[str]], Mapping[str, object]]

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Overlap:
    """Requests of a task that overlap: at most `in_flight` at once, each of them given up after
    `timeout` seconds and asked again up to `retries` times, after `backoff` seconds, then twice as
    long and so on."""

    in_flight: int = 200
    timeout: float = 2.0
    retries: int = 0
    backoff: float = 0.1

    def __post_init__(self) -> None:
        if self.in_flight < 1 or self.timeout <= 0 or self.retries < 0 or self.backoff < 0:
            raise ValueError("requests need room, time and no negative retries or back-off")


def _parts(keys: Sequence[str], size: int) -> list[list[str]]:
    return [list(keys[start : start + size]) for start in range(0, len(keys), size)]


def _missed(part: list[str], on_error: str) -> None:
    """Within an exception handler: raise it again, or take the keys of the request as misses."""
    if on_error == "fail":
        raise
    log.warning("fetch of %d keys failed, taken as misses", len(part), exc_info=True)


def _one_by_one(
    batches: Iterator[pd.Series], open_store: Callable[[], object], batch_size: int, on_error: str
) -> Iterator[pd.Series]:
    store = open_store()
    get_many = getattr(store, "get_many", store)
    close = getattr(store, "close", None)
    try:
        for keys in batches:
            found: dict[str, object] = {}
            for part in _parts(keys.dropna().unique(), batch_size):
                try:
                    found.update(get_many(part))
                except Exception:
                    _missed(part, on_error)
            yield keys.map(found.get).astype(object)
    finally:
        if close is not None:
            close()


async def _ask_all(
    get_many: Callable, parts: list[list[str]], overlap: Overlap, on_error: str
) -> dict[str, object]:
    """What the store holds for all parts; as many workers as may be in flight share them out."""
    found: dict[str, object] = {}
    waiting = iter(parts)

    async def ask(part: list[str]) -> None:
        for attempt in range(overlap.retries + 1):
            try:
                found.update(await asyncio.wait_for(get_many(part), overlap.timeout))
                return
            except Exception:
                if attempt == overlap.retries:
                    _missed(part, on_error)
            await asyncio.sleep(overlap.backoff * 2**attempt)

    async def work() -> None:
        for part in waiting:
            await ask(part)

    async with asyncio.TaskGroup() as group:  # the first failure cancels the others
        for _ in range(min(overlap.in_flight, len(parts))):
            group.create_task(work())
    return found


def _overlapped(
    batches: Iterator[pd.Series],
    open_store: Callable[[], object],
    batch_size: int,
    on_error: str,
    overlap: Overlap,
) -> Iterator[pd.Series]:
    with asyncio.Runner() as loop:

        async def opened() -> object:
            store = open_store()
            return await store if inspect.isawaitable(store) else store

        async def closed() -> None:
            ended = getattr(store, "close", lambda: None)()
            if inspect.isawaitable(ended):
                await ended

        store = loop.run(opened())
        get_many = getattr(store, "get_many", store)
        try:
            for keys in batches:
                parts = _parts(keys.dropna().unique(), batch_size)
                try:
                    found = loop.run(_ask_all(get_many, parts, overlap, on_error))
                except ExceptionGroup as failed:
                    raise failed.exceptions[0] from None
                yield keys.map(found.get).astype(object)
        finally:
            loop.run(closed())


def fetch(
    frame: DataFrame,
    open_store: Callable[[], object],
    *,
    key: str = "dim_key",
    output: str = "dim_value",
    dim_kind: str = "kv",
    batch_size: int = BATCH_SIZE,
    on_error: str = "fail",
    overlap: Overlap | None = None,
) -> DataFrame:
    """Add what the store holds for `key`, NULL on a miss.

    `open_store` runs in the task and returns a `get_many(keys)` function, or an object having
    one and perhaps `close()`.  Each Arrow batch asks once per distinct key, in requests of at
    most `batch_size` keys; `spark.sql.execution.arrow.maxRecordsPerBatch` bounds the batch.
    Nothing is shuffled, so a hot key is spread over the tasks as its rows are.

    With `overlap`, `get_many` is a coroutine function (`open_store` and `close` may be, too) and the
    requests of an Arrow batch overlap in one event loop for each task.  They may end in any order;
    values find their rows by key.  A request that fails or takes too long on its last attempt fails
    the job, or counts its keys as misses (`on_error="miss"`).
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if batch_size < 1:
        raise ValueError("batch_size must be positive")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if overlap is None:
            yield from _one_by_one(batches, open_store, batch_size, on_error)
        else:
            yield from _overlapped(batches, open_store, batch_size, on_error, overlap)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    returns = "map<string,string>" if dim_kind == "hash" else "string"
    # Marked as not repeatable so that the optimizer never evaluates a fetch twice.
    udf = F.pandas_udf(run, returns).asNondeterministic()
    return frame.withColumn(output, udf(F.col(key)))


def _by_key(rows: DataFrame, key: Column) -> DataFrame:
    """The rows sorted over ranges of a key, of which the longer follow the shorter ones."""
    order = ["__size", "__near"]
    named = rows.withColumns(
        {"__near": key, "__size": F.length(key), "__spread": F.monotonically_increasing_id()}
    )
    placed = named.repartitionByRange(*order, "__spread").sortWithinPartitions(*order)
    return placed.drop(*order, "__spread")


def external_lookup_join(
    lines: DataFrame,
    open_store: Callable[[], object],
    lookup: Lookup | LookupOptions | None = None,
    *,
    batch_size: int | None = None,
    on_error: str = "fail",
    distinct_keys: bool = False,
    near: bool = False,
    overlap: Overlap | None = None,
    **options,
) -> DataFrame:
    """`lookup_join` against a live store.

    By default each batch of lines fetches its own distinct keys.  With `distinct_keys` every
    key in use is fetched once for the whole input and joined back, which spares the store at
    the price of a shuffle of the keys.  `overlap` is that of `fetch`.  Keys to a request are
    `batch_size`, else those of `LookupOptions`, else BATCH_SIZE.

    `near` is for stores that hold neighbouring keys together, where a request for keys from all over
    the table costs as much as reading it: what asks (lines, or distinct keys) is first sorted over
    ranges of keys, shorter ones first, so that numbers after a prefix come in their order.  A hot key
    is spread over several ranges.
    """
    configure(lines.sparkSession)
    size = batch_size or getattr(lookup, "batch_size", None) or BATCH_SIZE
    lookup = as_lookup(lookup, options)
    settings = {
        "dim_kind": lookup.dim_kind, "batch_size": size, "on_error": on_error, "overlap": overlap
    }
    if distinct_keys:
        keys = lookup.keys(lines)
        if near:
            keys = _by_key(keys, F.col(_KEY))
        fetched = fetch(keys, open_store, output=lookup.stored, **settings)
        found = lookup.dimension(fetched)
        return lookup.emit(join_unique(lookup.keyed(lines), found, [_KEY], lookup.join))
    if near:
        lines = _by_key(*lookup.key_of(lines))
    keyed = lookup.keyed(lines)
    fetched = fetch(keyed, open_store, output=lookup.stored, **settings)
    found = lookup.with_entry(fetched)
    if lookup.miss == "drop":
        found = found.where(F.col(_DIM).isNotNull())
    return lookup.emit(found)
