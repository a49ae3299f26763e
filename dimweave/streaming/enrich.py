"""Enrichment of streams: static joins, and joins whose dimension is re-read as it ages."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from dimweave.operators.external import BATCH_SIZE, Overlap, fetch
from dimweave.operators.freshness import resolve_ttl, staleness
from dimweave.operators.lookup import Lookup, LookupOptions, as_lookup, lookup_join
from dimweave.session import configure, fresh_folder

LoadDim = Callable[[], DataFrame]
Sink = Callable[[DataFrame, int], None]


class AgingDim:
    """A dimension re-read when it is older than `ttl` seconds; no `ttl` re-reads every time.

    `ready` is its snapshot for one lookup: decoded, rendered and stored in buckets by key, so that a
    micro-batch neither decodes nor exchanges the dimension, but brings its own distinct keys to it.

    A snapshot is written below the shared checkpoint folder, so it survives lost executors
    and stays the same for the whole interval, which a cached DataFrame over a changing source
    would not.  Two places are used in turn: micro-batches run one after the other, so the
    snapshot before the last is not read any more.
    """

    def __init__(
        self,
        load: LoadDim,
        ttl: int | None = None,
        refresh: str | None = None,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._load, self._clock = load, clock
        self.ttl = resolve_ttl(ttl, refresh)
        self.loads = 0
        self._loaded_at: float | None = None
        self._folder: str | None = None
        self._snapshot: DataFrame | None = None
        self._ready: dict[Lookup, tuple[int, str, DataFrame]] = {}

    def ready(self, lookup: Lookup) -> DataFrame:
        """`(dim_key, entry)` of the current snapshot, in as many buckets as shuffle partitions."""
        dim = self.current()
        turn, table, fields = self._ready.get(lookup, (0, None, None))
        if turn == self.loads:
            return fields
        spark = dim.sparkSession
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        folder = f"{self._folder}/ready-{len(self._ready)}-{self.loads % 2}"
        table = f"dimweave_{uuid.uuid4().hex}"
        rows = lookup.dimension(dim).repartition(buckets, "dim_key")
        writer = rows.write.mode("overwrite").bucketBy(buckets, "dim_key").sortBy("dim_key")
        writer.format("parquet").option("path", folder).saveAsTable(table)
        fields = spark.table(table)
        self._ready[lookup] = self.loads, table, fields
        return fields

    def current(self) -> DataFrame:
        now = self._clock()
        if self.ttl is None:
            self.loads += 1
            return self._load()
        if self._snapshot is None or now - self._loaded_at >= self.ttl:
            dim = self._load()
            spark = dim.sparkSession
            if self._folder is None:
                self._folder = fresh_folder(spark, "dim")
            path = f"{self._folder}/{self.loads % 2}"
            dim.write.mode("overwrite").parquet(path)
            self._snapshot = spark.read.schema(dim.schema).parquet(path)
            self._loaded_at = now
            self.loads += 1
        return self._snapshot


def parquet_sink(path: str) -> Sink:
    """One folder per micro-batch, replaced when a batch is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def text_sink(path: str, column: str = "enriched") -> Sink:
    """The enriched lines as text, one folder per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(column).write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return write


class Remembered:
    """What a live store answered, by key, each answer reused for `ttl` seconds from its fetch on.

    Answers are rows of a table below the shared folder, one folder for each micro-batch that asked,
    named by the time it did; no task keeps anything.  A key is asked again only when its answer has
    aged, so of the folders that still count each key has one row, and none is rewritten.  A folder
    whose answers have aged is deleted.  With `negative` misses are remembered as well, else they are
    asked again by every micro-batch that needs them.  The table outlives a restart if `folder` does.
    """

    def __init__(
        self,
        folder: str,
        ttl: int,
        negative: bool = True,
        clock: Callable[[], float] = time.time,
    ) -> None:
        self.folder, self.ttl, self.negative, self._clock = folder, ttl, negative, clock

    def _folders(self, spark: SparkSession, batch_id: int, now_ms: int) -> list[str]:
        """Folders of earlier micro-batches whose answers are fresh; aged ones go, and what an
        attempt at this very batch has left, too."""
        root = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        fresh = []
        for status in files.listStatus(root) if files.exists(root) else []:
            name = status.getPath().getName()
            batch, at = (int(x) for x in name.split("-"))
            if batch >= batch_id or now_ms - at >= self.ttl * 1000:
                files.delete(status.getPath(), True)
            else:
                fresh.append(f"{self.folder}/{name}")
        return fresh

    def answers(
        self,
        keys: DataFrame,
        ask: Callable[[DataFrame], DataFrame],
        stored: str,
        batch_id: int,
    ) -> DataFrame:
        """`(dim_key, stored)` of distinct keys; `ask` adds `stored` to those that must be asked."""
        spark, now_ms = keys.sparkSession, int(self._clock() * 1000)
        folders = self._folders(spark, batch_id, now_ms)
        known = None
        if folders:
            fetched = spark.read.parquet(*folders)
            known = fetched if self.negative else fetched.where(F.col(stored).isNotNull())
        missing = keys if known is None else keys.join(known, "dim_key", "left_anti")
        path = f"{self.folder}/{batch_id}-{now_ms}"
        new = ask(missing)
        new.write.mode("overwrite").parquet(path)
        new = spark.read.schema(new.schema).parquet(path)
        return new if known is None else known.join(keys, "dim_key", "left_semi").unionByName(new)


def enrich_stream(
    lines: DataFrame,
    dim: AgingDim | LoadDim | None,
    sink: Sink,
    checkpoint: str,
    lookup: Lookup | LookupOptions | None = None,
    *,
    trigger: str | None = "",
    name: str | None = None,
    dedup: bool = False,
    open_store: Callable[[], object] | None = None,
    batch_size: int | None = None,
    on_error: str = "fail",
    overlap: Overlap | None = None,
    ttl: int | None = None,
    refresh: str | None = None,
    negative_cache: bool | None = None,
    clock: Callable[[], float] = time.time,
    statistics: str | None = None,
    **options,
) -> DataStreamWriter:
    """Stream writer that enriches each micro-batch; call `.start()` on it.

    A micro-batch takes the place of a buffer flushed by size or time: its time is `trigger`
    (a second, or that of `LookupOptions`; None drains what is there and stops), its size the limit
    of the source (`maxFilesPerTrigger`, `maxOffsetsPerTrigger`).  With the checkpoint and a sink
    that replaces a repeated `batch_id`, every line is delivered once.

    The dimension is either `dim`, of which `dedup` joins only the keys of the micro-batch (as is
    always done with a snapshot that is reused), or
    (with `dim` None) a live store: `open_store` runs in the tasks, and each micro-batch asks it
    once for each of its distinct keys, in requests of `batch_size`, which may `overlap`.

    `ttl` or `refresh` is how long an answer of the store is reused (`Remembered`, in a folder
    beside the checkpoint), counted for each key from its fetch; misses are reused as well unless
    `negative_cache` is False.  For a function that loads a dimension it is the age of its snapshot.

    `statistics` is a folder for the lookup statistics of each micro-batch, one row of lines looked
    up, found and missed (`lookup_totals`), counted while the sink reads the lines.
    """
    if (dim is None) == (open_store is None):
        raise ValueError("give either a dimension or a store")
    configure(lines.sparkSession)
    seconds, negative = staleness(lookup, ttl, refresh, negative_cache)
    size = batch_size or getattr(lookup, "batch_size", None) or BATCH_SIZE
    if trigger == "":
        trigger = f"{getattr(lookup, 'min_batch_ms', 1000)} milliseconds"
    lookup = as_lookup(lookup, options)
    aging = AgingDim(dim, ttl=seconds) if dim is not None and not isinstance(dim, AgingDim) else dim
    kept = None
    if open_store is not None and seconds is not None:
        kept = Remembered(f"{checkpoint.rstrip('/')}-answers", seconds, negative, clock)
    asking = {"batch_size": size, "on_error": on_error, "overlap": overlap}

    def ask(keys: DataFrame) -> DataFrame:
        return fetch(keys, open_store, output=lookup.stored, dim_kind=lookup.dim_kind, **asking)

    def enriched(batch: DataFrame, batch_id: int, seen) -> DataFrame:
        if open_store is None:
            if aging.ttl is None:
                return lookup_join(batch, aging.current(), lookup, dedup=dedup, seen=seen)
            return lookup_join(batch, None, lookup, entries=aging.ready(lookup), seen=seen)
        keys = lookup.keys(batch)
        found = ask(keys) if kept is None else kept.answers(keys, ask, lookup.stored, batch_id)
        return lookup_join(batch, found, lookup, seen=seen)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        seen = None
        if statistics is not None:
            seen = Observation(), Observation()
        sink(enriched(batch, batch_id, seen), batch_id)
        if seen is not None:
            rows, matched = seen[0].get.get("rows", 0), seen[1].get.get("matched", 0)
            counts = [(rows, matched, rows - matched)]
            told = spark.createDataFrame(counts, "rows long, matched long, missed long")
            told.coalesce(1).write.mode("overwrite").parquet(f"{statistics}/batch={batch_id}")

    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def lookup_totals(spark: SparkSession, statistics: str) -> DataFrame:
    """Lines looked up, found and missed by all micro-batches that have ended."""
    told = spark.read.parquet(statistics)
    names = ("rows", "matched", "missed")
    return told.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(n).alias(n) for n in names])
