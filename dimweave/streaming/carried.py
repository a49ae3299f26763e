"""Samples and windows of a stream that carry tables from one micro-batch to the next.

Each class is a sink for `foreachBatch`.  What a micro-batch leaves for the next is a table in a
folder of its batch number below `folder`; a repeated micro-batch starts from the one before it and
replaces its own, so results are the same after a restart.  The work itself is that of the batch
operators, so no key is gathered in one task and records stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.functions.fields import floor_to
from dimweave.operators.quality import error_counts
from dimweave.operators.sampling import sample_every_n, sample_greedy
from dimweave.session import configure

MILLIS = "__millis"


class _Carried:
    def __init__(self, folder: str) -> None:
        self.folder = folder.rstrip("/")

    def _save(self, frame: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = f"{self.folder}/{name}/batch={batch_id}"
        frame.write.mode("overwrite").parquet(path)
        return frame.sparkSession.read.schema(frame.schema).parquet(path)

    def _batches(self, spark: SparkSession, name: str) -> dict[int, object]:
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in files.listStatus(root)] if files.exists(root) else []
        return {int(p.getName().removeprefix("batch=")): p for p in found}

    def _before(self, spark: SparkSession, name: str, batch_id: int | None = None) -> DataFrame | None:
        """What the last micro-batch before `batch_id` left, or the last of all."""
        earlier = [b for b in self._batches(spark, name) if batch_id is None or b < batch_id]
        if not earlier:
            return None
        return spark.read.parquet(f"{self.folder}/{name}/batch={max(earlier)}")

    def _forget(self, spark: SparkSession, name: str, batch_id: int) -> None:
        """Delete what micro-batches older than the last one left."""
        old = {b: p for b, p in self._batches(spark, name).items() if b < batch_id - 1}
        for path in old.values():
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def _all(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{name}")


class StreamSampleEveryN(_Carried):
    """`sample_every_n` of a stream: the counters of the buckets go on over micro-batches.

    Within a micro-batch records count by `order`; so the result is that of the whole table where
    micro-batches come in that order.  `sample` reads the records chosen so far."""

    def __init__(
        self, folder: str, order: str, every: int = 1000, buckets: Sequence[str] = ()
    ) -> None:
        super().__init__(folder)
        self.order, self.every, self.buckets = order, every, list(buckets)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        counted = batch.groupBy(*self.buckets).agg(F.count(F.lit(1)).alias("counted"))
        before = self._before(spark, "counters", batch_id)
        self._save(
            sample_every_n(batch, self.order, self.every, self.buckets, counted=before),
            "sample", batch_id,
        )
        if before is not None:
            counted = counted.unionByName(before).groupBy(*self.buckets).agg(
                F.sum("counted").alias("counted")
            )
        self._save(counted, "counters", batch_id)
        self._forget(spark, "counters", batch_id)

    def sample(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "sample").drop("batch")


class StreamSampleGreedy(_Carried):
    """`sample_greedy` of a stream: whole records, in whatever order they come.

    Records wait until none before them is expected, that is until the newest one seen is `late_ms`
    ahead; then they are judged in the order of time.  Records that come later still, and those
    without a time, are set aside (`late`), so what was sampled and what was set aside add up to the
    batch operator's input.  Of each key the last emitted record is kept for one interval.
    `finish` judges what still waits when the stream has ended.
    """

    def __init__(
        self,
        folder: str,
        keys: Sequence[str],
        ts: str,
        interval_ms: int,
        order: Sequence[str],
        *,
        late_ms: int,
    ) -> None:
        super().__init__(folder)
        self.keys, self.ts, self.interval_ms = list(keys), ts, interval_ms
        self.order, self.late_ms = list(order), late_ms

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        timed = batch.withColumn(MILLIS, F.unix_millis(F.col(self.ts).cast("timestamp")))
        before = self._before(spark, "frontier", batch_id)
        passed, newest = before.first() if before is not None else (None, None)
        seen = timed.agg(F.max(MILLIS)).first()[0]  # one row
        newest = max((x for x in (newest, seen) if x is not None), default=None)
        frontier = newest - self.late_ms if newest is not None else None
        if passed is not None and frontier is not None:
            frontier = max(frontier, passed)
        overdue = F.col(MILLIS).isNull()
        if passed is not None:
            overdue = overdue | (F.col(MILLIS) < passed)
        self._save(timed.where(overdue).drop(MILLIS), "late", batch_id)
        on_time = timed.where(~overdue)
        pending = self._before(spark, "pending", batch_id)
        if pending is not None:
            on_time = on_time.unionByName(pending)
        ready = F.col(MILLIS) < F.lit(frontier) if frontier is not None else F.lit(False)
        self._judge(on_time.where(ready), batch_id, frontier)
        self._save(on_time.where(~ready), "pending", batch_id)
        kind = "passed long, newest long"
        self._save(spark.createDataFrame([(frontier, newest)], kind), "frontier", batch_id)
        for name in ("pending", "emitted", "frontier"):
            self._forget(spark, name, batch_id)

    def _judge(self, ready: DataFrame, batch_id: int, frontier: int | None) -> None:
        """Emit from records before the frontier; the last ones emitted earlier lead the chains."""
        spark = ready.sparkSession
        earlier = self._before(spark, "emitted", batch_id)
        mark = ready.withColumn("__led", F.lit(False))
        if earlier is not None:
            mark = mark.unionByName(earlier.withColumn("__led", F.lit(True)))
        order = ["__led_last", *self.order]
        mark = mark.withColumn("__led_last", ~F.col("__led"))  # of equal times the leader is first
        picked = sample_greedy(mark, self.keys, self.ts, self.interval_ms, order)
        chosen = self._save(picked.drop("__led_last"), "chosen", batch_id)
        self._save(chosen.where("NOT __led").drop("__led", MILLIS), "sample", batch_id)
        kept = chosen.drop("__led")
        if frontier is not None:
            kept = kept.where(F.col(MILLIS) > frontier - self.interval_ms)
        self._save(kept, "emitted", batch_id)
        self._forget(spark, "chosen", batch_id + 1)

    def finish(self, spark: SparkSession) -> None:
        """Judge the records that wait; no micro-batch may follow."""
        waiting = self._before(spark, "pending")
        if waiting is not None:
            batch_id = max(self._batches(spark, "pending")) + 1
            self._judge(waiting, batch_id, None)
            self._save(waiting.where("false"), "pending", batch_id)

    def sample(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "sample").drop("batch")

    def late(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "late").drop("batch")


class StreamWindows(_Carried):
    """Windows of a stream that late records correct, instead of being dropped.

    Each micro-batch adds its own share of every window it touches, and `windows` adds the shares up.
    Records whose window had ended `late_ms` before the newest record of earlier micro-batches count
    as late: they are in the windows all the same, and `late` has them by themselves."""

    def __init__(
        self,
        folder: str,
        ts: str = "ts",
        width_ms: int = 10_000,
        *,
        late_ms: int,
        share: Callable[[DataFrame, str, str], DataFrame] = error_counts,
    ) -> None:
        super().__init__(folder)
        self.ts, self.width_ms, self.late_ms, self.share = ts, width_ms, late_ms, share

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        at = F.unix_millis(F.col(self.ts).cast("timestamp"))
        before = self._before(spark, "newest", batch_id)
        newest = before.first()[0] if before is not None else None
        closed = F.lit(False)
        if newest is not None:
            ends = floor_to(at, self.width_ms) + self.width_ms
            closed = F.coalesce(ends <= newest - self.late_ms, F.lit(False))
        self._save(batch.where(closed), "late", batch_id)
        width = f"{self.width_ms} milliseconds"
        self._save(self.share(batch, self.ts, width), "shares", batch_id)
        seen = batch.agg(F.max(at)).first()[0]  # one row
        newest = max((x for x in (newest, seen) if x is not None), default=None)
        self._save(spark.createDataFrame([(newest,)], "newest long"), "newest", batch_id)
        self._forget(spark, "newest", batch_id)

    def windows(self, spark: SparkSession) -> DataFrame:
        shares = self._all(spark, "shares").drop("batch")
        numbers = [
            f.name for f in shares.schema if isinstance(f.dataType, T.NumericType) and f.name != "batch"
        ]
        return shares.groupBy("window_start").agg(*[F.sum(n).alias(n) for n in numbers])

    def late(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "late").drop("batch")
