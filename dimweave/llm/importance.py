"""Target-distribution importance resampling on hashed word n-grams.

A text is cut down to its words and single spaces, and an overlapped scan with boundary lookarounds
(`regex`, one match from every word on) emits the spans of its n-grams: the span of a match is the
longest n-gram from that word, and the shorter ones end where the following matches begin.  A span
is counted in the bucket of its CRC-32; the checksum of a longer span goes on from that of the
shorter one.

Two bucket counts, of the documents and of the target texts, give each bucket a gain: the logarithm
of its smoothed shares, in thousandths, rounded down.  The weight of a document is the sum of the
gains of its features.  A draw without replacement takes the highest weights after each document's
own Gumbel noise has been added, which depends on its id only.

The scan runs once: it writes the buckets of each document, two bytes each, from which counts and
weights are read.  Counts are summed in the tasks; the driver gets one number for each bucket.  The
order over all documents is a range partitioning with counts before each range, so no task sees them
all.

Null and empty texts have no features and weight 0.  Texts of any length are scanned whole.  Repeated
rows count each time and are drawn each for itself; equal scores and ids are put in an arbitrary but
fixed order.  A null id makes noise like an empty one and comes last among equal scores.  An empty
table gives no rows, an empty target the gains of an even distribution over the buckets.  Only the
named columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize

LONGEST = 3
BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20
DRAWN_PERCENT = 5

# Letters in lower case, digits and all bytes of other characters stay; the rest separates words.
_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def scanner(longest: int = LONGEST) -> regex.Pattern:
    """From every word on, the longest n-gram up to `longest` words that starts there."""
    return regex.compile(rb"(?: [^ ]+){1,%d}(?![^ ])" % longest)


def checksums(text: bytes | None, pattern: regex.Pattern, longest: int) -> tuple[int, np.ndarray]:
    """How many words a text has, and the CRC-32 of each of its n-grams."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0, np.zeros(0, np.uint32)
    line = b" " + b" ".join(words)
    starts = [m.start() for m in pattern.finditer(line, overlapped=True)]
    pieces = [line[a:b] for a, b in zip(starts, [*starts[1:], len(line)], strict=True)]
    now = list(map(zlib.crc32, words))
    found = now.copy()
    for n in range(1, longest):
        # the span from a word on grows by the next word, and so does its checksum
        now = list(map(zlib.crc32, pieces[n:], now))
        found += now
    return len(pieces), np.array(found, np.uint32)


def scan(docs: DataFrame, id_col: str, text_col: str, longest: int, buckets: int) -> DataFrame:
    """`id`, `n_words` and `features`, the buckets of a document as numbers of four or two bytes."""
    kind = docs.schema[id_col].dataType.simpleString()
    size = number(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        pattern = scanner(longest)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words, sums = checksums(text.as_py(), pattern, longest)
                rows.append((doc, words, (sums % np.uint32(buckets)).astype(size).tobytes()))
            yield rows

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_rows(named, run, f"id {kind}, n_words long, features binary")


def number(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def counts(scanned: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds, over all texts."""
    size = number(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for features in batch.column(0):
                total += np.bincount(np.frombuffer(features.as_py(), size), minlength=buckets)
        held = np.flatnonzero(total)
        yield list(zip(held.tolist(), total[held].tolist(), strict=True))

    # at most one row for each bucket
    table = map_rows(scanned.select("features"), run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in table.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over own share, smoothed by one in each bucket."""
    n = float(len(own))
    s, t = float(own.sum()) + n, float(target.sum()) + n
    return np.array(
        [
            math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t)))
            for a, b in zip(own, target, strict=True)
        ],
        np.int64,
    )


def weights(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """`row`, `id`, `n_words`, `n_features` and `weight` of each scanned document."""
    kind = scanned.schema["id"].dataType.simpleString()
    size = number(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            row, doc, words = (batch.column(k).to_pylist() for k in range(3))
            found = [np.frombuffer(f.as_py(), size) for f in batch.column(3)]
            sums = [int(gain[f].sum()) for f in found]
            yield list(zip(row, doc, words, map(len, found), sums, strict=True))

    rows = scanned.select("row", "id", "n_words", "features")
    return map_rows(rows, run, f"row long, id {kind}, n_words long, n_features long, weight long")


def noise(doc_id, seed: int):
    """Thousandths of a Gumbel variate from the id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """The rows with their `rank` by falling score, null beyond the first `drawn`.

    Rows are sorted over ranges; the written table keeps which range a row is in, and the rows of
    the ranges before are added to its place in its own."""
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    placed = scored.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    placed = materialize(placed, "ranked")
    # one row for each range
    sizes = sorted(placed.groupBy("range").count().collect())
    before, total = [], 0
    for place, count in sizes:
        before.append((place, total))
        total += count
    offsets = scored.sparkSession.createDataFrame(before, "range int, before long")
    own = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    numbered = placed.join(offsets, "range").withColumn("rank", F.col("before") + own)
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return numbered.withColumn("rank", rank).drop("range", "before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = DRAWN_PERCENT,
) -> DataFrame:
    """`id_col`, n_features, weight, score and rank (null if not drawn) of each document.

    Of the documents with `least_words` words or more, `percent` in a hundred are drawn."""
    found = scan(docs, id_col, text_col, longest, buckets)
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "features")
    wanted = scan(target.withColumn("__none", F.lit(None).cast("long")), "__none", target_text_col,
                  longest, buckets)
    gain = gains(counts(found, buckets), counts(wanted, buckets))
    scored = weights(found, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    enough = F.col("n_words") >= least_words
    drawn = found.filter(enough).count() * percent // 100
    some = ranked(scored.filter(enough), drawn)
    others = scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    return some.unionByName(others).select(
        F.col("id").alias(id_col), "n_features", "weight", "score", "rank"
    )
