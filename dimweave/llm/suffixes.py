"""Repeated passages across documents by sparse suffix arrays.

Of all suffixes of the corpus (in words) only those at minimiser positions stay: where the hash of
`GRAM` words is the smallest of `least - GRAM + 1` in a row.  The choice depends on the words alone,
so every passage of `least` words keeps the same suffixes wherever it stands.  Suffixes that begin
alike are sorted, neighbours are compared, and what they share is extended to the right and to the
left; from `least` words on it is a repeated passage.  A neighbour that shares most to the right
need not be the one that shares most altogether; so where more than two suffixes begin alike, all
windows of `least` words around them are compared by hash as well, which makes the result exact.

Suffixes whose beginning occurs in one document only are left out before anything is shuffled.
That test is a bitmap of fixed size over the hashes that occur in several documents; when it fills
up, it lets more through, never less.  Suffixes travel with the words around them as hashes, enough
to extend a match to `least` words on either side; longer passages are the union of such matches.
Beginnings that occur in over `GROUP` documents are not gathered: their windows are counted with
partial sums instead.

Passages that occur twice in one document only are no repeats.  Words are what stands between ASCII
white space.  Null, empty and short texts have none.  Repeated rows are documents of their own, so
a copied row is repeated in full.  The result has a row for each document with a repeat; an empty
table gives none.  Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize

LEAST = 50
GRAM = 16
GROUP = 20_000
BITMAP_BITS = 27
BLOCK_BITS = 19
CHUNK = 10_000

WEIGHTS = np.random.default_rng(11).integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(
    2
) + np.uint64(1)


def word_hashes(text: str | None) -> np.ndarray:
    """A number from 1 on for each word; 0 is no word."""
    digest = xxhash.xxh64_intdigest
    found = np.array([digest(w) for w in (text or "").encode().split()], dtype=np.uint64)
    return np.maximum((found >> np.uint64(32)).astype(np.uint32), 1)


def minimisers(words: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Chosen positions and the hashes of the `gram` words there."""
    if len(words) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n = len(words) - gram + 1
    hashes = np.zeros(n, np.uint64)
    for j in range(gram):
        hashes += words[j : j + n] * WEIGHTS[j]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    views = np.lib.stride_tricks.sliding_window_view(hashes, least - gram + 1)
    at = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return at, hashes[at]


def around(words: np.ndarray, at: np.ndarray, least: int, gram: int):
    """The words before each position, nearest first, and those from it on; 0 beyond the text."""
    before, after = least - gram, least
    padded = np.concatenate(
        [np.zeros(before, np.uint32), words, np.zeros(after, np.uint32)]
    )
    right = padded[at[:, None] + before + np.arange(after)]
    left = padded[at[:, None] + before - 1 - np.arange(before)]
    return left, right


def windows(left: np.ndarray, right: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each a: hashes of the `least` words of which a stand before the position; 0 where the
    text is too short for it."""
    before = np.cumsum(left * WEIGHTS[1000 : 1000 + left.shape[1]], axis=1, dtype=np.uint64)
    after = np.cumsum(right * WEIGHTS[2000 : 2000 + right.shape[1]], axis=1, dtype=np.uint64)
    for a in range(left.shape[1] + 1):
        whole = right[:, least - a - 1] != 0
        hashes = after[:, least - a - 1].copy()
        if a:
            whole &= left[:, a - 1] != 0
            hashes += before[:, a - 1]
        hashes ^= WEIGHTS[3000 + a]
        yield a, np.where(whole, np.maximum(hashes, 1), 0)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2 ** bits over the hashes; its blocks are made apart, the driver gets them."""
    block = min(BLOCK_BITS, bits)
    bit = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    rows = hashes.select(F.shiftright(bit, block).alias("block"), bit.alias("bit")).distinct()
    arranged = rows.repartition(max(1, 1 << (bits - block) >> 3), "block").sortWithinPartitions(
        "block"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            blocks, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for b in np.unique(blocks).tolist():
                flags = made.setdefault(b, np.zeros(1 << block, bool))
                flags[at[blocks == b] - (b << block)] = True
            for b in sorted(made)[:-1]:
                yield [(b, np.packbits(made.pop(b), bitorder="little").tobytes())]
        for b, flags in made.items():
            yield [(b, np.packbits(flags, bitorder="little").tobytes())]

    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    # 2 ** (bits - 3) bytes at most
    for b, data in map_rows(arranged, run, "block long, data binary").toLocalIterator():
        start = b << (block - 3)
        bitmap[start : start + len(data)] = np.frombuffer(data, np.uint8)
    return bitmap


def signed(hashes: np.ndarray) -> list[int]:
    return hashes.view(np.int64).tolist()


def beginnings(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """`hash` and `n`: beginnings of chosen suffixes and in how many documents they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(0):
                _, hashes = minimisers(word_hashes(text.as_py()), least, gram)
                rows += ((h,) for h in signed(np.unique(hashes)))
            yield rows

    found = map_rows(docs.select("text"), run, "hash long")
    return found.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")


def suffixes(docs: DataFrame, several: Broadcast, many: Broadcast, least: int, gram: int):
    """The chosen suffixes that may repeat, with the words around them.  Suffixes of a document
    that agree in all of these are one row with several places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            rows, held = [], 0
            columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)]
            for row, doc, text in zip(*columns, strict=True):
                words = word_hashes(text.as_py())
                at, hashes = minimisers(words, least, gram)
                keep = in_bitmap(several.value, hashes) & ~in_bitmap(many.value, hashes)
                at, hashes = at[keep], hashes[keep]
                places: dict[tuple, list[int]] = {}
                for k in range(0, len(at), CHUNK):
                    part, beginning = at[k : k + CHUNK], signed(hashes[k : k + CHUNK])
                    left, right = around(words, part, least, gram)
                    for p, h, a, b in zip(part.tolist(), beginning, left, right, strict=True):
                        places.setdefault((h, a.tobytes(), b.tobytes()), []).append(p)
                rows += ((h, b, a, row, doc, p) for (h, a, b), p in places.items())
                held += len(places)
                if held >= CHUNK:
                    yield rows
                    rows, held = [], 0
            yield rows

    kind = docs.schema["id"].dataType.simpleString()
    return map_rows(
        docs, run,
        f"hash long, right binary, left binary, row long, id {kind}, places array<int>",
    )


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words two rows of words share from the first on."""
    same = np.column_stack([(a == b) & (a != 0), np.zeros(len(a), bool)])
    return same.argmin(axis=1)


def matches(
    hashes: np.ndarray, right: np.ndarray, left: np.ndarray, rows: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """How many words before each suffix, and from it on, stand in passages of another document.

    The suffixes are sorted by hash and by what follows.  All passages around a suffix hold its
    first words, so their union is given by the farthest ends."""
    before, after = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    at = np.flatnonzero((hashes[1:] == hashes[:-1]) & (rows[1:] != rows[:-1]))
    y, x = common(right[at], right[at + 1]), common(left[at], left[at + 1])
    good = x + y >= least
    for pair in (at[good], at[good] + 1):
        np.maximum.at(before, pair, x[good])
        np.maximum.at(after, pair, y[good])
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(hashes)]]))
    crowd = np.flatnonzero(np.repeat(sizes > 2, sizes))
    if len(crowd):
        group = np.repeat(np.arange(len(sizes)), sizes)[crowd]
        spread = group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for a, keys in windows(left[crowd], right[crowd], least):
            some = np.flatnonzero(keys)
            if not len(some):
                continue
            keys = keys[some] ^ spread[some]
            order = np.argsort(keys, kind="stable")
            keys, which = keys[order], crowd[some[order]]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            several = np.minimum.reduceat(rows[which], first) != np.maximum.reduceat(
                rows[which], first
            )
            counts = np.diff(np.concatenate([first, [len(keys)]]))
            hit = which[np.repeat(several, counts)]
            before[hit] = np.maximum(before[hit], a)
            after[hit] = np.maximum(after[hit], least - a)
    return before, after


def words_from(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Binary values of `width` words each, as a matrix."""
    parts = []
    for chunk in column.chunks:
        data = np.frombuffer(chunk.buffers()[2], np.uint8)
        start = chunk.offset * 4 * width
        parts.append(data[start : start + len(chunk) * 4 * width].view(np.uint32))
    return np.concatenate(parts).reshape(-1, width)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    done: list[list[int]] = []
    for start, end in sorted(spans):
        if done and start <= done[-1][1]:
            done[-1][1] = max(done[-1][1], end)
        else:
            done.append([start, end])
    return [(s, e) for s, e in done]


def compared(found: DataFrame, least: int, gram: int) -> DataFrame:
    """row, id, start, end of the passages found among suffixes that begin alike."""
    kind = found.schema["id"].dataType.simpleString()
    arranged = found.repartition("hash").sortWithinPartitions("hash", "right", "row")

    def chunk(parts: list[pa.RecordBatch]) -> list[tuple]:
        table = pa.Table.from_batches(parts).combine_chunks()
        right, left = (
            words_from(table.column(c), n) for c, n in (("right", least), ("left", least - gram))
        )
        rows = table.column("row").to_numpy()
        before, after = matches(table.column("hash").to_numpy(), right, left, rows, least)
        hit = np.flatnonzero(after)
        found = table.select(["row", "id", "places"]).take(pa.array(hit)).to_pydict()
        spans: dict[int, list[tuple[int, int]]] = {}
        named = {}
        for r, doc, places, x, y in zip(
            *found.values(), before[hit].tolist(), after[hit].tolist(), strict=True
        ):
            named[r] = doc
            spans.setdefault(r, []).extend((p - x, p + y) for p in places)
        return [(r, named[r], s, e) for r, found in spans.items() for s, e in merged(found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        parts, size = [], 0
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            if size >= CHUNK:
                # the group that is still open ends where the hash changes
                last = parts[-1].column(0)[-1].as_py()
                end = int(np.searchsorted(hashes, last, "right"))
                parts.append(batch.slice(0, end))
                if end < len(hashes):
                    yield chunk(parts)
                    parts, size, batch = [], 0, batch.slice(end)
                else:
                    continue
            if batch.num_rows:
                parts.append(batch)
                size += batch.num_rows
        if parts:
            yield chunk(parts)

    return map_rows(arranged, run, f"row long, id {kind}, start int, end int")


def counted(docs: DataFrame, many: Broadcast, least: int, gram: int) -> DataFrame:
    """The same for beginnings in very many documents, by counting their windows."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            rows = []
            columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)]
            for row, doc, text in zip(*columns, strict=True):
                words = word_hashes(text.as_py())
                at, hashes = minimisers(words, least, gram)
                keep = in_bitmap(many.value, hashes)
                at, hashes = at[keep], hashes[keep]
                for k in range(0, len(at), CHUNK):
                    part, beginning = at[k : k + CHUNK], hashes[k : k + CHUNK]
                    left, right = around(words, part, least, gram)
                    for a, keys in windows(left, right, least):
                        some = np.flatnonzero(keys)
                        codes = signed(keys[some] ^ beginning[some])
                        starts = (part[some] - a).tolist()
                        rows += ((c, row, doc, p) for c, p in zip(codes, starts, strict=True))
                if len(rows) >= CHUNK:
                    yield rows
                    rows = []
            yield rows

    found = materialize(map_rows(docs, run, f"key long, row long, id {kind}, start int"), "windows")
    several = found.groupBy("key").agg(F.min("row").alias("a"), F.max("row").alias("b"))
    several = materialize(several.filter("a <> b").select("key"), "several")
    return found.join(several, "key").select("row", "id", "start", (F.col("start") + least).alias("end"))


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    least: int = LEAST,
    gram: int = GRAM,
    group: int = GROUP,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """doc_id, `n_repeated` (words) and `passages` (word ranges) of each document that shares a
    passage of at least `least` words with another one."""
    context = docs.sparkSession.sparkContext
    named = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )
    # written once: a number must mean the same row in every pass, also after a lost task
    named = materialize(named, "rows")
    known = materialize(beginnings(named, least, gram), "beginnings")
    several = context.broadcast(bitmap_of(known, bitmap_bits))
    crowded = known.filter(F.col("n") > group)
    hot = not crowded.isEmpty()
    # a beginning that shares a bit with a crowded one goes the other way with it, in all documents
    many = context.broadcast(
        bitmap_of(crowded, bitmap_bits) if hot else np.zeros(1, np.uint8)
    )
    spans = compared(suffixes(named, several, many, least, gram), least, gram)
    if hot:
        spans = spans.union(counted(named, many, least, gram))
    kind = named.schema["id"].dataType.simpleString()
    grouped = spans.groupBy("row", "id").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            rows = []
            for doc, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                done = merged([(s["start"], s["end"]) for s in found.as_py()])
                parts = [{"start": s, "end": e} for s, e in done]
                rows.append((doc, sum(e - s for s, e in done), parts))
            yield rows

    return map_rows(
        grouped.select("id", "spans"),
        join,
        f"doc_id {kind}, n_repeated long, passages array<struct<start:int,end:int>>",
    )
