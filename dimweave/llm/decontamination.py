"""Benchmark decontamination by suffix arrays over shards of the training documents.

Each Arrow batch of documents is a shard.  Its words become numbers of the benchmark's own
vocabulary (0 for any other word and between documents), and a suffix array with the lengths that
neighbours share is built by prefix doubling over the positions that could begin a match.  Every
suffix of the benchmark that holds a window is binary-searched in it, first by the window, then by
all its words; from where it would stand, the shared lengths give its longest verbatim match with
every suffix that begins with the window.  So each document gets the words that windows cover, and
for each item that occurs the longest verbatim match and both its places.

A position can begin a match only if the next `window` words all are benchmark words (fewer for
items shorter than a window), so the array is sparse, and leaving out the rest loses nothing.

The benchmark is numbered in tasks, in blocks of about `BLOCK_WORDS` words; the driver passes on
one block at a time and each is broadcast by itself, so the size of what is broadcast at once is
bounded whatever the benchmark's size.  Documents are read once and never shuffled.

Null and empty texts have no words and no hits.  Items without words never occur.  Repeated
documents are judged each on their own; items with equal texts all count.  Items with a null id
cover words but are not named.  With an empty
benchmark nothing is hit.  A very long text is a shard of its own; its work grows as n log n, also
where it repeats one word.  Only ids and texts are read, so other columns cannot clash.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize, remove, small_batches

WINDOW = 13
BLOCK_WORDS = 2_000_000
SHARD_BYTES = 1_000_000

# ASCII letters are lower-cased, digits and bytes of other characters are parts of
# words, every other ASCII character separates them.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def split_words(text: str | None) -> list[bytes]:
    """The words of a text; after the translation only spaces separate them."""
    return (text or "").encode().translate(WORD_BYTES).split()


def run_lengths(numbers: np.ndarray) -> np.ndarray:
    """At each position, how many numbers follow until the next 0."""
    at = np.arange(len(numbers))
    zero = np.where(numbers == 0, at, len(numbers))
    return np.minimum.accumulate(zero[::-1])[::-1] - at


def as_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of numbers as strings that sort like them."""
    rows = np.ascontiguousarray(rows.astype(">u4"))
    return rows.view(f"S{4 * rows.shape[1]}").ravel()


def ranks(numbers: np.ndarray) -> list[np.ndarray]:
    """For each power of two, the rank of each position by as many numbers, until all differ."""
    _, now = np.unique(numbers, return_inverse=True)
    found, step = [now.astype(np.int64)], 1
    while len(now) and found[-1].max() < len(now) - 1:
        later = np.zeros(len(now), np.int64)
        later[:-step] = found[-1][step:] + 1
        _, now = np.unique(found[-1] * (len(now) + 1) + later, return_inverse=True)
        found.append(now.astype(np.int64))
        step *= 2
    return found


def shared(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many numbers the suffixes at a and at b share from their beginning."""
    size = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + size, b + size
        inside = np.maximum(x, y) < len(levels[level])
        same = inside & (levels[level][np.where(inside, x, 0)] == levels[level][np.where(inside, y, 0)])
        size += same.astype(np.int64) << level
    return size


class SuffixArray:
    """The sorted suffixes of numbered words that share at least `least` words with the benchmark.

    0 ends every match, so each becomes a number of its own, above all others."""

    def __init__(self, numbers: np.ndarray, least: int, window: int):
        runs = run_lengths(numbers)
        inside = runs >= least
        # the rest of a run that is long enough belongs to it, and the 0 that ends it
        begin = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        ends = begin + runs[begin]
        edge = np.zeros(len(numbers) + 2, np.int64)
        np.add.at(edge, begin, 1)
        np.add.at(edge, ends + 1, -1)
        self.place = np.flatnonzero(np.cumsum(edge)[: len(numbers)])
        kept = numbers[self.place].astype(np.int64)
        top = 1 << 31
        self.numbers = np.where(kept == 0, top + np.arange(len(kept)), kept)
        levels = ranks(self.numbers)
        starts = np.flatnonzero(runs[self.place] >= least)
        self.order = starts[np.argsort(levels[-1][starts])]
        self.same = np.zeros(len(self.order), np.int64)  # with the suffix before
        self.same[1:] = shared(levels, self.order[:-1], self.order[1:])
        padded = np.concatenate([self.numbers, np.full(window, 0xFFFFFFFF)])
        self.keys = as_keys(padded[self.order[:, None] + np.arange(window)])

    def common(self, at: int, words: np.ndarray) -> int:
        """How many words the suffix in place `at` shares with the given ones."""
        start = self.order[at]
        own = self.numbers[start : start + len(words)]
        other = np.flatnonzero(own != words[: len(own)])
        return int(other[0]) if len(other) else len(own)

    def matches(self, words: np.ndarray, first: int, last: int) -> np.ndarray:
        """The longest match of `words` with each suffix in places first to last, all of which
        begin with its window."""
        low, high = first, last
        while low < high:
            middle = (low + high) // 2
            n = self.common(middle, words)
            if n == len(words) or self.numbers[self.order[middle] + n] > words[n]:
                high = middle
            else:
                low = middle + 1
        found = np.empty(last - first, np.int64)
        if low < last:
            right = np.concatenate([[self.common(low, words)], self.same[low + 1 : last]])
            found[low - first :] = np.minimum.accumulate(right)
        if low > first:
            left = np.concatenate([[self.common(low - 1, words)], self.same[first + 1 : low][::-1]])
            found[: low - first] = np.minimum.accumulate(left)[::-1]
        return found


@dataclass
class Block:
    """A part of the benchmark: numbered words of its distinct texts, with the ids of each."""

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    slots: dict[bytes, int] = field(default_factory=dict)
    texts: list[np.ndarray] = field(default_factory=list)
    names: list[list[str]] = field(default_factory=list)
    size: int = 0

    def add(self, item: str | None, text: str | None) -> None:
        words = split_words(text)
        if not words:
            return
        slot = self.slots.setdefault(b" ".join(words), len(self.texts))
        if slot == len(self.texts):
            number = self.vocabulary.setdefault
            self.texts.append(np.array([number(w, len(self.vocabulary) + 1) for w in words]))
            self.names.append([])
            self.size += len(words)
        if item is not None:
            self.names[slot].append(item)
        self.size += 1

    def searched(self) -> list[tuple]:
        """For each window length: lowest and highest key of the suffixes with a window of it, the
        text and the place each belongs to."""
        found = []
        for width in sorted({min(self.window, len(t)) for t in self.texts}):
            chosen = [k for k, t in enumerate(self.texts) if min(self.window, len(t)) == width]
            slot = np.concatenate([np.full(len(self.texts[k]) - width + 1, k) for k in chosen])
            place = np.concatenate([np.arange(len(self.texts[k]) - width + 1) for k in chosen])
            rows = np.concatenate(
                [np.lib.stride_tricks.sliding_window_view(self.texts[k], width) for k in chosen]
            )
            low = np.zeros((len(rows), self.window), np.int64)
            high = np.full((len(rows), self.window), 0xFFFFFFFF)
            low[:, :width] = high[:, :width] = rows
            found.append((width, as_keys(low), as_keys(high), slot, place))
        return found

    def packed(self) -> bytes:
        return pickle.dumps((self.vocabulary, self.texts, self.names, self.searched()))


def blocks_of(
    benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int
) -> list[Broadcast]:
    """The benchmark's blocks, numbered in tasks and broadcast one by one."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        block = Block(window)
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block.add(item, text)
                if block.size >= block_words:
                    yield [(block.packed(),)] if block.texts else []
                    block = Block(window)
        yield [(block.packed(),)] if block.texts else []

    parts = max(1, -(-size // (8 * block_words)))
    numbered = materialize(map_rows(rows.repartition(parts), run, "block binary"), "benchmark")
    context = benchmark.sparkSession.sparkContext
    found = [context.broadcast(pickle.loads(r["block"])) for r in numbered.toLocalIterator()]
    remove(numbered)
    return found


def longest_of(docs: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Each document and where in the arrays its greatest size is, the first of equal ones."""
    order = np.lexsort((np.arange(len(docs)), -sizes, docs))
    first = np.flatnonzero(np.diff(docs[order], prepend=-1))
    yield from zip(docs[order[first]].tolist(), order[first].tolist(), strict=True)


def scan(texts: list[str | None], blocks: list[Broadcast], window: int) -> list[tuple]:
    """Per text: words, hit words, longest match in words, hit ranges, items that occur, and the
    longest match with each."""
    texts_words = [split_words(t) for t in texts]
    counts = np.array([len(w) for w in texts_words], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(counts + 1)])
    cover = np.zeros(starts[-1] + 1, dtype=np.int64)
    # per text: item -> words, place in the text, place in the item
    met: list[dict[str, tuple[int, int, int]]] = [{} for _ in texts]
    longest = [0] * len(texts)
    for broadcast in blocks:
        vocabulary, items, names, searched = broadcast.value
        number = vocabulary.get
        numbers = np.fromiter(
            (n for words in texts_words for n in (*(number(w, 0) for w in words), 0)),
            dtype=np.uint32,
            count=int(starts[-1]),
        )
        array = SuffixArray(numbers, searched[0][0], window)
        for width, low, high, slots, places in searched:
            first = np.searchsorted(array.keys, low, "left")
            last = np.searchsorted(array.keys, high, "right")
            for k in np.flatnonzero(last > first).tolist():
                slot, place = int(slots[k]), int(places[k])
                at = array.place[array.order[first[k] : last[k]]]
                cover[at] += 1
                cover[at + width] -= 1
                sizes = array.matches(items[slot][place:], int(first[k]), int(last[k]))
                for doc, best in longest_of(np.searchsorted(starts, at, "right") - 1, sizes):
                    size = int(sizes[best])
                    longest[doc] = max(longest[doc], size)
                    match = (size, int(at[best] - starts[doc]), place)
                    for name in names[slot]:
                        if size > met[doc].get(name, (0,))[0]:
                            met[doc][name] = match
        if len(blocks) > 1:
            broadcast.__dict__.pop("_value", None)  # one block in memory at a time
    hit = np.cumsum(cover)[:-1] > 0
    rows = []
    for n, start, most, items_met in zip(counts.tolist(), starts.tolist(), longest, met, strict=False):
        if not most:
            rows.append((n, 0, 0, [], [], []))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit[start : start + n], [0]])))
        spans = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
        found = sorted(items_met)
        matches = [
            dict(zip(("item", "words", "start", "item_start"), (i, *items_met[i]), strict=True))
            for i in found
        ]
        rows.append((n, int(hit[start : start + n].sum()), most, spans, found, matches))
    return rows


def shards(batch: pa.RecordBatch, text: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about SHARD_BYTES of text each, more if several blocks are searched;
    a longer text is one slice."""
    limit = SHARD_BYTES * min(max(blocks, 1), 8)
    start, held = 0, 0
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    for at, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: `n_words`, `n_hit` (words inside a benchmark window), `longest`
    (words of the longest verbatim match with one item), `spans` of word positions, `items` with
    windows in it, and `matches`: for each of them the longest match, where it begins in the
    document and in the item."""
    blocks = blocks_of(benchmark, item_col, item_text_col, window, block_words)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            for shard in shards(batch, 1, len(blocks)):
                rows = scan(shard.column(1).to_pylist(), blocks, window)
                yield [(d, *r) for d, r in zip(shard.column(0).to_pylist(), rows, strict=True)]

    return map_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        run,
        f"doc_id {kind}, n_words long, n_hit long, longest long, "
        "spans array<struct<start:long,end:long>>, items array<string>, "
        "matches array<struct<item:string,words:long,start:long,item_start:long>>",
    )


def contaminated(n_hit, n_words, share: int = 20):
    """At least one word in `share` is inside a benchmark window; of numbers or columns."""
    return (n_hit > 0) & (share * n_hit >= n_words)


def remove_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents that are not contaminated, with all their columns, in one pass."""
    blocks = blocks_of(benchmark, item_col, item_text_col, window, block_words)
    text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in shards(batch, text, len(blocks)):
                rows = scan(shard.column(text).to_pylist(), blocks, window)
                keep = [not contaminated(hit, n) for n, hit, *_ in rows]
                yield shard.filter(pa.array(keep, pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
