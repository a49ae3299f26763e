"""Approximate nearest neighbours by a hash-prefix forest.

Every tree gives each vector a hash string of `BITS` bits, the signs of random projections, and
holds the strings as a sorted array.  A query descends to its longest match in each tree by binary
search, then ascends bit by bit in all trees together: at each level the vectors that share that
prefix are a slice of each array, and it stops once the slices hold enough entries (an entry counts
in each tree where it is met).  What lies in them is scored exactly.  Levels so differ from query to
query: short strings where vectors are sparse, long ones in clusters, at last the root.

The index is dealt to blocks by a hash of the vectors, each with a forest of its own, and every
query visits every block of its length; so vectors are shuffled once, not once a tree, and no
cluster is one task.  A block has about `32 * sqrt(n)` vectors, so queries are copied `sqrt(n) / 32`
times, and no more than `BLOCK` vectors or `NUMBERS` components, which bounds the memory of a task;
over `CHUNK` queries are dealt to several copies of a block.

How many entries are enough comes from the data: for `CALIBRATION` queries (those with the smallest
hash) the true neighbours are found by an exact pass over all vectors, and the least share of a
block is taken with which `TARGET` of them would be met; `k + 1` different vectors of each block are
met in any case.  Vectors without structure need a large share, and the search comes near an exact
one, as it must.

Nearness is the inner product.  Vectors are stretched onto a sphere by one more component, so that
a larger product is a smaller angle.  Equal vectors are one entry: it keeps its `k + 1` smallest
ids, which is all that can be among `k` nearest, and equal queries are searched once.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids.
Vectors of each length are searched among their own.  Repeated rows count as one.  With fewer than
`k` other vectors all are returned.  Only the named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize

TREES = 32  # at most 64
BITS = 58  # of a hash string; six more hold the number of its tree
SEED = 7
CALIBRATION = 100
TARGET = 0.95
LEAST_BLOCK = 4096
BLOCK = 131_072
NUMBERS = 8_000_000
CHUNK = 131_072
PIECE = 256


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, width)


@lru_cache(maxsize=4)
def planes(width: int, trees: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, trees * 64))


def strings(points: np.ndarray, trees: int) -> np.ndarray:
    """Hash strings [vector, tree] as numbers: the tree, then the bits, first bit highest."""
    found = [np.zeros((0, trees), np.uint64)]
    for at in range(0, len(points), PIECE):
        signs = points[at : at + PIECE] @ planes(points.shape[1], trees) > 0
        bits = np.packbits(signs.reshape(len(signs), trees, 64), axis=2).view(">u8")[:, :, 0]
        found.append(bits.astype(np.uint64) >> np.uint64(64 - BITS))
    return np.concatenate(found) | (np.arange(trees, dtype=np.uint64) << np.uint64(BITS))


def bit_length(x: np.ndarray) -> np.ndarray:
    for step in (1, 2, 4, 8, 16, 32):
        x = x | (x >> np.uint64(step))
    return np.bitwise_count(x).astype(np.int64)


def slices(array: np.ndarray, asked: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the entries begin and end that agree in all but the last `free` bits, in each tree."""
    rest = (np.uint64(1) << free.astype(np.uint64)[:, None]) - np.uint64(1)
    return (
        np.searchsorted(array, asked & ~rest),
        np.searchsorted(array, asked | rest, side="right"),
    )


def longest_match(array: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Descent: the bits that no tree's closest entry needs free, at least, per query."""
    at = np.searchsorted(array, asked)
    left = array[np.maximum(at - 1, 0)] ^ asked
    right = array[np.minimum(at, len(array) - 1)] ^ asked
    return np.minimum(bit_length(np.minimum(left, right)).min(axis=1), BITS)


def ascend(array: np.ndarray, asked: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
    """Synchronous ascent from the longest match until the slices of all trees hold `enough`
    entries together, or to the root."""
    free = longest_match(array, asked)
    low, high = np.zeros(asked.shape, np.int64), np.zeros(asked.shape, np.int64)
    climbing = np.arange(len(asked))
    while len(climbing):
        low[climbing], high[climbing] = slices(array, asked[climbing], free[climbing])
        held = (high[climbing] - low[climbing]).sum(axis=1)
        climbing = climbing[(held < enough) & (free[climbing] < BITS)]
        free[climbing] += 1
    return low, high


@dataclass
class Forest:
    """The vectors of a block and, of all trees in one, the sorted strings and whose they are."""

    points: np.ndarray
    keys: list[str]
    ids: np.ndarray
    longest: float
    trees: int

    def __post_init__(self):
        self.strings = strings(on_sphere(self.points, self.longest), self.trees)
        order = np.argsort(self.strings, axis=None, kind="stable")
        self.array, self.owner = self.strings.ravel()[order], order // self.trees

    def search(self, vectors: np.ndarray, k: int, share: float) -> Iterator[tuple]:
        """query, vector, score of the k best that the ascent meets."""
        entries = len(self.array)
        enough = max(self.trees * k, int(np.ceil(share * entries)))
        low, high = ascend(self.array, strings(as_query(vectors), self.trees), enough)
        for q, vector in enumerate(vectors):
            met = np.zeros(len(self.ids), bool)
            for a, b in zip(low[q].tolist(), high[q].tolist(), strict=True):
                met[self.owner[a:b]] = True
            at = np.flatnonzero(met)
            scores = self.points[at] @ vector
            for j in best(scores[None, :], self.ids[at], k)[0]:
                yield q, int(at[j]), float(scores[j])

    def needed(self, vectors: np.ndarray, k: int) -> Iterator[tuple]:
        """query, vector, score of the k best of all, and the share of entries beyond which the
        ascent has met it."""
        asked = strings(as_query(vectors), self.trees)
        for q, at in enumerate(best(vectors @ self.points.T, self.ids, k)):
            free = bit_length(self.strings[at] ^ asked[q]).min(axis=1)
            same = np.repeat(asked[q : q + 1], len(at), axis=0)
            low, high = slices(self.array, same, np.maximum(free - 1, 0))
            before = np.where(free > 0, (high - low).sum(axis=1) + 1, 0) / len(self.array)
            scores = self.points[at] @ vectors[q]
            for row in zip(at.tolist(), scores.tolist(), before.tolist(), strict=True):
                yield q, *row


def on_sphere(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Indexed vectors with one more component that makes them equally long."""
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))
    return np.column_stack([scaled, rest])


def as_query(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([vectors, np.zeros(len(vectors))])


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the columns with the k highest scores, ties to smaller ids."""
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    else:
        least = np.full(len(scores), -np.inf)
    found = []
    for row, limit in zip(scores, least, strict=True):
        at = np.flatnonzero(row >= limit)
        found.append(at[np.lexsort((ids[at], -row[at]))][:k])
    return found


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The rows that take part, as `id`, `vector` and `key` (two hashes of the vector)."""
    finite = F.forall(
        "vector",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & finite
        & F.exists("vector", lambda x: x != 0)
    )
    key = F.concat_ws(
        ":", F.hex(F.xxhash64("vector")), F.hex(F.xxhash64(F.lit(1), "vector"))
    )
    return rows.withColumn("key", key)


def top(frame: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group, with their `rank`; groups are cut before the shuffle."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return frame.withColumn("rank", place).filter(F.col("rank") <= k)


def layout(index: DataFrame, queries: DataFrame) -> DataFrame:
    """For each length of vectors: the longest one, how many blocks, how many copies of each."""
    peak = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    scaled = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x.cast("double") / peak) ** 2)
    width = F.size("vector").alias("width")
    sizes = index.groupBy(width).agg(
        F.count("*").alias("n"), F.max(peak * F.sqrt(scaled)).alias("longest")
    )
    asking = queries.groupBy(width).agg(F.count("*").alias("asking"))
    size = F.least(
        F.greatest(F.lit(float(LEAST_BLOCK)), 32 * F.sqrt("n")),
        F.lit(float(BLOCK)),
        F.greatest(F.lit(1.0), NUMBERS / F.col("width")),
    )
    return sizes.join(asking, "width").select(
        "width", "longest", F.ceil(F.col("n") / size).cast("int").alias("blocks"),
        F.ceil(F.col("asking") / CHUNK).cast("int").alias("copies"),
    )


def visits(index: DataFrame, queries: DataFrame, cells: DataFrame, trees: int,
           function: Callable[[Forest, np.ndarray], Iterator[tuple]], extra: str = "") -> DataFrame:
    """`query`, `key`, `least`, `score` (and `extra`): what `function` finds for the queries in
    each block."""
    width = F.size("vector").alias("width")
    deal = F.xxhash64("key")
    columns = ["width", "block", "copy", "asks", "key", "least", "longest", "vector"]
    indexed = index.select("*", width).join(cells, "width").select(
        "*", F.pmod(deal, F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("asks"),
    )
    asking = queries.select("*", width).join(cells, "width").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(deal, F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("asks"),
    )
    both = indexed.select(columns).union(asking.select(columns))
    arranged = both.repartition("width", "block", "copy").sortWithinPartitions(
        "width", "block", "copy", "asks"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        here, held, forest = None, [], None
        for batch in batches:
            place = np.column_stack([batch.column(c).to_numpy() for c in range(4)])
            edges = np.flatnonzero((np.diff(place, axis=0) != 0).any(axis=1)) + 1
            for start, end in itertools.pairwise([0, *edges.tolist(), len(place)]):
                part = batch.slice(start, end - start)
                if tuple(place[start, :3]) != here:
                    here, held, forest = tuple(place[start, :3]), [], None
                if not place[start, 3]:
                    held.append(part)
                    continue
                if forest is None and held:
                    rows = pa.Table.from_batches(held)
                    forest = Forest(
                        np.concatenate([matrix(p.column(7), int(here[0])) for p in held]),
                        rows.column(4).to_pylist(), rows.column(5).to_numpy(),
                        rows.column(6)[0].as_py(), trees,
                    )
                    held = []
                if forest is None:
                    continue  # a block that got no vector
                names, vectors = part.column(4).to_pylist(), matrix(part.column(7), int(here[0]))
                for at in range(0, len(vectors), PIECE):
                    yield [
                        (names[at + q], forest.keys[j], int(forest.ids[j]), *rest)
                        for q, j, *rest in function(forest, vectors[at : at + PIECE])
                    ]

    return map_rows(arranged, run, f"query string, key string, least long, score double{extra}")


def calibrated(index: DataFrame, queries: DataFrame, cells: DataFrame, trees: int, k: int,
               target: float) -> float:
    """The share of entries with which the target share of true neighbours is met."""
    # at most CALIBRATION vectors, then k of each of them
    sample = materialize(queries.orderBy(F.xxhash64("key"), "key").limit(CALIBRATION), "sample")
    found = visits(
        index, sample, cells, trees, lambda f, v: f.needed(v, k), ", needed double"
    )
    order = [F.desc("score"), F.asc("least")]
    needed = [r.needed for r in top(found, "query", order, k).select("needed").collect()]
    return float(np.quantile(needed, target, method="higher")) if needed else 0.0


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    trees: int = TREES,
    target: float = TARGET,
    share: float | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which `is_query` (over
    a column `id`) holds.  `share` is that of a block's entries at which the ascent ends."""
    rows = materialize(usable(vectors, id_col, vector_col), "vectors")
    members = materialize(
        top(rows.dropDuplicates(["key", "id"]), "key", [F.asc("id")], k + 1), "members"
    )
    index = members.filter("rank = 1").select("key", F.col("id").alias("least"), "vector")
    asked = rows.filter(is_query).select("id", "key").distinct()
    wanted = materialize(index.join(asked.select("key").distinct(), "key", "left_semi"), "queries")
    cells = materialize(layout(index, wanted), "cells")  # a row for each length
    if share is None:
        share = calibrated(index, wanted, cells, trees, k + 1, target)
    met = visits(index, wanted, cells, trees, lambda f, v: f.search(v, k + 1, share))
    nearby = top(met, "query", [F.desc("score"), F.asc("least")], k + 1).drop("rank", "least")
    held = members.select("key", F.col("id").alias("vec_id"))
    found = nearby.join(held, "key").select("query", "vec_id", "key")
    # the score anew, term by term on the vectors themselves
    left = index.select(F.col("key").alias("query"), F.col("vector").alias("a"))
    right = index.select("key", F.col("vector").alias("b"))
    product = F.aggregate(
        F.zip_with("a", "b", lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    scored = found.join(left, "query").join(right, "key").select(
        "query", "vec_id", product.alias("score")
    )
    order = [F.desc("score"), F.asc("vec_id")]
    each = materialize(top(scored, "query", order, k + 1).drop("rank"), "nearest")
    told = asked.join(each.withColumnRenamed("query", "key"), "key").filter("id <> vec_id")
    ranked = top(told.withColumnRenamed("id", "query_id"), "query_id", order, k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
