"""Near copies by the Jaccard similarity of their word shingles, found by SimHash and min-hashes.

Two documents are linked if the sets of their five-word shingles have a similarity of `LEAST` (4/5)
or more.  Candidates come from two searches, and all are verified on the sets themselves:

1. The generalised pigeonhole search of `simhash` on fingerprints of the five-word shingles, at its
   production distance.  It meets copies with small edits, however many there are.
2. Min-hashes, for what lies beyond: a pair of a similarity of exactly 0.8 differs in some 10 of 64
   bits, at which a pigeonhole search would have to probe a constant share of all pairs.  `BANDS` keys
   of `ROWS` min-hashes each; a pair at 0.8 meets with a chance of 0.999997, a closer one sooner.

Documents with equal sets are one node from the start, and buckets with the same members count once.
No bucket is held by one task and no step emits its pairs: buckets whose members the links so far
connect are done; in the others each member is compared with one leader, whose members are dealt
to several tasks, `ROUNDS` times; of what is not connected then, members of large buckets go that by an exact bound
cannot be linked to others, and those outside the largest group of a bucket are compared with all, in
blocks, by tasks that give forest edges only.  So every pair that met has been linked, ruled out or lies in one group.

Letters are lower-cased in ASCII and words end at ASCII white space, as in `simhash`.  A text of
fewer words is one shingle; null and empty texts have none and are copies of each other.  Texts of any
length are taken whole; a task holds the sets of a block.  Repeated rows are copies.  Null ids
count as the smallest.  An empty table gives no rows.  Only the named columns are read; all are
passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize, remove
from dimweave.llm.hyperminhash import exact_links, labelled, narrowed, rooted, units, verified
from dimweave.llm.simhash import DISTANCE, majority, search

SHINGLE = 5
LEAST = (4, 5)
BANDS, ROWS = 24, 4
PIECE = 1 << 14
ROUNDS = 2
CHUNK = 128
FLUSH_BYTES = 8_000_000
MIX = np.random.default_rng(42).integers(1, 2**63, (BANDS * ROWS, 2), dtype=np.uint64)
MIX[:, 0] |= np.uint64(1)


def hashes_of(text: str | None) -> np.ndarray:
    """The hashes of the shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    rows = zip(*(words[i:] for i in range(SHINGLE)), strict=False)
    hashes = [digest(b" ".join(s)) for s in rows] or [digest(b" ".join(words))]
    return np.array(hashes, dtype=np.uint64)


def band_keys(found: np.ndarray) -> list[int]:
    """One signed key a band, of the min-hashes of its rows."""
    least = np.full(len(MIX), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), PIECE):
        piece = found[at : at + PIECE]
        for k, (times, plus) in enumerate(MIX):
            mixed = piece * times + plus
            least[k] = min(least[k], (mixed ^ (mixed >> np.uint64(32))).min())
    rows = least.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def signatures(named: DataFrame) -> DataFrame:
    """`__row`, `node` (digest of the set), `fp` (SimHash) and `keys` (bands) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            out = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = hashes_of(text.as_py())
                found = np.unique(hashes)
                fp = int(np.uint64(majority(hashes) if len(hashes) else 0).astype(np.int64))
                out.append((row, xxhash.xxh3_128_digest(found.tobytes()), fp, band_keys(found)))
            yield out

    return map_rows(named, run, "__row long, node binary, fp long, keys array<long>")


def simhash_pairs(nodes: DataFrame, distance: int) -> DataFrame:
    """(u, v): nodes to compare, as their fingerprints are equal or connected by the search."""
    prints = materialize(nodes.groupBy("fp").agg(F.min("node").alias("node")), "prints")
    near = search(prints.select("fp"), distance)
    for name in ("u", "v"):
        end = prints.select(F.col("fp").alias(name), F.col("node").alias(f"{name}_node"))
        near = near.join(end, name)
    same = nodes.join(prints.withColumnRenamed("node", "first"), "fp").filter("node <> first")
    both = near.select(F.col("u_node").alias("u"), F.col("v_node").alias("v")).union(
        same.select("first", "node")
    )
    return materialize(both, "pairs")


def buckets(nodes: DataFrame) -> DataFrame:
    """`key`, `node` of the members of each bucket of two or more."""
    met = nodes.select("node", F.explode("keys").alias("key"))
    mark = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    several = met.groupBy("key").agg(F.count("*").alias("n"), mark.alias("members"))
    once = several.filter("n > 1").groupBy("n", "members").agg(F.min("key").alias("key"))
    return materialize(met.join(once.select("key"), "key"), "buckets")


def sets_of(texts: DataFrame) -> DataFrame:
    """`node` and `found` (the bytes of the set) of rows of `node` and `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        out, held = [], 0
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = np.unique(hashes_of(text.as_py())).tobytes()
                out.append((node, found))
                held += len(found)
                if held >= FLUSH_BYTES:
                    yield out
                    out, held = [], 0
        yield out

    return materialize(map_rows(texts.select("node", "text"), run, "node binary, found binary"), "sets")


def leader_pairs(mixed: DataFrame, turn: int) -> DataFrame:
    """(u, v): the leader of each bucket, another one each turn, and members of other groups."""
    order = F.xxhash64("node", F.lit(turn))
    first = mixed.groupBy("key").agg(F.min(F.struct(order.alias("at"), "node", "label")).alias("first"))
    met = mixed.join(first, "key").filter(F.col("label") != F.col("first.label"))
    return met.select(F.col("first.node").alias("u"), F.col("node").alias("v")).distinct()


def blocks(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of one bucket whose labels differ, block against block."""
    return exact_links(units(mixed, CHUNK), sets, LEAST)


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, distance: int = DISTANCE
) -> DataFrame:
    """The documents with one of each group of near copies: the one with the smallest id, or the
    first of equal ones.  All columns stay as they are."""
    names = docs.columns
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    named = rows.select("__row", F.col(text_col).alias("text"))
    marked = materialize(signatures(named), "signatures")
    keyed = rows.select("__row", F.struct(F.col(id_col).alias("id"), F.col("__row").alias("row")).alias("key"))
    nodes = marked.select("__row", "node").join(keyed, "__row").groupBy("node").agg(F.min("key").alias("key"))
    one = nodes.select("node", "key", F.col("key.row").alias("__row"))
    nodes = materialize(one.join(marked.drop("node"), "__row"), "nodes")

    pairs, members = simhash_pairs(nodes, distance), buckets(nodes)
    live = pairs.select("u").union(pairs.select("v")).union(members.select("node")).distinct()
    wanted = live.select(F.col("u").alias("node")).join(nodes.select("node", "__row"), "node")
    sets = sets_of(wanted.join(named, "__row"))

    edges = materialize(verified(pairs, sets, LEAST), "links")
    for turn in range(ROUNDS):
        mixed = materialize(labelled(members, rooted(edges)), "mixed")
        edges = edges.union(materialize(verified(leader_pairs(mixed, turn), sets, LEAST), "links"))
    mixed = materialize(labelled(members, rooted(edges)), "mixed")
    mixed = narrowed(mixed, sets, LEAST, CHUNK)
    edges = edges.union(materialize(blocks(mixed, sets), "links"))
    remove(sets)
    remove(marked)

    groups = nodes.select("node", "key").join(rooted(edges), "node", "left")
    groups = groups.withColumn("root", F.coalesce("root", "node"))
    least = groups.groupBy("root").agg(F.min("key").alias("least"))
    kept = least.select(F.col("least.row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*names)
