"""Near duplicates by SimHash and the generalised pigeonhole principle.

A fingerprint has 64 bits.  The bits are dealt into m parts; if two fingerprints differ in at most
`distance` bits, then for any thresholds t_1 + ... + t_m = distance - m + 1 they differ in at most
t_i bits within some part i (a part with -1 is left out).  Bits that go together across the corpus
share a part, so that the values of a part are as uneven as the data allow, and dynamic programming
gives each part the threshold for which the estimated candidates and probes cost least.  Each
distinct fingerprint is indexed under its value of each part and probes the values around it;
what meets in a bucket is verified on all 64 bits.

Equal fingerprints are one node from the start, so copies are never paired.  A bucket gives the
edges of a spanning forest of its links, not all pairs, and a probe is linked once to each set that
the forest connects.  A bucket of over `BUCKET` fingerprints is
split by the plain pigeonhole principle on its remaining bits, up to `SPLITS` times, which keeps the
result exact.  What is over `BUCKET` still is dense as a rule: its fingerprints agree in half of their
bits, nearly all are reached from the first few, and a task takes 8 bytes for each.
All statistics (bit correlations, value counts) cover all distinct fingerprints; what the driver
gets has a fixed size.

Null and empty texts have fingerprint zero and are linked like any other.  Repeated rows share a
component.  Null ids take no part in the choice of the smallest id; a component of null ids alone
has a null id.  An empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize
from dimweave.llm.components import components

DISTANCE = 4
SHINGLE = 4
SEED = 42
LAYOUTS = (5, 4, 3)
BLOCK_BITS = 11
BUCKET = 8192
SPLITS = 2
PROBE_COST = 500.0  # one shuffled row, in verified pairs
FEW = 48


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The bits set in over half of the hashes of the shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    rows = zip(*(words[i:] for i in range(shingle)), strict=False)
    hashes = [digest(b" ".join(s), SEED) for s in rows] or [digest(b" ".join(words), SEED)]
    return majority(np.array(hashes, dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    table = hashes.view(np.uint8).reshape(-1, 8)
    if len(table) < 2048:
        counts = np.unpackbits(table, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate(
            [np.bincount(table[:, b], minlength=256) @ BYTE_BITS for b in range(8)]
        )
    return int(np.packbits(2 * counts > len(table), bitorder="little").view("<u8")[0])


BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
BYTE_BITS = BYTE_BITS.astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """`id` and `fp` (a signed long) of each document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
            yield list(zip(batch.column(0).to_pylist(), signed, strict=True))

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_rows(named, run, f"id {kind}, fp long")


def bits_of(prints: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones per fingerprint."""
    return np.unpackbits(
        prints.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )


def correlations(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many distinct fingerprints there are, and how their bits go together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        count, both = 0, np.zeros((64, 64))
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy()).astype(np.float32)
            both += bits.T @ bits
            count += len(bits)
        yield [(-1, float(count)), *enumerate(both.ravel().tolist())]

    # 4097 rows, whatever the input
    sums = map_rows(distinct.select("fp"), run, "cell int, n double").groupBy("cell")
    cells = dict(sums.agg(F.sum("n").alias("n")).collect())
    count = int(cells.pop(-1, 0))
    both = np.array([cells.get(i, 0.0) for i in range(4096)]).reshape(64, 64) / max(count, 1)
    share = np.diag(both)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    return count, np.abs((both - np.outer(share, share)) / np.outer(spread, spread))


def deal(together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits into parts of even width; each part starts with the most entangled bit left and takes
    the bits that go with it most."""
    left, dealt = set(range(64)), []
    for k in range(parts):
        width = 64 // parts + (k < 64 % parts)
        order = sorted(left)
        first = max(order, key=lambda b: together[b, order].sum())
        part = [first]
        left.discard(first)
        while len(part) < width:
            nearest = max(sorted(left), key=lambda b: together[b, part].sum())
            part.append(nearest)
            left.discard(nearest)
        dealt.append(sorted(part))
    return dealt


def value_counts(distinct: DataFrame, blocks: list[list[int]]) -> list[np.ndarray]:
    """How many fingerprints have each value of each block of at most BLOCK_BITS bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        counts = [np.zeros(1 << len(b), dtype=np.int64) for b in blocks]
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy()).astype(np.int64)
            for count, block in zip(counts, blocks, strict=True):
                values = bits[:, block] @ (1 << np.arange(len(block)))
                count += np.bincount(values, minlength=len(count))
        yield [
            (i, int(v), int(count[v])) for i, count in enumerate(counts)
            for v in np.flatnonzero(count)
        ]

    # at most 2 ** BLOCK_BITS rows for each block
    table = map_rows(distinct.select("fp"), run, "block int, value int, n long")
    found = [np.zeros(1 << len(b)) for b in blocks]
    for block, value, n in table.groupBy("block", "value").agg(F.sum("n")).collect():
        found[block][value] = n
    return found


def distance_shares(counts: np.ndarray, most: int) -> np.ndarray:
    """The share of pairs that differ in 0, 1, ... `most` bits of a block."""
    width = len(counts).bit_length() - 1
    at = np.arange(len(counts))
    sums = [
        sum(
            (counts @ counts[at ^ sum(1 << b for b in flips)])
            for flips in itertools.combinations(range(width), d)
        )
        for d in range(most + 1)
    ]
    return np.array(sums, dtype=float) / max(counts.sum() ** 2, 1)


def ball(width: int, radius: int) -> int:
    total, layer = 0, 1
    for d in range(radius + 1):
        total += layer
        layer = layer * (width - d) // (d + 1)
    return total


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds with the given total for which the summed costs are least."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for t, c in cost.items():
                now = (spent + c, [*chosen, t])
                if used + t not in step or now[0] < step[used + t][0]:
                    step[used + t] = now
        best = step
    return best[total]


def plan(distinct: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """The parts to index and their thresholds, over all layouts the cheapest."""
    count, together = correlations(distinct)
    layouts = [deal(together, m) for m in LAYOUTS if m <= distance + 1]
    blocks: list[list[int]] = []
    places = []
    for layout in layouts:
        for part in layout:
            pieces = -(-len(part) // BLOCK_BITS)
            cuts = [part[k::pieces] for k in range(pieces)]
            places.append(range(len(blocks), len(blocks) + pieces))
            blocks += cuts
    shares = [distance_shares(c, distance) for c in value_counts(distinct, blocks)]
    found, place = [], iter(places)
    for layout in layouts:
        costs = []
        for part in layout:
            share = np.ones(1)
            for b in next(place):  # blocks of one part are taken as independent
                share = np.convolve(share, shares[b])
            below = np.cumsum(share[: distance + 1])
            costs.append(
                {-1: 0.0}
                | {
                    t: float(count) ** 2 * below[t]
                    + PROBE_COST * count * (ball(len(part), t) + (t > 0))
                    for t in range(distance + 1)
                }
            )
        cost, thresholds = allocate(costs, distance - len(layout) + 1)
        found.append((cost, [(p, t) for p, t in zip(layout, thresholds, strict=True) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def postings(distinct: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """`part`, `value`, `fp`, `probe`: each fingerprint under its own values, and as a probe
    under the values around them."""
    rows = []
    for k, (bits, threshold) in enumerate(parts):
        own = F.col("fp").bitwiseAND(F.lit(signed(mask_of(bits))))
        flips = [
            signed(mask_of(c))
            for d in range(1, threshold + 1)
            for c in itertools.combinations(bits, d)
        ]
        rows.append(F.array(_posting(k, own, False)))
        if flips:
            around = F.array(*(F.lit(f).cast("long") for f in flips))
            rows.append(_around(k, own, around))
    return distinct.select("fp", F.explode(F.concat(*rows)).alias("p")).select("p.*", "fp")


def _around(part: int, own: Column, flips: Column) -> Column:
    return F.transform(flips, lambda f: _posting(part, own.bitwiseXOR(f), True))


def _posting(part: int, value: Column, probe: bool) -> Column:
    return F.struct(
        F.lit(part).alias("part"), value.cast("long").alias("value"), F.lit(probe).alias("probe")
    )


def divide(rows: DataFrame, parts: list[tuple[list[int], int]], distance: int, bucket: int):
    """Split buckets of over `bucket` rows on their remaining bits, `SPLITS` times at most."""
    masks = {str(k): mask_of(bits) for k, (bits, _) in enumerate(parts)}
    rows = rows.withColumn("part", F.col("part").cast("string"))
    done, level, splits = None, rows, 0
    while True:
        level = materialize(level, "postings")
        hot = level.groupBy("part", "value").count().filter(F.col("count") > bucket)
        hot = materialize(hot.drop("count"), "hot")
        splittable = {p for (p,) in hot.select("part").distinct().collect()}
        if splits == SPLITS:
            splittable = set()
        splits += 1
        cool = level.join(hot.filter(F.col("part").isin(*splittable)), ["part", "value"], "left_anti")
        done = (level if not splittable else cool) if done is None else done.union(cool)
        if not splittable:
            return done
        split = None
        warm = level.join(hot.filter(F.col("part").isin(*splittable)), ["part", "value"])
        for part in sorted(splittable):
            rest = [b for b in range(64) if not masks[part] >> b & 1]
            for j in range(distance + 1):
                name, bits = f"{part}.{j}", rest[j :: distance + 1]
                masks[name] = masks[part] | mask_of(bits)
                own = F.col("fp").bitwiseAND(F.lit(signed(mask_of(bits))))
                piece = warm.filter(F.col("part") == part).select(
                    F.lit(name).alias("part"),
                    F.col("value").bitwiseOR(own).alias("value"),
                    "probe",
                    "fp",
                )
                split = piece if split is None else split.union(piece)
        level = split


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits differ; of unsigned numbers, as numpy counts the bits of absolute values."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def links(prints: np.ndarray, probe: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that connect what is linked in a bucket: a forest of the indexed fingerprints, and
    from each probe one edge to each set of them that is not connected yet.

    Probes link to indexed fingerprints only; pairs of probes meet elsewhere, if at all."""
    own, others = prints[~probe], prints[probe]
    edges: list[tuple[int, int]] = []
    sets = np.full(len(own), -1)  # the number of the connected set
    if len(own) <= FEW and (differing(own[:, None], own[None, :]) <= distance).sum() == len(own):
        sets = np.arange(len(own))  # no links, as in most small buckets
    while (sets < 0).any():
        first = int(np.argmin(sets >= 0))
        sets[first] = first
        todo = [first]
        waiting = np.flatnonzero(sets < 0)
        while todo and len(waiting):
            node = todo.pop()
            near = differing(own[waiting], own[node]) <= distance
            reached = waiting[near]
            sets[reached] = first
            edges += ((int(own[node]), x) for x in own[reached].tolist())
            todo.extend(reached.tolist())
            waiting = waiting[~near]
    if len(others) and len(own):
        step = max(1, 1_000_000 // len(own))
        for at in range(0, len(others), step):
            near = differing(others[at : at + step, None], own[None, :]) <= distance
            a, b = np.nonzero(near)
            pairs = np.column_stack([a, sets[b]])
            _, once = np.unique(pairs, axis=0, return_index=True)
            a, b = a[once], b[once]
            edges += zip(others[at + a].tolist(), own[b].tolist(), strict=True)
            for here in np.unique(a[1:][a[1:] == a[:-1]]):  # a probe that joins several sets
                joined = np.unique(sets[b[a == here]])
                sets[np.isin(sets, joined)] = joined[0]
    return edges


def verify(rows: DataFrame, distance: int) -> DataFrame:
    """The edges (u, v) found in each bucket."""
    arranged = rows.repartition("part", "value").sortWithinPartitions("part", "value", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        key, held = None, []
        for batch in batches:
            part = batch.column(0).dictionary_encode()
            values = batch.column(1).to_numpy()
            codes = part.indices.to_numpy()
            prints = batch.column(3).to_numpy()
            probe = batch.column(2).to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(codes) != 0) | (np.diff(values) != 0)) + 1
            edges = []
            for start, end in itertools.pairwise([0, *change.tolist(), len(values)]):
                here = (part.dictionary[codes[start]].as_py(), values[start])
                if here != key:
                    edges += _bucket(held, distance)
                    key, held = here, []
                held.append((prints[start:end], probe[start:end]))
            yield edges
        yield _bucket(held, distance)

    found = map_rows(arranged.select("part", "value", "probe", "fp"), run, "u long, v long")
    return found.distinct()


def _bucket(held: list[tuple[np.ndarray, np.ndarray]], distance: int) -> list[tuple[int, int]]:
    if sum(len(p) for p, _ in held) < 2:
        return []
    prints, probe = (np.concatenate(x) for x in zip(*held, strict=True))
    return links(prints, probe, distance)


def search(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints `fp` within `distance` bits."""
    parts = plan(distinct, distance)
    return verify(divide(postings(distinct, parts), parts, distance, bucket), distance)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    distance: int = DISTANCE,
    shingle: int = SHINGLE,
    bucket: int = BUCKET,
) -> DataFrame:
    """`id`, `fp` and `component_id` (the smallest id reachable over links) of each document."""
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    edges = search(distinct, distance, bucket)
    roots = components(edges).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "components")
    return marked.join(named, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options):
    """The documents with one of each component: the one with the smallest id, or the first of
    equal ones.  All columns stay as they are."""
    names = docs.columns
    rows = docs.withColumn("__row", F.monotonically_increasing_id())
    rows = materialize(rows, "rows")
    keyed = rows.select(
        F.struct(F.col(id_col).alias("id"), F.col("__row").alias("row")).alias("key"),
        F.col(text_col).alias("text"),
    )
    found = near_duplicates(keyed, "key", "text", **options)
    gone = found.filter(F.col("id.row") != F.col("component_id.row")).select(
        F.col("id.row").alias("__row")
    )
    return rows.join(gone, "__row", "left_anti").select(*names)
