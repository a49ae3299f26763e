"""Near duplicates by HyperMinHash sketches, banded and then verified on full shingle sets.

A sketch has `REGISTERS` registers.  The hash of a shingle picks a register with its first bits; of
the hashes in a register the smallest one stays, as its count of leading zeros and `MANTISSA` bits
after them, so a register takes two bytes.  `BANDS` bands of `ROWS` registers give the keys under
which sets meet; an empty register lends its value from the first filled one in an order of its own,
which keeps the chance of agreement at the Jaccard similarity for small sets, too.  At a similarity of
0.85 two sets meet with a chance of 0.9999996.

What meets is judged by the sketches first: the share of equal registers, less the share by which
compressed registers of unrelated sets of these sizes collide, estimates the similarity, and only
pairs less than `SIGMAS` standard deviations below the limit go on.  Links are confirmed on the sets
of 64-bit shingle hashes themselves.

No step emits the pairs of a group.  Documents with equal sets are one node from the start, and
buckets with the same members count once.  A bucket is dealt out in chunks; in a chunk, members are
assigned to few leaders, the ones with most estimated neighbours, and only (leader, member) is
verified, with the leader's members dealt out as well.  The next round does the same with one member
of each component so far.  Of buckets of over a chunk that still hold several components, members
go of whose shingles so many are held by their own component alone that no set in the bucket can be
linked to them.  What still holds members of different components with an estimated link is compared in blocks, those outside the
largest component of the bucket against all, on the sets, by tasks that give forest edges only; so
every pair that met has been linked, ruled out, or lies within one component.

Letters are lower-cased in ASCII and words end at ASCII white space.  A text of fewer words than a
shingle is one shingle; null, empty and blank texts have none and link with nothing.  Sets of fewer
than six shingles can only link to equal ones.  Texts of any length are taken whole; a task holds the
sets of a block.  Repeated rows share a component.  Null ids take no part in the choice of the smallest
id; a component of null ids alone has a null id and keeps all.  An empty table gives no rows.  Only the
named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize, remove
from dimweave.llm.components import components

SHINGLE = 3
LEAST = (85, 100)
BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
MANTISSA = 10
BANDS, ROWS = 25, 5
SIGMAS = 5.0
ROUNDS = 2
CHUNK = 256
SHARD = 256
OCTAVES = 53
FLUSH_BYTES = 8_000_000
HELD, MINOR, PROBE, BOTH = range(4)

_CHANCE = np.random.default_rng(12)
TIMES = _CHANCE.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# for each register the order in which others are asked for a value
LENDERS = np.array([[r, *(x for x in _CHANCE.permutation(REGISTERS) if x != r)] for r in range(REGISTERS)])


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the shingles."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = max(len(own) - size + 1, 1)
    mixed = np.zeros(count, np.uint64)
    for k in range(min(size, len(own))):
        mixed += own[k : k + count] * TIMES[k]
    mixed ^= mixed >> np.uint64(33)
    mixed *= TIMES[-1]
    mixed ^= mixed >> np.uint64(29)
    mixed *= TIMES[-2]
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def sketch(found: np.ndarray) -> np.ndarray:
    """The registers of a set of sorted hashes: zeros + 1 above the mantissa, 0 where empty."""
    place = (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))  # the smallest hash of each register
    rest = (found[first] << np.uint64(BUCKET_BITS)) >> np.uint64(64 - OCTAVES)
    part, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.where(rest > 0, OCTAVES - exponent, OCTAVES)
    bits = np.where(rest > 0, (2 * part - 1) * (1 << MANTISSA), 0).astype(np.int64)
    out = np.zeros(REGISTERS, np.uint16)
    out[place[first]] = (zeros + 1 << MANTISSA) + bits
    return out


def band_keys(registers: np.ndarray) -> list[int]:
    """One signed key for each band, empty registers filled by their lenders."""
    lender = LENDERS[np.arange(REGISTERS), (registers[LENDERS] > 0).argmax(axis=1)]
    filled = (lender.astype(np.uint32) << np.uint32(16)) | registers[lender]
    rows = filled[: BANDS * ROWS].reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def smallest(least: tuple[int, int]) -> int:
    """How many shingles a set must have to link with a different one."""
    num, den = least
    return -(-num // (den - num)) if num < den else 1 << 62


def _collisions() -> np.ndarray:
    """The chance that filled registers of unrelated sets are equal, by quarters of octaves of
    the two sets' sizes.

    Within an octave of hash values a cell is as wide as the octave over 2**MANTISSA; the chance that
    both minima fall into one cell is the width times the integral of the product of densities."""
    mean = 2.0 ** (np.arange(160) / 4) / REGISTERS
    a, b = mean[:, None], mean[None, :]
    low = 2.0 ** -(np.arange(OCTAVES) + 1.0)
    out = np.zeros((160, 160))
    for x in low:
        out += x / (1 << MANTISSA) * a * b / (a + b) * (np.exp(-(a + b) * x) - np.exp(-(a + b) * 2 * x))
    return out / ((1 - np.exp(-a)) * (1 - np.exp(-b)))


COLLISIONS = _collisions()


def estimated(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, least) -> np.ndarray:
    """Which of the sets of sketches `a` and `b`, of sizes `n` and `m`, may be linked."""
    num, den = least
    filled, others = (a > 0).astype(np.float32), (b > 0).astype(np.float32)
    union = filled.sum(1)[:, None] + others.sum(1)[None, :] - filled @ others.T
    equal = np.zeros((len(a), len(b)), np.int16)
    for k in range(REGISTERS):
        equal += (a[:, k, None] == b[None, :, k]) & (a[:, k, None] > 0)
    size, other = (np.rint(4 * np.log2(x)).astype(int) for x in (n, m))
    chance = COLLISIONS[size[:, None], other[None, :]]
    jaccard = (equal / union - chance) / (1 - chance)
    limit = num / den
    near = jaccard >= limit - SIGMAS * np.sqrt(limit * (1 - limit) / union)
    sizes = num * np.maximum(n[:, None], m[None, :]) <= den * np.minimum(n[:, None], m[None, :])
    return near & sizes


def linked(a: np.ndarray, b: np.ndarray, least: tuple[int, int]) -> bool:
    num, den = least
    if num * max(len(a), len(b)) > den * min(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[place] == small).sum())
    return den * both >= num * (len(a) + len(b) - both)


def stars(near: np.ndarray) -> list[tuple[int, int]]:
    """(leader, member): members are covered by the leaders that have most uncovered neighbours."""
    waiting = near.any(axis=1)
    pairs: list[tuple[int, int]] = []
    while waiting.any():
        counts = near[:, waiting].sum(axis=1)
        leader = int(counts.argmax())
        if not counts[leader]:
            break
        new = np.flatnonzero(near[leader] & waiting)
        pairs += [(leader, int(x)) for x in new]
        waiting[new] = False
        waiting[leader] = False
    return pairs


def group_rows(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """The groups of sorted rows with equal first columns: the key and the other columns."""
    now, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for key, rows in itertools.groupby(zip(*columns, strict=True), lambda r: r[:keys]):
            if key != now:
                if held:
                    yield now, list(zip(*held, strict=True))
                now, held = key, []
            held += [r[keys:] for r in rows]
    if held:
        yield now, list(zip(*held, strict=True))


def in_groups(rows: DataFrame, keys: list[str], function: Callable, schema: str) -> DataFrame:
    """`function(key, *columns)` over the groups of `rows`, whose sizes the caller has bounded."""
    arranged = rows.repartition(*keys).sortWithinPartitions(*keys, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        out = []
        for key, columns in group_rows(batches, len(keys)):
            out += function(key, *columns)
            if len(out) >= 10_000:
                yield out
                out = []
        yield out

    names = [c for c in rows.columns if c not in (*keys, "node")]
    return map_rows(arranged.select(*keys, "node", *names), run, schema)


def matrix(registers: tuple[bytes, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(registers), np.uint16).reshape(len(registers), REGISTERS)


def marks(docs: DataFrame, id_col: str, text_col: str, size: int, least) -> DataFrame:
    """`id`, `n` (shingles), `node` (digest of the set), `registers` (where a link is possible)."""
    kind = docs.schema[id_col].dataType.simpleString()
    enough = smallest(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = shingles(text.as_py(), size)
                n = len(found)
                node = xxhash.xxh3_128_digest(found.tobytes()) if n else None
                out.append((doc, n, node, sketch(found).tobytes() if n >= enough else None))
            yield out

    return map_rows(named(docs, id_col, text_col), run, f"id {kind}, n long, node binary, registers binary")


def named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))


def buckets(nodes: DataFrame) -> DataFrame:
    """`key`, `node`, `n`, `registers` of the members of each bucket of two or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            yield [
                (key, node) for node, r in rows for key in band_keys(np.frombuffer(r, np.uint16))
            ]

    sketched = nodes.filter("registers IS NOT NULL").select("node", "registers", "n")
    met = materialize(map_rows(sketched.select("node", "registers"), run, "key long, node binary"), "bands")
    mark = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    several = met.groupBy("key").agg(F.count("*").alias("size"), mark.alias("members"))
    once = several.filter("size > 1").groupBy("size", "members").agg(F.min("key").alias("key"))
    live = met.join(once.select("key"), "key")
    found = materialize(live.join(sketched, "node").select("key", "node", "n", "registers"), "buckets")
    remove(met)
    return found


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """`node`, `found` (the bytes of the set) of wanted nodes (`node`, `least`), read from the text
    of their document with the smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        out, held = [], 0
        for batch in batches:
            for text in batch.column(0):
                found = shingles(text.as_py(), size).tobytes()
                out.append((xxhash.xxh3_128_digest(found), found))
                held += len(found)
                if held >= FLUSH_BYTES:
                    yield out
                    out, held = [], 0
        yield out

    ids = wanted.select(F.col("least").alias("__least")).distinct()
    texts = named(docs, id_col, text_col).join(ids, F.col("id").eqNullSafe(F.col("__least")), "left_semi")
    found = map_rows(texts.select("text"), run, "node binary, found binary")
    own = found.join(wanted.select("node"), "node", "left_semi")
    return materialize(own.dropDuplicates(["node"]), "sets")


def dealt(members: DataFrame, most: int) -> DataFrame:
    """Members with the number of chunks of their bucket and their own."""
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    return members.join(sizes, "key").withColumn("chunk", own)


def leaders(members: DataFrame, least) -> DataFrame:
    """`u` (a leader), `v`: at most one pair for each member of a chunk."""

    def choose(key, nodes, n, registers):
        if len(nodes) < 2:
            return []
        own, sizes = matrix(registers), np.array(n)
        near = estimated(own, own, sizes, sizes, least)
        np.fill_diagonal(near, False)
        return [(nodes[a], nodes[b]) for a, b in stars(near)]

    rows = dealt(members, CHUNK).select("key", "chunk", "node", "n", "registers")
    found = in_groups(rows, ["key", "chunk"], choose, "u binary, v binary")
    return found.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "u", "v").groupBy(
        "a", "b").agg(F.min("u").alias("u"), F.max("v").alias("v")).select(
        F.col("u"), F.when(F.col("u") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("v"))


def verified(pairs: DataFrame, sets: DataFrame, least) -> DataFrame:
    """The pairs that are linked; a leader's members are dealt to tasks of `SHARD`."""
    sizes = pairs.groupBy("u").agg(F.ceil(F.count("*") / F.lit(SHARD)).cast("int").alias("shards"))
    share = F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")
    placed = materialize(pairs.join(sizes, "u").select("u", share.alias("shard"), "v"), "pairs")
    first = placed.select("u", "shard").distinct().join(sets.withColumnRenamed("node", "u"), "u")
    first = first.select("u", "shard", F.lit(None).cast("binary").alias("v"), "found")
    second = placed.join(sets.withColumnRenamed("node", "v"), "v").select("u", "shard", "v", "found")
    both = first.unionByName(second).repartition("u", "shard")
    arranged = both.sortWithinPartitions("u", "shard", F.asc_nulls_first("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        own = None
        for batch in batches:
            out = []
            nodes, others = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for u, v, found in zip(nodes, others, batch.column(3), strict=True):
                held = np.frombuffer(found.as_py(), np.uint64)
                if v is None:
                    own = held
                elif linked(own, held, least):
                    out.append((u, v))
            yield out

    return map_rows(arranged, run, "u binary, v binary")


def labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets with several components, with their `label`."""
    named = members.join(roots.withColumnRenamed("root", "label"), "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    return named.join(mixed.filter("a <> b").select("key"), "key", "left_semi")


def rooted(edges: DataFrame) -> DataFrame:
    return components(edges).select(F.col("u").alias("node"), F.col("v").alias("root"))


def held_shingles(named: DataFrame) -> DataFrame:
    """`shingle`, `node`, `low` and `high` (labels of holders) from `node`, `label` (long) and `found`.

    Shingles that a task has met under several labels come once, without a node; others once for
    each node."""

    def rows(nodes: list, labels: list, founds: list) -> list[tuple]:
        sizes = [len(f) for f in founds]
        owner = np.repeat(np.arange(len(nodes)), sizes)
        tokens = np.concatenate(founds).view(np.int64)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        held = np.array(labels, np.int64)[owner]
        low, high = np.minimum.reduceat(held, start), np.maximum.reduceat(held, start)
        several = low != high
        out = [
            (t, None, a, b) for t, a, b in zip(
                tokens[start][several].tolist(), low[several].tolist(), high[several].tolist(), strict=True
            )
        ]
        single = ~np.repeat(several, np.diff(np.append(start, len(tokens))))
        out += (
            (t, nodes[o], x, x) for t, o, x in zip(
                tokens[single].tolist(), owner[single].tolist(), held[single].tolist(), strict=True
            )
        )
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        nodes, labels, founds = [], [], []
        for batch in batches:
            for node, label, found in zip(*(c for c in batch.columns), strict=True):
                nodes.append(node.as_py())
                labels.append(label.as_py())
                founds.append(np.frombuffer(found.as_py(), np.uint64))
                if sum(map(len, founds)) * 8 >= FLUSH_BYTES:
                    yield rows(nodes, labels, founds)
                    nodes, labels, founds = [], [], []
        if nodes:
            yield rows(nodes, labels, founds)

    return map_rows(
        named.select("node", "label", "found"), run, "shingle long, node binary, low long, high long"
    )


def open_members(crowd: DataFrame, sets: DataFrame, least) -> DataFrame:
    """`key`, `node`, `own` of members that may be linked to another component.

    `own` counts the shingles of a node that no member of another component has, in all of `crowd`
    (`key`, `node`, `label`); two sets share at most the others, and a set in the bucket has at least
    as many shingles as its smallest one."""
    num, den = least
    nodes = crowd.select("node", F.xxhash64("label").alias("label")).distinct()
    found = nodes.join(sets, "node")
    held = materialize(held_shingles(found), "held")
    alone = held.groupBy("shingle").agg(F.min("low").alias("a"), F.max("high").alias("b")).filter("a = b")
    own = held.filter("node IS NOT NULL").join(alone.select("shingle"), "shingle").groupBy("node").agg(
        F.count("*").alias("own"))
    sizes = found.select("node", F.expr("octet_length(found) div 8").alias("n"))
    named = crowd.join(sizes.join(own, "node", "left"), "node").fillna(0, ["own"])
    named = materialize(named, "bounds")
    smallest = named.groupBy("key").agg(F.min("n").alias("fewest"))
    may = F.lit(num) * (F.col("n") + F.col("fewest")) <= F.lit(num + den) * (F.col("n") - F.col("own"))
    left = named.join(smallest, "key").filter(may).select("key", "node", "own")
    left = materialize(left, "open")
    remove(held)
    return left


def narrowed(mixed: DataFrame, sets: DataFrame, least, most: int) -> DataFrame:
    """`mixed` without the members of buckets of over `most` that cannot be linked to another
    component; each step emits at most a row for a member or a shingle."""
    large = mixed.groupBy("key").count().filter(F.col("count") > most).select("key")
    crowd = mixed.select("key", "node", "label").join(large, "key", "left_semi")
    crowd = materialize(crowd, "crowd")
    if crowd.isEmpty():
        return mixed
    left = open_members(crowd, sets, least)
    gone = crowd.select("key", "node").join(left.select("key", "node"), ["key", "node"], "left_anti")
    return materialize(mixed.join(gone, ["key", "node"], "left_anti"), "mixed")


def units(mixed: DataFrame, most: int) -> DataFrame:
    """Members dealt to units (`key`, `i`, `j`) in which each one outside the largest component of its
    bucket meets every other one: members as `HELD` (`MINOR`, if outside) of chunk i, and the outside
    ones as `PROBE` of chunk j.  In a bucket of one chunk they are `BOTH`."""
    columns = mixed.columns
    parts = mixed.groupBy("key", "label").agg(F.count("*").alias("count"))
    chunks = parts.groupBy("key").agg(
        F.max(F.struct("count", "label")).alias("main"), F.sum("count").alias("all")
    ).select(
        "key", F.col("main.label").alias("main"), F.ceil(F.col("all") / F.lit(most)).cast("int").alias("c"),
        F.ceil((F.col("all") - F.col("main.count")) / F.lit(most)).cast("int").alias("d"),
    ).filter("d > 0")
    placed = mixed.join(chunks, "key").withColumn("outside", F.col("label") != F.col("main"))
    own, first = F.xxhash64("node"), F.lit(0)
    role = F.when(~F.col("outside"), HELD).when(F.col("c") == 1, BOTH).otherwise(MINOR)
    held = placed.withColumns({"i": F.pmod(own, F.col("c")).cast("int"), "role": role})
    held = held.withColumn("j", F.explode(F.sequence(first, F.col("d") - 1)))
    probe = placed.filter("outside AND c > 1").withColumns(
        {"j": F.pmod(own, F.col("d")).cast("int"), "role": F.lit(PROBE)})
    probe = probe.withColumn("i", F.explode(F.sequence(first, F.col("c") - 1)))
    names = ["key", "i", "j", "role", *(c for c in columns if c != "key")]
    return held.select(names).unionByName(probe.select(names))


def meetings(roles: tuple[int, ...], labels: tuple[bytes, ...]):
    """Of a unit sorted by node: the rows of probes, those of held members, and who meets whom."""
    role = np.array(roles)
    number = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    group = np.array([number[x] for x in labels])
    probe, held = np.flatnonzero(role >= PROBE), np.flatnonzero(role != PROBE)
    once = (role[held] == HELD)[None, :] | (probe[:, None] < held[None, :])
    return probe, held, once & (group[probe][:, None] != group[held][None, :])


def exact_links(rows: DataFrame, sets: DataFrame, least) -> DataFrame:
    """Forest edges (u, v) of the links in units of `node`, `role` and `label`, on the sets."""
    num, den = least
    names = ["key", "i", "j", "node", "role", "label", "found"]

    def compare(key, nodes, roles, labels, founds):
        probe, held, meet = meetings(roles, labels)
        if not meet.any():
            return []
        found = [np.frombuffer(f, np.uint64) for f in founds]
        sizes = np.array([len(f) for f in found])
        tokens = np.concatenate([found[x] for x in held])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], np.repeat(np.arange(len(held)), sizes[held])[order]
        root = {x: x for x in labels}

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        edges = []
        for at, x in enumerate(probe):
            low = np.searchsorted(tokens, found[x], "left")
            many = np.searchsorted(tokens, found[x], "right") - low
            place = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            both = np.bincount(owner[place], minlength=len(held))
            near = den * both >= num * (sizes[x] + sizes[held] - both)
            for y in held[near & meet[at]]:
                if top(labels[x]) != top(labels[y]):
                    root[top(labels[x])] = top(labels[y])
                    edges.append((nodes[x], nodes[y]))
        return edges

    return in_groups(
        rows.join(sets, "node").select(names), ["key", "i", "j"], compare, "u binary, v binary"
    )


def remaining(members: DataFrame, sets: DataFrame, least) -> DataFrame:
    """Links between members of one bucket whose labels differ, exact, block against block."""

    def candidates(key, nodes, role, label, n, registers):
        probe, held, meet = meetings(role, label)
        if not meet.any():
            return []
        own, sizes = matrix(registers), np.array(n)
        near = meet & estimated(own[probe], own[held], sizes[probe], sizes[held], least)
        rows = np.union1d(probe[near.any(axis=1)], held[near.any(axis=0)])
        return [(*key, nodes[x], role[x], label[x]) for x in rows]

    placed = units(members, CHUNK).select("key", "i", "j", "node", "role", "label", "n", "registers")
    schema = "key long, i int, j int, node binary, role int, label binary"
    kept = materialize(in_groups(placed, ["key", "i", "j"], candidates, schema), "units")
    return exact_links(kept, sets, least)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = SHINGLE,
    least: tuple[int, int] = LEAST,
) -> DataFrame:
    """`id_col`, n_shingles, component_id (the smallest id reachable over links) and kept, of each
    document; `least` is the similarity as a fraction."""
    marked = materialize(marks(docs, id_col, text_col, shingle, least), "marks")
    nodes = materialize(
        marked.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("id").alias("least"), F.max("n").alias("n"), F.max("registers").alias("registers")
        ),
        "nodes",
    )
    members = buckets(nodes)
    live = nodes.select("node", "least").join(members.select("node").distinct(), "node")
    sets = sets_of(docs, live, id_col, text_col, shingle)

    edges, asked = None, members
    for turn in range(ROUNDS):
        new = materialize(verified(leaders(asked, least), sets, least), "links")
        edges = new if edges is None else edges.union(new)
        mixed = materialize(labelled(members, rooted(edges)), "mixed")
        one = mixed.groupBy("key", "label").agg(F.min("node").alias("node"))
        asked = mixed.join(one.select("key", "node"), ["key", "node"], "left_semi")
        if turn < ROUNDS - 1 and mixed.isEmpty():
            break
    mixed = narrowed(mixed, sets, least, CHUNK)
    edges = edges.union(materialize(remaining(mixed, sets, least), "links"))

    groups = nodes.select("node", "least").join(rooted(edges), "node", "left")
    groups = materialize(groups.withColumn("root", F.coalesce("root", "node")), "rooted")
    smallest_id = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = materialize(groups.join(smallest_id, "root").select("node", "component_id"), "components")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return marked.join(placed, "node", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.col("id").eqNullSafe(own).alias("kept"),
    )
