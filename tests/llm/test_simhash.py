import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from dimweave.llm import simhash
from dimweave.llm.components import components
from dimweave.llm.simhash import allocate, deal, distance_shares, fingerprint, keep_one
from dimweave.llm.simhash import near_duplicates


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    rows = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(nodes, linked):
    """The smallest node reachable from each."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    bases = [[rng.choice(words) for _ in range(120)] for _ in range(8)]
    rows = []
    for i in range(150):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((i, " ".join(own).title()))
    return [*rows, (200, None), (201, ""), (202, " \t"), (203, "É a"), (204, "é a"), (205, "A b c")]


@pytest.mark.parametrize("text", ["", "A b", "a B c d", "x y z w v", "é " * 5000, "the cat " * 3])
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


def test_long_and_short_counting_agree():
    text = " ".join(str(i % 977) for i in range(4000))
    assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("layouts", [(5, 4, 3), (4,), (3,), (2,)])
@pytest.mark.parametrize("bucket", [8192, 3])
def test_components_against_brute_force(docs, monkeypatch, layouts, bucket):
    monkeypatch.setattr(simhash, "LAYOUTS", layouts)
    rows = texts()
    prints = {i: brute_fingerprint(t) for i, t in rows}
    linked = [
        (a, b)
        for a, b in itertools.combinations(prints, 2)
        if (prints[a] ^ prints[b]).bit_count() <= 4
    ]
    want = grouped(prints, linked)
    assert 10 < len(set(want.values())) < len(want)
    found = near_duplicates(docs([*rows, rows[0]]), bucket=bucket).collect()
    assert len(found) == len(rows) + 1
    assert {r.id: r.component_id for r in found} == want
    assert all(r.fp % 2**64 == prints[r.id] for r in found)


def test_keep_one(docs):
    rows = texts()
    frame = docs([*rows, rows[0], (None, rows[1][1]), (None, None)])
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    prints = {i: brute_fingerprint(t) for i, t in rows}
    linked = [
        p for p in itertools.combinations(prints, 2) if (prints[p[0]] ^ prints[p[1]]).bit_count() <= 4
    ]
    want = set(grouped(prints, linked).values())
    # null ids are the smallest
    lost = {c for c in want if c in (grouped(prints, linked)[1], grouped(prints, linked)[200])}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(g for g in got if g is not None) == sorted(want - lost)
    assert got.count(None) == 2


def test_empty_table(docs):
    assert near_duplicates(docs([])).count() == 0
    assert keep_one(docs([])).count() == 0


@pytest.mark.parametrize("spread", [6, 20])
def test_links_of_a_bucket_are_few_and_lose_nothing(spread):
    rng = np.random.default_rng(spread)
    bits = np.array([0, *(1 << np.arange(spread)).tolist()])
    prints = np.unique(rng.choice(bits, (3000, 5)).sum(axis=1))
    probe = rng.random(len(prints)) < 0.5
    edges = simhash.links(prints, probe, 2)
    assert all((u ^ v).bit_count() <= 2 for u, v in edges)
    pairs = [
        (int(a), int(b)) for a in prints for b in prints[~probe] if (int(a) ^ int(b)).bit_count() <= 2
    ] if len(prints) < 500 else None
    nodes = prints.tolist()
    if pairs is not None:
        assert grouped(nodes, edges) == grouped(nodes, pairs)
    assert len(edges) < 2 * len(prints)


def test_a_dense_bucket_of_probes():
    low = np.arange(4096, dtype=np.int64)
    prints = np.concatenate([low[np.bitwise_count(low) <= 2], low[np.bitwise_count(low) <= 2] << 20])
    prints = np.unique(prints)
    probe = np.arange(len(prints)) % 2 == 0
    edges = simhash.links(prints, probe, 4)
    assert len(edges) < 2 * len(prints) and grouped(prints.tolist(), edges)[int(prints[-1])] == 0


def test_thresholds_are_the_cheapest():
    rng = random.Random(1)
    for _ in range(50):
        costs = [{t: rng.random() for t in range(-1, 4)} for _ in range(4)]
        best = min(
            sum(c[t] for c, t in zip(costs, ts, strict=True))
            for ts in itertools.product(range(-1, 4), repeat=4)
            if sum(ts) == 1
        )
        cost, chosen = allocate(costs, 1)
        assert cost == pytest.approx(best) and sum(chosen) == 1


def test_distance_shares_and_parts():
    values = np.random.default_rng(1).integers(0, 32, 60)
    shares = distance_shares(np.bincount(values, minlength=32).astype(float), 3)
    pairs = np.bitwise_count(values[:, None] ^ values[None, :])
    assert shares == pytest.approx([(pairs == d).mean() for d in range(4)])
    parts = deal(np.eye(64), 5)
    assert sorted(b for p in parts for b in p) == list(range(64))


def test_components_of_paths_and_stars(table):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 130)] + [(7, 7), (9, 8)]
    found = {r.u: r.v for r in components(table(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {j: 100 for j in range(101, 130)}
    assert components(table([], "u long, v long")).count() == 0
