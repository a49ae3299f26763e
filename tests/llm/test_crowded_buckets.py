"""Buckets of many members: all that has to meet meets once, and few rows are dealt for it."""

import itertools
import random
from collections import Counter

import pytest
from test_hyperminhash import brute, edited, run

from dimweave.llm import hyperminhash as hm
from dimweave.llm import near_copies


def texts(count):
    """A text, copies with one other word and a few with so many that they are no link."""
    chance = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(5000, " ".join(base))]
    rows += [(i, edited(base, chance, 1)) for i in range(count)]
    return rows + [(6000 + i, edited(base, chance, 7)) for i in range(12)]


@pytest.fixture
def dealt_rows(monkeypatch):
    """How many rows were dealt to the blocks that hold members of a bucket with their sets."""
    seen = []

    def counting(rows, keys, function, schema):
        if "found" in rows.columns:
            seen.append(rows.count())
        return in_groups(rows, keys, function, schema)

    in_groups = hm.in_groups
    for module in (hm, near_copies):
        monkeypatch.setattr(module, "in_groups", counting, raising=False)
        monkeypatch.setattr(module, "CHUNK", 16)
    return seen


def test_each_pair_of_components_meets_once(spark):
    """One large component, one of all outside, and single members only."""
    labels = {1: [0] * 70 + [1] * 9 + [2] * 5, 2: list(range(40)), 3: [0] * 5 + [1, 2], 4: [0, 1]}
    rows = [(k, bytes([k, x]), bytes([k, y])) for k, held in labels.items() for x, y in enumerate(held)]
    frame = spark.createDataFrame(rows, "key long, node binary, label binary")
    groups = {}
    for r in sorted(hm.units(frame, 8).collect(), key=lambda r: bytes(r.node)):
        groups.setdefault((r.key, r.i, r.j), []).append(r)
    met = Counter()
    for held in groups.values():
        probe, others, meet = hm.meetings([r.role for r in held], [bytes(r.label) for r in held])
        for a, b in zip(*meet.nonzero(), strict=True):
            met[frozenset((bytes(held[probe[a]].node), bytes(held[others[b]].node)))] += 1
    want = {
        frozenset((a[1], b[1])) for a, b in itertools.combinations(rows, 2) if a[0] == b[0] and a[2] != b[2]
    }
    assert met == dict.fromkeys(want, 1)


def test_rows_of_op12_grow_with_the_members(docs, dealt_rows):
    counts = []
    for count in (100, 300):
        dealt_rows.clear()
        assert run(docs(texts(count))) == brute(texts(count))
        counts.append(sum(dealt_rows))
    assert counts[1] <= 4 * counts[0] + 600


def test_rows_of_the_pipeline_grow_with_the_members(docs, dealt_rows):
    counts = []
    for count in (100, 300):
        dealt_rows.clear()
        kept = sorted(r.doc_id for r in near_copies.keep_one(docs(texts(count))).collect())
        assert kept == [0, *range(6000, 6012)]
        counts.append(sum(dealt_rows))
    assert counts[1] <= 4 * counts[0] + 600


def test_members_that_no_set_can_link_to_go(spark, docs):
    """Half of the shingles of the last one are nowhere else; the others share all but one."""
    base = list(range(1, 41))
    held = {b"a": base, b"b": base[:-1] + [90], b"c": base[1:] + [91], b"d": base[20:] + list(range(200, 220))}
    sets = spark.createDataFrame(
        [(k, hm.np.array(v, "<u8").tobytes()) for k, v in held.items()], "node binary, found binary"
    )
    crowd = spark.createDataFrame([(7, k, k) for k in held], "key long, node binary, label binary")
    left = hm.open_members(crowd, sets, (85, 100)).collect()
    assert {bytes(r.node): r.own for r in left} == {b"a": 0, b"b": 1, b"c": 1}
