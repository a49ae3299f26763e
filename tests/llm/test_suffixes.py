import random

import pytest

from dimweave.llm.suffixes import bitmap_of, in_bitmap, repeated_passages


def brute(rows, least):
    words = [(t or "").split() for _, t in rows]
    where = {}
    for k, w in enumerate(words):
        for i in range(len(w) - least + 1):
            where.setdefault(tuple(w[i : i + least]), set()).add(k)
    want = []
    for (doc, _), w in zip(rows, words, strict=True):
        hit = set()
        for i in range(len(w) - least + 1):
            if len(where[tuple(w[i : i + least])]) > 1:
                hit.update(range(i, i + least))
        if hit:
            want.append((doc, sorted(hit)))
    return sorted(want, key=str)


def texts():
    rng = random.Random(8)
    def fresh(n):
        return [f"u{rng.randrange(10**6)}" for _ in range(n)]

    passages = [fresh(n) for n in (20, 25, 30, 60)]
    passages.append(passages[0] + passages[1])
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts += [fresh(rng.randint(0, 15)), rng.choice(passages)]
        rows.append((i, " ".join(w for p in [*parts, fresh(5)] for w in p)))
    rows += [(70, "la " * 300), (71, "la " * 500), (72, "do " * 400), (73, None), (74, ""), (75, "a b")]
    rows += [(80, rows[3][1] + " x"), (3, rows[3][1]), (None, rows[4][1])]
    return rows


@pytest.mark.parametrize("options", [{}, {"group": 2}, {"group": 4, "bitmap_bits": 6}])
def test_against_brute_force(docs, options):
    rows = texts()
    found = repeated_passages(docs(rows), least=20, gram=6, **{"bitmap_bits": 16} | options)
    got = []
    for r in found.collect():
        hit = [i for s in r.passages for i in range(s["start"], s["end"])]
        assert r.n_repeated == len(hit)
        got.append((r.doc_id, hit))
    want = brute(rows, 20)
    assert len(want) > 20
    assert sorted(got, key=str) == want


def test_edges(docs):
    assert repeated_passages(docs([])).count() == 0
    long = " ".join(str(i) for i in range(60_000))
    found = repeated_passages(docs([(1, long), (2, long), (3, "x " * 49)])).collect()
    assert sorted((r.doc_id, r.n_repeated) for r in found) == [(1, 60_000), (2, 60_000)]


def test_bitmap(spark, table):
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = rng.integers(-(2**63), 2**63 - 1, 500)
    bitmap = bitmap_of(table([(int(h),) for h in hashes], "hash long"), 22)
    assert in_bitmap(bitmap, hashes.view(np.uint64)).all()
    others = rng.integers(-(2**63), 2**63 - 1, 5000)
    assert in_bitmap(bitmap, others.view(np.uint64)).mean() < 0.01
