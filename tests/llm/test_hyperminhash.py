"""HyperMinHash near duplicates against all pairs of plain sets."""

import random

import numpy as np

from dimweave.llm import hyperminhash as hm
from dimweave.llm.hyperminhash import near_duplicates


def shingle_set(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1)))


def brute(rows):
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if top(j) == top(i) and d is not None]
        least = min(ids) if ids else None
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=str)


def run(frame, **options):
    found = near_duplicates(frame, **options)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def edited(words, chance, times):
    words = list(words)
    for _ in range(times):
        words[chance.randrange(len(words))] = f"n{chance.randrange(10**9)}"
    return " ".join(words)


def corpus(seed):
    chance = random.Random(seed)
    rows = []
    for size in (5, 8, 9, 12, 20, 60, 200, 600):
        for _ in range(12):
            words = [f"w{chance.randrange(3000)}" for _ in range(size)]
            rows.append(" ".join(words))
            for times in (1, 1, 2, max(1, size // 40), max(1, size // 30)):
                rows.append(edited(words, chance, times))
            rows.append(" ".join(words[1:]))
            rows.append(" ".join(words).upper().replace(" ", "\n\t"))
    chance.shuffle(rows)
    return list(enumerate(rows))


def test_brute_force(docs):
    rows = corpus(1) + [(9001, None), (9002, ""), (9003, " \n"), (9004, "a"), (9005, "A"),
                        (9006, "a b"), (9007, "a  b"), (9008, "b a")]
    assert run(docs(rows)) == brute(rows)


def test_null_and_repeated_ids(docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text + " x"), (7, text), (7, "other words of this one row"),
            (7, text + " y"), (None, "alone in the world"), (None, None), (3, "b c d e f g")]
    assert run(docs(rows)) == brute(rows)


def test_empty(docs):
    assert run(docs([])) == []
    assert run(docs([(1, None), (2, "")])) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_large_group_of_near_copies(docs, monkeypatch):
    """All are linked by way of the text they were made from, hardly any with each other; chunks
    and shards are small, so that the group is dealt out."""
    monkeypatch.setattr(hm, "CHUNK", 16)
    monkeypatch.setattr(hm, "SHARD", 8)
    chance = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = [(500, " ".join(base))]
    rows += [(i, edited(base, chance, 1)) for i in range(1, 200)]
    rows += [(i, "far " + edited(base, chance, 9)) for i in range(1000, 1040)]
    assert run(docs(rows)) == brute(rows)


def test_chain(docs):
    """Each text is linked to the next one only."""
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - k, " ".join(words[12 * k : 12 * k + 200])) for k in range(16)]
    assert run(docs(rows)) == brute(rows)
    assert len({r[2] for r in run(docs(rows))}) == 1


def test_very_long_text(docs):
    chance = random.Random(2)
    words = [f"w{chance.randrange(10**6)}" for _ in range(200_000)]
    rows = [(1, " ".join(words)), (2, edited(words, chance, 3000)), (3, edited(words, chance, 20_000)),
            (4, "x" * 2_000_000)]
    assert run(docs(rows)) == brute(rows)


def test_estimate_is_corrected_for_collisions():
    """Unrelated large sets share hardly a register; the estimate of near ones is near."""
    chance = np.random.default_rng(1)
    limit, close = hm.LEAST[0] / hm.LEAST[1], []
    for n in (50, 1000, 100_000):
        both = np.unique(chance.integers(0, 2**64, n, dtype=np.uint64))
        more = np.unique(chance.integers(0, 2**64, n // 4, dtype=np.uint64))
        a, b = (hm.sketch(x)[None] for x in (both, np.unique(np.concatenate([both, more]))))
        far = hm.sketch(np.unique(chance.integers(0, 2**64, n, dtype=np.uint64)))[None]
        size = np.array([n])
        close.append(bool(hm.estimated(a, b, size, size, hm.LEAST)[0, 0]))
        assert not hm.estimated(a, far, size, size, hm.LEAST)[0, 0]
    assert limit == 0.85 and close == [True] * 3
    assert 0 < hm.COLLISIONS[40, 40] < 0.001


def test_candidates_meet_at_the_limit():
    """Pairs of sets of similarity 0.85 to 0.88, of any size, share a band."""
    chance, missed = np.random.default_rng(3), 0
    for n in [6, 7, 8, 13, 17, 40, 100, 1000] * 100:
        extra = int(n * 100 / 85) - n
        both = chance.integers(0, 2**64, n, dtype=np.uint64)
        more = chance.integers(0, 2**64, max(extra, 1), dtype=np.uint64)
        a, b = (hm.sketch(np.unique(x)) for x in (both, np.concatenate([both, more])))
        missed += not set(hm.band_keys(a)) & set(hm.band_keys(b))
    assert missed == 0
