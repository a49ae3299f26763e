"""Importance resampling against a plain count over regular-expression words."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from dimweave.llm.importance import resample


def words_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text):
    w = words_of(text)
    grams = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return [zlib.crc32(g.encode()) % 10000 for g in grams]


def brute(rows, target, percent=5, least=20):
    own = Counter(b for _, text in rows for b in features(text))
    want = Counter(b for text in target for b in features(text))
    s, t = sum(own.values()) + 10000, sum(want.values()) + 10000
    out = []
    for doc, text in rows:
        f = features(text)
        weight = sum(math.floor(1000 * math.log((want[b] + 1) * s / ((own[b] + 1) * t))) for b in f)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(f), weight, score, None, len(words_of(text)) >= least])
    enough = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(enough[: percent * len(enough) // 100], 1):
        row[4] = place
    return Counter(tuple(r[:5]) for r in out)


def run(frame, target, **options):
    return Counter(tuple(r) for r in resample(frame, target, **options).collect())


def test_brute_force(docs, table):
    chance = random.Random(3)
    vocabulary = ["alpha", "Beta", "x", "7", "été", "ÉTÉ", "日本", "a-b", "don't", " z"]
    rows = [
        (i, " ".join(chance.choices(vocabulary, k=chance.choice([0, 1, 2, 3, 19, 20, 21, 60]))))
        for i in range(300)
    ]
    rows += [(None, None), (None, "alpha " * 30), (5, ""), (900, "\n\t .,"), (7, rows[7][1])]
    target = ["Alpha beta x 7", None, "", "日本 été"]
    goal = table([(t,) for t in target], "text string")
    assert run(docs(rows), goal) == brute(rows, target)
    assert run(docs(rows), goal, percent=60, least_words=3) == brute(rows, target, 60, 3)


def test_long_text_and_repeated_rows(docs, table):
    long = "lorem Ipsum, dolor? " * 100_000
    rows = [(1, long), (2, "w" * 1_000_000)] + [(3, "one two three " * 10)] * 40
    goal = table([("lorem ipsum",)], "text string")
    assert run(docs(rows), goal, percent=50) == brute(rows, ["lorem ipsum"], 50)


def test_empty(docs, table):
    goal = table([], "text string")
    assert run(docs([]), goal) == Counter()
    rows = [(1, "a b c " * 10), (2, None)]
    assert run(docs(rows), goal) == brute(rows, [])


def test_every_draw_has_its_own_rank(docs, table):
    rows = [(9, "same words here " * 8)] * 50
    found = resample(docs(rows), table([], "text string"), percent=100).collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 51))
