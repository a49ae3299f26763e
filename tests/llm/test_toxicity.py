import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from dimweave.llm.toxicity import fit, held_out, log_odds, remove_toxic, segments, toxicity

CLEAN = [f"word{i}" for i in range(60)]
BAD = ["vile", "rotten", "scoundrelish"]


def corpus(n=900):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(CLEAN, k=rng.randint(5, 120))
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices([*BAD, "rottenest"], k=3)
        rows.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(docs, table):
    rows, labels = corpus()
    labels += [labels[0], (5, 1, None), (None, 1, 1), (10**6, 0, 1)]
    edges = [(2000, None), (2001, ""), (2002, "?!"), (2003, "word1 " * 100_000), (2003, "word1")]
    frame = docs([*rows, *edges])
    model = fit(frame, table(labels, LABELS))
    found = toxicity(frame, model).collect()
    assert len(found) == len(rows) + len(edges)
    predicted = {r.doc_id: r.predicted for r in found}
    tested = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(predicted[i] == (i % 4 == 0) for i in tested) / len(tested)
    assert len(tested) > 100 and right > 0.97
    assert all(0 <= r.score <= 1 for r in found)
    assert [predicted[i] for i in (2000, 2001, 2002, 2003)] == [0, 0, 0, 0]
    kept = remove_toxic(frame, model)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in found if not r.predicted
    )
    marked = [r for r in found if r.predicted and r.passages]
    assert len(marked) > 100
    texts = dict(rows)
    for r in marked:
        words = texts[r.doc_id].split()
        assert any(set(words[p.start : p.end]) & {*BAD, "rottenest"} for p in r.passages)


def test_labels_held_out_are_not_learnt(docs, table, spark):
    rows, labels = corpus(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    one, other = (fit(docs(rows), table(x, LABELS)) for x in (labels, flipped))
    assert one.curve == other.curve and np.array_equal(one.odds, other.odds)
    marks = docs(rows).select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in marks)


def test_without_labels(docs, table):
    frame = docs([(1, "a b"), (None, None)])
    for labels in ([], [(1, 1, 0)]):
        found = toxicity(frame, fit(frame, table(labels, LABELS))).collect()
        assert [(r.score, r.predicted) for r in found] == [(0.0, 0)] * 2
    assert toxicity(docs([]), fit(docs([]), table([], LABELS))).count() == 0


def brute_segments(scores):
    """Maximal segments by definition: split at the best one, then go on at both sides."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            total = sum(scores[i:j])
            if total > 0 and (best is None or total > best[2] + 1e-9):
                best = (i, j, total)
    if best is None:
        return []
    i, j, _ = best
    left = brute_segments(scores[:i])
    right = [(a + j, b + j, t) for a, b, t in brute_segments(scores[j:])]
    return [*left, best, *right]


def test_segments():
    rng = random.Random(2)
    for _ in range(150):
        scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 64 for _ in range(14)]
        got = sorted((s, e) for s, e, _ in segments(np.array(scores)))
        assert got == sorted((s, e) for s, e, _ in brute_segments(scores))


def test_unseen_words_say_nothing():
    odds, certain = log_odds(np.array([90.0, 0, 300]), np.array([0.0, 0, 3000]))
    assert odds[0] > 1 and certain[0] > 4 and abs(odds[1]) < 1e-6
