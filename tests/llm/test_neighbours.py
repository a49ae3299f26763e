import numpy as np
import pytest
from pyspark.sql import functions as F

from dimweave.llm import neighbours
from dimweave.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, key string, vector int"


def vectors(n=900, width=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((30, width))
    points = centres[rng.integers(0, 30, n)] + 0.4 * rng.standard_normal((n, width))
    return (points * rng.uniform(0.5, 2, (n, 1))).astype(np.float32)


def run(table, rows, **options):
    frame = table([(i, v, "clash", 0) for i, v in rows], SCHEMA).repartition(3)
    return nearest(frame, F.col("id") % 20 == 0, **options).collect()


def brute(rows, k=20):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    want = {}
    for at in np.flatnonzero(ids % 20 == 0):
        scores = points @ points[at]
        order = [j for j in np.lexsort((ids, -scores.round(12))) if j != at][:k]
        want[int(ids[at])] = [(int(ids[j]), scores[j]) for j in order]
    return want


def result(found):
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


@pytest.mark.parametrize("share", [None, 1.0, 0.05, 0.0])
def test_recall_and_scores(table, monkeypatch, share):
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "CHUNK", 20)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors())]
    got, want = result(run(table, rows, share=share)), brute(rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    if share in (None, 1.0):
        assert hits >= 0.9 * 20 * len(want)
    if share == 1.0:
        assert {q: [i for i, _ in r] for q, r in got.items()} == {
            q: [i for i, _ in r] for q, r in want.items()
        }
    points = dict(rows)
    for q, found in got.items():
        assert len(found) == 20
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        for i, score in found:
            assert score == pytest.approx(np.dot(np.float64(points[q]), np.float64(points[i])))


def test_ascent_takes_the_longest_prefixes():
    rng = np.random.default_rng(3)
    points = vectors(300, 8).astype(float)
    forest = neighbours.Forest(points, [str(i) for i in range(300)], np.arange(300), 9.0, 4)
    asked = neighbours.strings(neighbours.as_query(rng.standard_normal((5, 8))), 4)
    low, high = neighbours.ascend(forest.array, asked, 60)
    for q in range(5):
        agree = np.array(
            [[58 - int(a ^ b).bit_length() for a, b in zip(s, asked[q])] for s in forest.strings]
        )
        counts = {level: int((agree >= level).sum()) for level in range(59)}
        level = max(x for x in counts if counts[x] >= 60)
        met = [sorted(forest.owner[a:b].tolist()) for a, b in zip(low[q], high[q])]
        assert met == [np.flatnonzero(agree[:, t] >= level).tolist() for t in range(4)]


def test_recall_on_the_given_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.select("vec_id", "embedding").collect()]
    got, want = result(nearest(frame, F.col("id") % 20 == 0).collect()), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_huge_components_and_other_lengths(table):
    rows = [(0, [1e300, 0.0]), (1, [1e-300, 1.0]), (2, [2.0, 1.0]), (20, [1.0, 0.0, 1e200])]
    rows += [(3, [0.5, 0.5, 1.0]), (4, [-1.0, 0.0, 0.0])]
    frame = table(rows, "vec_id long, embedding array<double>")
    got = result(nearest(frame, F.col("id") % 20 == 0).collect())
    assert {q: [i for i, _ in r] for q, r in got.items()} == {0: [2, 1], 20: [3, 4]}


def test_equal_vectors_and_ties(table):
    rows = [(i, [1.0, 2.0]) for i in range(70)] + [(i, [0.5, 1.0]) for i in range(100, 130)]
    got = result(run(table, [*rows, rows[0]]))
    assert [i for i, _ in got[0]] == list(range(1, 21))
    assert [i for i, _ in got[20]] == [*range(20)]
    assert [i for i, _ in got[100]] == [*range(20)]


def test_what_takes_no_part(table):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (20, [None, 1.0]),
        (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
        (40, [-1.0, 0.0]),
    ]
    got = result(run(table, rows))
    assert {q: [i for i, _ in r] for q, r in got.items()} == {0: [1, 40], 40: [1, 0]}
    assert run(table, []) == []
    assert run(table, [(0, [1.0])]) == []
