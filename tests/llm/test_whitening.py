"""Whitening against an eigenvalue decomposition of the whole list."""

import math

import numpy as np
import pytest

from dimweave.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, id string, x string, component string"


def make(table, rows):
    full = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows]
    return table([(i, v, "a", "b", "c") for i, v in full], SCHEMA).repartition(3)


def brute(rows, most=16):
    kept = [
        (i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v))
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    exact = {x: [n * c - s for c, s in zip(x, sums, strict=True)] for x in fit}
    off = np.array([exact[x] for x in fit], float) / n
    cov = off.T @ off / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    return kept, exact, n, values[:k], vectors[:, :k], np.trace(cov)


def check(table, rows, most=16):
    found = whiten(make(table, rows), components=most).collect()
    kept, exact, n, values, vectors, total = brute(rows, most)
    k = len(values)
    assert len(found) == len(kept) * k
    assert {r["n"] for r in found} == {n}
    by = {}
    for r in found:
        by.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    signs = None
    for i, x in kept:
        row = by[(i, sum(d * d for d in exact[x]))]
        got = np.array([row[c + 1]["whitened"] for c in range(k)])
        want = np.array(exact[x], float) / n @ vectors / np.sqrt(values)
        if signs is None:
            signs = np.ones(k)
        for c in range(k):
            if abs(want[c]) > 1e-3 and signs[c] == 1 and got[c] * want[c] < 0 and (c, "set") not in by:
                signs[c] = -1
            if abs(want[c]) > 1e-3:
                by[(c, "set")] = True
        assert np.allclose(got, want * signs, atol=1e-7)
        assert np.allclose([row[c + 1]["explained"] for c in range(k)], values / total, rtol=1e-9)
        assert max(row[c + 1]["identity_error"] for c in range(k)) < 1e-9


@pytest.mark.parametrize("width", [1, 3, 20, 40])
def test_brute_force(table, width):
    chance = np.random.default_rng(width)
    data = chance.standard_normal((150, width)) * np.linspace(3, 0.5, width)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(i, rows[i % 10][1]) for i in range(200, 260)]  # copies enter the fit once
    rows += [(500, None), (501, [None] * width), (502, [math.nan] * width),
             (503, [math.inf] * width), (504, [0.0] * width), (None, rows[3][1])]
    check(table, rows)


def test_few_components_stop_early(table):
    chance = np.random.default_rng(5)
    data = chance.standard_normal((200, 3)) * [40, 20, 10] @ chance.standard_normal((3, 50))
    rows = [(i, (v + 0.2 * chance.standard_normal(50)).tolist()) for i, v in enumerate(data)]
    check(table, rows, most=3)


def test_fewer_rows_than_dimensions(table):
    chance = np.random.default_rng(6)
    check(table, [(i, chance.standard_normal(30).tolist()) for i in range(8)])


def test_repeated_eigenvalues(table):
    # corners of a cross: all variances are equal
    rows = []
    for d in range(6):
        for sign in (1, -1):
            v = [0.0] * 6
            v[d] = 2.0 * sign
            rows.append((len(rows), v))
    found = whiten(make(table, rows)).collect()
    assert len(found) == 12 * 6
    assert {round(r["explained"], 12) for r in found} == {round(1 / 6, 12)}
    assert max(r["identity_error"] for r in found) < 1e-12
    white = np.zeros((12, 6))
    for r in found:
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
    # any basis will do, but distances are those of the vectors over the deviation
    assert np.allclose((white**2).sum(axis=1), 6)


def test_edges(table):
    assert whiten(make(table, [])).collect() == []
    assert whiten(make(table, [(1, [1.0, 2.0])] * 5)).collect() == []  # no variance
    assert whiten(make(table, [(1, []), (2, None)])).collect() == []
    two = whiten(make(table, [(1, [0.0]), (2, [1.0])])).collect()
    assert sorted((r["vec_id"], r["n"], r["deviation"], abs(r["whitened"])) for r in two) == [
        (1, 2, 64 * 64, 1.0), (2, 2, 64 * 64, 1.0)
    ]
    huge = whiten(make(table, [(1, [1e30]), (2, [-1e30]), (3, [0.0])])).collect()
    assert [r["deviation"] for r in huge] == [None] * 3 or len(huge) == 3


def test_lengths_are_fitted_apart(table):
    chance = np.random.default_rng(7)
    short = [(i, chance.standard_normal(3).tolist()) for i in range(20)]
    long = [(100 + i, chance.standard_normal(5).tolist()) for i in range(30)]
    found = whiten(make(table, short + long)).collect()
    assert len(found) == 20 * 3 + 30 * 5
    assert {(r["vec_id"] < 100, r["n"]) for r in found} == {(True, 20), (False, 30)}
