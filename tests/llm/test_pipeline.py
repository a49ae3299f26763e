"""The stages on a small corpus, each against what plain Python says about its own input."""

import itertools
import random

import corpus_pipeline
import pytest
from test_decontamination import brute as brute_hits
from test_packing import check
from test_simhash import grouped
from test_toxicity import BAD, CLEAN

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row int"


def corpus():
    rng = random.Random(12)
    items = [(i, " ".join(rng.choices(CLEAN, k=20))) for i in range(5)]
    rows, labels = [], []
    for i in range(700):
        words = rng.choices(CLEAN, k=rng.randint(20, 90))
        if i % 4 == 0:
            words[5:5] = rng.choices(BAD, k=3)
            labels.append((i, 1, 1))
        else:
            labels.append((i, 1, 0))
            if i % 9 == 0:
                words += items[i % 5][1].split()
            if i % 11 == 0:
                words[3:3] = [f"token=Abc{i}defGhijkl"]
        text = " ".join(words)
        rows.append((i, text, "en", f"s{i % 7}", len(text), 1))
    copies = [(1000 + i, *rows[i][1:]) for i in range(1, 400, 7)]
    # one or two words of the middle or the end changed: similarities from 0.6 to 0.98
    for i in range(3, 400, 7):
        words = rows[i][1].split()
        for at in [(-1,), (len(words) // 2,), (5, -6)][i % 3]:
            words[at] = rng.choice(CLEAN) + "x"
        copies.append((1500 + i, " ".join(words), *rows[i][2:]))
    edges = [(2000, None, None, None, None, 1), (2001, "", "en", "s", 0, 1), rows[1]]
    return [*rows, *copies, *edges], labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels, items = corpus()
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    return path


def five_word_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    _, _, items = corpus()
    seen = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
    before, after = seen["documents"], seen["toxicity"]
    bad = [r for r in before if set((r.text or "").split()) & set(BAD)]
    clean = [r for r in before if r not in bad]
    assert sum(r in after for r in bad) < 0.03 * len(bad)
    assert sum(r in after for r in clean) > 0.97 * len(clean)

    sets = [five_word_shingles(r.text) for r in after]
    nodes = range(len(after))
    linked = [
        (a, b) for a, b in itertools.combinations(nodes, 2)
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    edited = [p for p in linked if sets[p[0]] != sets[p[1]]]
    assert len(edited) > 20
    groups = {}
    for node, root in grouped(nodes, linked).items():
        groups.setdefault(root, set()).add(after[node].doc_id)
    kept = [r.doc_id for r in seen["near_duplicates"]]
    assert sorted(kept) == sorted(min(ids) for ids in groups.values())

    clean = []
    for r in seen["near_duplicates"]:
        n, hit, *_ = brute_hits(r.text, items)
        if not (hit and 20 * hit >= n):
            clean.append(r)
    assert sorted(seen["decontamination"], key=str) == sorted(clean, key=str)

    texts = {r.doc_id: r.text for r in seen["decontamination"]}
    assert len(seen["secrets"]) == len(texts)
    for r in seen["secrets"]:
        old = texts[r.doc_id]
        assert ("token=" in (old or "")) == ("[REDACTED:assign:live]" in (r.text or ""))
        assert "token=" not in (r.text or "")
        assert r.n_chars == (len(r.text) if r.text is not None else None)
        if "token=" not in (old or ""):
            assert r.text == old
    check([(r.doc_id, r.text) for r in seen["secrets"]], seen["packing"])


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
