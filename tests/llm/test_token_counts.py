import random

from dimweave.llm.packing import default_tokenizer
from dimweave.llm.token_counts import Automaton, byte_level, token_counts


def greedy(word, beginning, continuing):
    at = count = 0
    while at < len(word):
        pieces = continuing if at else beginning
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), 0)
        if not end:
            return 1
        at, count = end, count + 1
    return count


def test_against_greedy_matching():
    rng = random.Random(3)
    for _ in range(500):
        def some():
            return {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 12))}

        beginning, continuing = some(), some()
        automaton = Automaton(beginning, continuing)
        for _ in range(10):
            word = bytes(rng.choices(b"abc", k=rng.randint(1, 12)))
            assert automaton.count(word) == greedy(word, beginning, continuing)


def test_frame(docs):
    automaton = byte_level(default_tokenizer())
    texts = [None, "", " \t", "hello tokenization", "é日本 x", "a" * 300_000]
    rows = [*enumerate(texts), (3, texts[3])]
    found = token_counts(docs(rows)).collect()
    assert len(found) == len(rows)
    want = {
        i: (len(w), sum(map(automaton.count, w)))
        for i, t in rows
        for w in [(t or "").encode().split()]
    }
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in found} == want
    assert want[3][1] < 8
    assert token_counts(docs([])).count() == 0
