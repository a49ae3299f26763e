"""Word-piece counts by a linear longest-match automaton.

The pieces of a vocabulary form a trie with two roots, one for pieces that begin a word and one for
those that continue it.  Each node has a failure link, to where matching goes on once the greedy
pieces inside its string are taken off, and the number of pieces that are taken off.  A word is then
read once, byte by byte, and its greedy longest-match pieces are counted without being built, in
time linear in its length whatever the vocabulary.

A word whose greedy match gets stuck is one unknown piece.  Counts of words are kept while a task
reads, at most `KNOWN_WORDS` of them.  Words are what stands between ASCII white space.

Null, empty and blank texts have no pieces.  Repeated rows are counted one by one.  Only the id and
the text are read; there is no shuffle.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows
from dimweave.llm.packing import byte_letters, default_tokenizer

KNOWN_WORDS = 200_000
NONE = -1
BEGIN, CONTINUE = 0, 1


class Automaton:
    """Trie, failure links and popped counts over bytes."""

    def __init__(self, beginning: Iterable[bytes], continuing: Iterable[bytes]):
        self.next: dict[int, int] = {}  # node * 256 + byte
        ends, size, parents = set(), 2, [(NONE, 0), (NONE, 0)]
        for root, pieces in ((BEGIN, beginning), (CONTINUE, continuing)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in self.next:
                        self.next[key] = size
                        parents.append((node, byte))
                        size += 1
                    node = self.next[key]
                if piece:
                    ends.add(node)
        self.fail = [NONE] * size
        self.popped = [0] * size
        children: list[list[int]] = [[] for _ in range(size)]
        for node in range(2, size):
            children[parents[node][0]].append(node)
        todo = deque([*children[BEGIN], *children[CONTINUE]])
        while todo:
            node = todo.popleft()
            todo.extend(children[node])
            if node in ends:
                self.fail[node], self.popped[node] = CONTINUE, 1
                continue
            parent, byte = parents[node]
            at, count = self.fail[parent], self.popped[parent]
            while at != NONE and (at << 8 | byte) not in self.next:
                count += self.popped[at]
                at = self.fail[at]
            if at != NONE:
                self.fail[node], self.popped[node] = self.next[at << 8 | byte], count

    def count(self, word: bytes) -> int:
        """Number of greedy pieces of a word; 1 if it cannot be cut into pieces."""
        node, total = BEGIN, 0
        following, fail, popped = self.next, self.fail, self.popped
        for byte in word:
            while (to := following.get(node << 8 | byte, NONE)) == NONE:
                total += popped[node]
                node = fail[node]
                if node == NONE:
                    return 1
            node = to
        while node > CONTINUE:
            total += popped[node]
            node = fail[node]
            if node == NONE:
                return 1
        return total


@lru_cache(maxsize=2)
def byte_level(path: str) -> Automaton:
    """The automaton of a byte-level vocabulary file: pieces after a space begin a word, the
    others continue it; every byte by itself does both."""
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    letters = byte_letters()
    pieces = [bytes(letters[c] for c in t) for t in vocab if all(c in letters for c in t)]
    bytes_alone = [bytes([b]) for b in range(256)]
    beginning = [p[1:] for p in pieces if p[:1] == b" " and len(p) > 1]
    continuing = [p for p in pieces if p[:1] != b" "]
    return Automaton([*beginning, *bytes_alone], [*continuing, *bytes_alone])


class WordCounts(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = n = self.automaton.count(word)
        return n


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """doc_id, `n_words` and `n_tokens` of each document."""
    path = vocabulary or default_tokenizer()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        known = WordCounts(byte_level(path))
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").encode().split()
                rows.append((doc, len(words), sum(known[w] for w in words)))
            yield rows

    return map_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        run,
        f"doc_id {kind}, n_words long, n_tokens long",
    )
