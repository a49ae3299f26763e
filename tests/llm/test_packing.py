import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from dimweave.llm.packing import Windows, default_tokenizer, encoder, pack, place, sequences
from dimweave.llm.packing import token_ids, token_pieces


def test_tightest_window():
    rng = random.Random(1)
    windows, rooms = Windows(64), []
    for _ in range(3000):
        length = rng.randint(1, 64)
        window, offset = windows.put(length)
        fits = [r for r in rooms if r >= length]
        assert offset == (64 - min(fits) if fits else 0)
        if window == len(rooms):
            rooms.append(64)
        assert 64 - rooms[window] == offset
        rooms[window] -= length


@pytest.mark.parametrize(
    "text", ["", "Hello  world\n\n x\t1234 don't", "é日本 <|endoftext|> \x00", "a" * 5000, " " * 9000]
)
def test_ids_are_those_of_the_tokenizer(text):
    reference = Tokenizer.from_file(default_tokenizer())
    reference.encode_special_tokens = True
    want = reference.encode(text, add_special_tokens=False).ids
    assert encoder(default_tokenizer()).encode_ordinary(text) == want


def test_added_tokens_keep_their_ids(docs):
    end = "<|endoftext|>"
    rows = [(1, f"a {end} b"), (2, end), (3, f"{end}{end}x <|endoftext|"), (4, f"é {end}\n" * 3000)]
    placed = pack(docs(rows)).collect()
    check(rows, placed)
    assert {p.doc_id: p.doc_tokens for p in placed}[2] == 2


def check(rows, placed, capacity=2048):
    reference = Tokenizer.from_file(default_tokenizer())
    pieces = {}
    for p in placed:
        pieces.setdefault(p.doc_id, []).append(p)
    windows = {}
    for doc, text in rows:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(pieces[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            part = np.array(ids[at : at + p.length], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == p.ids_crc32
            windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
            at += p.length
        assert at == len(ids)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return windows


def test_pack(docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["one", "two", "xyzzy"], k=rng.randint(0, 3000)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "w " * 30_000)]
    windows = check(rows, pack(docs(rows)).collect())
    used = sum(length for parts in windows.values() for _, length in parts)
    assert used / (2048 * len(windows)) > 0.97


def test_edges(docs):
    assert pack(docs([])).count() == 0
    twice = pack(docs([(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert sorted(p.length for p in twice) == [2, 3, 3]
    assert len({(p.sequence_id, p.offset) for p in twice}) == 3


def test_sequences(docs):
    pieces = token_pieces(docs([(i, "some words " * i) for i in range(50)]), capacity=64)
    placed = place(pieces, capacity=64, shard_pieces=7)
    done = sequences(placed).collect()
    assert sum(len(s.ids) for s in done) == 4 * pieces.agg({"length": "sum"}).first()[0]
    assert max(len(s.ids) for s in done) <= 4 * 64


@pytest.mark.parametrize("letter", [" ", "\n", "\t", "\u3000", "a", "1", "\u4e2d", " \n"])
def test_two_million_of_a_letter(letter):
    """The pattern engine of the fast encoder gives up on long white space; the ids are the same."""
    text = "x " + letter * (2_000_000 // len(letter)) + " y"
    path = default_tokenizer()
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert token_ids(text, path) == want


def test_long_white_space_among_others(docs):
    rows = [(1, " " * 1_000_000 + "end"), (2, "short"), (3, "\n" * 1_000_000), (4, None)]
    placed = pack(docs(rows)).collect()
    check(rows, placed)
