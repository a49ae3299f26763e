"""Best-fit decreasing packing of tokenised documents into fixed windows.

A document is tokenised, closed by an end token and cut into full windows; what is left over is
packed best fit first: the pieces of a shard arrive longest first, and a segment tree over the
remaining capacities finds the tightest open window that still takes the piece.

Shards are a hash of the piece's place, so a shard is the same on every run, holds about
`SHARD_PIECES` pieces whatever the data, and ends in one or two windows that are not full.

Null and empty texts are the end token alone.  Texts of any length are taken whole, runs of millions
of equal characters included.  Repeated rows are packed each on their own.  An
empty table gives no rows.  Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.llm.common import map_rows, materialize

CAPACITY = 2048
END_ID = 1
SHARD_PIECES = 20_000
FLUSH_IDS = 2_000_000

PIECE = "start long, length long, doc_tokens long, ids binary"


@lru_cache(maxsize=2)
def encoder(path: str):
    """A byte-level BPE tokenizer file as a tiktoken encoding, with the same ids.

    The ids of a byte-level BPE vocabulary follow its merges, so they serve as ranks.  tiktoken
    takes a fifth of the CPU time of the `tokenizers` library for the same ids.  The file's added
    tokens stand for themselves wherever a text spells them.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        source = json.load(file)
    vocab = source["model"]["vocab"]
    added = {t["content"]: t["id"] for t in source.get("added_tokens", [])}
    for token in source.get("added_tokens", []):
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError(f"tiktoken has no such matching of {token['content']!r}")
    byte_of = byte_letters()
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in vocab.items()
        if all(c in byte_of for c in token) and token not in added
    }
    return tiktoken.Encoding(
        os.path.basename(path),
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens=added,
    )


@lru_cache(maxsize=2)
def plain_encoder(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str | None, path: str) -> list[int]:
    """The ids of a text.  tiktoken's pattern engine gives up on white space that runs over some
    hundred thousand characters; such a text goes to the `tokenizers` library."""
    try:
        return encoder(path).encode(text or "", allowed_special="all")
    except ValueError:
        return plain_encoder(path).encode(text, add_special_tokens=False).ids


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for
    themselves, the others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """The pieces of each document: `start`, `length`, `doc_tokens` and the ids themselves as
    little-endian unsigned 32-bit integers.  Without a shuffle."""
    path = tokenizer or default_tokenizer()
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        rows, held = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*token_ids(text.as_py(), path), end_id], dtype="<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    rows.append((doc, start, len(piece), len(ids), piece.tobytes()))
                held += len(ids)
                if held >= FLUSH_IDS:
                    yield rows
                    rows, held = [], 0
        yield rows

    return map_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        cut,
        f"doc_id {kind}, {PIECE}",
    )


class Windows:
    """Open windows by remaining capacity, under a segment tree that counts them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def _add(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least `length` that an open window has."""
        count, node = self.count, self.size + length
        if count[node]:
            return length
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node + (not count[2 * node])
                return node - self.size
            node >>= 1
        return None

    def put(self, length: int) -> tuple[int, int]:
        """Window and offset of a piece."""
        room = self.tightest(length)
        if room is None:
            window, room = self.made, self.capacity
            self.made += 1
        else:
            window = self.open[room].pop()
            self._add(room, -1)
        left = room - length
        if left:
            self.open[left].append(window)
            self._add(left, 1)
        return window, self.capacity - room


def place(
    pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """`pieces` (doc_id, start, length and others) with `sequence_id` and `offset`.

    The pieces are read twice, so they should be a written table."""
    shards = max(1, -(-pieces.count() // shard_pieces))
    keyed = pieces.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "start"), F.lit(shards)).cast("int")
    )
    arranged = keyed.repartition(shards, "shard").sortWithinPartitions(
        "shard", F.desc("length"), "doc_id", "start"
    )
    fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*pieces.schema.fields, *fields])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, windows = None, None
        for batch in batches:
            ids, offsets = [], []
            lengths = batch.column("length").to_pylist()
            for at, length in zip(batch.column("shard").to_pylist(), lengths, strict=True):
                if at != shard:
                    shard, windows = at, Windows(capacity)
                window, offset = windows.put(length)
                ids.append((shard << 32) + window)
                offsets.append(offset)
            kept = [batch.column(c) for c in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())],
                names=schema.names,
            )

    return arranged.mapInArrow(fit, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed windows: `sequence_id` and the ids of its pieces in order, joined."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids")
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Where each piece of each document goes, with the CRC-32 of its ids.

    The ids do not travel: they are a function of the text, and `token_pieces` gives them again
    for `sequences` where the windows themselves are wanted.
    """
    pieces = token_pieces(docs, id_col, text_col, **options).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return place(materialize(pieces, "pieces"), options.get("capacity", CAPACITY))
