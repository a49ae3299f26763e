"""A deterministic sharded WARC writer, and a reader that checks what it reads.

Records are range-sorted by id into shards.  The bounds come from the ids whose hash falls into a
fixed residue class, weighted by size, so they depend on the rows alone and the same table gives
the same files, byte for byte, on any cluster.  There are at most `MAX_SHARDS` shards, which bounds
what the driver gets; beyond `MAX_SHARDS * SHARD_BYTES` of pages they grow instead.  Each shard is a
partition of its own.  A task streams its shard into gzip members, one per
record, and starts another file when the compressed size reaches `FILE_BYTES`.  Headers and SHA-1
digests are made anew from the payload; dates are a parameter.

Of records with equal payloads the one with the smallest id is a response, the others are revisits
that refer to it.  Revisits are found on (id, digest) alone and travel as markers in the same
shuffle as the pages, so the pages are shuffled once.  A digest that a third of the pages share is
counted with partial sums, and its join is one that adaptive execution can split.

Task attempts write under names of their own and return manifest rows; Spark's commit decides which
attempt counts.  A second pass, which may be repeated, moves the files of the manifest to their
final names.  The manifest is then written beside the archives (`<prefix>-manifest`, JSON lines by
shard and file), so whoever gets the folder knows which files count, and the folder of the attempts
is cleared.  Files outside the manifest are leftovers of lost attempts and are never read.

Ids are numbers or texts.  Null payloads are empty; very long ones are one record, held by the task
that writes it.  Null ids sort first and are kept.  Repeated rows with the same id and
payload give one response (or none) and revisits for the rest; one id's records stay in one shard,
which streams them.  Line breaks and spaces in URLs are percent-encoded, null URLs left out.  An
empty table gives an empty manifest.  Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize, remove

SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
SAMPLES_PER_SHARD = 20
MAX_SHARDS = 20_000
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:dimweave:warc")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, file int, name string, path string, records long, bytes long, sha1 string"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: str | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page}:{digest}:{copy}')}>"


def headers(first: str, pairs: list[tuple[str, str | None]]) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in pairs if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record(kind: str, pairs: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One gzip member with a WARC record."""
    head = headers(
        "WARC/1.1",
        [
            ("WARC-Type", kind),
            *pairs,
            ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
            ("Content-Length", str(len(block))),
        ],
    )
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # the gzip header carries no time
    return packer.compress(head) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def http_head(size: int) -> bytes:
    pairs = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))]
    return headers("HTTP/1.1 200 OK", pairs)


def safe_url(url: str | None) -> str | None:
    if url is None:
        return None
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


class Shard:
    """The files of one shard."""

    def __init__(
        self, folder: str, attempts: str, shard: int, prefix: str, file_bytes: int, date: str
    ):
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.prefix = shard, prefix
        self.file_bytes, self.date = file_bytes, date
        self.attempt = f"{attempts}/{uuid.uuid4().hex}"
        self.rows: list[tuple] = []
        self.stream = None
        self.page: str | None = None
        self.pages = 0
        self.refers: dict[str, str] = {}
        self.seen: dict[str, int] = {}

    def _open(self) -> None:
        number = len(self.rows)
        self.name = f"{self.prefix}-{self.shard:06d}-{number:05d}.warc.gz"
        path = f"{self.root}/{self.attempt}"
        self.files.create_dir(path, recursive=True)
        self.path = f"{path}/{self.name}"
        self.stream = self.files.open_output_stream(self.path, compression=None)
        self.size, self.count, self.sum = 0, 0, hashlib.sha1()
        info = headers("software: dimweave", [("format", "WARC File Format 1.1")])
        self._put(
            record(
                "warcinfo",
                [
                    ("WARC-Record-ID", record_id(self.name, "", 0)),
                    ("WARC-Date", self.date),
                    ("WARC-Filename", self.name),
                    ("Content-Type", "application/warc-fields"),
                ],
                info,
            )
        )

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sum.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None
            done = self.sum.hexdigest()
            self.rows.append(
                (self.shard, len(self.rows), self.name, self.path, self.count, self.size, done)
            )

    def turn(self, page: str | None) -> None:
        if page != self.page or not self.pages:
            self.page, self.refers, self.seen = page, {}, {}
        self.pages += 1

    def mark(self, digest: str, refers: str) -> None:
        """Records of the current id with this digest revisit that of another id."""
        self.refers[digest] = refers

    def add(self, url: str | None, payload: bytes, least: int) -> None:
        digest = sha1(payload)
        refers = self.refers.get(digest)
        copy = self.seen.get(digest, 0)
        self.seen[digest] = copy + 1
        if refers is None and copy and len(payload) >= least:
            refers = self.page
        if self.stream is None:
            self._open()
        head = http_head(len(payload))
        pairs = [
            ("WARC-Record-ID", record_id(self.page, digest, copy)),
            ("WARC-Date", self.date),
            ("WARC-Target-URI", safe_url(url)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http;msgtype=response"),
            ("X-Page-ID", self.page),
        ]
        if refers is None:
            self._put(record("response", pairs, head + payload))
        else:
            pairs += [
                ("WARC-Profile", PROFILE),
                ("WARC-Refers-To", record_id(refers, digest, 0)),
                ("X-Refers-To-Page-ID", refers),
            ]
            self._put(record("revisit", pairs, head))
        self.count += 1
        if self.size >= self.file_bytes:
            self.close()


def shard_bounds(pages: DataFrame, shard_bytes: int, max_shards: int = MAX_SHARDS) -> list:
    """Ids at which shards of about `shard_bytes` begin, or larger ones if there were too many.

    The driver gets about SAMPLES_PER_SHARD ids for each of at most `max_shards` shards."""
    sizes = pages.select("id", F.octet_length("payload").alias("n"))
    total, count = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    shards = min(-(-total // shard_bytes), max_shards)
    if shards < 2:
        return []
    step = max(1, count // (SAMPLES_PER_SHARD * shards))
    sample = (
        sizes.filter((F.pmod(F.xxhash64("id"), F.lit(step)) == 0) & F.col("id").isNotNull())
        .sort("id")
        .collect()
    )
    part, held, bounds = sum(r["n"] for r in sample) / shards, 0, []
    for before, row in pairwise(sample):
        held += before["n"]
        if held >= part * (len(bounds) + 1) and row["id"] > before["id"]:
            bounds.append(row["id"])
    return bounds


def shard_of(bounds: list) -> Column:
    """The number of the shard of column `id`; null ids come first."""
    if not bounds:
        return F.lit(0)

    def number(ids: pa.Array) -> pa.Array:
        found = ids.to_pylist()
        return pa.array([0 if i is None else bisect_right(bounds, i) for i in found], pa.int32())

    return F.arrow_udf(number, "int")("id")


def write(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    prefix: str = "pages",
    least: int = 0,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
    max_shards: int = MAX_SHARDS,
) -> DataFrame:
    """Write the pages below `folder`, which the driver and all executors reach; the manifest."""
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload"),
    )
    narrow = rows.filter(F.octet_length("payload") >= least).select(
        "id", F.sha1("payload").alias("digest")
    )
    first = narrow.groupBy("digest").agg(F.min("id").alias("refers"), F.count("*").alias("n"))
    first = materialize(first.filter("n > 1 AND refers IS NOT NULL").drop("n"), "warc-first")
    marks = narrow.join(first, "digest").filter("id IS NULL OR id <> refers").distinct()
    both = rows.select(
        "id", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("string").alias("refers")
    ).unionByName(
        marks.select(
            "id",
            F.lit(0).alias("kind"),
            F.col("digest").alias("url"),
            F.lit(None).cast("binary").alias("payload"),
            F.col("refers").cast("string").alias("refers"),
        )
    )
    bounds = shard_bounds(rows, shard_bytes, max_shards)
    arranged = (
        both.select(
            shard_of(bounds).alias("shard"), F.col("id").cast("string").alias("page"), "kind",
            "url", "payload", "refers", "id",
        )
        .repartitionById(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", "id", "kind", "url", F.sha1("payload"))
    )
    attempts = f"_attempts/{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        now: Shard | None = None
        for batch in batches:
            table = [c.to_pylist() for c in batch.columns[:4]]
            for at, (number, page, kind, url) in enumerate(zip(*table, strict=True)):
                if now is None or now.shard != number:
                    if now is not None:
                        now.close()
                        yield now.rows
                    now = Shard(folder, attempts, number, prefix, file_bytes, date)
                now.turn(page)
                if kind == 0:
                    digest = base64.b32encode(bytes.fromhex(url)).decode()
                    now.mark(digest, batch.column(5)[at].as_py())
                else:
                    now.add(url, batch.column(4)[at].as_py(), least)
        if now is not None:
            now.close()
            yield now.rows

    written = materialize(map_rows(arranged.drop("id"), run, MANIFEST), "warc-attempts")
    manifest = commit(written, folder)
    beside = manifest.drop("path").orderBy("shard", "file")
    beside.write.mode("overwrite").json(f"{folder}/{prefix}-manifest")
    clear(folder, attempts)
    remove(written)
    remove(first)
    return manifest


def clear(folder: str, attempts: str) -> None:
    """Remove what is left of the attempts of a committed run."""
    files, root = fs.FileSystem.from_uri(folder)
    if files.get_file_info(f"{root}/{attempts}").type != fs.FileType.NotFound:
        files.delete_dir(f"{root}/{attempts}")


def spread(files: DataFrame) -> DataFrame:
    """One task for each file, or for a few if there are very many."""
    return files.repartition(max(1, min(files.count(), 10_000)), "path")


def commit(attempts: DataFrame, folder: str) -> DataFrame:
    """Move the files of the manifest to their final names; a repeated move is no move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                path = f"{root}/{row[2]}"
                if files.get_file_info(row[3]).type != fs.FileType.NotFound:
                    files.move(row[3], path)
                rows.append((*row[:3], path, *row[4:]))
            yield rows

    return materialize(map_rows(spread(attempts), run, MANIFEST), "warc-manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one record each."""
    rest = b""
    while rest or (rest := stream.read(1 << 20)):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
            if not unpacker.eof:
                rest = stream.read(1 << 20)
                if not rest:
                    raise ValueError("archive ends within a record")
        yield b"".join(parts)


def fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {p[0]: p[1] for p in pairs if len(p) == 2}


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record whose length and digest are right."""
    head, _, rest = data.partition(b"\r\n\r\n")
    named = fields(head)
    block = rest[: int(named["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or named["WARC-Block-Digest"] != f"sha1:{sha1(block)}":
        raise ValueError(f"damaged record {named.get('WARC-Record-ID')}")
    return named, block


def read_back(manifest: DataFrame, folder: str, *, payload: bool = True) -> DataFrame:
    """The records of the files of a manifest, with digests checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for data in members(stream):
                        named, block = parsed(data)
                        if named["WARC-Type"] == "warcinfo":
                            continue
                        head, _, body = block.partition(b"\r\n\r\n")
                        digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
                        if named["WARC-Type"] == "response" and sha1(body) != digest:
                            raise ValueError(f"damaged payload {named['WARC-Record-ID']}")
                        size = int(fields(head)["Content-Length"])
                        text = body.decode() if payload and named["WARC-Type"] == "response" else None
                        rows.append(
                            (
                                named.get("X-Page-ID"), named.get("WARC-Target-URI"), size, digest,
                                named["WARC-Type"], named.get("X-Refers-To-Page-ID"), text,
                            )
                        )
                        held += len(text or "")
                        if held > 8_000_000:
                            yield rows
                            rows, held = [], 0
                yield rows

    return map_rows(
        spread(manifest).select("path"),
        run,
        "page string, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers string, payload string",
    )
