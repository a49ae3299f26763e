import base64
import gzip
import hashlib
import json
import random

import pytest

from pyspark.sql import functions as F

from dimweave.llm.warc import read_back, shard_bounds, write

SCHEMA = "page_id long, url string, html string, digest string, shard int"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def rows():
    rng = random.Random(6)
    texts = ["", None, "é" * 3000, "<p>same</p>", *(f"<p>{rng.random()}" * 50 for _ in range(40))]
    made = [(i * 7 - 20, f"http://x/{i} y\n", rng.choice(texts)) for i in range(150)]
    return [(*r, "clash", 1) for r in [*made, (None, None, "null id"), made[3], made[3]]]


def expected(pages):
    first, seen, want = {}, set(), []
    for page, _, html, *_ in sorted(pages, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        again = payload in first or (page, payload) in seen
        seen.add((page, payload))
        first.setdefault(payload, page)
        kind = "revisit" if again else "response"
        want.append((page, len(payload), digest(html), kind, first[payload] if again else None))
    return sorted(want, key=str)


def run(spark, pages, folder, **options):
    manifest = write(spark.createDataFrame(pages, SCHEMA).repartition(4), folder, **options)
    found = [
        (
            int(r.page) if r.page else None, r.payload_bytes, r.payload_digest, r.record_type,
            int(r.refers) if r.refers else None,
        )
        for r in read_back(manifest, folder).collect()
    ]
    return manifest, sorted(found, key=str)


@pytest.mark.parametrize(
    "options", [{}, {"shard_bytes": 8000, "file_bytes": 500}, {"shard_bytes": 3000}]
)
def test_round_trip(spark, tmp_path, options):
    pages = rows()
    manifest, found = run(spark, pages, str(tmp_path), **options)
    assert found == expected(pages)
    payloads = {
        r.payload_digest: r.payload
        for r in read_back(manifest, str(tmp_path)).collect()
        if r.record_type == "response"
    }
    assert payloads == {digest(h): h or "" for _, _, h, *_ in pages}


def test_files_are_the_same_on_every_run(spark, tmp_path):
    pages, options = rows(), {"shard_bytes": 8000, "file_bytes": 2000}
    sums = []
    for k, order in enumerate((pages, pages[::-1])):
        folder = tmp_path / str(k)
        folder.mkdir()
        run(spark, order, str(folder), **options)
        files = sorted(folder.glob("*.warc.gz"))
        sums.append([(f.name, hashlib.sha256(f.read_bytes()).hexdigest()) for f in files])
    assert sums[0] == sums[1] and len(sums[0]) > 3
    assert gzip.decompress((tmp_path / "0" / sums[0][0][0]).read_bytes()).startswith(b"WARC/1.1\r\n")


def test_least_payload(spark, tmp_path):
    pages = [(1, None, "ab", "", 0), (2, None, "ab", "", 0), (3, None, "abc", "", 0), (4, None, "abc", "", 0)]
    _, found = run(spark, pages, str(tmp_path), least=3)
    assert [f[3] for f in found] == ["response"] * 3 + ["revisit"]


def test_damage_is_found(spark, tmp_path):
    manifest, _ = run(spark, [(1, "u", "abcdef" * 10, "", 0)], str(tmp_path))
    file = next(tmp_path.glob("*.warc.gz"))
    data = gzip.decompress(file.read_bytes())
    at = data.index(b"abcdef")
    head = gzip.compress(data[: data.index(b"WARC/1.1", 5)])
    rest = gzip.compress(data[data.index(b"WARC/1.1", 5) :].replace(b"abcdef", b"abcdeX", 1))
    file.write_bytes(head + rest)
    assert at
    with pytest.raises(Exception, match="damaged"):
        read_back(manifest, str(tmp_path)).collect()


def test_empty_table(spark, tmp_path):
    manifest, found = run(spark, [], str(tmp_path))
    assert manifest.count() == 0 and found == []


def test_text_ids(spark, tmp_path):
    """Texts in the place of numbers, over several shards in the order of the texts."""
    pages = [(i, f"u{i}", f"{i} " * 400, "", 0) for i in range(60)]
    frame = spark.createDataFrame(pages, SCHEMA)
    frame = frame.withColumn("page_id", F.concat(F.lit("é-"), F.sha1(F.col("page_id").cast("string"))))
    manifest = write(frame.repartition(3), str(tmp_path), shard_bytes=8000)
    found = read_back(manifest, str(tmp_path)).collect()
    assert {r.page: r.payload for r in found} == {r.page_id: r.html for r in frame.collect()}
    names = sorted(r.name for r in manifest.collect())
    assert len({r.shard for r in manifest.collect()}) > 3
    order = [
        line.split(": ")[1]
        for n in names
        for line in gzip.decompress((tmp_path / n).read_bytes()).decode().split("\r\n")
        if line.startswith("X-Page-ID")
    ]
    assert order == sorted(r.page for r in found)


def test_manifest_beside_the_archives(spark, tmp_path):
    manifest, _ = run(spark, rows(), str(tmp_path), shard_bytes=8000, file_bytes=2000)
    parts = sorted(tmp_path.glob("pages-manifest/part-*"))
    lines = [json.loads(x) for part in parts for x in part.read_text().splitlines()]
    assert [x["name"] for x in lines] == sorted(f.name for f in tmp_path.glob("*.warc.gz"))
    for x in lines:
        data = (tmp_path / x["name"]).read_bytes()
        assert len(data) == x["bytes"] and hashlib.sha1(data).hexdigest() == x["sha1"]
    assert not list(tmp_path.glob("_attempts/*"))
    assert sum(x["records"] for x in lines) == len(rows())


def test_shards_grow_beyond_their_number(spark, tmp_path):
    pages = [(i, None, f"{i}" * 500, "", 0) for i in range(200)]
    frame = spark.createDataFrame(pages, SCHEMA).select(F.col("page_id").alias("id"), F.encode("html", "UTF-8").alias("payload"))
    assert len(shard_bounds(frame, 2000)) > 20
    assert len(shard_bounds(frame, 2000, 4)) == 3
    _, found = run(spark, pages, str(tmp_path), shard_bytes=2000, max_shards=4)
    assert found == expected(pages)


def test_very_long_payload(spark, tmp_path):
    pages = [(1, "u", "é<p>" * 2_000_000, "", 0), (2, "u", "x", "", 0), (3, "u", "é<p>" * 2_000_000, "", 0)]
    _, found = run(spark, pages, str(tmp_path), file_bytes=500)
    assert found == expected(pages)
