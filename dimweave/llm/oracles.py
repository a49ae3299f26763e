"""SQL for DuckDB that must give the rows of the registered queries."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op8_decontamination"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents
), item_words AS (
  SELECT item_id, row_number() OVER () AS item_row,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark
), item_windows AS (
  SELECT item_id, item_row, i AS j, least(13, len(w)) AS width,
    array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, item_row, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM item_words WHERE len(w) > 0)
), widths AS (
  SELECT DISTINCT width FROM item_windows
), doc_windows AS (
  SELECT row_id, i, width, array_to_string(w[i : i + width - 1], ' ') AS gram
  FROM (SELECT row_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM words, widths WHERE len(w) >= width)
), hits AS (
  SELECT row_id, i, d.width, item_id, item_row, j
  FROM doc_windows d JOIN item_windows m USING (gram)
), covered AS (
  SELECT row_id, count(DISTINCT p) AS n_hit
  FROM (SELECT row_id, unnest(range(i, i + width)) AS p
        FROM (SELECT DISTINCT row_id, i, width FROM hits))
  GROUP BY row_id
), runs AS (
  SELECT row_id, max(n) AS longest FROM (
    SELECT row_id, max(i) - min(i) + any_value(width) AS n FROM (
      SELECT row_id, item_row, i, width, i - j AS diagonal,
        i - row_number() OVER (PARTITION BY row_id, item_row, i - j ORDER BY i) AS g
      FROM hits)
    GROUP BY row_id, item_row, diagonal, g)
  GROUP BY row_id
), found AS (
  SELECT row_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hits GROUP BY row_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(longest, 0)::BIGINT AS longest
FROM words LEFT JOIN covered USING (row_id) LEFT JOIN found USING (row_id)
  LEFT JOIN runs USING (row_id)
"""

_PATTERNS = [
    ("assign", 0, r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", 2, r"[0-9a-f]{16,}", 0, 16),
    ("bearer", 3, r"[Bb]earer\x20+([A-Za-z0-9+/_.=-]{20,})", 1, 20),
    ("prefixed", 4, r"(?:gh[pousr]_|xox[abprs]-|sk_live_|sk-|glpat-|AIza)[A-Za-z0-9_-]+", 0, 20),
    ("jwt", 5, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    ("userinfo", 6, r"://[^\s/:@]+:([^\s/:@]+)@", 1, 8),
    ("digits", 7, r"[0-9]{13,}", 0, 13),
    ("mixed", 8, r"[A-Za-z0-9+/_-]{24,}", 0, 24),
]


def _matches(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Matches of one kind: split the text at them and add up the lengths before each."""
    return f"""
  SELECT row_id, source, repository, '{kind}' AS kind, {rank} AS rank, value,
    list_sum(list_transform(gaps[1:k], lambda g: length(g)))::BIGINT
      + coalesce(list_sum(list_transform(hits[1:k - 1], lambda h: length(h))), 0)::BIGINT AS a,
    length(hit) AS size
  FROM (SELECT row_id, source, repository, gaps, hits, unnest(hits) AS hit, unnest(groups) AS value,
          unnest(range(1, len(hits) + 1)) AS k
        FROM (SELECT row_id, source, md5(t) AS repository, string_split_regex(t, '{pattern}') AS gaps,
                regexp_extract_all(t, '{pattern}', 0) AS hits,
                regexp_extract_all(t, '{pattern}', {group}) AS groups
              FROM texts WHERE regexp_matches(t, '{pattern}')))
  WHERE length(value) >= {least}"""


def secrets_sql(texts: str) -> str:
    """Common table expressions `texts`, `owners` (per value) and `told` (the spans reported)."""
    every = "\n  UNION ALL".join(_matches(*p) for p in _PATTERNS)
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, *, coalesce(text, '') AS t FROM {texts}
), found AS ({every}
), owners AS (
  SELECT value, CASE WHEN owners >= 3 OR repositories >= 10 THEN 'example'
    WHEN owners = 1 THEN 'live' ELSE 'shared' END AS verdict
  FROM (SELECT value, count(DISTINCT coalesce('=' || source, '')) AS owners,
          count(DISTINCT repository) AS repositories FROM found GROUP BY value)
), told AS (
  SELECT row_id, kind, rank, a, a + size AS z, verdict FROM found JOIN owners USING (value)
  WHERE rank < 3 OR verdict <> 'example'
)"""


ORACLES["op2_secret_scans"] = f"""{secrets_sql("documents")}
, joined AS (
  SELECT row_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
    count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) AS spans,
    count(*) FILTER (verdict = 'live') AS n_live,
    count(*) FILTER (verdict = 'example') AS n_example
  FROM told GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM texts LEFT JOIN joined USING (row_id)
"""

ORACLES["op6_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
    sha1(encode(coalesce(html, ''))) AS h
  FROM pages
), first AS (
  SELECT h, min(page_id) AS page FROM p GROUP BY h
)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (('0x' || substr(h, 5 * (k // 4)::INT + 1, 5))::INT >> (15 - 5 * (k % 4))::INT) % 32 + 1, 1)),
    '') AS payload_digest,
  CASE WHEN page_id = page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> page THEN page END AS refers_to
FROM p JOIN first USING (h)
"""

_WORD_LIST = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

# The CRC-32 of a byte, by the polynomial; then of a text, byte by byte.
ORACLES["op11_importance_resampling"] = f"""
WITH RECURSIVE byte_sums AS (
  SELECT b, b AS c, 0 AS k FROM (SELECT unnest(range(256)) AS b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM byte_sums WHERE k < 8
), steps AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS step FROM byte_sums WHERE k = 8
), texts AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, {_WORD_LIST} AS w, true AS own FROM documents
  UNION ALL
  SELECT -row_number() OVER (), NULL, {_WORD_LIST}, false FROM benchmark
), grams AS MATERIALIZED (
  SELECT row_id, own, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT row_id, own, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM texts, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n)
), sums AS MATERIALIZED (
  SELECT gram, xor(4294967295, list_reduce(list_transform(range(0, len(h), 2),
      lambda i: ('0x' || substr(h, i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1]), 4294967295::BIGINT)) % 10000 AS bucket
  FROM (SELECT gram, hex(encode(gram)) AS h FROM (SELECT DISTINCT gram FROM grams)), steps
), counted AS MATERIALIZED (
  SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t
  FROM grams JOIN sums USING (gram) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counted
), weighed AS (
  SELECT row_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM grams JOIN sums USING (gram) JOIN gains USING (bucket) WHERE own GROUP BY row_id
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))))::BIGINT AS score
  FROM texts LEFT JOIN weighed USING (row_id) WHERE own
), placed AS (
  SELECT doc_id, n_features, weight, score, n_words >= 20 AS enough,
    row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN enough AND place <= drawn THEN place END AS rank
FROM placed
"""

ORACLES["op12_hyperminhash"] = r"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), grams AS MATERIALIZED (
  SELECT DISTINCT row_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS gram
  FROM (SELECT row_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i
        FROM texts WHERE len(w) > 0)
), sizes AS MATERIALIZED (
  SELECT row_id, count(*) AS n FROM grams GROUP BY row_id
), met AS (
  SELECT a.row_id AS u, b.row_id AS v, count(*) AS n
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.row_id <> b.row_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT u, v FROM met JOIN sizes a ON a.row_id = u JOIN sizes b ON b.row_id = v
  WHERE 100 * met.n >= 85 * (a.n + b.n - met.n)
), reached AS (
  SELECT row_id AS u, row_id AS v FROM texts
  UNION
  SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v
), least_ids AS (
  SELECT u, min(doc_id) AS component_id FROM reached JOIN texts ON row_id = v GROUP BY u
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM texts LEFT JOIN sizes USING (row_id) JOIN least_ids ON u = row_id
"""
