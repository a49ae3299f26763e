"""SQL that gives the result of each registered query on the same tables, for DuckDB."""

from __future__ import annotations

_KV = "'user_id=' || user_id || '|event_type=' || event_type"
_DIRTY = (
    "'|user_id=' || user_id || '||event_type=' || event_type"
    " || '|junk|=x|flag=|user_id=' || (user_id + 1)"
)
_SUPPLIER = "'s_name=' || s_name || '|s_nationkey=' || s_nationkey"
_SUPPLIER_BLANK = f"CASE WHEN s_nationkey < 8 THEN '' ELSE {_SUPPLIER} END"
_SUPPLIER_HASH = (
    "'s_name=' || s_name || '|s_nationkey=' || s_nationkey || '|s_suppkey=' || s_suppkey"
)
_DELIMITED = """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber
               WHEN 1 THEN l_partkey || '|' || l_returnflag
               WHEN 2 THEN l_partkey || '|' || l_returnflag || '||' || l_linestatus || '|extra'
               ELSE l_partkey || '|' || l_returnflag || '||' || l_linestatus
           END AS line
    FROM lineitem"""
_RENDERED = """
    'partkey=' || l_partkey || '|returnflag=' || l_returnflag
        || CASE WHEN l_linenumber = 1 THEN '' ELSE '|gap=|status=' || l_linestatus END"""


def _exploded(lines: str, key: str) -> str:
    """Tokens with text before the first `=`, the last of equal fields."""
    return f"""
    WITH lines AS ({lines}),
    tokens AS (
        SELECT {key}, unnest(string_split(line, '|')) AS token,
               unnest(range(len(string_split(line, '|')))) AS pos
        FROM lines
    )
    SELECT {key}, substr(token, 1, strpos(token, '=') - 1) AS k,
           arg_max(substr(token, strpos(token, '=') + 1), pos) AS v
    FROM tokens
    WHERE strpos(token, '=') > 1
    GROUP BY ALL"""


def _by_user(select: str, join: str = "LEFT JOIN", where: str = "") -> str:
    return f"""
    SELECT event_id, {select} AS enriched
    FROM events {join} supplier ON s_suppkey = user_id
    {where}"""


def _part_lookup(join: str) -> str:
    return f"""
    SELECT l_orderkey, l_linenumber,
           {_RENDERED} || coalesce('|p_name=' || p_name || '|p_brand=' || p_brand, '') AS enriched
    FROM lineitem {join} part ON p_partkey = l_partkey"""


_VERSIONS = """
    SELECT c_custkey,
           1704067200 + (c_custkey % 5) * 86400 + (c_custkey * 7919) % 86400
               + version * 259200 AS at_second,
           'c_name=' || c_name || '|version=' || version AS dim_value
    FROM customer, range(10) AS v(version)"""


def _as_of(lookups: str, value: str) -> str:
    """`lookups` are joins of e (event_id, line, user_id, at_us) with v (the versions)."""
    return f"""
    WITH v AS ({_VERSIONS}),
    e AS (SELECT event_id, user_id, {_KV} AS line, epoch_us(ts) AS at_us FROM events)
    SELECT event_id, line || coalesce('|' || {value}, '') AS enriched
    FROM e {lookups}"""


def _asof_join(alias: str, at: str) -> str:
    return f"""
    ASOF LEFT JOIN v AS {alias} ON {alias}.c_custkey = e.user_id
        AND {alias}.at_second * 1000000 <= {at}"""


def _snapshot(ttl: int) -> str:
    return f"e.at_us - e.at_us % {ttl * 1_000_000}"


def _draw(salt: str, bound: int) -> str:
    return f"('0x' || substr(md5(o_orderkey || '-{salt}'), 1, 8))::BIGINT % {bound}"


def _skewed(bound: int) -> str:
    return f"""CASE
        WHEN {_draw("class", 100)} < 25 THEN {_draw("key", bound // 100)}
        WHEN {_draw("class", 100)} < 40 THEN {_draw("key", bound * 5 // 100)}
        WHEN {_draw("class", 100)} < 65 THEN {_draw("key", bound // 10)}
        WHEN {_draw("class", 100)} < 90 THEN {bound // 10} + {_draw("key", bound * 2 // 10)}
        ELSE {bound * 3 // 10} + {_draw("key", bound * 7 // 10)} END"""


def _skewed_lookup(bound: int, join: str) -> str:
    return f"""
    WITH k AS (
        SELECT o_orderkey AS id, {_skewed(bound)} AS key, {_draw("age", 100)} AS age
        FROM orders
    )
    SELECT id, 'userId=' || key || '|age=' || age || '|country=CN'
                   || coalesce('|p_name=' || p_name || '|p_brand=' || p_brand, '') AS enriched
    FROM k {join} part ON p_partkey = key"""


def _windows(seconds: int, message: str) -> str:
    start = f"epoch_us(ts) // 1000000 // {seconds} * {seconds}"
    return f"""
    SELECT {start} AS window_start, count(*) AS records,
           arg_min({message}, (ts, event_id)) AS message
    FROM events GROUP BY window_start"""


def _greedy(key: str, columns: str) -> str:
    """The greedy chain of each value of `key`, a NULL one included."""
    return f"""
        WITH RECURSIVE keyed AS (
            SELECT *, {key} AS key FROM events
        ),
        ticks AS (
            SELECT key, coalesce(key::VARCHAR, 'no key') AS name, epoch_ms(ts) AS tick,
                   arg_min(event_id, (ts, event_id)) AS event_id
            FROM keyed GROUP BY key, tick
        ),
        following AS (
            SELECT a.name, a.tick, a.event_id, b.tick AS next_tick
            FROM ticks AS a ASOF LEFT JOIN ticks AS b
                ON a.name = b.name AND a.tick + {_HOUR_MS} <= b.tick
        ),
        chain AS (
            SELECT * FROM following
            QUALIFY row_number() OVER (PARTITION BY name ORDER BY tick) = 1
            UNION ALL
            SELECT f.* FROM chain AS c JOIN following AS f
                ON f.name = c.name AND f.tick = c.next_tick
        )
        SELECT {columns} FROM chain JOIN keyed USING (event_id)"""


_CHECKED = """
    WITH checked AS (
        SELECT event_id, ts, user_id,
               user_id + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS id,
               CASE WHEN event_type = 'signup' THEN NULL
                    ELSE epoch_us(ts) // 1000000 - event_id % 1800 END AS updated
        FROM events
    ),
    judged AS (
        SELECT event_id, ts,
               CASE WHEN user_id <> id THEN 'key_mismatch'
                    WHEN updated IS NULL THEN 'unparseable'
                    WHEN epoch_ms(ts) - updated * 1000
                         > CASE WHEN id < 100 THEN 306 ELSE 912 END * 1000 THEN 'stale'
               END AS violation
        FROM checked
    )"""

_HOUR_MS = 3_600_000

ORACLES: dict[str, str] = {
    "kv_decode": _exploded(f"SELECT event_id, {_DIRTY} AS line FROM events", "event_id"),
    "kv_dim_decode": _exploded(
        f"SELECT 'tp_' || s_suppkey AS dim_key, {_SUPPLIER_BLANK} AS line FROM supplier",
        "dim_key",
    ),
    "kv_render": """
        SELECT o_orderkey,
               'status=' || o_orderstatus || '|priority='
                   || CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE o_orderpriority END
                   || '|cust=' || o_custkey AS line
        FROM orders""",
    "kv_round_trip": """
        SELECT event_id,
               'user_id=' || (user_id + 1) || '|event_type=' || event_type || '|flag=' AS line
        FROM events""",
    "delimited_decode": f"""
        WITH lines AS ({_DELIMITED}),
        split AS (SELECT l_orderkey, l_linenumber, string_split(line, '|') AS t FROM lines)
        SELECT l_orderkey, l_linenumber, t[1] AS partkey, t[2] AS returnflag, t[3] AS gap,
               t[4] AS status,
               'partkey=' || t[1] || '|returnflag=' || t[2] || coalesce('|gap=' || t[3], '')
                   || coalesce('|status=' || t[4], '') AS rendered
        FROM split""",
    "delimited_regex_fallback": r"""
        WITH lines AS (
            SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_type AS line FROM part
        ),
        split AS (
            SELECT p_partkey,
                   CASE WHEN regexp_matches(line, '[\[09\]-]')
                        THEN string_split_regex(line, '[\[09\]-]')
                        ELSE string_split_regex(regexp_replace(line, '[0-9]+$', ''), '[0-9]')
                   END AS t
            FROM lines
        )
        SELECT p_partkey, t[1] AS head, t[2] AS tail FROM split""",
    "key_expr": """
        SELECT event_id,
               'tp_' || CASE WHEN event_type = 'error' THEN 'null' ELSE user_id::VARCHAR END
                   AS dim_key
        FROM events""",
    "json_path_default": """
        WITH d AS (SELECT event_id, props, '{"a":{"b":' || props || '}}' AS nested FROM events)
        SELECT event_id,
               coalesce(json_extract_string(props, '$.k'), 'none') AS leaf,
               coalesce(json_extract_string(nested, '$.a.b.k'), 'none') AS deep,
               coalesce(json_extract_string(nested, '$.a.b'), 'none') AS container,
               coalesce(json_extract_string(nested, '$.a.x'), 'none') AS missing
        FROM d""",
    "bytes_decode": "SELECT doc_id, text AS utf8, text AS utf16 FROM documents",
    "reject_lines": """
        SELECT event_id,
               CASE event_type WHEN 'error' THEN 'junk' ELSE ' ' || chr(9) END AS line
        FROM events WHERE event_type IN ('error', 'signup')""",
    "left_lookup_kv": _by_user(f"{_KV} || coalesce('|' || {_SUPPLIER}, '')"),
    "left_lookup_hash": _by_user(f"{_KV} || coalesce('|' || {_SUPPLIER_HASH}, '')"),
    "left_lookup_dirty": f"""
        SELECT event_id,
               'user_id=' || (user_id + 1) || '|event_type=' || event_type || '|flag='
                   || coalesce('|' || {_SUPPLIER}, '') AS enriched
        FROM events LEFT JOIN supplier ON s_suppkey = user_id + 1""",
    "left_lookup_null_key": f"""
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN 'event_type=error'
                    ELSE {_KV} || coalesce('|' || {_SUPPLIER}, '') END AS enriched
        FROM events LEFT JOIN supplier ON s_suppkey = user_id""",
    "map_merge": _by_user(
        "CASE WHEN s_suppkey IS NULL THEN " + _KV + """
              ELSE 'user_id=' || user_id || '|event_type=nation ' || s_nationkey
                   || '|s_name=' || s_name END"""
    ),
    "inner_lookup_kv": _by_user(
        f"{_KV} || '|' || {_SUPPLIER}", "JOIN", "WHERE s_nationkey >= 8"
    ),
    "inner_lookup_kv_keep_blank": _by_user(
        f"{_KV} || CASE WHEN s_nationkey < 8 THEN '' ELSE '|' || {_SUPPLIER} END", "JOIN"
    ),
    "inner_lookup_hash": _by_user(f"{_KV} || '|' || {_SUPPLIER_HASH}", "JOIN"),
    "raw_key_lookup": """
        SELECT o_orderkey,
               'key=c' || o_custkey || '&value='
                   || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS enriched
        FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE o_orderpriority <> '5-LOW' AND c_mktsegment <> 'MACHINERY'""",
    "miss_as_blank_row": _by_user(
        f"""CASE WHEN s_suppkey IS NULL THEN ''
                 WHEN s_nationkey < 8 THEN {_KV}
                 ELSE {_KV} || '|' || {_SUPPLIER} END"""
    ),
    "async_hash_lookup": _by_user(f"{_KV} || coalesce('|' || {_SUPPLIER_HASH}, '')"),
    "delimited_lookup": _part_lookup("LEFT JOIN"),
    "dedup_lookup": _part_lookup("LEFT JOIN"),
    "external_lookup": _part_lookup("LEFT JOIN"),
    "external_lookup_distinct": _part_lookup("JOIN"),
    "external_lookup_async": _part_lookup("LEFT JOIN"),
    "unique_dim_lookup": f"""
        SELECT event_id, {_KV} || coalesce('|c_name=' || c_name || '|version=9', '') AS enriched
        FROM events LEFT JOIN customer ON c_custkey = user_id""",
    "unique_dim_lookup_checked": _by_user(f"{_KV} || coalesce('|' || {_SUPPLIER}, '')"),
    "lookup_stats": """
        SELECT event_id // 2000 AS batch, count(*) AS rows,
               count(DISTINCT user_id) AS distinct_keys,
               count(*) - count(DISTINCT user_id) AS fetches_saved,
               count(s_suppkey) AS matched, count(*) - count(s_suppkey) AS missed
        FROM events LEFT JOIN supplier ON s_suppkey = user_id
        GROUP BY batch""",
    "ttl_lookup": _as_of(_asof_join("a", _snapshot(21600)), "a.dim_value"),
    "ttl_lookup_no_negative": _as_of(
        _asof_join("a", _snapshot(21600)) + _asof_join("b", "e.at_us"),
        "coalesce(a.dim_value, b.dim_value)",
    ),
    "options_lookup": _as_of(
        _asof_join("a", _snapshot(21600)) + _asof_join("b", "e.at_us"),
        "coalesce(a.dim_value, b.dim_value)",
    )
    + " WHERE coalesce(a.dim_value, b.dim_value) IS NOT NULL",
    "ttl_policy_lookup": _as_of(_asof_join("a", _snapshot(1800)), "a.dim_value"),
    "live_lookup": _as_of(_asof_join("a", "e.at_us"), "a.dim_value"),
    "gen_sequential_kv": """
        SELECT o_orderkey AS id, 'mykey=' || (o_orderkey % 10) AS line FROM orders""",
    "gen_sequential_text": f"""
        SELECT o_orderkey AS id,
               (o_orderkey % 50000) || '|' || ({_draw("age", 100)}) || '|CN' AS line
        FROM orders""",
    "gen_skewed_text": f"""
        SELECT o_orderkey AS id,
               ({_skewed(1_000_000)}) || '|' || ({_draw("age", 100)}) || '|CN' AS line
        FROM orders""",
    "skew_profile": f"""
        WITH k AS (SELECT {_skewed(50_000)} AS key FROM orders)
        SELECT CASE WHEN key < 500 THEN 'hot' WHEN key < 2500 THEN 'warm'
                    WHEN key < 5000 THEN 'mild' WHEN key < 15000 THEN 'cool'
                    ELSE 'cold' END AS band,
               count(*) AS records, count(DISTINCT key) AS distinct_keys
        FROM k GROUP BY band""",
    "skewed_lookup": _skewed_lookup(50_000, "JOIN"),
    "skewed_lookup_wide": _skewed_lookup(1_000_000, "JOIN"),
    "skewed_left_lookup": _skewed_lookup(50_000, "LEFT JOIN"),
    "skewed_dedup_lookup": _skewed_lookup(50_000, "LEFT JOIN"),
    "throughput_10s": _windows(10, _KV),
    "throughput_10m": _windows(600, _KV),
    "sample_bucketed": f"""
        SELECT event_id, event_type, {_KV} AS line FROM events
        QUALIFY row_number() OVER (
            PARTITION BY event_type, epoch_ms(ts) // {_HOUR_MS} ORDER BY ts, event_id) = 1""",
    "sample_greedy": _greedy("event_type", f"event_id, event_type, {_KV} AS line"),
    "sample_greedy_by_number": _greedy(
        "CASE WHEN event_type <> 'error' THEN (1::BIGINT << 60) + length(event_type) END",
        "event_id, key AS number",
    ),
    "sample_every_n": """
        SELECT o_orderkey, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) % 1000 = 0""",
    "check_all": _CHECKED + "SELECT event_id, violation FROM judged",
    "check_key_id": _CHECKED + "SELECT event_id FROM judged WHERE violation = 'key_mismatch'",
    "check_staleness": _CHECKED + "SELECT event_id FROM judged WHERE violation = 'stale'",
    "check_unparseable": _CHECKED + "SELECT event_id FROM judged WHERE violation = 'unparseable'",
    "error_counts": _CHECKED
    + """
        SELECT epoch_us(ts) // 1000000 // 10 * 10 AS window_start, count(*) AS records,
               count(violation) AS errors
        FROM judged GROUP BY window_start""",
    "bytes_lookup": f"""
        SELECT event_id, {_KV} || CASE WHEN event_type = 'error' THEN chr(65533) ELSE '' END
                   || coalesce('|' || {_SUPPLIER}, '') AS enriched
        FROM events LEFT JOIN supplier ON s_suppkey = user_id""",
    **dict.fromkeys(
        ["stream_left_lookup", "stream_ttl_lookup", "stream_dedup_lookup", "stream_external_lookup",
         "stream_keyed_ttl_lookup"],
        f"""
        SELECT 'event_id=' || event_id || '|' || {_KV} || coalesce('|' || {_SUPPLIER}, '')
                   AS enriched
        FROM events LEFT JOIN supplier ON s_suppkey = user_id""",
    ),
    "stream_throughput": _windows(600, "event_type"),
    "stream_lookup_stats": """
        SELECT 3::BIGINT AS batches, count(*) AS rows, count(s_suppkey) AS matched,
               count(*) - count(s_suppkey) AS missed
        FROM events LEFT JOIN supplier ON s_suppkey = user_id""",
}
# What a stream gives is what the table gives.
ORACLES["live_lookup_by_range"] = ORACLES["live_lookup"]
ORACLES["ttl_lookup_by_range"] = ORACLES["ttl_lookup_no_negative"]
ORACLES["stream_sample_every_n"] = ORACLES["sample_every_n"].replace("% 1000", "% 100")
ORACLES["stream_sample_greedy"] = ORACLES["sample_greedy"]
ORACLES["stream_error_counts_late"] = ORACLES["error_counts"]
