"""Fixture views derived from the driver's tables (see FIXTURES.md).

Each view has one SQL text for both engines; ``{...}`` marks the few places
where their spelling differs.
"""

import re

NOW = 1700000000

# Fixture payloads are the lines of at most this many pages of one source, so
# a payload stays small while their number grows with the data.
PAYLOAD_PAGES = 50

_SHARED = {
    "host": "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)",
    "link": "split_part(url, '#', 1)",
    "test_id": "user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR(10))",
    "block": f"CAST(floor((line_id % 1000000000000) / {PAYLOAD_PAGES}) AS BIGINT)",
}
_DUCKDB = {
    **_SHARED, "sha": "sha256", "bits": "",
    "joined": "string_agg(line, chr(10) ORDER BY line_id)",
    "base64": "to_base64(encode(txt))", "bytes": "encode(body)",
}
_SPARK = {
    **_SHARED, "sha": "sha2", "bits": ", 256",
    "joined": "string_agg(line, chr(10)) WITHIN GROUP (ORDER BY line_id)",
    "base64": r"regexp_replace(base64(encode(txt, 'UTF-8')), r'[\r\n]', '')",
    "bytes": "encode(body, 'UTF-8')",
}

VIEWS = {
    "raw_lines": """
SELECT page_id AS line_id, 'src' || (page_id % 7) AS source, url AS line FROM pages
UNION ALL SELECT page_id + 1000000000000, 'src' || ((page_id + 1) % 7),
  split_part(url, '#', 1) || '#label ' || page_id FROM pages WHERE page_id % 5 = 0
UNION ALL SELECT page_id + 2000000000000, 'src' || (page_id % 7),
  'not a link ' || page_id FROM pages WHERE page_id % 11 = 0
UNION ALL SELECT page_id + 3000000000000, 'src' || (page_id % 7),
  '#only://comment ' || page_id FROM pages WHERE page_id % 13 = 0""",

    "payloads": """
SELECT source, CASE WHEN split_part(source, '/', 1) IN ('src1', 'src3', 'src5')
  THEN {base64} ELSE txt END AS body
FROM (SELECT source, {joined} AS txt FROM (
  SELECT source || '/' || {block} AS source,
    line_id, line FROM raw_lines) p GROUP BY source) q""",

    "source_state": """
SELECT source AS link, CASE WHEN split_part(source, '/', 1) IN ('src0', 'src1', 'src2')
  THEN {sha}({bytes}{bits}) ELSE 'stale' END AS last_data_hash
FROM payloads WHERE split_part(source, '/', 1) <> 'src6'""",

    "outbounds": """
SELECT link, max(outbound) AS outbound FROM (
SELECT {link} AS link, CASE WHEN page_id % 9 = 0 THEN NULL
  WHEN page_id % 23 = 5 THEN '{"protocol":"vless","settings":{"address": '
  WHEN page_id % 23 = 6 THEN '[{"protocol":"vless","address":"' || {host} || '"}]' ELSE
  CASE WHEN page_id % 5 = 2 THEN '{"protocol":"ss",' ELSE '{' END || '"protocol":"' || CASE WHEN page_id % 2 = 0 THEN 'vless' ELSE 'trojan' END
  || '","settings":{"' || CASE WHEN page_id % 2 = 0 THEN 'vnext' ELSE 'servers' END
  || '":[{"address":"' || {host} || '"}]},"streamSettings":{"network":"'
  || CASE WHEN page_id % 4 = 0 THEN 'xhttp' WHEN page_id % 4 = 1 THEN 'httpupgrade' ELSE 'tcp' END
  || '","xhttpSettings":{"host":"' || CASE WHEN page_id % 8 = 0 THEN 'user@h' ELSE 'h' END
  || '","path":"/' || repeat('p', CAST(page_id % 260 AS INT)) || '"},"tlsSettings":{"serverName":"'
  || CASE WHEN page_id % 5 = 0 THEN '' ELSE 's.example' END
  || '"},"realitySettings":{"serverName":"'
  || CASE WHEN page_id % 10 = 0 THEN 'é' ELSE 'r.example' END || '"}}'
  || CASE WHEN page_id % 4 = 3 THEN ',"mux":{"out":[{"address":"first.example"},{"via":{"address":"' || {host}
    || '"}}],"text":"{address"}' ELSE '' END || '}' END AS outbound FROM pages
) q GROUP BY link""",

    "catalog": """
SELECT {sha}(c_name{bits}) AS proxy_hash, 'vless://' || c_name AS raw_link, 'vless' AS scheme,
  CAST(1690000000 - c_custkey AS BIGINT) AS first_seen_at, CAST(1695000000 AS BIGINT) AS last_seen_at,
  CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(1695000000 + c_custkey AS BIGINT) END AS last_checked_at,
  CASE c_custkey % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'cidr_ok' WHEN 2 THEN 'url_ok' WHEN 3 THEN 'speed_ok' ELSE 'dead' END AS last_status,
  CASE c_custkey % 5 WHEN 0 THEN 'unknown' WHEN 4 THEN 'url_test_failed' ELSE 'ok' END AS reason,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE abs(c_acctbal) END AS latency_ms,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE abs(c_acctbal) END AS mbps,
  CASE c_custkey % 11 WHEN 7 THEN '2001:db8:' || hex(c_custkey % 4096) || '::' || hex(c_custkey % 97)
    WHEN 8 THEN '2001:DB8:' || hex(c_custkey % 25) || ':' || hex(32768 + c_custkey % 8192) || '::1.2.3.4'
    WHEN 9 THEN '2001:db8:0:' || (c_custkey % 9999) || ':x'
    ELSE (c_custkey % 223 + 1) || '.' || (c_custkey % 256) || '.' || (c_custkey * 7 % 256) || '.' || (c_custkey * 13 % 256) END AS exit_ip,
  CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE chr(CAST(65 + c_nationkey AS INT)) || chr(CAST(65 + (c_nationkey * 7) % 26 AS INT)) END AS country,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'City ' || c_nationkey END AS city
FROM customer""",

    "dead": """
SELECT {sha}(c_name{bits}) AS proxy_hash, 'vless://' || c_name AS raw_link, 'vless' AS scheme, 'url_test_failed' AS reason,
  CAST(1690000000 AS BIGINT) AS created_at, CAST(1699999990 + c_custkey % 20 AS BIGINT) AS expires_at
FROM customer WHERE c_custkey % 9 = 0
UNION ALL SELECT {sha}(link{bits}), link, 'vless', 'url_test_failed', CAST(1690000000 AS BIGINT),
  CAST(1699999990 + min(page_id) % 20 AS BIGINT)
FROM (SELECT {link} AS link, page_id FROM pages WHERE page_id % 7 = 3) p GROUP BY link""",

    # The fixture of the merge: customers of some nations are in the catalogue
    # before, customers of other, partly the same nations come in fresh, and so do
    # all that are not in the catalogue.
    "existing": """
SELECT * FROM catalog WHERE city < 'City 3' OR country IS NULL""",

    "fresh": """
SELECT {sha}(c_name{bits}) AS proxy_hash, 'vless://' || c_name AS raw_link,
  CASE WHEN c_custkey % 4 = 0 THEN 'trojan' ELSE 'vless' END AS scheme
FROM customer WHERE c_nationkey >= 10 OR (c_nationkey % 6 <> 0
  AND NOT coalesce(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'City ' || c_nationkey END < 'City 3', false))""",

    "results": """
SELECT event_id AS seq, {sha}('Customer#' || lpad(CAST(user_id * 13 AS VARCHAR(20)), 9, '0'){bits}) AS proxy_hash,
  CASE event_type WHEN 'purchase' THEN 'speed' WHEN 'signup' THEN 'cidr' ELSE 'url' END AS kind, event_type <> 'error' AS success,
  CASE event_type WHEN 'error' THEN 'url_test_failed' ELSE 'ok' END AS reason,
  CASE WHEN event_type IN ('click', 'view') THEN value ELSE NULL END AS latency_ms,
  CASE WHEN event_type = 'view' THEN '10.0.' || (event_id % 256) || '.1' ELSE NULL END AS exit_ip,
  CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'DE' ELSE NULL END AS country, CAST(NULL AS VARCHAR(20)) AS city,
  CASE WHEN event_type = 'purchase' THEN value ELSE NULL END AS mbps FROM events""",

    "attempts": """
SELECT {test_id} AS test_id, event_id AS attempt_seq, event_type <> 'error' AS ok,
  event_type = 'error' AND event_id % 2 = 0 AS timed_out,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS latency_ms,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 97 * 10000 AS BIGINT) END AS n_bytes,
  CASE WHEN event_id % 101 = 0 THEN 0.0E0 ELSE value / 100 END AS duration_s FROM events""",

    "exit_answers": """
SELECT {test_id} AS test_id, event_id AS answer_seq, event_type <> 'error' AS ok,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN '  '
  ELSE ' 10.1.' || (event_id % 256) || '.7 ' END AS body FROM events""",

    "resolutions": """
SELECT DISTINCT {host} AS host,
  CASE page_id % 17 WHEN 4 THEN '2001:db8:' || hex(page_id % 97) || ':' || hex(page_id % 512) || '::' || hex(page_id % 65536)
    WHEN 5 THEN 'unreadable ' || (page_id % 10)
    ELSE (page_id % 223 + 1) || '.' || (page_id % 256) || '.' || (page_id * 7 % 256) || '.1' END AS address
FROM pages WHERE page_id % 3 <> 0""",

    # Two lookups of each page's host: some failed, some too old, some later than NOW.
    "lookups": """
SELECT {host} AS host, CASE WHEN page_id % 4 <> 0 THEN (page_id % 223 + 1) || '.' || (page_id % 256) || '.0.2' END AS address,
  CAST(1699998800 + page_id * 37 % 1500 AS BIGINT) AS resolved_at, page_id % 5 <> 2 AS ok FROM pages
UNION ALL SELECT {host}, (page_id % 223 + 1) || '.' || (page_id % 256) || '.0.' || (page_id % 3),
  CAST(1699998800 + page_id % 50 * 30 AS BIGINT), page_id % 7 <> 2 FROM pages""",

    "cidr_lines": """
SELECT (n_nationkey * 8 + 1) || '.0.0.9/' || (8 + n_regionkey) AS line FROM nation
UNION ALL SELECT (s_suppkey % 223 + 1) || '.' || (s_suppkey % 256) || '.' || (s_suppkey * 7 % 256) || '.0/24' FROM supplier
UNION ALL SELECT '# note ' || n_nationkey FROM nation UNION ALL SELECT n_nationkey || '.1.2' FROM nation
UNION ALL SELECT '  ' FROM region UNION ALL SELECT (r_regionkey + 40) || '.1.2.3' FROM region
UNION ALL SELECT '2001:db8:' || hex(s_suppkey % 97) || ':' || hex(s_suppkey % 512) || ':7::/' || (40 + s_suppkey % 89) FROM supplier
UNION ALL SELECT '2001:db8:' || hex(n_nationkey) || '::' || hex(n_nationkey) FROM nation
UNION ALL SELECT (n_nationkey + 100) || '.3.0.9/255.255.0.0' FROM nation
UNION ALL SELECT (n_nationkey + 130) || '.4.7.0/0.0.0.255' FROM nation
UNION ALL SELECT (n_nationkey + 60) || '.1.0.0/33' FROM nation UNION ALL SELECT '0' || n_nationkey || '.2.3.4/24' FROM nation
UNION ALL SELECT '1.2.3.4/255.0.255.' || r_regionkey FROM region UNION ALL SELECT (r_regionkey + 256) || '.1.1.0/24' FROM region
UNION ALL SELECT '2001:db8::/' || (129 + r_regionkey) FROM region UNION ALL SELECT '2001:db8::' || r_regionkey || 'g/64' FROM region
UNION ALL SELECT '2001:db8:' || r_regionkey || '/64' FROM region""",

    "geo_networks": """
SELECT (n_nationkey * 8 + 1) || '.0.0.0/' || (8 + n_regionkey) AS network,
  CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE chr(CAST(65 + n_nationkey AS INT)) || 'X' END AS iso_code,
  n_name AS country_name, CAST(NULL AS VARCHAR(20)) AS city FROM nation
UNION ALL SELECT (s_suppkey % 223 + 1) || '.' || (s_suppkey % 256) || '.0.0/16',
  'S' || chr(CAST(65 + s_suppkey % 26 AS INT)), 'Supplierland', 'Town ' || s_suppkey FROM supplier
UNION ALL SELECT '2001:db8:' || hex(s_suppkey) || '::/48', 'S' || chr(CAST(65 + s_suppkey % 26 AS INT)), 'Supplierland', 'Town ' || s_suppkey
  FROM supplier WHERE s_suppkey < 65536
UNION ALL SELECT '2001:db8:' || hex(n_nationkey) || ':8000::/' || (49 + n_regionkey), 'Q' || chr(CAST(65 + n_nationkey AS INT)), n_name, NULL FROM nation
UNION ALL SELECT '2001::/' || (12 + 3 * r_regionkey), '', r_name, NULL FROM region""",

    # Texts for the duration parser out of every event.
    "durations": """
SELECT event_id AS id, CASE event_id % 8 WHEN 0 THEN '10' WHEN 1 THEN ' 10s ' WHEN 2 THEN (event_id % 977) || 'ms'
  WHEN 3 THEN '2M' WHEN 4 THEN (event_id % 31) || '.5 s' WHEN 5 THEN '0s' WHEN 6 THEN '-3s' ELSE 'soon' END AS txt
FROM events""",

    # Observations of one run: events stand for the tries of the pages' links.
    "tries": """
SELECT p.proxy_hash, e.event_id, e.event_type, e.value
FROM (SELECT event_id, event_type, value, event_id % (SELECT count(*) FROM pages) AS page_id FROM events) e
JOIN (SELECT page_id, {sha}({link}{bits}) AS proxy_hash FROM pages) p ON p.page_id = e.page_id""",

    "run_url_attempts": """
SELECT proxy_hash, event_id AS attempt_seq, event_type <> 'error' AS ok,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS latency_ms FROM tries""",

    "run_exit_answers": """
SELECT proxy_hash, event_id AS answer_seq, event_type <> 'error' AS ok,
  CASE WHEN event_type = 'signup' THEN ' '
  ELSE ' ' || CASE WHEN event_id % 11 = 3 THEN '2001:db8:' || hex(event_id % 4096) || '::7'
    ELSE (event_id % 223 + 1) || '.' || (event_id % 256) || '.1.7' END END AS body FROM tries""",

    "run_speed_attempts": """
SELECT proxy_hash, event_id AS attempt_seq, event_type <> 'error' AS ok,
  CAST(event_id % 97 * 10000 AS BIGINT) AS n_bytes,
  CASE WHEN event_id % 101 = 0 THEN 0.0E0 ELSE value / 100 END AS duration_s FROM tries""",
}

# The columns in use; given, so that no file is opened to find them out.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE",
    "supplier": "s_suppkey BIGINT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "pages": "page_id BIGINT, url STRING",
}


def _spelled(name, words):
    text = VIEWS[name]
    for word, spelling in words.items():
        text = text.replace("{" + word + "}", spelling)
    return text


def _used(names):
    """The views and what they are made of, in the order of their definition."""
    found, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", VIEWS.get(name, ""))
    return [t for t in TABLES if t in found], [v for v in VIEWS if v in found]


def view(spark, sf_dir, name):
    """A fixture view as a DataFrame."""
    tables, views = _used([name])
    read = {t: spark.read.schema(TABLES[t]).parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    bodies = [f"{v} AS ({_spelled(v, _SPARK)})" for v in views]
    text = f"{', '.join(bodies)} SELECT * FROM {name}".replace("{", "{{").replace("}", "}}")
    heads = "".join(f"{t} AS (SELECT * FROM {{{t}}}), " for t in tables)
    return spark.sql(f"WITH {heads}{text}", **read)


def duckdb_sql(query, extra=()):
    """A DuckDB query with the definitions of the views that it reads in front.

    ``extra`` are more definitions (name, sql), which may read the views.
    """
    text = " ".join([query, *[sql for _, sql in extra]])
    names = [v for v in VIEWS if re.search(rf"\b(?:FROM|JOIN)\s+{v}\b", text)]
    parts = [f"{v} AS ({_spelled(v, _DUCKDB)})" for v in _used(names)[1]]
    parts += [f"{name} AS ({sql})" for name, sql in extra]
    return f"WITH {', '.join(parts)} {query}" if parts else query
