"""SQL texts for DuckDB, one per query, over the same fixture views."""

import re

from .fixtures import NOW, duckdb_sql
from .queries import CHANGED_SOURCES, COUNT_PARAMS, DNS_TTL, EXPORT, NOW_2, TOP_N

_CATALOG = ("proxy_hash, raw_link, scheme, first_seen_at, last_seen_at, last_checked_at, "
            "last_status, reason, latency_ms, mbps, exit_ip, country, city")
# An address as one number, NULL where it is none: IPv6 from 0 on, IPv4 below 0.
_V4 = r"(0|[1-9][0-9]{{0,2}})([.](0|[1-9][0-9]{{0,2}})){{3}}"
_DOTTED = ("CASE WHEN regexp_full_match({0}, '" + _V4 + "') AND list_max(list_transform(string_split({0}, '.'), "
           "lambda x: CAST(x AS INTEGER))) < 256 THEN list_reduce(list_transform(string_split({0}, '.'), "
           "lambda x: CAST(x AS HUGEINT)), lambda a, b: a * 256 + b) END")
# Groups of hexadecimal digits; a dotted tail counts as two of them, and '::' stands for those left out.
_TAIL = ("CASE WHEN contains({0}, '.') THEN regexp_replace({0}, '[0-9.]+$', '') || "
         "regexp_replace(printf('%08x', CAST(" + _DOTTED.replace("{0}", "split_part({0}, ':', -1)") + " AS BIGINT)), "
         "'^(....)', '\\1:') ELSE {0} END")
_SIDE = "list_filter(string_split(split_part(" + _TAIL + ", '::', {1}), ':'), lambda x: x <> '')"
_LEFT, _RIGHT = _SIDE.replace("{1}", "1"), _SIDE.replace("{1}", "2")
_GROUPS = f"list_concat({_LEFT}, list_transform(range(0, 8 - len({_LEFT}) - len({_RIGHT})), lambda i: '0'), {_RIGHT})"
_V6 = (f"CASE WHEN regexp_full_match({{0}}, '[0-9A-Fa-f:.]+') AND len({_GROUPS}) = 8 AND (contains({{0}}, '::') OR len({_LEFT}) = 8) THEN "
       f"list_reduce(list_transform({_GROUPS}, lambda x: CAST(try_cast('0x' || x AS BIGINT) AS HUGEINT)), lambda a, b: a * 65536 + b) END")


def _ip(column):
    return (f"CASE WHEN contains({column}, ':') THEN {_V6.format(column)} "
            f"ELSE {_DOTTED.format(column)} - 4294967296::HUGEINT END")


# Shared steps, each reading views or earlier steps.
STEPS = {
    "links": """
SELECT source, link, sha256(link) AS proxy_hash FROM (
  SELECT source, trim(split_part(line, '#', 1)) AS link FROM raw_lines WHERE contains(line, '://')) l
WHERE link <> ''""",

    # Of the "protocol" keys the last counts; "mux" is the last member with an address.
    "checks": """
SELECT link, outbound, doc IS NOT NULL AS readable,
  CASE WHEN doc IS NOT NULL THEN regexp_extract_all(doc, '"protocol":"([a-z]+)"', 1)[-1] END AS scheme,
  coalesce(json_extract_string(doc, '$.mux.out[1].via.address'),
           json_extract_string(doc, '$.settings.vnext[0].address'),
           json_extract_string(doc, '$.settings.servers[0].address')) AS host,
  json_extract_string(doc, '$.streamSettings.network') IN ('xhttp', 'splithttp', 'httpupgrade') AS checked,
  list_aggregate([regexp_matches(x, '[^\\x00-\\x7F]') OR contains(x, '@') OR length(x) > 250
    FOR x IN [coalesce(nullif(json_extract_string(doc, '$.streamSettings.tlsSettings.serverName'), ''),
                       json_extract_string(doc, '$.streamSettings.realitySettings.serverName'), ''),
              coalesce(json_extract_string(doc, '$.streamSettings.xhttpSettings.host'), ''),
              coalesce(json_extract_string(doc, '$.streamSettings.xhttpSettings.path'), '')]], 'bool_or') AS odd
FROM (SELECT link, outbound, CASE WHEN json_valid(outbound) THEN
        CASE WHEN json_type(outbound) = 'OBJECT' THEN outbound END END AS doc FROM outbounds) o""",

    "verdicts": """
SELECT link, sha256(link) AS proxy_hash, scheme, host,
  CASE WHEN outbound IS NULL THEN 'missing' WHEN NOT readable THEN 'unreadable'
       WHEN checked AND odd THEN 'unsafe' ELSE 'safe' END AS verdict
FROM checks""",

    "known": """
SELECT proxy_hash, raw_link, scheme FROM (
  SELECT sha256(link) AS proxy_hash, link AS raw_link, scheme FROM checks WHERE readable) c""",

    "payload_texts": """
SELECT source, sha256(encode(body)) AS data_hash,
  CASE WHEN contains(body, '://') THEN body ELSE decode(from_base64(body)) END AS txt FROM payloads""",

    "payload_lines": """
SELECT source, data_hash, trim(line) AS line FROM (
  SELECT source, data_hash, unnest(string_split(txt, chr(10))) AS line FROM payload_texts) l
WHERE contains(line, '://')""",

    "page_links": """
SELECT DISTINCT k.proxy_hash, k.raw_link, k.scheme FROM links l JOIN known k ON k.proxy_hash = l.proxy_hash
WHERE NOT EXISTS (SELECT 1 FROM dead d WHERE d.proxy_hash = l.proxy_hash)""",

    "list_lines": """
SELECT trim(line) AS line FROM cidr_lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')""",

    "net_parts": f"""
SELECT line, ip, mask, CASE WHEN ip < 0 THEN 4 WHEN ip >= 0 THEN 6 END AS version, {_DOTTED.format("mask")} AS dotted FROM (
  SELECT line, {_ip("split_part(line, '/', 1)")} AS ip,
    CASE WHEN contains(line, '/') THEN split_part(line, '/', 2) END AS mask FROM list_lines) l""",

    # A dotted mask may name the bits of the network or those of the hosts.
    "net_lengths": """
SELECT line, ip, version, CASE version WHEN 4 THEN 32 ELSE 128 END AS width, CAST(CASE
  WHEN mask IS NULL THEN CASE version WHEN 4 THEN 32 ELSE 128 END
  WHEN regexp_full_match(mask, '[0-9]+') THEN CAST(mask AS INTEGER)
  WHEN version = 4 THEN coalesce(
    list_filter(range(0, 33), lambda k: dotted = 4294967296 - (1::BIGINT << (32 - k)))[1],
    list_filter(range(0, 33), lambda k: dotted = (1::BIGINT << (32 - k)) - 1)[1]) END AS INTEGER) AS prefix_len
FROM net_parts WHERE version IS NOT NULL""",

    "nets": """
SELECT line, CAST(version AS INTEGER) AS version, prefix_len, width,
  CAST((CASE WHEN version = 4 THEN ip + 4294967296 ELSE ip END) // (1::HUGEINT << (width - prefix_len)) AS HUGEINT) AS p
FROM net_lengths WHERE prefix_len BETWEEN 0 AND width""",

    "ranges": """
SELECT DISTINCT first_ip, first_ip + (1::HUGEINT << (width - prefix_len)) - 1 AS last_ip FROM (
  SELECT width, prefix_len, p * (1::HUGEINT << (width - prefix_len)) - CASE WHEN version = 4 THEN 4294967296 ELSE 0 END AS first_ip
  FROM nets) n""",

    "host_hits": f"""
SELECT r.host, bool_or(n.first_ip IS NOT NULL) AS hit, bool_or(r.ip IS NULL) AS unreadable
FROM (SELECT host, {_ip('address')} AS ip FROM resolutions) r LEFT JOIN ranges n ON r.ip BETWEEN n.first_ip AND n.last_ip GROUP BY r.host""",

    "geo_ranges": f"""
SELECT first_ip, first_ip + (1::HUGEINT << (CASE WHEN first_ip < 0 THEN 32 ELSE 128 END - len)) - 1 AS last_ip, len, country, city FROM (
  SELECT {_ip("split_part(network, '/', 1)")} AS first_ip, CAST(split_part(network, '/', 2) AS INTEGER) AS len,
    coalesce(nullif(iso_code, ''), country_name) AS country, city FROM geo_networks) g""",

    "url_tries": """
SELECT proxy_hash, arg_min(latency_ms, attempt_seq) FILTER (WHERE ok) AS latency_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY proxy_hash ORDER BY attempt_seq) AS rn FROM run_url_attempts) a
WHERE rn <= 3 GROUP BY proxy_hash""",

    "exits": """
SELECT proxy_hash, nullif(trim(body), '') AS exit_ip FROM (
  SELECT *, row_number() OVER (PARTITION BY proxy_hash ORDER BY answer_seq) AS nth FROM (
    SELECT *, row_number() OVER (PARTITION BY proxy_hash ORDER BY answer_seq) AS rn FROM run_exit_answers) a
  WHERE rn <= 4 AND ok) b
WHERE nth = 1""",

    "exit_places": f"""
SELECT proxy_hash, exit_ip, country, city FROM (
  SELECT e.proxy_hash, e.exit_ip, g.country, g.city,
    row_number() OVER (PARTITION BY e.proxy_hash ORDER BY g.len DESC NULLS LAST) AS rn
  FROM exits e LEFT JOIN geo_ranges g ON {_ip('e.exit_ip')} BETWEEN g.first_ip AND g.last_ip) p
WHERE rn = 1""",

    "speed_tries": """
SELECT proxy_hash, coalesce(min(attempt_seq) FILTER (WHERE good), max(attempt_seq)) AS seq,
  arg_min(mbps, attempt_seq) FILTER (WHERE good) AS mbps FROM (
  SELECT *, ok AND duration_s > 0 AS good,
    CASE WHEN duration_s > 0 THEN n_bytes / duration_s * 8 / 1048576 END AS mbps,
    row_number() OVER (PARTITION BY proxy_hash ORDER BY attempt_seq) AS rn FROM run_speed_attempts) a
WHERE rn <= 3 GROUP BY proxy_hash""",

    # A whole first run: candidates, three stages, dead-list.
    "run_links": """
SELECT DISTINCT k.proxy_hash, k.raw_link, k.scheme, v.host, v.verdict
FROM (SELECT DISTINCT sha256(trim(split_part(line, '#', 1))) AS proxy_hash FROM payload_lines
      WHERE trim(split_part(line, '#', 1)) <> '') l
JOIN known k ON k.proxy_hash = l.proxy_hash JOIN verdicts v ON v.proxy_hash = l.proxy_hash""",

    "run_cidr": """
SELECT l.*, coalesce(h.hit, false) AS cidr_ok FROM run_links l LEFT JOIN host_hits h ON h.host = l.host""",

    "run_url": """
SELECT c.*, CASE WHEN url_ok THEN t.latency_ms END AS latency_ms, CASE WHEN url_ok THEN p.exit_ip END AS exit_ip,
  CASE WHEN url_ok THEN p.country END AS country, CASE WHEN url_ok THEN p.city END AS city,
  url_ok AND p.country IS NOT NULL AND p.country NOT IN ('SB', 'SC') AS kept,
  CASE WHEN c.verdict = 'unsafe' THEN 'invalid_proxy_uri' WHEN url_ok THEN 'discarded_filtering' ELSE 'url_test_failed' END AS why, url_ok
FROM (SELECT c.*, c.verdict = 'safe' AND t.latency_ms IS NOT NULL AS url_ok FROM run_cidr c
      LEFT JOIN url_tries t ON t.proxy_hash = c.proxy_hash WHERE cidr_ok) c
LEFT JOIN url_tries t ON t.proxy_hash = c.proxy_hash LEFT JOIN exit_places p ON p.proxy_hash = c.proxy_hash""",

    "run_speeds": """
SELECT u.proxy_hash, s.seq, s.mbps, coalesce(s.mbps > 2.0, false) AS fast
FROM run_url u JOIN speed_tries s ON s.proxy_hash = u.proxy_hash WHERE u.kept""",

    "run_cut": """
SELECT CASE WHEN count(*) >= 10 THEN max(seq) END AS last_seq FROM (
  SELECT seq FROM run_speeds WHERE fast ORDER BY seq LIMIT 10) s""",

    "run_end": """
SELECT u.proxy_hash, u.raw_link, u.scheme, u.latency_ms, u.exit_ip, u.country, u.city, s.seq, s.mbps, s.fast
FROM run_url u LEFT JOIN (SELECT * FROM run_speeds WHERE seq <= coalesce((SELECT last_seq FROM run_cut), seq)) s
ON s.proxy_hash = u.proxy_hash WHERE u.kept""",
}


def _sql(query):
    found, todo = set(), [query]
    while todo:
        text = todo.pop()
        for name in STEPS:
            if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                found.add(name)
                todo.append(STEPS[name])
    return duckdb_sql(query, [(n, STEPS[n]) for n in STEPS if n in found])


_CHANGED = "split_part(source, '/', 1) IN (" + ", ".join(f"'{c}'" for c in CHANGED_SOURCES) + ")"
_RUN_DEAD = """
  SELECT proxy_hash, raw_link, scheme, 'cidr_discarded' AS reason FROM run_cidr WHERE NOT cidr_ok
  UNION ALL SELECT proxy_hash, raw_link, scheme, why FROM run_url WHERE NOT kept
  UNION ALL SELECT proxy_hash, raw_link, scheme, CASE WHEN mbps IS NULL THEN 'speed_test_failed' ELSE 'speed_below_threshold' END
  FROM run_end WHERE seq IS NOT NULL AND NOT fast"""
_SEEN_AGAIN = f"""(SELECT sha256(trim(split_part(line, '#', 1))) AS proxy_hash FROM payload_lines
  WHERE {_CHANGED} AND trim(split_part(line, '#', 1)) <> '')"""

_FOLDED = """
SELECT proxy_hash, arg_max(CASE WHEN success THEN kind || '_ok' ELSE 'dead' END, seq) AS status, arg_max(reason, seq) AS reason,
  arg_max(latency_ms, seq) FILTER (WHERE latency_ms IS NOT NULL) AS latency_ms,
  arg_max(mbps, seq) FILTER (WHERE mbps IS NOT NULL) AS mbps,
  arg_max(exit_ip, seq) FILTER (WHERE exit_ip IS NOT NULL) AS exit_ip,
  arg_max(country, seq) FILTER (WHERE country IS NOT NULL) AS country,
  arg_max(city, seq) FILTER (WHERE city IS NOT NULL) AS city
FROM results GROUP BY proxy_hash"""

_APPLY = f"""
SELECT c.proxy_hash, c.raw_link, c.scheme, c.first_seen_at, c.last_seen_at,
  CASE WHEN f.status IS NULL THEN c.last_checked_at ELSE {NOW} END AS last_checked_at,
  coalesce(f.status, c.last_status) AS last_status, coalesce(f.reason, c.reason) AS reason,
  coalesce(f.latency_ms, c.latency_ms) AS latency_ms, coalesce(f.mbps, c.mbps) AS mbps,
  coalesce(f.exit_ip, c.exit_ip) AS exit_ip, coalesce(f.country, c.country) AS country, coalesce(f.city, c.city) AS city
FROM catalog c LEFT JOIN ({_FOLDED}) f ON f.proxy_hash = c.proxy_hash"""


def _country(condition):
    hit = f"last_status IN ('url_ok', 'speed_ok') AND (country IS NULL OR {condition})"
    return f"""SELECT proxy_hash, country, CASE WHEN {hit} THEN 'dead' ELSE last_status END AS last_status,
  CASE WHEN {hit} THEN 'discarded_filtering' ELSE reason END AS reason FROM catalog"""


_TOP = f"""(SELECT proxy_hash, CAST({NOW} AS BIGINT) AS selected_at, raw_link, latency_ms, mbps, exit_ip, country, city
FROM catalog WHERE last_status = 'speed_ok' ORDER BY mbps DESC NULLS LAST, proxy_hash LIMIT {TOP_N})"""

_LINE = """
SELECT proxy_hash, split_part(raw_link, '#', 1) || CASE WHEN remark = '' THEN '' ELSE
  '#' || replace(url_encode(remark), '%2F', '/') END AS line FROM (
  SELECT proxy_hash, raw_link, concat_ws(' | ', 'IP=' || nullif(exit_ip, ''),
    CASE WHEN city IS NOT NULL OR country IS NOT NULL THEN 'Geo=' || concat_ws(',', city, country) || ' '
      || CASE WHEN country IS NULL THEN '' ELSE chr(127397 + ascii(country)) || chr(127397 + ascii(substr(country, 2))) END END,
    'URL=' || printf('%.0f', latency_ms) || 'ms', 'Speed=' || printf('%.2f', mbps) || 'MB/s') AS remark
  FROM {0} s) r"""

_AT = f"make_timestamp({NOW}::BIGINT * 1000000)"
_ANNOUNCE = f"'Exported at ' || strftime({_AT}, '%H:%M:%S %d.%m.%Y') || chr(10) || 'Count: ' || n || chr(10)"


def _lines(rows):
    return "SELECT ord, line FROM (SELECT count(*) AS n FROM " + _TOP + " t) c, LATERAL (VALUES " + ", ".join(
        f"({i}, {text})" for i, text in rows) + ") AS h(ord, line)"


_CLOCK = int(COUNT_PARAMS["elapsed"])
_RULE = "-" * 50


def _attempt_oracle(latency):
    return f"""SELECT test_id, coalesce(min(attempt_seq) FILTER (WHERE ok), max(attempt_seq)) AS seq, coalesce(bool_or(ok), false) AS success,
  CASE WHEN bool_or(ok) THEN 'ok' ELSE 'url_test_failed' END AS reason,
  arg_min({latency}, attempt_seq) FILTER (WHERE ok) AS latency_ms
FROM (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY attempt_seq) AS rn FROM attempts) a WHERE rn <= 3 GROUP BY test_id"""


_SPEED_ATTEMPTS = """SELECT test_id, seq, coalesce(mbps > 50, false) AS success,
  CASE WHEN mbps IS NULL THEN 'speed_test_failed' WHEN mbps > 50 THEN 'ok' ELSE 'speed_below_threshold' END AS reason, mbps FROM (
  SELECT test_id, coalesce(min(attempt_seq) FILTER (WHERE good), max(attempt_seq)) AS seq,
    arg_min(speed, attempt_seq) FILTER (WHERE good) AS mbps FROM (
    SELECT *, ok AND duration_s > 0 AS good, CASE WHEN duration_s > 0 THEN n_bytes / duration_s * 8 / 1048576 END AS speed,
      row_number() OVER (PARTITION BY test_id ORDER BY attempt_seq) AS rn FROM attempts) a WHERE rn <= 3 GROUP BY test_id) s"""

_SPEEDS = """(SELECT seq, proxy_hash, kind, mbps > 20 AS success, reason, latency_ms, exit_ip, country, city, mbps
FROM results WHERE kind = 'speed')"""
_STOPPED = f"""SELECT * FROM {_SPEEDS} r WHERE seq <= coalesce(
  (SELECT CASE WHEN count(*) >= 40 THEN max(seq) END FROM (SELECT seq FROM {_SPEEDS} s WHERE success ORDER BY seq LIMIT 40) f), seq)"""

_BURY = f"""SELECT coalesce(d.proxy_hash, c.proxy_hash) AS proxy_hash, coalesce(d.raw_link, c.raw_link) AS raw_link,
  coalesce(d.scheme, c.scheme) AS scheme, coalesce(c.reason, d.reason) AS reason,
  coalesce(d.created_at, {NOW}) AS created_at,
  CASE WHEN c.proxy_hash IS NULL THEN d.expires_at ELSE {NOW} + 30 * 86400 END AS expires_at
FROM dead d FULL JOIN (SELECT * FROM catalog WHERE last_status = 'dead') c ON c.proxy_hash = d.proxy_hash"""

_ALIVE = f"(SELECT * FROM dead WHERE expires_at >= {NOW})"
_MERGE = f"""SELECT coalesce(p.proxy_hash, t.proxy_hash) AS proxy_hash, coalesce(t.raw_link, p.raw_link) AS raw_link,
  coalesce(t.scheme, p.scheme) AS scheme, coalesce(p.first_seen_at, {NOW}) AS first_seen_at,
  CASE WHEN t.proxy_hash IS NULL THEN p.last_seen_at ELSE {NOW} END AS last_seen_at, p.last_checked_at,
  coalesce(p.last_status, 'unknown') AS last_status, coalesce(p.reason, 'unknown') AS reason,
  p.latency_ms, p.mbps, p.exit_ip, p.country, p.city
FROM existing p FULL JOIN (SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM {_ALIVE} d WHERE d.proxy_hash = f.proxy_hash)) t
ON t.proxy_hash = p.proxy_hash"""

# At least half of the successes, cut by their number.
_STOPPED_HALF = f"""SELECT * FROM {_SPEEDS} r WHERE seq <= (SELECT seq FROM (
  SELECT seq, row_number() OVER (ORDER BY seq) AS nth, count(*) OVER () AS n FROM {_SPEEDS} s WHERE success) f
  WHERE nth = n // 2 + 1)"""

_QUERIES = {
    "load_state": f"SELECT {_CATALOG} FROM catalog",
    "selected_scan": f"SELECT proxy_hash, raw_link, coalesce(country, '?') AS country FROM {_TOP} t",
    "parse_networks": """SELECT line, version, prefix_len,
  CAST(CASE WHEN prefix_len > 64 THEN p // (1::HUGEINT << (prefix_len - 64)) ELSE p END AS BIGINT) AS p_hi FROM nets""",
    "rejected_networks": "SELECT line FROM list_lines WHERE line NOT IN (SELECT line FROM nets)",
    "distinct_links": "SELECT DISTINCT proxy_hash FROM links",
    "split_payload_links": "SELECT source, line FROM payload_lines",
    "decode_base64_payload": "SELECT source, decode(from_base64(body)) AS decoded FROM payloads WHERE NOT contains(body, '://')",
    "changed_sources": """SELECT t.source, t.data_hash FROM payload_texts t LEFT JOIN source_state s ON s.link = t.source
WHERE t.data_hash IS DISTINCT FROM s.last_data_hash""",
    "source_state_upsert": """SELECT coalesce(t.source, s.link) AS link, coalesce(t.data_hash, s.last_data_hash) AS last_data_hash
FROM source_state s FULL JOIN payload_texts t ON s.link = t.source""",
    "fresh_candidates": "SELECT DISTINCT k.proxy_hash, k.raw_link, k.scheme FROM links l JOIN known k ON k.proxy_hash = l.proxy_hash",
    "stage_fresh": "SELECT DISTINCT l.proxy_hash, l.link AS raw_link, k.scheme FROM links l JOIN known k ON k.proxy_hash = l.proxy_hash WHERE k.scheme IS NOT NULL",
    "ingest_stats": """SELECT l.source, count(*) AS total_links, count(k.proxy_hash) AS parsed, count(DISTINCT k.proxy_hash) AS unique_parsed
FROM links l LEFT JOIN known k ON k.proxy_hash = l.proxy_hash GROUP BY l.source""",
    "ingest_totals": """SELECT count(*) AS total_links, count(k.proxy_hash) AS parsed, count(DISTINCT k.proxy_hash) AS unique_fresh,
  count(DISTINCT CASE WHEN d.proxy_hash IS NULL THEN k.proxy_hash END) AS added,
  count(DISTINCT CASE WHEN d.proxy_hash IS NOT NULL THEN k.proxy_hash END) AS skipped_dead
FROM links l LEFT JOIN known k ON k.proxy_hash = l.proxy_hash LEFT JOIN dead d ON d.proxy_hash = k.proxy_hash""",
    "expire_dead": f"SELECT * FROM dead WHERE expires_at >= {NOW}",
    "merge_candidates": _MERGE,
    "merge_count": f"SELECT count(*) AS added FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM {_ALIVE} d WHERE d.proxy_hash = f.proxy_hash)",
    "apply_results": _APPLY,
    "stream_apply_results": _APPLY,
    "stream_attempts": _attempt_oracle("latency_ms"),
    "stream_speed_attempts": _SPEED_ATTEMPTS,
    "move_dead_catalog": f"SELECT {_CATALOG} FROM catalog WHERE last_status <> 'dead'",
    "move_dead_deadlist": _BURY,
    "status_counts": "SELECT last_status, count(*) AS n FROM catalog GROUP BY last_status",
    "country_filter_exclude": _country("country IN ('BH', 'CO', 'DV')"),
    "country_filter_include": _country("country NOT IN ('BH', 'CO', 'DV')"),
    "country_filter_empty_list": _country("false"),
    "country_filter_include_empty_list": _country("true"),
    "resolve_hosts": "SELECT DISTINCT r.host, r.address FROM resolutions r JOIN checks c ON c.host = r.host",
    "resolve_hosts_as_of": f"""SELECT DISTINCT l.host, l.address FROM (
  SELECT *, max(resolved_at) OVER (PARTITION BY host) AS newest FROM lookups
  WHERE ok AND address IS NOT NULL AND resolved_at <= {NOW} AND resolved_at + {DNS_TTL} > {NOW}) l
JOIN checks c ON c.host = l.host WHERE l.resolved_at = l.newest""",
    "cidr_include": "SELECT host, hit AS passed FROM host_hits",
    "cidr_exclude": "SELECT host, NOT hit AND NOT unreadable AS passed FROM host_hits",
    "address_in_networks": f"""SELECT DISTINCT exit_ip AS address FROM catalog c
WHERE EXISTS (SELECT 1 FROM ranges n WHERE {_ip('c.exit_ip')} BETWEEN n.first_ip AND n.last_ip)""",
    "geo_lookup": f"""SELECT proxy_hash, exit_ip, country, city FROM (
  SELECT c.proxy_hash, c.exit_ip, g.country, g.city, row_number() OVER (PARTITION BY c.proxy_hash ORDER BY g.len DESC NULLS LAST) AS rn
  FROM catalog c LEFT JOIN geo_ranges g ON {_ip('c.exit_ip')} BETWEEN g.first_ip AND g.last_ip) x WHERE rn = 1""",
    "url_first_success": _attempt_oracle("latency_ms"),
    "url_elapsed_latency": f"SELECT test_id, success, latency_ms FROM ({_attempt_oracle('duration_s * 1000')}) u",
    "speed_first_success": _SPEED_ATTEMPTS,
    "attempt_bytes": "SELECT test_id, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM attempts GROUP BY test_id",
    "exit_ip_first_answer": """SELECT test_id, max(CASE WHEN answer_seq = first_seq THEN nullif(trim(body), '') END) AS exit_ip FROM (
  SELECT *, min(CASE WHEN ok THEN answer_seq END) OVER (PARTITION BY test_id) AS first_seq FROM (
    SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY answer_seq) AS rn FROM exit_answers) a WHERE rn <= 4) b GROUP BY test_id""",
    "speed_early_stop": _STOPPED,
    "speed_early_stop_half": _STOPPED_HALF,
    "success_count": f"SELECT count(*) FILTER (WHERE success) AS successes, count(*) AS tests FROM ({_STOPPED}) k",
    "safe_outbounds": "SELECT link FROM verdicts WHERE verdict = 'safe'",
    "outbound_host": "SELECT link, host FROM checks",
    "outbound_facts": "SELECT link, scheme, host, verdict FROM verdicts",
    "duration_texts": """SELECT id, CASE WHEN num > 0 THEN CASE unit WHEN 'ms' THEN num / 1000.0::DOUBLE WHEN 'm' THEN num * 60.0::DOUBLE ELSE num END END AS seconds FROM (
  SELECT id, TRY_CAST(nullif(regexp_extract(txt, '^\\s*([0-9]+([.][0-9]+)?)\\s*(ms|s|m)?\\s*$', 1, 'i'), '') AS DOUBLE) AS num,
    lower(regexp_extract(txt, '^\\s*([0-9]+([.][0-9]+)?)\\s*(ms|s|m)?\\s*$', 3, 'i')) AS unit FROM durations) d""",
    "cidr_stage": """SELECT p.proxy_hash, coalesce(h.hit, false) AS success,
  CASE WHEN h.hit THEN 'ok' ELSE 'cidr_discarded' END AS reason
FROM page_links p JOIN verdicts v ON v.proxy_hash = p.proxy_hash LEFT JOIN host_hits h ON h.host = v.host""",
    "url_stage": """SELECT proxy_hash, success, CASE WHEN verdict = 'unsafe' THEN 'invalid_proxy_uri' WHEN success THEN 'ok' ELSE 'url_test_failed' END AS reason,
  CASE WHEN success THEN latency_ms END AS latency_ms, CASE WHEN success THEN exit_ip END AS exit_ip,
  CASE WHEN success THEN country END AS country, CASE WHEN success THEN city END AS city, CAST(NULL AS DOUBLE) AS mbps FROM (
  SELECT p.proxy_hash, v.verdict, v.verdict = 'safe' AND t.latency_ms IS NOT NULL AS success, t.latency_ms, e.exit_ip, e.country, e.city
  FROM page_links p JOIN verdicts v ON v.proxy_hash = p.proxy_hash LEFT JOIN url_tries t ON t.proxy_hash = p.proxy_hash
  LEFT JOIN exit_places e ON e.proxy_hash = p.proxy_hash) x""",
    "speed_stage": """SELECT p.proxy_hash, v.verdict = 'safe' AND coalesce(t.mbps > 50, false) AS success,
  CASE WHEN v.verdict = 'unsafe' THEN 'invalid_proxy_uri' WHEN t.mbps IS NULL THEN 'speed_test_failed'
    WHEN t.mbps > 50 THEN 'ok' ELSE 'speed_below_threshold' END AS reason,
  CASE WHEN v.verdict = 'safe' THEN t.mbps END AS mbps
FROM page_links p JOIN verdicts v ON v.proxy_hash = p.proxy_hash LEFT JOIN speed_tries t ON t.proxy_hash = p.proxy_hash
WHERE v.verdict = 'unsafe' OR t.seq IS NOT NULL""",
    "select_top": f"SELECT * FROM {_TOP} t",
    "keyset_page": "SELECT proxy_hash, raw_link, scheme FROM catalog WHERE proxy_hash > '8' ORDER BY proxy_hash LIMIT 100",
    "keyset_first_page": "SELECT proxy_hash, raw_link, scheme FROM catalog ORDER BY proxy_hash LIMIT 100",
    "stored_page": """SELECT proxy_hash, raw_link, scheme FROM catalog WHERE last_status <> 'dead' AND proxy_hash > '8'
ORDER BY proxy_hash LIMIT 100""",
    "latency_top_n": f"""SELECT proxy_hash, latency_ms FROM catalog WHERE last_status = 'url_ok' AND latency_ms IS NOT NULL
ORDER BY latency_ms, proxy_hash LIMIT {TOP_N}""",
    "export_lines": _LINE.format(_TOP),
    "export_all_lines": _LINE.format("catalog"),
    "export_headers": _lines([
        (0, f"'#profile-title: base64:' || to_base64(encode('{EXPORT.title}'))"),
        (1, "'#profile-update-interval: 24'"),
        (2, f"'#profile-web-page-url: {EXPORT.web_page_url}'"),
        (4, f"'#announce: base64:' || to_base64(encode({_ANNOUNCE} || 'Candidates processed: {COUNT_PARAMS['candidates']}' || chr(10)))"),
    ]),
    "export_headers_file": _lines([
        (0, "'add_header profile-title \"base64:' || to_base64(encode('endpulse')) || '\";'"),
        (1, "'add_header profile-update-interval \"24\";'"),
        (3, "'add_header support-url \"https://s.example\";'"),
        (4, f"'add_header announce \"base64:' || to_base64(encode({_ANNOUNCE})) || '\";'"),
    ]),
    "export_banner": _lines([
        (0, f"'#{_RULE}{EXPORT.banner}{_RULE}'"),
        (1, f"'# Exported at ' || strftime({_AT}, '%Y-%m-%dT%H:%M:%S+00:00')"),
        (2, "'# Count: ' || n"),
        (3, "'# Stats: '"),
        (4, f"'# Time elapsed: ' || printf('%02d:%02d:%02d', {_CLOCK} // 3600, {_CLOCK} % 3600 // 60, {_CLOCK} % 60)"),
        (5, f"'# Candidates processed: {COUNT_PARAMS['candidates']}'"),
    ]),
    "stream_changed_sources": """SELECT t.source, t.line FROM payload_lines t LEFT JOIN source_state s ON s.link = t.source
WHERE t.data_hash IS DISTINCT FROM s.last_data_hash""",
    "run_once_selected": f"""SELECT proxy_hash, CAST({NOW} AS BIGINT) AS selected_at, raw_link, latency_ms, mbps, exit_ip, country, city
FROM run_end WHERE fast ORDER BY mbps DESC, proxy_hash LIMIT 10""",
    "run_once_catalog": f"""SELECT proxy_hash, raw_link, scheme, CAST({NOW} AS BIGINT) AS first_seen_at, CAST({NOW} AS BIGINT) AS last_seen_at,
  CAST({NOW} AS BIGINT) AS last_checked_at, CASE WHEN fast THEN 'speed_ok' ELSE 'url_ok' END AS last_status, 'ok' AS reason,
  latency_ms, mbps, exit_ip, country, city FROM run_end WHERE seq IS NULL OR fast""",
    "run_once_dead": f"""SELECT proxy_hash, raw_link, scheme, reason, CAST({NOW} AS BIGINT) AS created_at, CAST({NOW} + 30 * 86400 AS BIGINT) AS expires_at
FROM ({_RUN_DEAD}) d""",
    # The same tests again: the living stay as they are, the dead are skipped, changed sources are seen again.
    "second_run_dead": f"""SELECT proxy_hash, raw_link, scheme, reason, CAST({NOW} AS BIGINT) AS created_at, CAST({NOW} + 30 * 86400 AS BIGINT) AS expires_at
FROM ({_RUN_DEAD}) d""",
    "stream_resume_sources": f"""SELECT coalesce(p.source, s.link) AS link, CASE WHEN p.source IS NULL THEN s.last_data_hash
  WHEN {_CHANGED} THEN sha256(encode(p.body || chr(10))) ELSE sha256(encode(p.body)) END AS last_data_hash
FROM payloads p FULL JOIN source_state s ON s.link = p.source""",
    # The second run after 40 days: nobody is barred any more, but no source changed either.
    "run_figures": f"""SELECT 'candidates' AS figure, count(*) AS n FROM run_end WHERE seq IS NULL OR fast
UNION ALL SELECT 'expired', count(*) FROM ({_RUN_DEAD}) d
UNION ALL SELECT 'hostless', count(*) FROM run_end e JOIN run_links l ON l.proxy_hash = e.proxy_hash WHERE (seq IS NULL OR fast) AND l.host IS NULL
UNION ALL SELECT 'selected', least(10, count(*)) FROM run_end WHERE fast
UNION ALL SELECT 'speed_candidates', count(*) FROM run_end WHERE seq IS NULL OR fast""",
    "second_run_catalog": f"""SELECT proxy_hash, raw_link, scheme, CAST({NOW} AS BIGINT) AS first_seen_at,
  CAST(CASE WHEN proxy_hash IN {_SEEN_AGAIN} THEN {NOW_2} ELSE {NOW} END AS BIGINT) AS last_seen_at,
  CAST({NOW_2} AS BIGINT) AS last_checked_at, CASE WHEN fast THEN 'speed_ok' ELSE 'url_ok' END AS last_status, 'ok' AS reason,
  latency_ms, mbps, exit_ip, country, city FROM run_end WHERE seq IS NULL OR fast""",
    "second_run_selected": f"""SELECT proxy_hash, CAST({NOW_2} AS BIGINT) AS selected_at, raw_link, latency_ms, mbps, exit_ip, country, city
FROM run_end WHERE fast ORDER BY mbps DESC, proxy_hash LIMIT 10""",
    "second_run_sources": f"""SELECT source AS link, sha256(encode(CASE WHEN {_CHANGED} THEN body || chr(10) ELSE body END)) AS last_data_hash
FROM payloads""",
    "second_run_totals": f"""SELECT count(*) AS total_links, count(k.proxy_hash) AS parsed, count(DISTINCT k.proxy_hash) AS unique_fresh,
  count(DISTINCT CASE WHEN d.proxy_hash IS NULL THEN k.proxy_hash END) AS added,
  count(DISTINCT CASE WHEN d.proxy_hash IS NOT NULL THEN k.proxy_hash END) AS skipped_dead
FROM {_SEEN_AGAIN} l LEFT JOIN known k ON k.proxy_hash = l.proxy_hash
LEFT JOIN ({_RUN_DEAD}) d ON d.proxy_hash = k.proxy_hash""",
}



def _file(speed):
    return f"""SELECT CAST(row_number() OVER (ORDER BY section, ord, speed DESC NULLS LAST, proxy_hash) - 1 AS INTEGER) AS n, line FROM (
  SELECT 0 AS section, ord, CAST(NULL AS DOUBLE) AS speed, '' AS proxy_hash, line FROM ({_QUERIES['export_headers']}) h
  UNION ALL SELECT 1, ord, NULL, '', line FROM ({_QUERIES['export_banner']}) b
  UNION ALL SELECT 2, 0, {speed}, l.proxy_hash, l.line FROM ({_QUERIES['export_lines']}) l JOIN {_TOP} t ON t.proxy_hash = l.proxy_hash) f"""


_QUERIES["stored_status_counts"] = f"SELECT last_status, count(*) AS n FROM ({_QUERIES['second_run_catalog']}) c GROUP BY last_status"
_QUERIES |= {"export_file": _file("NULL"), "export_file_by_speed": _file("t.mbps")}

ORACLES = {name: _sql(query) for name, query in _QUERIES.items()}
