"""SQL texts for DuckDB of those queries that SQL can express."""

from endpulse.llm.decontamination import SPAN
from endpulse.llm.license_scan import NOTICES, PHRASES, THRESHOLD, step_of
from endpulse.llm.line_dedup import RUN
from endpulse.llm.mixing import BLOCK_DOCS, MAX_NAMED, MAX_PARTS
from endpulse.llm.prefix_trie import BASES, HEADS

WORDS = ("regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

op1 = f"""
WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
b AS (SELECT cast(item_id AS VARCHAR) AS item, {WORDS.format('text')} AS w FROM benchmark),
spans AS (SELECT DISTINCT least(len(w), {SPAN}) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT item, w, least(len(w), {SPAN}) AS n,
               unnest(range(1, len(w) - least(len(w), {SPAN}) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, spans WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, item FROM places p JOIN windows USING (n, x)),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_SHORT = [f"""
  UNION ALL SELECT doc_id, i, {n}, false, array_to_string(lines[i + 1:i + {n}], chr(10))
  FROM (SELECT doc_id, lines, n_words, unnest(range(0, len(lines) - {n} + 1)) AS i FROM d WHERE len(lines) >= {n})
  WHERE list_sum(n_words[i + 1:i + {n}]) >= MIN_WORDS
  UNION ALL SELECT doc_id, 0, {n}, true, text FROM d WHERE len(lines) = {n}""" for n in range(1, RUN)]


def op2(min_words: int) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, text, lines, list_transform(lines, lambda x: len({WORDS.format('x')})) AS n_words
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents)),
runs AS (
  SELECT doc_id, i, {RUN} AS n, false AS whole, array_to_string(lines[i + 1:i + {RUN}], chr(10)) AS x
  FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - {RUN} + 1)) AS i
        FROM d WHERE len(lines) >= {RUN}){''.join(_SHORT).replace('MIN_WORDS', str(min_words))}),
again AS (
  SELECT doc_id, i, n FROM (
    SELECT *, row_number() OVER (PARTITION BY n, whole, x ORDER BY doc_id, i) AS r FROM runs)
  WHERE r > 1),
gone AS (
  SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM again)),
lines AS (
  SELECT doc_id, k, line FROM (
    SELECT doc_id, unnest(range(0, len(lines))) AS k, unnest(lines) AS line FROM d))
SELECT doc_id, count(*) AS n_lines, count(gone.k) AS n_deleted,
       coalesce(string_agg(cast(gone.k AS VARCHAR), ',' ORDER BY gone.k), '') AS deleted_lines,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY lines.k) FILTER (gone.k IS NULL), '')) AS text_sha256
FROM lines LEFT JOIN gone USING (doc_id, k) GROUP BY doc_id
"""


op6 = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, 2 * length(text) - length(regexp_replace(text, '[\\\\<>\\[\\]]', '', 'g')) AS text_chars,
    2 * length(role) - length(regexp_replace(role, '[\\\\<>\\[\\]]', '', 'g')) AS role_chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  cast(3 + sum(text_chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE role_chars + 16 END)
       AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_PHRASE_ROWS = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in PHRASES)
_NOTICE_ROWS = ", ".join(f"(list_distinct(string_split('{t}', ' ')), '{label}', ' {mark} ')" for t, label, mark in NOTICES)
_STEP = step_of()
op8 = f"""
WITH phrases(phrase, k, label) AS (VALUES {_PHRASE_ROWS}),
notices(tokens, label, mark) AS (VALUES {_NOTICE_ROWS}),
d AS (SELECT doc_id, text, {WORDS.format('text')} AS w FROM documents),
places AS (
  SELECT doc_id, i, label FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM d), phrases
  WHERE w[i + 1] = split_part(phrase, ' ', 1) AND array_to_string(w[i + 1:i + k], ' ') = phrase),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         list_sort(list_distinct(list(label))) AS labels FROM places GROUP BY doc_id),
lines AS (
  SELECT doc_id, {WORDS.format('line')} AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  UNION ALL SELECT doc_id, w FROM d),
blocks AS (
  SELECT doc_id, list_distinct(b) AS b, ' ' || array_to_string(b, ' ') || ' ' AS x FROM (
    SELECT doc_id, w[a + 1:a + {2 * _STEP}] AS b
    FROM (SELECT doc_id, w, unnest(range(0, len(w), {_STEP})) AS a FROM lines))),
met AS (
  SELECT doc_id, label, common, n FROM (
    SELECT doc_id, label, len(list_intersect(b, tokens)) AS common, len(tokens) AS n
    FROM blocks, notices WHERE contains(x, mark))
  WHERE common >= ceil({THRESHOLD} * n - 1e-9)),
more AS (
  SELECT doc_id, list_distinct(list(label)) AS labels, max(common / n) AS best FROM met GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


def op10(weights: dict[str, int]) -> str:
    """Each source found that is not named has an equal share of the parts of '*', or a turn in '*' if they are many."""
    own = {n: a for n, a in weights.items() if n != "*"}
    named = ", ".join(f"('{n}', {a})" for n, a in sorted(own.items()))
    inside, rest = ", ".join(f"'{n}'" for n in own), weights["*"]
    return f"""
WITH RECURSIVE q AS (
  SELECT doc_id, source, coalesce(source, '*') AS queue FROM documents),
others AS (
  SELECT queue, row_number() OVER (ORDER BY n DESC, queue = '*', queue) - 1 AS i,
    row_number() OVER (ORDER BY md5(queue), queue) - 1 AS turn FROM (
    SELECT queue, count(*) AS n FROM q WHERE queue NOT IN ({inside}) GROUP BY queue)),
size AS (
  SELECT n, {rest} * f AS room, f, n <= least({rest} * f, {MAX_NAMED}) AS split FROM (
    SELECT n, CASE WHEN n = 0 THEN 1 ELSE least(n // gcd(n, {rest}), {MAX_PARTS // sum(weights.values())}) END AS f
    FROM (SELECT count(*) AS n FROM others))),
s AS (SELECT q.*, CASE WHEN split OR queue IN ({inside}) THEN queue ELSE '*' END AS share FROM q, size),
w AS (
  SELECT share, a * CASE WHEN split THEN f ELSE 1 END AS a FROM (VALUES {named}) v(share, a), size
  UNION ALL SELECT queue, room // n + CASE WHEN i < room % n THEN 1 ELSE 0 END FROM others, size WHERE split
  UNION ALL SELECT '*', CASE WHEN n > 0 AND split THEN 1 ELSE {rest} END FROM size
    WHERE NOT split OR NOT EXISTS (SELECT 1 FROM others WHERE queue = '*')),
total AS (SELECT cast(sum(a) AS BIGINT) AS total FROM w),
jobs AS (
  SELECT share, a, j, j * total // a AS release, ((j + 1) * total + a - 1) // a AS deadline
  FROM (SELECT share, a, unnest(range(0, cast(a AS BIGINT))) AS j FROM w), total),
edf(t, done) AS (
  SELECT 0, []::VARCHAR[]
  UNION ALL
  SELECT t + 1, list_append(done, (
    SELECT share || '/' || j FROM jobs
    WHERE release <= t AND NOT list_contains(done, share || '/' || j)
    ORDER BY deadline, share LIMIT 1))
  FROM edf WHERE t < (SELECT total FROM total)),
slots AS (
  SELECT unnest(done) AS job, unnest(range(0, total)) AS slot FROM edf, total WHERE t = total),
period AS (SELECT jobs.*, slot FROM jobs JOIN slots ON job = share || '/' || j),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY queue ORDER BY md5(cast(doc_id AS VARCHAR)), doc_id) - 1 AS r
  FROM s),
blocks AS (
  SELECT ranked.*, r // {BLOCK_DOCS} * CASE WHEN split OR share <> '*' THEN 1 ELSE n END
    + CASE WHEN split OR share <> '*' THEN 0 ELSE turn END AS block
  FROM ranked LEFT JOIN others USING (queue), size)
SELECT doc_id, source, share, block,
       cast(block // a * total + slot AS BIGINT) AS slot,
       cast(block // a * total + release AS BIGINT) AS release,
       cast(block // a * total + deadline AS BIGINT) AS deadline,
       cast(r % {BLOCK_DOCS} AS INTEGER) AS place
FROM blocks JOIN w USING (share) JOIN period USING (share, a), total WHERE block % a = j
"""


# CRC-32 of the decimal digits, bit by bit.
_CRC = """xor(4294967295::BIGINT, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(cast(conv_id AS VARCHAR), ''), lambda x: cast(ascii(x) AS BIGINT))),
    lambda r, x: list_reduce([xor(r, x), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
                             lambda a, b: xor(a // 2, (a % 2) * 3988292384))))"""
op12 = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY n) AS l, cast({_CRC} % {HEADS} AS BIGINT) AS h
      FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, CASE WHEN b.l IS NULL THEN c.l[c.h + 1:] ELSE list_concat(b.l[1:c.h], c.l[c.h + 1:]) END AS s
  FROM c LEFT JOIN c AS b ON b.conv_id = c.conv_id - c.conv_id % {BASES}),
m AS (SELECT conv_id, len(s) AS n, d, s[1:d] AS p FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM r)),
nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(cast(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256,
    CASE WHEN d > 0 THEN len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words
  FROM m GROUP BY d, p),
children AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT a AS d, p[1:a] AS p, sum(leaf) AS n_leaves, sum(saved) AS saved FROM (
    SELECT p, unnest(range(0, d + 1)) AS a, (n IS NULL)::INT AS leaf, (n_convs - 1) * words AS saved
    FROM nodes LEFT JOIN children USING (d, p)) GROUP BY ALL)
SELECT x.conv_id, cast(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs,
  coalesce(children.n, 0) AS n_children, cast(n_leaves AS BIGINT) AS n_leaves, cast(saved AS BIGINT) AS saved_tokens,
  x.ends_sha256
FROM nodes AS x JOIN below ON below.d = x.d AND below.p = x.p
LEFT JOIN children ON children.d = x.d AND children.p = x.p
LEFT JOIN nodes AS up ON up.d = x.d - 1 AND up.p = x.p[1:x.d - 1]
"""
