"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

from rillstone.llm.chat import CONTENT, END, START
from rillstone.llm.secrets import ACCESS, ASSIGN, CANDIDATE, HEX, LIMITS, WINDOW

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _spans(pattern: str, kind: int) -> str:
    """(start, kind, end, value) of each match; the pieces between matches give the places."""
    quoted = pattern.replace("'", "''")
    return f"""(SELECT coalesce(list({{'s': g + f - length(v), 'k': {kind}, 'e': g + f, 'v': v}}), []) FROM (
      SELECT found[i] AS v, list_sum(list_transform(gaps[1:i], lambda x: length(x))) AS g, list_sum(list_transform(found[1:i], lambda x: length(x))) AS f
      FROM (SELECT string_split_regex(t, '{quoted}') AS gaps, regexp_extract_all(t, '{quoted}') AS found), unnest(range(1, len(found) + 1)) AS r(i)))"""


def _names(spans: str) -> str:
    return f"list_aggregate(list_transform({spans}, lambda x: ['assign', 'access', 'hex', 'entropy'][x.k + 1] || ':' || x.s || ':' || x.e), 'string_agg', ',')"


def _count(kind: int) -> str:
    return f"CAST(len(list_filter(base, lambda x: x.k = {kind})) AS BIGINT)"


_ASSIGN_SQL = ASSIGN.replace("'", "''")
SECRETS = rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
  found AS (SELECT doc_id, list_filter({_spans(ASSIGN, 0)}, lambda x: length(regexp_extract(x.v, '{_ASSIGN_SQL}', 2)) >= 6) AS a,
    {_spans(ACCESS, 1)} AS c, {_spans(HEX, 2)} AS h, {_spans(CANDIDATE, 3)} AS p FROM t),
  based AS (SELECT doc_id, list_concat(list_concat(a, c), h) AS base, p FROM found),
  added AS (SELECT doc_id, base, list_filter(p, lambda x: len(list_filter(base, lambda b: b.s < x.e AND x.s < b.e)) = 0
    AND regexp_matches(x.v, '[0-9]') AND regexp_matches(x.v, '[A-Za-z]')
    AND NOT regexp_full_match(x.v, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}')
    AND NOT regexp_matches(x.v, 'EXAMPLE|0123456789|abcdefghij|ABCDEFGHIJ') AND replace(x.v, x.v[1], '') <> ''
    AND NOT regexp_full_match(x.v, '[a-z]+([-_/][a-z]+)*[-_/]?[0-9]{{0,4}}')
    AND list_max(list_transform(range(1, length(x.v) - {WINDOW} + 2), lambda i: list_aggregate(string_split(x.v[i:i + {WINDOW} - 1], ''), 'entropy')))
      >= CASE WHEN regexp_full_match(x.v, '[0-9a-fA-F]+') THEN {LIMITS['hex']} ELSE {LIMITS['base64']} END) AS more FROM based)
SELECT doc_id, {_count(0)} AS n_assign, {_count(1)} AS n_access, {_count(2)} AS n_hex,
  sha256(coalesce({_names('list_sort(base)')}, '')) AS base_sha256,
  coalesce({_names('list_sort(list_concat(base, more))')}, '') AS spans FROM added"""

CHAT = rf"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(START + CONTENT + END)} + length(role) + length(text) + len(regexp_extract_all(text, '<\||</?s>|\[/?INST\]|\\'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""

JACCARD = rf"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
  links AS (SELECT x, y FROM shared JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y WHERE 100 * i >= 85 * (p.n + q.n - i)),
  reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.y) AS component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN reach ON reach.x = doc_id GROUP BY doc_id"""

DECONTAMINATION = f"""WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN} AS w FROM benchmark),
  win AS (SELECT DISTINCT item, unnest(CASE WHEN len(w) >= 10 THEN list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM b),
  places AS (SELECT doc_id, i, n, w[i:i + n - 1] AS g FROM d, (SELECT DISTINCT len(g) AS n FROM win), unnest(range(1, len(w) - n + 2)) AS r(i)),
  hit AS (SELECT DISTINCT doc_id, i, n, item FROM places JOIN win USING (g)),
  words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

HARD_NEGATIVES = """WITH v AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scored AS (SELECT a.id AS anchor, a.label AS own, b.id, b.label, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v AS a JOIN v AS b ON a.id % 100 = 0 AND a.id <> b.id),
  pos AS (SELECT anchor, own, id, score FROM scored WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM pos AS p JOIN scored AS s ON s.anchor = p.anchor AND s.label <> p.own AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10"""

_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda acc, x: list_reduce(list_prepend(xor(acc, x), list_transform(range(8), lambda i: CAST(0 AS BIGINT))),
      lambda r, i: xor(r >> 1, CASE WHEN r % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END))), CAST(4294967295 AS BIGINT))"""
PREFIXES = rf"""WITH t AS (SELECT CAST(conv_id AS BIGINT) AS c,
    list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
  h AS (SELECT c, s, c - c % 20 AS d, {_CRC32} % 4 AS h FROM t),
  b AS (SELECT h.c, list_concat(coalesce(t.s[1:h.h], []), h.s[h.h + 1:]) AS s FROM h LEFT JOIN t ON t.c = h.d),
  p AS (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM b),
  n AS (SELECT d, s[1:d] AS k, count(*) AS n, min(c) AS c,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '') AS ends,
    len(list_filter(string_split_regex(coalesce(any_value(s[d].t), ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words FROM p GROUP BY 1, 2),
  kids AS (SELECT k[1:d - 1] AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
  m AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN kids USING (k)),
  up AS (SELECT k[1:u] AS k, kids = 0 AS leaf, (n - 1) * CASE WHEN d = 0 THEN 0 ELSE words END AS gain
    FROM (SELECT *, unnest(range(d + 1)) AS u FROM m)),
  sums AS (SELECT k, count(*) FILTER (leaf) AS leaves, CAST(sum(gain) AS BIGINT) AS saved FROM up GROUP BY k)
SELECT m.c AS conv_id, m.d AS depth, par.c AS parent_conv_id, m.n AS n_convs, m.kids AS n_children, leaves AS n_leaves, saved AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN sums USING (k) LEFT JOIN n AS par ON m.d > 0 AND par.k = m.k[1:m.d - 1]"""
