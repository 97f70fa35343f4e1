"""DuckDB SQL for the operators that SQL can express.

Not here: language ID (a fitted model), SimHash and suffix arrays (tested
against brute force in tests/llm), piece ids (tested against the sentencepiece
library), graph searches (measured against exact search) and main text.
"""

from __future__ import annotations

from tempora.llm.secret_scan import BASE, KINDS, WEAK
from tempora.llm.urls import RULES

_WORD = r"[^\x20\x09-\x0D]+"

OP4 = rf"""
WITH quality AS (SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '{_WORD}')), 0)::BIGINT AS size,
         coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, '')) || ':' ||
                  (row_number() OVER (PARTITION BY d.doc_id, d.source, md5(coalesce(d.text, ''))) - 1)) AS name,
         -ln((('0x' || substr(md5('mix:' || name), 1, 12))::BIGINT + 1)::DOUBLE / 281474976710657.0)
           / (CASE WHEN q.q IS NULL THEN 1.0 WHEN q.q > 0 THEN 2.0 ELSE 0.5 END)::DOUBLE AS k
  FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
                  source_size * 2.0::DOUBLE AS cap FROM src),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
goals AS (
  SELECT source, source_size, CASE WHEN cap <= level * w THEN cap
         ELSE (max(CASE WHEN cap > level * w THEN level END) OVER ()) * w END AS target FROM levels),
runs AS (
  SELECT s.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS epochs,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS run
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, source,
       (epochs + CASE WHEN target - epochs * source_size > 0 AND run - size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END)::INT AS copies,
       ((epochs + CASE WHEN target - epochs * source_size > 0 AND run - size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM runs
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _host(url: str) -> str:
    return _LOWER.format(f"coalesce(regexp_extract({url}, '://([^/?#]*)', 1), '')")


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '')"


def _node(url: str) -> str:
    return (f"CASE WHEN contains({url}, '://') THEN '://' || {_host(url)} || {_path(url)} || "
            f"regexp_extract({url}, '://[^/?#]*[^?#]*(\\?[^#]*)?', 1) END")


def _value(name: str) -> str:
    pattern = rf"(?i)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)".replace("'", "''").replace('\\"', '"')
    return f"trim(regexp_extract(tag, '{pattern}', 1), '\"'' ')"


OP6 = f"""
WITH RECURSIVE rules(r_host, r_path, r_verdict) AS (VALUES {', '.join(str(r) for r in RULES)}),
tags AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html,
      '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'), '(?i)<(?:link|meta)\\b[^>]*>')) AS tag
  FROM pages WHERE contains(url, '://') AND regexp_matches(html, '(?i)canonical|http-equiv')),
goals AS (
  SELECT url, replace(CASE
      WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(lower({_value('rel')}), '(?:^|\\s)canonical(?:\\s|$)') THEN {_value('href')}
      WHEN regexp_matches(tag, '(?i)^<meta') AND lower({_value('http-equiv')}) = 'refresh'
      THEN regexp_extract({_value('content')}, '(?i)url\\s*=\\s*[''"]?([^''"]+)', 1) END, '&amp;', '&') AS goal FROM tags),
ends AS (
  SELECT url, CASE
      WHEN regexp_matches(goal, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN goal
      WHEN starts_with(goal, '//') THEN ':' || goal
      WHEN starts_with(goal, '/') THEN '://' || {_host('url')} || goal
      WHEN starts_with(goal, '?') THEN '://' || {_host('url')} || {_path('url')} || goal
      WHEN starts_with(goal, '#') THEN url
      ELSE '://' || {_host('url')} || regexp_extract({_path('url')}, '^(.*/)?') || goal END AS dest
  FROM goals WHERE goal <> ''),
edges AS (SELECT DISTINCT u, v FROM (SELECT {_node('url')} AS u, {_node('dest')} AS v FROM ends) WHERE u <> v),
both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
reach(a, b) AS (SELECT u, u FROM both_ways UNION SELECT r.a, e.v FROM reach r JOIN both_ways e ON r.b = e.u),
sites AS (SELECT DISTINCT {_host('x')} AS host, {_path('x')} AS path FROM (SELECT url AS x FROM pages UNION SELECT a FROM reach)),
ruled AS (
  SELECT host, path, r_host || r_path AS rule, r_verdict FROM sites JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(r_host || r_path) DESC, length(r_host) DESC, r_verdict) = 1),
passed AS (
  SELECT a, CASE WHEN bool_or(r_verdict = 'allow') THEN 'allow' WHEN bool_or(r_verdict = 'block') THEN 'block' END AS passed
  FROM reach LEFT JOIN ruled ON {_host('b')} = ruled.host AND {_path('b')} = ruled.path GROUP BY a)
SELECT p.page_id, {_host('p.url')} AS host, {_path('p.url')} AS path, r.rule, coalesce(r.r_verdict, x.passed, 'allow') AS verdict
FROM pages p LEFT JOIN ruled r ON {_host('p.url')} = r.host AND {_path('p.url')} = r.path LEFT JOIN passed x ON {_node('p.url')} = x.a
"""


def _kind(k: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    more = "AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[0-9]')" if kind == "weak_key" else ""
    return f"""SELECT rid, {k} AS k, stop - length(hit) AS start, stop FROM (
      SELECT rid, hit, val, sum(length(piece) + length(coalesce(hit, ''))) OVER (PARTITION BY rid ORDER BY n) AS stop
      FROM (SELECT rid, unnest(string_split_regex(text, '{p}')) AS piece, unnest(regexp_extract_all(text, '{p}', 0)) AS hit,
                   unnest(regexp_extract_all(text, '{p}', {group})) AS val, generate_subscripts(string_split_regex(text, '{p}'), 1) AS n FROM texts))
    WHERE hit IS NOT NULL AND length(val) >= {least} {more}"""


_NAMES = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
_LIST = "coalesce(string_agg({n}[k + 1] || ':' || start || ':' || stop, ',' ORDER BY start, k) {{}}, '')".format(n=_NAMES)

OP7 = f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({' UNION ALL '.join(_kind(k, *x) for k, x in enumerate(BASE + WEAK))}),
outside AS (
  SELECT * FROM (SELECT *, coalesce(max(CASE WHEN k < 3 THEN stop END) OVER (
      PARTITION BY rid ORDER BY start RANGE UNBOUNDED PRECEDING), 0) AS reached FROM parts) WHERE k < 3 OR reached < stop),
gaps AS (
  SELECT *, start - max(CASE WHEN k IN (1, 3) THEN stop END) OVER upto AS id_before, min(CASE WHEN k IN (1, 3) THEN start END) OVER onward - stop AS id_after,
         start - max(CASE WHEN k IN (0, 2, 4) THEN stop END) OVER upto AS key_before, min(CASE WHEN k IN (0, 2, 4) THEN start END) OVER onward - stop AS key_after
  FROM outside WINDOW upto AS (PARTITION BY rid ORDER BY start RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                      onward AS (PARTITION BY rid ORDER BY start RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
linked AS (SELECT *, coalesce(least(id_before, id_after) <= 200, false) AS ids, coalesce(least(key_before, key_after) <= 200, false) AS keys FROM gaps),
spans AS (SELECT * FROM linked WHERE k < 3 OR (k = 4 AND ids) OR (k = 3 AND keys) OR (k = 5 AND ids AND keys)),
found AS (
  SELECT rid, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
         {_LIST.format('FILTER (WHERE k < 3)')} AS base, {_LIST.format('')} AS spans, count(*) FILTER (WHERE k >= 3) AS n_linked
  FROM spans GROUP BY rid)
SELECT t.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0)::BIGINT AS n_linked
FROM texts t LEFT JOIN found f ON t.rid = f.rid
"""

# 40 hex digits of a SHA-1 as 32 letters of base32: each 5 digits are 20 bits, hence 4 letters
OP12 = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
         max(page_id) OVER (PARTITION BY body) AS newest
  FROM p),
letters AS (
  SELECT body, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                 1 + ((('0x' || substr(sha1(body), 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))) & 31), 1), '' ORDER BY i) AS b32
  FROM (SELECT DISTINCT body FROM p) CROSS JOIN (SELECT unnest(range(32))::INTEGER AS i) GROUP BY body)
SELECT page_id, strlen(r.body)::BIGINT AS payload_bytes, b32 AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN newest END AS refers_to
FROM ranked r JOIN letters l ON r.body = l.body
"""

# crc32 by the usual table of 256 remainders, made from its polynomial
OP13 = """
WITH told AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT c, length(body)::BIGINT AS chars, sha256(length(role)::VARCHAR || ':' || role || body) AS token,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || body)) AS pos
  FROM told),
remainders AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, (r & 1) * 3988292384)) AS v
    FROM (SELECT unnest(range(256)) AS i))),
ids AS (
  SELECT c, c - c % 100 AS base,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                                     lambda r, x: xor(r >> 8, t[1 + (xor(r, x) & 255)]))) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns), remainders),
parts AS (
  SELECT ids.c, 0 AS part, pos, token, chars FROM ids JOIN turns ON turns.c = base AND pos <= h
  UNION ALL SELECT ids.c, 1, pos, token, chars FROM ids JOIN turns ON turns.c = ids.c AND pos > h),
deep AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth FROM parts),
steps AS (
  SELECT c, depth, chars, string_agg(token, ',') OVER (PARTITION BY c ORDER BY depth) AS path FROM deep
  UNION ALL SELECT c, 0, 0, '' FROM ids),
linked AS (SELECT *, lag(path) OVER w AS up, lead(depth) OVER w IS NULL AS last FROM steps WINDOW w AS (PARTITION BY c ORDER BY depth)),
nodes AS (
  SELECT depth, path, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
  FROM linked GROUP BY depth, path),
families AS (SELECT up AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up),
whole AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN families ON nodes.path = families.path),
below AS (
  SELECT s.depth, s.path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * w.chars) AS saved_tokens
  FROM whole w JOIN steps s ON s.c = w.conv_id AND s.depth <= w.depth GROUP BY s.depth, s.path)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM whole w JOIN below b ON w.path = b.path AND w.depth = b.depth LEFT JOIN whole p ON w.depth > 0 AND p.path = w.up AND p.depth = w.depth - 1
"""

ORACLE: dict[str, str] = {
    "op4_mix_sources": OP4,
    "op6_url_filter": OP6,
    "op7_secret_scan": OP7,
    "op12_warc": OP12,
    "op13_prefix_trie": OP13,
}
