"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

CHAT = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations),
whole AS (
  SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY pos) AS said FROM t GROUP BY conv_id),
classes AS (
  SELECT said, n_turns, min(conv_id) AS conv_id, count(*) AS copies FROM whole GROUP BY said, n_turns),
prefixes AS (
  SELECT DISTINCT said[1:k] AS said FROM (SELECT said, unnest(range(1, n_turns)) AS k FROM classes))
SELECT conv_id, CAST((t.pos - 1) // 1024 AS INTEGER) AS part, n_turns, copies,
       string_agg('<|' || t.role || '|>' || chr(10) || t.text || chr(10), '' ORDER BY t.pos) AS rendered
FROM classes JOIN t USING (conv_id)
WHERE said NOT IN (SELECT said FROM prefixes)
GROUP BY conv_id, (t.pos - 1) // 1024, n_turns, copies
"""

EXACT = """
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

URLS = """
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
part AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rule, rule_host, rule_path, action) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
fit AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM part JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM part LEFT JOIN fit USING (page_id)
"""

#: Damage, faults, all ways through the role grammar (the cheapest and ASCII-least kept per state and row), rendering.
REPAIR = """
WITH RECURSIVE c AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name, conv_id, turn,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
bits AS (  -- crc32, a byte at a time
  SELECT name, CAST(4294967295 AS BIGINT) AS crc, 0 AS k, hex(encode(name)) AS h FROM (SELECT DISTINCT name FROM c)
  UNION ALL
  SELECT name, list_reduce([xor(crc, CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)), 1, 2, 3, 4, 5, 6, 7, 8],
                           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), k + 1, h
  FROM bits WHERE 2 * k < length(h)),
codes AS (SELECT name, xor(crc, 4294967295) % 20 AS code FROM bits WHERE 2 * k = length(h)),
d AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
  FROM c JOIN codes USING (name) WHERE code <> 0),
n AS (
  SELECT *, row_number() OVER w AS pos, lag(left(role, 1)) OVER w || left(role, 1) AS pair,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS tail
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (
  SELECT *, tail = '' AS blank, tail <> '' AND nth > 1 AS dup,
         tail <> '' AND nth = 1 AND tail NOT IN ('.', '!', '?') AS cut, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM n)),
edits(edit, price) AS (VALUES ('D', 4), ('K', 0), ('R', 3)),
moves(state, said, target) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
added(state, target, more, price) AS (VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 3),
  (1, 2, 'I', 3), (2, 3, 'I', 3), (3, 2, 'I', 3), (0, 3, 'II', 6), (1, 3, 'II', 6)),
steps AS (  -- what a row can do to a state
  SELECT conv, pos, edit, price + CASE WHEN cut AND edit <> 'D' THEN 3 ELSE 0 END AS price, m.state, m.target
  FROM f, edits JOIN moves m ON edit <> 'D'
  WHERE NOT (blank OR dup) AND (edit = 'K' AND left(role, 1) = said OR edit = 'R' AND said <> 's')
  UNION ALL SELECT conv, pos, 'D', 4, s, s FROM f, range(4) AS r(s)),
walk AS (
  SELECT conv, CAST(0 AS BIGINT) AS pos, target AS state, price AS cost, more AS audit
  FROM (SELECT DISTINCT conv FROM f), added WHERE state = 0
  UNION ALL
  SELECT w.conv, w.pos + 1, a.target, w.cost + s.price + a.price, w.audit || s.edit || a.more
  FROM walk w JOIN steps s ON s.conv = w.conv AND s.pos = w.pos + 1 AND s.state = w.state JOIN added a ON a.state = s.target
  QUALIFY row_number() OVER (PARTITION BY w.conv, a.target ORDER BY w.cost + s.price + a.price,
                             w.audit || s.edit || a.more) = 1),
best AS (
  SELECT conv, cost, audit FROM walk JOIN (SELECT conv, max(pos) AS pos FROM f GROUP BY conv) USING (conv, pos)
  WHERE state IN (0, 3) QUALIFY row_number() OVER (PARTITION BY conv ORDER BY cost, audit) = 1),
letters AS (SELECT conv, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS i FROM best),
placed AS (
  SELECT conv, i, edit, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv ORDER BY i) AS pos,
         sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv ORDER BY i) AS place,
         sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv) AS total FROM letters WHERE edit <> ''),
said AS (
  SELECT p.conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - total % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS whole
  FROM placed p LEFT JOIN f ON f.conv = p.conv AND f.pos = p.pos WHERE edit <> 'D' GROUP BY p.conv),
counted AS (
  SELECT conv_id, conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id, conv)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted k ON o.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN best USING (conv) LEFT JOIN said USING (conv)
"""

SCORES = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

AUDIT = """
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM t),
f AS (
  SELECT doc_id, part, CAST(len(words) < 200 AS INTEGER) AS a, CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INTEGER) AS b,
         CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INTEGER) AS c,
         CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER) AS d,
         CAST(coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS INTEGER) AS e FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
m AS (
  SELECT part, CASE WHEN a = 1 THEN 'A' ELSE '' END || CASE WHEN b = 1 THEN 'B' ELSE '' END || CASE WHEN c = 1 THEN 'C' ELSE '' END
         || CASE WHEN d = 1 THEN 'D' ELSE '' END || CASE WHEN e = 1 THEN 'E' ELSE '' END AS fails,
         count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (
  SELECT filter_order, k AS step, filter_order[k] AS letter, left(filter_order, k - 1) AS before
  FROM orders, range(1, 6) AS r(k)),
o AS (
  SELECT part, filter_order, step, letter, sum(CASE WHEN translate(fails, before || letter, '') = fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps, m GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM o
"""

ORACLES: dict[str, str] = {
    "op2_chat_snapshots": CHAT,
    "op3_exact_dedup": EXACT,
    "op10_url_rules": URLS,
    "op11_audit_paths": REPAIR,
    "op12_bit_sliced": SCORES,
    "op13_filter_lattice": AUDIT,
}
