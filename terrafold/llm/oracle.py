"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, no, list_extract(parts, no) AS raw, len(parts) AS n
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS no
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))),
norm AS (SELECT *, lower(trim(raw, ' ')) AS line FROM lines),
firsts AS (SELECT line, min({'d': doc_id, 'n': no}) AS place FROM norm WHERE line <> '' GROUP BY line),
halves AS (
  SELECT DISTINCT line, place, unnest([
    'a' || left(line, (length(line) // 2)::INT), 'z' || right(line, (length(line) // 2)::INT),
    'a' || left(line, ((length(line) - 1) // 2)::INT), 'z' || right(line, ((length(line) - 1) // 2)::INT)]) AS half
  FROM firsts WHERE length(line) >= 20),
near AS (SELECT DISTINCT b.line FROM halves a JOIN halves b ON a.half = b.half
         WHERE a.line <> b.line AND a.place < b.place AND abs(length(a.line) - length(b.line)) <= 1 AND levenshtein(a.line, b.line) <= 1),
marked AS (
  SELECT m.doc_id, m.no, m.raw, m.n,
         m.line <> '' AND (near.line IS NOT NULL OR {'d': m.doc_id, 'n': m.no} <> f.place) AS gone
  FROM norm m LEFT JOIN firsts f ON f.line = m.line LEFT JOIN near ON near.line = m.line)
SELECT doc_id, max(n)::INT AS n_lines, count(*) FILTER (WHERE gone)::INT AS n_dropped,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (WHERE NOT coalesce(gone, false)), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE["op3_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE["op7_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             CASE (r - 1) % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END AS slope,
             2.0::DOUBLE * source_size AS most FROM s),
f AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                 - coalesce(sum(most) OVER (ORDER BY most / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY most / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (SELECT *, min({'a': most / weight, 'r': r, 'l': level}) FILTER (WHERE level * weight <= most) OVER () AS o FROM f),
t AS (SELECT source, source_size, slope, coalesce(least(most, o.l * weight), most) AS target FROM g),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(concat_ws('|', CAST(doc_id AS VARCHAR), source, CAST(size AS VARCHAR))), doc_id, size
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle FROM d),
x AS (SELECT p.doc_id, p.size, t.source_size, t.target, p.middle, t.slope,
             CASE WHEN p.size > 0 THEN greatest(0, floor((t.target - p.middle) / t.source_size) + 1) ELSE 0 END AS epochs
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
y AS (SELECT *, least(1, middle / target) AS s0, least(1, (middle + (epochs - 1) * source_size) / target) AS s1 FROM x)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(size * epochs AS BIGINT) AS taken, CAST(epochs AS INT) AS epochs,
       CASE WHEN epochs > 0 THEN round(2 * s0 / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * s0)), 6) END AS first_position,
       CASE WHEN epochs > 0 THEN round(2 * s1 / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * s1)), 6) END AS last_position
FROM y
"""

ORACLE["op8_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (SELECT doc_id AS u, doc_id AS r FROM documents UNION SELECT reach.u, l.v FROM reach JOIN l ON l.u = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON reach.u = d.doc_id GROUP BY d.doc_id, n.n
"""

ORACLE["op9_url_rules"] = r"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
        FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
m AS (SELECT u.*, fit.rule, fit.verdict AS ruled,
             (SELECT x FROM (VALUES ('*casino-win.*'), ('*cheap-pills.*'), ('*free-bets.*'), ('*spam-farm.*'), ('*ads-track.*'), ('*adult-x.*')) t(x)
              WHERE contains(host || path, replace(x, '*', '')) ORDER BY length(x) DESC, x LIMIT 1) AS pattern
      FROM u LEFT JOIN fit USING (page_id))
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       coalesce(rule, pattern) AS matched FROM m
"""

ORACLE["op12_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS h FROM documents),
k AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS k1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS k2,
             ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM d),
c AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 100 THEN 'plain'
                     WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(u[1:least(k1, k2)], '') AS p, array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], '') AS m,
             array_to_string(u[greatest(k1, k2) + 1:], '') AS s FROM k)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM c
"""

ORACLE["op13_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
k AS (SELECT lang, term FROM (SELECT DISTINCT id, lang, term FROM w) GROUP BY ALL HAVING count(*) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
a AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, CAST(1 + (1000000000 * (n + 1)) // (sum(n) OVER o + count(*) OVER o) AS BIGINT) AS p
      FROM a WINDOW o AS (PARTITION BY lang, source)),
l AS (SELECT lang, term, CAST(1 + (1000000000 * (n + 1)) // (sum(n) OVER o + count(*) OVER o) AS BIGINT) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM a GROUP BY ALL) WINDOW o AS (PARTITION BY lang)),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
      FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
      UNION ALL
      SELECT p.lang, p.source, 'term', p.term, (p.p - l.q) * (p.p - l.q) // l.q FROM p JOIN l USING (lang, term) WHERE p.n > 0 AND p.p > l.q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM y QUALIFY part = 'pair' OR rank <= 200
"""
