"""SQL for DuckDB that gives the rows of the registered queries that SQL can express, by the plainest way there is."""

# one level for all sources that are not bound; the first few in the order of bound over weight are
OP6 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, md5('mix' || coalesce('=' || source, '-')) AS digest
  FROM sized GROUP BY source
),
weighed AS (
  SELECT *, source_size * 3 AS bound, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sources
),
ranked AS (
  SELECT *, row_number() OVER w AS k, sum(bound) OVER w - bound AS bound_before, sum(weight) OVER () - sum(weight) OVER w + weight AS weight_left,
    sum(source_size) OVER () AS total
  FROM weighed WINDOW w AS (ORDER BY bound / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
),
levels AS (
  SELECT arg_min(level, k) AS level FROM (
    SELECT k, CAST(total - bound_before AS DOUBLE) / CAST(weight_left AS DOUBLE) AS level, bound, weight FROM ranked
  ) WHERE weight * level <= bound
),
targets AS (
  SELECT source, source_size, least(level * CAST(weight AS DOUBLE), CAST(bound AS DOUBLE)) AS target,
    (CAST(CAST('0x' || substr(digest, 1, 4) AS INTEGER) AS DOUBLE) + 0.5) / 65536 AS shift
  FROM weighed, levels
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS place FROM sized
)
SELECT doc_id, size, source_size, target,
  CAST(coalesce(floor(CAST(place + 1 AS DOUBLE) * target / nullif(CAST(source_size AS DOUBLE), 0) + shift)
    - floor(CAST(place AS DOUBLE) * target / nullif(CAST(source_size AS DOUBLE), 0) + shift), 0) AS BIGINT) * size AS taken
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
"""

# all pairs that share a shingle; equal sets are one class, so that copies make no pairs
OP9 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM worded
),
digests AS MATERIALIZED (SELECT doc_id, len(s) AS n, md5(array_to_string(s, chr(10))) AS h FROM sets),
classes AS MATERIALIZED (SELECT h, any_value(n) AS n, min(doc_id) AS doc_id FROM digests WHERE n > 0 GROUP BY h),
items AS MATERIALIZED (
  SELECT h, n, unnest(s) AS shingle FROM classes JOIN sets USING (doc_id)
),
shared AS (
  SELECT a.h AS a, b.h AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.h < b.h GROUP BY a.h, b.h
),
near AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * common >= 80 * (na + nb - common)),
links AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (
  SELECT h AS a, h AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT reach.a AS h, min(doc_id) AS component_id FROM reach JOIN classes ON reach.b = classes.h GROUP BY reach.a)
SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id
FROM digests LEFT JOIN least USING (h)
"""

# Aliases are followed where a page names them by a whole URL. Resolving relative ones is left to the tests.
OP10 = r"""
WITH RECURSIVE rules(rh, rp, rv) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
tags AS (
  SELECT url, regexp_extract(html, '(?is)<link\s[^<>]*rel\s*=\s*["'']?canonical["''\s>][^<>]*>?') AS link,
    regexp_extract(html, '(?is)<meta\s[^<>]*http-equiv\s*=\s*["'']?refresh["''\s>][^<>]*>?') AS meta FROM pages
),
named AS (
  SELECT url, regexp_extract(link, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1) AS target FROM tags
  UNION ALL SELECT url, regexp_extract(meta, '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1) FROM tags
),
edges AS MATERIALIZED (
  SELECT regexp_extract(url, '(?s)^.*?://[^#]*') AS a, regexp_extract(replace(target, '&amp;', '&'), '(?s)^.*?://[^#]*') AS b
  FROM named WHERE contains(url, '://') AND contains(target, '://')
),
both_ways AS MATERIALIZED (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
nodes AS (
  SELECT regexp_extract(url, '(?s)^.*?://[^#]*') AS node FROM pages WHERE contains(url, '://') UNION SELECT b FROM edges
),
parts AS MATERIALIZED (
  SELECT node, translate(regexp_extract(node, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(node, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM nodes
),
ruled AS MATERIALIZED (
  SELECT node, max({'n': length(rh || rp), 'rule': rh || rp, 'verdict': rv}) AS best
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY node
),
reach AS (
  SELECT DISTINCT a, a AS b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
),
by_alias AS (SELECT reach.a AS node, min(best.verdict) AS verdict FROM reach JOIN ruled ON reach.b = ruled.node GROUP BY reach.a)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, best.rule AS rule,
  coalesce(best.verdict, by_alias.verdict, 'allow') AS verdict
FROM pages
LEFT JOIN parts ON contains(url, '://') AND parts.node = regexp_extract(url, '(?s)^.*?://[^#]*')
LEFT JOIN ruled ON parts.node = ruled.node LEFT JOIN by_alias ON parts.node = by_alias.node
"""

# Levels one by one; every leaf then walks up its group's tree and the tree of subroots. The checksum goes bit by bit.
OP11 = r"""
WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER () AS rid, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END),
    4294967295::BIGINT) AS crc FROM documents
),
fields AS (
  SELECT rid, doc_id, coalesce('=' || lang, '-') AS g, crc % 7 = 0 AND n_chars IS NOT NULL AS touched,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS size,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS other_size,
    coalesce(strlen(text) || ':' || text, '-') AS body FROM numbered
),
leaves AS MATERIALIZED (
  SELECT rid, doc_id, g, sha256(head || size || body) AS leaf,
    CASE WHEN touched THEN sha256(head || other_size || body) ELSE sha256(head || size || body) END AS start FROM fields
),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY g) AS n FROM leaves
),
nodes(g, level, idx, n, h) AS (
  SELECT g, 0, place, n, leaf FROM placed
  UNION ALL SELECT g, level + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY g, level, idx // 2
),
stored AS MATERIALIZED (SELECT * FROM nodes),
subroots AS MATERIALIZED (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM stored WHERE n = 1
),
tops(level, idx, n, h) AS (
  SELECT 0, place, n, h FROM subroots
  UNION ALL SELECT level + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY level, idx // 2
),
stored_tops AS MATERIALIZED (SELECT * FROM tops),
walk(rid, g, level, idx, n, h, proof) AS (
  SELECT rid, g, 0, place, n, start, '' FROM placed
  UNION ALL SELECT w.rid, w.g, w.level + 1, w.idx // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.idx % 2 = 0 THEN w.h || s.h ELSE s.h || w.h END), w.proof || coalesce(s.h, '')
  FROM walk w LEFT JOIN stored s ON s.g = w.g AND s.level = w.level AND s.idx = xor(w.idx, 1) WHERE w.n > 1
),
on_top(rid, level, idx, n, h, proof) AS (
  SELECT rid, 0, place, subroots.n, walk.h, proof FROM walk JOIN subroots USING (g) WHERE walk.n = 1
  UNION ALL SELECT w.rid, w.level + 1, w.idx // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.idx % 2 = 0 THEN w.h || s.h ELSE s.h || w.h END), w.proof || coalesce(s.h, '')
  FROM on_top w LEFT JOIN stored_tops s ON s.level = w.level AND s.idx = xor(w.idx, 1) WHERE w.n > 1
)
SELECT doc_id, leaf, subroots.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, o.h AS folded_root, o.h = t.h AS verified
FROM placed JOIN subroots USING (g) JOIN (SELECT * FROM on_top WHERE n = 1) o USING (rid), (SELECT h FROM stored_tops WHERE n = 1) t
"""

SQL = {"op6_mixing": OP6, "op9_jaccard_join": OP9, "op10_url_filter": OP10, "op11_manifest": OP11}
