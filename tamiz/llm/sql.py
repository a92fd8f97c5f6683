"""DuckDB SQL for the queries that SQL can express; each restates the contract, not the method."""

from __future__ import annotations

from .licenses import HEADER_LINES, HEADER_STARTS, NOTICE_LINES, TEMPLATES, TEXTS
from .url_filter import TRACKING

_HOST = r"translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

_QUERY = r"coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '')"

URL_FILTER = rf"""
WITH p AS (
  SELECT page_id, url, coalesce({_HOST}, '') AS host, coalesce({_PATH}, '') AS path FROM pages),
c AS (SELECT *, CASE WHEN host <> '' THEN concat(regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)?$', ''),
    regexp_replace(path, '(\.html)?/*$', ''), CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END) END AS canon
  FROM (SELECT *, list_sort(list_filter(string_split({_QUERY}, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))) AS kept FROM p)),
listed AS (SELECT DISTINCT canon FROM c WHERE contains(url, 'utm_source=') AND canon IS NOT NULL),
rules(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(v, length(rhost || rpath)) AS v
  FROM c JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT c.page_id, host, path, rule,
  coalesce(v, CASE WHEN listed.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN fit USING (page_id) LEFT JOIN listed ON c.canon = listed.canon"""

_VALUES = ", ".join(f"({i}, '{name}', '{text}', {i < len(TEMPLATES)})" for i, (name, text) in enumerate([*TEMPLATES, *TEXTS]))
_TOKENS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')"

LICENSES = rf"""
WITH files AS (SELECT doc_id, text, concat_ws('/', source, doc_id // 1000,
    CASE WHEN doc_id % 1000 = 0 THEN 'LICENSE' WHEN doc_id % 50 = 0 THEN concat(doc_id // 50, '/LICENSE')
    ELSE concat(doc_id // 50, '/', doc_id, '.txt') END) AS path FROM documents),
ln AS (SELECT doc_id, path, list_filter(list_transform(string_split(text, chr(10)), lambda x: {_TOKENS.format('x')}), lambda t: len(t) > 0) AS ls
  FROM files WHERE text IS NOT NULL),
l AS (SELECT unnest(ls) AS toks FROM ln),
tpl(id, license, text, short) AS (VALUES {_VALUES}),
tt AS (SELECT id, license, short, unnest({_TOKENS.format('text')}) AS token FROM tpl),
tc AS (SELECT id, license, short, token, count(*) AS n FROM tt GROUP BY ALL),
df AS (SELECT token, count(*) AS d FROM (SELECT unnest(list_distinct(toks)) AS token FROM l) WHERE token IN (SELECT token FROM tc) GROUP BY token),
total AS (SELECT count(*) AS lines FROM l),
idf AS (SELECT DISTINCT tc.token, ln((1 + lines) / (1 + coalesce(d, 0))) + 1 AS idf FROM tc LEFT JOIN df USING (token), total),
win AS (SELECT path, true AS short, ls[i:i + n - 1] AS w FROM (SELECT path, ls, unnest(range(1, len(ls) + 1)) AS i FROM ln), range(1, {NOTICE_LINES + 1}) x(n)
    WHERE i + n - 1 <= len(ls)
  UNION ALL SELECT path, false, ls[i:i + n - 1] FROM ln, range(1, {HEADER_STARTS + 1}) y(i), (SELECT unnest({list(HEADER_LINES)}) AS n) WHERE i <= len(ls)
  UNION ALL SELECT path, false, ls FROM ln WHERE path LIKE '%/LICENSE' AND len(ls) > 0),
unit AS (SELECT row_number() OVER () AS line, path, short, flatten(w) AS toks FROM win),
-- a unit needs terms of a template; the others cannot reach the threshold
cand AS (SELECT * FROM unit WHERE len(list_intersect(toks, (SELECT list(DISTINCT token) FROM tc))) > 0),
tf AS (SELECT line, path, short, token, count(*) AS n FROM (SELECT line, path, short, unnest(toks) AS token FROM cand) GROUP BY ALL),
w AS (SELECT line, path, short, token, n * coalesce(idf, ln(1 + lines) + 1) AS w FROM tf LEFT JOIN idf USING (token), total),
norm AS (SELECT line, path, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL),
tw AS (SELECT id, license, short, token, n * idf AS x FROM tc JOIN idf USING (token)),
tn AS (SELECT id, sqrt(sum(x * x)) AS tnorm FROM tw GROUP BY id),
s AS (SELECT norm.path, license, round(sum(w * x / tnorm) / norm, 6) AS score
  FROM w JOIN tw USING (token, short) JOIN tn USING (id) JOIN norm USING (line) GROUP BY line, norm.path, id, license, norm),
own AS (SELECT path, arg_min(license, (-score, license)) AS license, max(score) AS score FROM s WHERE score >= 0.8 GROUP BY path),
place AS (SELECT regexp_replace(path, '/LICENSE$', '') AS dir, license FROM own WHERE path LIKE '%/LICENSE'),
up AS (SELECT path, license, dir, row_number() OVER (PARTITION BY path ORDER BY length(dir) DESC) AS r
  FROM files JOIN place ON starts_with(path, dir || '/'))
SELECT files.path, coalesce(own.license, up.license) AS license, own.score,
  CASE WHEN own.license IS NOT NULL THEN 'own' WHEN up.license IS NOT NULL THEN 'directory' ELSE 'none' END AS via,
  CASE WHEN own.license IS NULL THEN dir END AS found_in
FROM files LEFT JOIN own USING (path) LEFT JOIN (SELECT * FROM up WHERE r = 1) up ON files.path = up.path"""

_FINE = "len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"

EMBEDDING_DEDUP = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_FINE}
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS e FROM v),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)"""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS m FROM g GROUP BY h),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM g JOIN f USING (h) WHERE m < doc_id),
o AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
k AS (SELECT o.doc_id, count(*) FILTER (c.pos IS NOT NULL) AS n_removed,
    string_agg(word, ' ' ORDER BY o.pos) FILTER (c.pos IS NULL) AS kept
  FROM o LEFT JOIN c ON o.doc_id = c.doc_id AND o.pos = c.pos GROUP BY o.doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)"""

TOPK = f"""
WITH v AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND {_FINE}),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.e) = len(x.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

#: CRC-32 (reversed polynomial 0xEDB88320) of the bytes that a list of two-digit hex strings names.
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(range(8),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"""

SHARDING = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS tab),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT doc_id, text, md5(text) AS key, octet_length(encode(text)) + 16 AS size, row_number() OVER w - 1 AS idx,
    sum(octet_length(encode(text)) + 16) OVER w - octet_length(encode(text)) - 16 AS start
  FROM d WINDOW w AS (ORDER BY md5(text), doc_id ROWS UNBOUNDED PRECEDING)),
t AS (SELECT sum(size) AS total FROM o),
m AS (SELECT o.*, least(39, (2 * start + size) * 40 // (2 * total)) AS own FROM o, t),
cut AS (SELECT i, (SELECT count(*) FROM m WHERE own < i) AS c FROM range(1, 40) x(i)),
g AS (SELECT key, min(idx) AS first, count(*) AS n, min(start) AS start, sum(size) AS bytes FROM o GROUP BY key),
edge AS (SELECT i, CASE WHEN g.key IS NULL OR bytes * 40 > 0.02 * total THEN c
    WHEN (2 * g.start + bytes) * 40 < 2 * total * i THEN first + n ELSE first END AS c
  FROM cut LEFT JOIN g ON first < c AND c < first + n, t),
s AS (SELECT o.*, (SELECT count(*) FROM edge WHERE c <= idx) AS shard FROM o)
SELECT doc_id, CAST(size AS BIGINT) AS size, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'),
    lambda x: CAST('0x' || x AS BIGINT)), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32,
  'bytes' AS law, CAST(shard AS INTEGER) AS shard, CAST(idx - coalesce((SELECT max(c) FROM edge WHERE i = shard), 0) AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM s, crc"""

HARD_NEGATIVES = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_FINE}),
s AS (SELECT q.vec_id AS anchor_id, x.vec_id, x.label = q.label AS same, CAST(list_inner_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.e) = len(x.e) WHERE q.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
r AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5"""
