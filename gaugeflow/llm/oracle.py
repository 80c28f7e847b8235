"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
m AS (SELECT doc_id AS page_id, count(quality) AS n,
    count(*) FILTER (quality = 1 AND coalesce(toxic, 0) = 0) AS k FROM labels GROUP BY doc_id),
h0 AS (SELECT host, sum(coalesce(n, 0))::BIGINT AS n, sum(coalesce(k, 0))::BIGINT AS k FROM u LEFT JOIN m USING (page_id) GROUP BY host),
h1 AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM h0),
h2 AS (SELECT *, string_split(bare, '.') AS l, regexp_matches(bare, '^[0-9.]*$') OR starts_with(bare, '[') AS addr FROM h1),
h3 AS (SELECT *, array_to_string(l[-2:], '.') AS two FROM h2),
h4 AS (SELECT *, two IN ('ac.uk','co.in','co.jp','co.nz','co.uk','co.za','com.au','com.br','com.cn','com.mx','gov.uk','ne.jp','net.au','or.jp','org.au','org.uk') AS dbl FROM h3),
h AS (SELECT host, n, k,
    CASE WHEN addr THEN '' WHEN dbl THEN two ELSE l[-1] END AS suffix,
    CASE WHEN addr THEN bare WHEN dbl THEN array_to_string(l[-3:], '.') ELSE two END AS domain FROM h4),
d AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM h GROUP BY ALL),
kids AS (
  SELECT 'host' AS level, domain AS parent, n, k FROM h UNION ALL
  SELECT 'domain', suffix, n, k FROM d UNION ALL
  SELECT 'suffix', '', n, k FROM s),
sib AS (SELECT level, parent, sum(n)::DOUBLE AS nn, sum(k)::DOUBLE AS kk, count(*)::DOUBLE AS m,
    sum(k * k / n) AS k2, sum((n * n)::DOUBLE) AS n2 FROM kids WHERE n > 0 GROUP BY ALL HAVING sum(k) > 0 AND sum(k) < sum(n)),
fit AS (SELECT level,
    sum((k2 - kk * (kk / nn)) / ((kk / nn) * (1 - kk / nn)) - (m - 1)) AS excess,
    sum(nn - n2 / nn - (m - 1)) AS room FROM sib GROUP BY level),
st AS (SELECT lv.level, 1 / coalesce(CASE WHEN room > 0 THEN greatest(0.001, least(0.5, excess / room)) END, 0.1) - 1 AS strength
  FROM (VALUES ('host'), ('domain'), ('suffix')) lv(level) LEFT JOIN fit USING (level)),
p AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS mean,
    (SELECT strength FROM st WHERE level = 'host') AS sh, (SELECT strength FROM st WHERE level = 'domain') AS sd,
    (SELECT strength FROM st WHERE level = 'suffix') AS ss FROM h),
s2 AS (SELECT suffix, (ss * mean + k) / (ss + n) AS above FROM s, p),
d2 AS (SELECT domain, suffix, (sd * above + k) / (sd + n) AS prior FROM d JOIN s2 USING (suffix), p),
h5 AS (SELECT host, (sh * prior + k) / (sh + n) AS mean, sh + n AS mass FROM h JOIN d2 USING (domain, suffix), (SELECT sh FROM p)),
h6 AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (mass + 1)) AS low FROM h5),
r AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) r(v, rh, rp)),
best AS (SELECT page_id, host, path, arg_max(v, length(rh || rp)) AS v, arg_max(rh || rp, length(rh || rp)) AS rule
  FROM (SELECT DISTINCT page_id, host, path FROM u) u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.v, CASE WHEN low >= 0.6 THEN 'allow' ELSE 'block' END) AS verdict, round(low, 6) AS low
FROM u JOIN h6 USING (host) LEFT JOIN best ON u.page_id IS NOT DISTINCT FROM best.page_id AND u.host = best.host AND u.path = best.path
"""

OP3 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT e.x, r.root FROM r JOIN e ON r.doc_id = e.y)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, coalesce(min(r.root), d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN r ON d.doc_id = r.doc_id GROUP BY d.doc_id
"""

OP7 = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS x FROM pages),
b AS (SELECT page_id, url, strlen(body) AS n, min(page_id) OVER (PARTITION BY body) AS first_page,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(x, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '') AS digest FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, kind AS record_type,
  CASE WHEN kind = 'revisit' THEN first_page END AS refers_to,
  (strlen(E'WARC/1.1\r\nWARC-Type: \r\nWARC-Record-ID: \r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:\r\n') + strlen(kind) + 47 + 32
    + coalesce(strlen(E'WARC-Target-URI: \r\n' || replace(replace(url, E'\r', '%0D'), E'\n', '%0A')), 0)
    + CASE WHEN kind = 'revisit' THEN strlen(E'WARC-Refers-To: \r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n') + 47 ELSE n END
    + strlen(E'Content-Type: application/http; msgtype=response\r\nContent-Length: \r\n\r\n') + http + strlen((CASE WHEN kind = 'revisit' THEN http ELSE http + n END)::VARCHAR) + 4)::BIGINT AS record_bytes
FROM (SELECT *, CASE WHEN page_id IS DISTINCT FROM first_page THEN 'revisit' ELSE 'response' END AS kind,
  strlen(E'HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: \r\n\r\n') + strlen(n::VARCHAR) AS http FROM b)
"""

OP8 = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM s),
v AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][turn + 1] AS weight, source_size * 3.0::DOUBLE AS cap FROM w),
f AS (SELECT *, coalesce(sum(cap) OVER o, 0) AS full_, coalesce(sum(weight) OVER o, 0) AS used,
    (sum(source_size) OVER ())::DOUBLE AS total, sum(weight) OVER () AS allw
  FROM v WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (total - full_) / (allw - used) AS level FROM f WHERE cap / weight >= (total - full_) / (allw - used)
  ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, turn, least(cap, coalesce(level * weight, cap)) AS target FROM f LEFT JOIN l ON true),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.turn,
    (sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::DOUBLE AS start,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CASE WHEN size > 0 THEN least(epochs + CASE WHEN start + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END, 3) ELSE 0 END AS copies FROM r),
q AS (SELECT *, least((start + size / 2) / target, 1.0) AS u FROM c)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
  round(CASE WHEN copies = 0 THEN NULL
    WHEN turn = 0 THEN least((sqrt(greatest(1.5 * 1.5 + 2 * -1.0 * u, 0)) - 1.5) / -1.0, 1.0)
    WHEN turn = 1 THEN u
    WHEN u * 1.0 >= 0.3125 THEN least(0.5 + (sqrt(greatest(0.75 * 0.75 + 5.0 * (u - 0.3125), 0)) - 0.75) / 2.5, 1.0)
    ELSE least((sqrt(greatest(0.25 + 1.0 * u, 0)) - 0.5) / 0.5, 0.5) END, 6) AS first_position
FROM q
"""

OP2 = r"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP10 = r"""
WITH RECURSIVE t AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
a AS (SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, (conv_id + turn) % 3 AS kind, (conv_id + turn) % 11 = 0 AS odd,
    coalesce(regexp_extract(text, '[A-Za-z]+', 0), '') AS word, coalesce(length(text), 0) % 50 AS lim,
    'c' || conv_id || '-' || CASE WHEN conv_id % 5 = 0 THEN turn + 2 ELSE turn - 2 END AS needs
  FROM t WHERE role = 'assistant'),
res AS (SELECT 'c' || conv_id || '-' || (turn - 1) AS call_id, text AS content FROM t WHERE role = 'user'),
lev AS (
  SELECT call_id, 0 AS level FROM a WHERE needs NOT IN (SELECT call_id FROM a)
  UNION ALL SELECT a.call_id, lev.level + 1 FROM a JOIN lev ON a.needs = lev.call_id),
j AS (SELECT a.*, content, res.call_id IS NOT NULL AS answered,
    CASE WHEN conv_id % 5 = 0 THEN lev.level ELSE 0 END AS level,
    CASE WHEN kind = 0 AND odd THEN 'bad_arguments' WHEN res.call_id IS NULL THEN 'no_result' ELSE 'ok' END AS status
  FROM a LEFT JOIN res USING (call_id) LEFT JOIN lev USING (call_id))
SELECT conv_id, call_id, turn, level::INTEGER AS level, status,
  '{"arguments":' || CASE WHEN kind = 0 AND odd THEN 'null' WHEN kind = 0 THEN '{"limit":' || lim || ',"query":"' || word || '"}'
    WHEN kind = 1 THEN '{"text":"' || word || '"}' ELSE '{"key":"' || word || '","strict":true}' END
  || ',"id":"' || call_id || '","name":"' || CASE kind WHEN 0 THEN 'search' WHEN 1 THEN 'count' ELSE 'lookup' END
  || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"status":"' || status || '"}' AS message
FROM j
"""

#: One round: the nearest entry of every part (squares of whole numbers, exact in doubles), then new entries.
OP13_ASSIGN = """
a{r} AS MATERIALIZED (SELECT rn, p, any_value(x) AS x, min({{'d': list_inner_product(x, x) - 2 * list_inner_product(x, e) + list_inner_product(e, e), 'k': b{r}.k}}) AS best
  FROM cuts JOIN b{r} USING (p) GROUP BY rn, p)"""
OP13_UPDATE = """,
u{r} AS (SELECT p, best.k AS k, list(floor(s / n) ORDER BY i) AS e FROM (
    SELECT p, best, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT p, {{'k': best.k}} AS best, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY p, best, i) GROUP BY p, best.k),
b{t} AS MATERIALIZED (SELECT p, k, coalesce(u{r}.e, b{r}.e) AS e FROM b{r} LEFT JOIN u{r} USING (p, k)),"""
OP13 = (
    """
WITH kept AS (SELECT row_number() OVER () AS rn, row_number() OVER (ORDER BY vec_id) - 1 AS k, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cuts AS MATERIALIZED (SELECT rn, k, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM kept, range(4) t(p)),
b0 AS MATERIALIZED (SELECT p, k, x AS e FROM cuts WHERE k < 256),"""
    + "".join(OP13_ASSIGN.format(r=r) + OP13_UPDATE.format(r=r, t=r + 1) for r in range(4))
    + OP13_ASSIGN.format(r=4)
    + """,
coded AS (SELECT rn, string_agg(printf('%02x', best.k::INTEGER), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a4 GROUP BY rn),
rows AS (SELECT vec_id, label, code, error FROM coded JOIN kept USING (rn)),
sums AS (SELECT label, sum(error)::BIGINT AS label_error FROM rows GROUP BY label),
books AS (SELECT sha256(string_agg(c, ',' ORDER BY p, k)) AS codebooks_sha256
  FROM (SELECT p, k, array_to_string(list_transform(e, lambda c: c::BIGINT), ',') AS c FROM b4))
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM rows JOIN sums ON rows.label IS NOT DISTINCT FROM sums.label, books
"""
)

ORACLE_SQL = {"op13_orchard_codes": OP13, "op2_maxscore": OP2, "op3_ngram_jaccard": OP3, "op10_tool_calls": OP10, "op1_url_reputation": OP1, "op7_warc_archive": OP7, "op8_curriculum_mix": OP8}
