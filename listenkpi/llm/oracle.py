"""DuckDB SQL twins of the operators that SQL can express."""

from __future__ import annotations

OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw USING (win)),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP1 = r"""
WITH p AS (
  SELECT page_id, url, to_timestamp(1700000000 + page_id * 60) AS ts, sha1(coalesce(html, '')) AS digest,
    '"' || substr(sha1(coalesce(html, '')), 1, 16) || '"' AS tag, '"' || substr(sha1(coalesce(url, '')), 1, 16) || '"' AS url_tag,
    strftime(to_timestamp(1600000000 + length(coalesce(html, ''))) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS modified,
    strlen(coalesce(html, '')) AS size,
    regexp_replace(url, '#.*$', '') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_source=again#part' AS other
  FROM pages),
t AS (SELECT *, strftime(ts AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS at_text FROM p),
recs AS (
  SELECT page_id * 4 AS record_id, true AS full_, url, ts AS time, tag, modified, digest, size, NULL AS at_text FROM t
  UNION ALL SELECT page_id * 4 + 1, false, other, ts - INTERVAL 1 HOUR, tag, NULL, NULL, NULL, NULL FROM t
  UNION ALL SELECT page_id * 4 + 2, false, other, ts + INTERVAL 24 HOUR, tag, NULL, NULL, NULL, at_text FROM t
  UNION ALL SELECT page_id * 4 + 3, false, url, ts + INTERVAL 48 HOUR, CASE WHEN page_id % 2 = 0 THEN url_tag END, modified, digest, NULL, at_text FROM t),
plain AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM recs),
parts AS (
  SELECT *, regexp_replace(lower(regexp_extract(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)', 1)), ':(80|443)?$', '') AS host,
    regexp_replace(regexp_extract(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(?i)(utm_[a-z]+|gclid|fbclid|msclkid|ref)(=|$)'))), '&') AS query
  FROM plain),
keyed AS (
  SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS url_key FROM parts),
placed AS (
  SELECT *, last_value(CASE WHEN full_ THEN record_id END IGNORE NULLS) OVER (PARTITION BY url_key ORDER BY time, record_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS found FROM keyed),
joined AS (
  SELECT a.record_id, a.url_key, CASE WHEN a.url_key IS NOT NULL THEN a.found END AS found, a.tag, a.modified, a.digest, a.at_text, a.record_id % 4 AS k,
    b.tag AS old_tag, b.modified AS old_modified, b.digest AS old_digest, b.size AS old_size
  FROM placed a LEFT JOIN recs b ON b.record_id = a.found AND a.url_key IS NOT NULL WHERE NOT a.full_),
judged AS (
  SELECT *, CASE WHEN found IS NULL THEN 'no_response' WHEN tag IS NOT NULL THEN CASE WHEN tag = old_tag THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL THEN CASE WHEN modified = old_modified THEN 'resolved' ELSE 'mismatch' END ELSE 'no_validator' END AS status
  FROM joined)
SELECT record_id, url_key, status, CASE WHEN status = 'resolved' THEN found END AS response_id,
  CASE WHEN status = 'resolved' THEN array_to_string(list_sort(list_filter([
    CASE WHEN k = 2 THEN 'cache-control: max-age=120' ELSE 'cache-control: max-age=60' END,
    'content-length: ' || old_size, 'content-type: text/html', CASE WHEN k = 3 THEN 'date: ' || at_text END,
    'etag: ' || CASE k WHEN 2 THEN 'W/' || tag ELSE coalesce(tag, old_tag) END,
    CASE WHEN k = 2 THEN 'expires: ' || at_text END, 'last-modified: ' || old_modified], lambda x: x IS NOT NULL)), chr(10)) END AS headers,
  CASE WHEN status = 'resolved' THEN old_digest END AS payload_digest, CASE WHEN status = 'resolved' THEN old_size END AS payload_length
FROM judged
"""

OP11 = r"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (length(t) + 1) AS a,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (length(t) + 1) AS b, CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS p,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS q FROM d),
f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p >= 90 THEN 'plain'
    WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form, least(a, b) AS i, greatest(a, b) AS j FROM g),
c AS (SELECT *, substring(t, 1, i) AS x, substring(t, i + 1, j - i) AS y, substring(t, j + 1, n - j) AS z FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(i AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(j - i AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
    ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256, sha256(t) AS restored_sha256
FROM c
"""

OP13 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLE: dict[str, str] = {"op1_revisits": OP1, "op10_decontaminate": OP10, "op11_neighbours": OP11, "op12_middle": OP12, "op13_negatives": OP13}
