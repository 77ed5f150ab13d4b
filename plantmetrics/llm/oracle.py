"""SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, {start}, 5))::BIGINT >> {shift}) % 32)::INT + 1, 1)"
    for start in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)

WARC = f"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (SELECT hex, min(page_id) AS first_id FROM payloads GROUP BY hex)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM payloads JOIN firsts USING (hex)
"""

LINE_RULES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, source IS NULL AS no_host, coalesce(text, '') AS text
  FROM documents
), worded AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM docs
), spread AS (
  SELECT r, words, lines, unnest(range(greatest(len(words) - 4, 0))) AS pos FROM worded
), spans AS (
  SELECT r, pos, count(*) OVER (PARTITION BY r, words[pos + 1], words[pos + 2], words[pos + 3], words[pos + 4], words[pos + 5]) AS n
  FROM spread
), covered AS (
  SELECT r, count(DISTINCT word) AS n_repeat_words FROM (SELECT r, unnest(range(pos, pos + 5)) AS word FROM spans WHERE n > 1) GROUP BY r
), all_lines AS (
  SELECT r, lower(list_aggregate(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), 'string_agg', ' ')) AS line,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT r, unnest(lines) AS line FROM worded)
), hosts AS (SELECT host, no_host, count(*) AS documents FROM docs GROUP BY ALL
), boilerplate AS (
  SELECT host, no_host, line FROM all_lines JOIN docs USING (r) JOIN hosts USING (host, no_host)
  GROUP BY host, no_host, line, documents
  HAVING count(DISTINCT r) > 20 AND count(DISTINCT r) * 100 > documents
), gone AS (
  SELECT r, sum(words) AS gone FROM all_lines JOIN docs USING (r) JOIN boilerplate USING (host, no_host, line) GROUP BY r
), counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum([length(x) FOR x IN words]), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    (len(words) - coalesce(gone, 0))::BIGINT AS n_left
  FROM docs JOIN worded USING (r) LEFT JOIN covered USING (r) LEFT JOIN gone USING (r)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_left >= 10 AND n_left * 100 >= n_words * 50 AS kept
FROM counted
"""

# Fixed values of the query: its rules and the hosts on its block list.
URL_CASCADE = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), names AS (
  SELECT unnest(['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) AS name
), listed AS (SELECT name || '.example.' || top AS blocked FROM names, (SELECT unnest(['com', 'net', 'org']) AS top)
), hosts AS (
  SELECT host, bool_or(host = blocked OR ends_with(host, '.' || blocked)) AS listed
  FROM (SELECT DISTINCT host FROM parts), listed GROUP BY host
), ruled AS (
  SELECT page_id, host, path, listed, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts JOIN hosts USING (host)
)
SELECT page_id, host, path, rule, listed, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

#: Assignments to the centroids of ``round`` (a row per vector): nearest by squared distance, then number.
_NEAREST = """
near_{k} AS MATERIALIZED (
  SELECT r, cluster, distance FROM (
    SELECT r, cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
    FROM entries v JOIN centroids_{k} c USING (dim) GROUP BY r, cluster
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1
)"""
_MOVED = """
centroids_{next} AS MATERIALIZED (
  SELECT cluster, dim, coalesce(moved, x) AS x FROM centroids_{k} LEFT JOIN (
    SELECT cluster, dim, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS moved
    FROM near_{k} JOIN entries USING (r) GROUP BY cluster, dim
  ) USING (cluster, dim)
)"""
_ROUNDS = ",".join(_NEAREST.format(k=k) + "," + _MOVED.format(k=k, next=k + 1) for k in range(5)) + "," + _NEAREST.format(k=5)

ZONE_CLUSTERS = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS xs FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), entries AS MATERIALIZED (
  SELECT r, unnest(range(64)) AS dim, unnest(xs) AS x FROM kept
), centroids_0 AS MATERIALIZED (
  SELECT cluster, unnest(range(64)) AS dim, unnest(xs) AS x FROM (
    SELECT xs, row_number() OVER (ORDER BY sha256('2:' || vec_id), xs) - 1 AS cluster FROM kept WHERE vec_id IS NOT NULL
  ) WHERE cluster < 40
),{_ROUNDS}, digests AS (
  SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM centroids_5 GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance,
  (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM near_5 JOIN kept USING (r) JOIN digests USING (cluster)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc": WARC,
    "op9_line_rules": LINE_RULES,
    "op11_url_cascade": URL_CASCADE,
    "op13_zone_clusters": ZONE_CLUSTERS,
}
