"""DuckDB SQL of the queries that SQL can express, from the queries' rules alone."""

from __future__ import annotations

_RULES = """(VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
 ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS rules(rule_host, rule_path, rule_verdict)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP6 = f"""
WITH parted AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), fitting AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict AS verdict
  FROM parted LEFT JOIN {_RULES}
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, coalesce(max_by(verdict, length(rule)), 'allow') AS verdict
FROM fitting GROUP BY page_id, host, path
"""

OP10 = f"""
WITH made AS (
  SELECT page_id AS p, j, url, html, ((j = 0 AND page_id % 11 <> 0) OR j = 3) AS response,
    epoch_us(TIMESTAMP '2024-01-01 00:00:00') + 1000000 * ((page_id % 97) * 3600 + j * ((1 + page_id % 3) * 86400 + 7)) AS "at",
    coalesce(html, '') || CASE WHEN j = 3 THEN '<!-- changed -->' ELSE '' END AS body
  FROM pages, LATERAL (SELECT unnest(range(CAST(page_id % 4 + 2 AS BIGINT))) AS j)
), tagged AS (
  SELECT *, '<urn:page:' || p || ':' || j || '>' AS record_id,
    CASE WHEN NOT response AND p % 7 = 3 THEN NULL
         WHEN NOT response AND p % 13 = 5 THEN '"other"'
         ELSE '"' || p || '-' || CASE WHEN j >= 3 THEN 1 ELSE 0 END || '"' END AS etag,
    CASE WHEN j % 2 = 1 AND (response OR p % 13 <> 5) THEN 'W/' ELSE '' END AS weak,
    regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '(?i)^[a-z][a-z0-9+.-]*://', '') AS bare
  FROM made
), keyed AS (
  SELECT *, strftime(make_timestamp("at"), '%Y-%m-%dT%H:%M:%SZ') AS shown,
    list_sort(list_filter(string_split(regexp_extract(bare, '(?s)\\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|fbclid|gclid|ref)(=|$)'))) AS query
  FROM tagged
), named AS (
  SELECT *, regexp_replace(regexp_replace(translate(regexp_extract(bare, '(?s)^([^/?]*)', 1), '{_UPPER}', '{_LOWER}'), '^www\\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(bare, '(?s)^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS url_key
  FROM keyed
), latest AS (
  SELECT url_key, "at", max(record_id) AS record_id FROM named WHERE response GROUP BY url_key, "at"
), joined AS (
  SELECT r.*, s.record_id AS source_id
  FROM (SELECT * FROM named WHERE NOT response) r ASOF LEFT JOIN latest s ON r.url_key = s.url_key AND r."at" > s."at"
), sourced AS (
  SELECT j.*, s.etag AS source_etag, s.weak AS source_weak, s.body AS source_body, s.j AS source_j,
    CASE WHEN j.source_id IS NULL THEN 'missing' WHEN j.etag IS NULL THEN 'unverified'
         WHEN j.etag = s.etag THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM joined j LEFT JOIN (SELECT DISTINCT record_id, etag, weak, body, j FROM named WHERE response) s ON j.source_id = s.record_id
), merged AS (
  SELECT *, CASE WHEN outcome IN ('resolved', 'unverified') THEN list_sort([
      'cache-control: max-age=' || j, 'content-type: text/html; charset=utf-8', 'date: ' || shown,
      'etag: ' || CASE WHEN etag IS NULL THEN source_weak || source_etag ELSE weak || etag END, 'server: origin']) END AS headers
  FROM sourced
)
SELECT record_id, url_key, "at", outcome, source_id, CAST(len(headers) AS INTEGER) AS n_headers,
  sha256(array_to_string(headers, chr(10))) AS headers_sha256,
  CASE WHEN headers IS NOT NULL THEN 'sha256:' || sha256(source_body) END AS payload_digest,
  CASE WHEN headers IS NOT NULL THEN CAST(length(source_body) AS BIGINT) END AS n_chars
FROM merged
"""

OP2 = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i + 1 : i + n], ' ') AS gram
  FROM (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(len(words) - least(10, len(words)) + 1)) AS i FROM item WHERE len(words) > 0)
), doc_window AS (
  SELECT r, n, i, array_to_string(words[i + 1 : i + n], ' ') AS gram
  FROM (SELECT r, words, n, unnest(range(len(words) - n + 1)) AS i FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(words) >= n)
), hit AS (
  SELECT r, n, i, gram FROM doc_window WHERE (n, gram) IN (SELECT (n, gram) FROM item_window)
), covered AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hit) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, n, gram FROM hit) JOIN item_window USING (n, gram) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

OP11 = f"""
WITH piece AS (
  SELECT row_number() OVER () AS p, lang, words FROM (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
  ) WHERE len(words) > 0
), language AS (
  SELECT lang, CAST(sum(len(words)) AS HUGEINT) AS n FROM piece GROUP BY lang
), gram AS (
  SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
    FROM piece, (SELECT unnest(range(1, 6)) AS size) WHERE len(words) >= size)
), frequent AS (
  SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS f FROM gram GROUP BY lang, size, phrase HAVING count(*) >= 100
), cut AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k FROM frequent WHERE size > 1
), valued AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n, (1000 * c.a * n) // (x.f * y.f) AS score
  FROM cut c JOIN language g ON c.lang = g.lang
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1 : k], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1 :], ' ')
), lowest AS (
  SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM frequent t WHERE t.lang = s.lang AND t.size > len(string_split(s.phrase, ' '))
      AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * t.f >= 100 * s.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

_WHOLE = """whole AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda v: CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0{more}
)"""


def _rounds(rounds: int) -> str:
    """Every round as its assignment (a) and its centroids (c)."""
    out = []
    for r in range(1, rounds + 2):
        assigned = f"""a{r} AS MATERIALIZED (
  SELECT id, arg_min(cluster, struct_pack(d := d, c := cluster)) AS cluster, min(d) AS distance
  FROM (SELECT id, cluster, sum((v - w) * (v - w)) AS d FROM part JOIN c{r} USING (dim) GROUP BY id, cluster) GROUP BY id
)"""
        moved = f"""c{r + 1} AS MATERIALIZED (
  SELECT cluster, dim, coalesce(m, w) AS w FROM c{r} LEFT JOIN (
    SELECT cluster, dim, (s - ((s % n) + n) % n) // n AS m
    FROM (SELECT cluster, dim, CAST(sum(v) AS HUGEINT) AS s, count(*) AS n FROM part JOIN a{r} USING (id) GROUP BY cluster, dim)
  ) USING (cluster, dim)
)"""
        out += [assigned, moved] if r <= rounds else [assigned]
    return ", ".join(out)


OP12 = f"""
WITH {_WHOLE.format(more=" AND len(embedding) = 64")}, part AS MATERIALIZED (
  SELECT id, unnest(range(1, 65)) AS dim, CAST(unnest(x) AS HUGEINT) AS v FROM whole
), c1 AS MATERIALIZED (
  SELECT cluster, dim, v AS w FROM part JOIN (
    SELECT id, CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS INTEGER) AS cluster
    FROM whole QUALIFY cluster < 8) USING (id)
), {_rounds(10)}, inertia AS (
  SELECT cluster, sum(distance) AS cluster_inertia, sum(sum(distance)) OVER () AS inertia FROM a11 GROUP BY cluster
), digest AS (
  SELECT cluster, sha256(string_agg(CAST(w AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c11 GROUP BY cluster
)
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance, CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
  CAST(inertia AS BIGINT) AS inertia, centroid_sha256
FROM whole JOIN a11 USING (id) JOIN inertia USING (cluster) JOIN digest USING (cluster)
"""

OP13 = f"""
WITH {_WHOLE.format(more="")}, pair AS (
  SELECT q.id AS query, q.vec_id AS query_id, c.vec_id, c.id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.x, c.x, true), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.id <> c.id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST, id) AS INTEGER) AS rank, vec_id, score
  FROM pair
)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op2_decontaminate": OP2,
    "op6_url_filter": OP6,
    "op10_warc": OP10,
    "op11_collocations": OP11,
    "op12_clusters": OP12,
    "op13_top_k": OP13,
}
