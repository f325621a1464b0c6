"""The numbered queries in plain SQL, where SQL can express them."""

ORACLES = {
    "op2_url_rules": """
WITH a AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM a
), r(rule, h, p, v) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
    ('net/fr/', 'net', '/fr/', 'block')
), fits AS (
  SELECT b.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.v, length(r.rule)) AS v
  FROM b JOIN r ON (b.host = r.h OR ends_with(b.host, '.' || r.h)) AND starts_with(b.path, r.p)
  GROUP BY b.page_id
)
SELECT b.page_id, b.host, b.path, fits.rule, coalesce(fits.v, 'allow') AS verdict
FROM b LEFT JOIN fits ON b.page_id = fits.page_id
""",
    "op9_leak_scan": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, len(part) AS size, array_to_string(part, ' ') AS gram FROM (
    SELECT item, words[i:i + 9] AS part
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)
  )
), grams AS (
  SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)
), found AS (
  SELECT doc_id, item, i, g.size FROM grams g JOIN windows w ON g.size = w.size AND g.gram = w.gram
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.names, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
""",
    "op10_quality_cascade": r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(len(list_distinct(words)) AS BIGINT) AS n_distinct_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeats r ON r.doc_id = w.doc_id
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT *, NOT (base_failed
  OR n_symbols > n_words
  OR 2 * n_dup_lines > n_lines
  OR (n_words >= 30 AND 10 * n_symbols > 4 * n_words)
  OR 4 * n_distinct_words * n_distinct_words < 9 * n_words
  OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM b
""",
    "op12_secret_scan": r"""
WITH rules(place, kind, pattern, part, least) AS (
  VALUES (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    (1, 'access', '(AKIA[A-Z0-9]+)', 1, 20), (2, 'hex', '([0-9a-f]+)', 1, 24), (3, 'github', '(gh[pousr]_[A-Za-z0-9]+)', 1, 40),
    (4, 'slack', '(xox[abposr]-[A-Za-z0-9-]+)', 1, 15), (5, 'google', '(AIza[A-Za-z0-9_-]+)', 1, 39),
    (6, 'jwt', '(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)', 1, 30),
    (7, 'private_key', '(-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----)', 1, 1)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT r, place, kind, least, regexp_extract_all(text, pattern) AS found,
    CASE WHEN part = 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern, 1) END AS measured,
    string_split_regex(text, pattern) AS rest
  FROM d JOIN rules ON regexp_matches(text, pattern)
), sized AS (
  SELECT r, place, kind, least, i, length(found[i]) AS size, length(measured[i]) AS part, length(rest[i]) AS gap
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM cut)
), placed AS (
  SELECT *, sum(gap + size) OVER (PARTITION BY r, place ORDER BY i) AS stop FROM sized
), spans AS (
  SELECT r, place, kind, stop - size AS start, kind || ':' || CAST(stop - size AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM placed WHERE part >= least
), each AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base, string_agg(span, ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN each ON each.r = d.r
""",
    "op11_ranked_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT row_number() OVER () AS i, item_id,
    list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS words
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), s AS (
  SELECT CAST(count(*) FILTER (len(words) > 0) AS BIGINT) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_all FROM d
), tf AS (
  SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n, unnest(words) AS term FROM d) GROUP BY r, doc_id, n, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN s GROUP BY term, n_docs
), parts AS (
  SELECT r, doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_all)))) AS part
  FROM tf JOIN w ON w.term = tf.term CROSS JOIN s
), scores AS (
  SELECT i, item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM (SELECT i, item_id, unnest(words) AS term FROM b) q JOIN parts ON parts.term = q.term
  GROUP BY i, item_id, r, doc_id HAVING sum(part) > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scores) WHERE rank <= 50
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same) WHERE place <= 5
), n AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""",
}
