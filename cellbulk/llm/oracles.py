"""DuckDB statements for the corpus queries that SQL can express."""

ASCII_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(" + ASCII_LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
i AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s
        FROM b WHERE len(w) > 0)),
l AS (SELECT DISTINCT n FROM i),
p AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, l WHERE len(w) >= n)),
h AS (SELECT p.doc_id, p.n, p.s, i.item FROM p JOIN i USING (n, phrase)),
c AS (SELECT doc_id, count(DISTINCT spot) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS spot FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

WARC = """
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to, 'GET' AS request_method, 200 AS http_status
FROM (SELECT page_id, h, first, strlen(h) >= 100 AND first <> page_id AS again
      FROM (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages))
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id, vec_id AS reach FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reach = l.a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) USING (vec_id)
JOIN (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id) c USING (vec_id)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id AND len(a.e) = len(b.e)),
p AS (
  SELECT anchor, other, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT s.anchor AS anchor_id, p.other AS positive_id,
  CAST(row_number() OVER (PARTITION BY s.anchor, p.other ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
  s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM s JOIN p ON s.anchor = p.anchor
WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

PHRASES = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({text}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (
  SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, k, f AS a FROM f WHERE k > 1),
cut AS (
  SELECT c.lang, c.phrase, c.a, i.i, x.f AS l, y.f AS r, t.n,
    (1000 * c.a::HUGEINT * t.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM c JOIN (SELECT unnest(range(1, 5)) AS i) i ON i.i < c.k
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:i.i], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[i.i + 1:c.k], ' ')
  JOIN t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, i.i) = 1),
o AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS outside
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS s FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)
  GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM cut LEFT JOIN o USING (lang, phrase) WHERE outside IS NULL OR 100 * outside < 100 * a
QUALIFY rank <= 2000
""".replace("{text}", ASCII_LOWER.format("text"))

ORACLES = {"op11_phrases": PHRASES, "op13_hard_negatives": HARD_NEGATIVES, "op3_warc": WARC, "op4_embedding_dedup": EMBEDDINGS, "op8_decontamination": DECONTAMINATION}
