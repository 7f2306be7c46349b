"""DuckDB SQL of the queries that it can express."""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
), seen AS (
    SELECT lang, w[i] AS w1, CASE WHEN i + 1 <= len(w) THEN w[i + 1] END AS w2,
        CASE WHEN i + 2 <= len(w) THEN w[i + 2] END AS w3
    FROM placed
), one AS (
    SELECT lang, w1, count(*) AS f FROM seen GROUP BY ALL
), two AS (
    SELECT lang, w1, w2, count(*) AS a FROM seen WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), three AS (
    SELECT lang, w1, w2, w3, count(*) AS a FROM seen WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), longer AS (
    SELECT lang, w1, w2, max(a) AS b
    FROM (SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY ALL
), cuts AS (
    SELECT lang, w1 || ' ' || w2 AS phrase, 1 AS k, t.a, x.f AS l, y.f AS r
    FROM two t JOIN one x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, f FROM one) y USING (lang, w2)
        LEFT JOIN longer USING (lang, w1, w2)
    WHERE b IS NULL OR 100 * b < 50 * t.a
    UNION ALL
    SELECT lang, w1 || ' ' || w2 || ' ' || w3, 1, t.a, x.f, y.a
    FROM three t JOIN one x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, w2 AS w3, a FROM two) y USING (lang, w2, w3)
    UNION ALL
    SELECT lang, w1 || ' ' || w2 || ' ' || w3, 2, t.a, x.a, y.f
    FROM three t JOIN two x USING (lang, w1, w2) JOIN (SELECT lang, w1 AS w3, f FROM one) y USING (lang, w3)
), scored AS (
    SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""

HARD_NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), compared AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
        list_inner_product(a.e, b.e)::BIGINT AS score
    FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM compared WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
    (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
    other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN compared USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
