"""The phrases of ``collocations`` as DuckDB SQL over ``documents``."""

PHRASES_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs
), lists AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
  FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), f AS MATERIALIZED (
  SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT lang, k AS size, g, f AS a FROM f WHERE k > 1
), parts AS MATERIALIZED (
  SELECT c.*, x.k, c.g[1:x.k] AS first_part, c.g[x.k + 1:c.size] AS rest
  FROM candidates c JOIN (SELECT unnest([1, 2, 3]) AS k) x ON x.k < c.size
), firsts AS MATERIALIZED (
  SELECT p.*, f.f AS l FROM parts p JOIN f ON f.lang = p.lang AND f.g = p.first_part
), cuts AS (
  SELECT p.lang, p.g, p.a, p.k, p.l, f.f AS r,
    ((2000000::HUGEINT * p.a) // (p.l::HUGEINT + f.f))::BIGINT AS score
  FROM firsts p JOIN f ON f.lang = p.lang AND f.g = p.rest
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), around AS (
  SELECT c.lang, c.g[x.i:x.i + x.size - 1] AS g, max(c.a) AS longer
  FROM candidates c JOIN (
    SELECT i, size FROM (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS size)
  ) x ON x.size < c.size AND x.i + x.size - 1 <= c.size
  GROUP BY ALL
), kept AS (
  SELECT w.* FROM worst w LEFT JOIN around o ON o.lang = w.lang AND o.g = w.g
  WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < 80::HUGEINT * w.a
), ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
