"""The mix of ``source_mix`` as DuckDB SQL over ``documents``."""

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE / count(*) AS mean_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, (number % 3 + 1)::DOUBLE AS weight, 3 * source_size AS cap FROM sources
), shares AS (
  SELECT (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS share
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT *, least(cap::DOUBLE, weight * (SELECT max(share) FROM shares)) AS target FROM weighed
), planned AS (
  SELECT *, floor(rate)::BIGINT AS whole, rate - floor(rate) AS p,
    target - floor(rate) * source_size AS wanted
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0::DOUBLE END AS rate
        FROM targets)
), drawn AS (
  SELECT d.doc_id, d.size, t.source_size, t.mean_size, t.target, t.number, t.whole, t.p, t.wanted,
    (('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT + 0.5::DOUBLE)
      / 281474976710656::DOUBLE AS u,
    d.size * 50 > t.wanted AS large
  FROM sized d JOIN planned t ON d.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, least(floor(CASE WHEN sampled THEN pareto * odds / (1 + pareto * odds) ELSE u END
    * 16777216::DOUBLE)::BIGINT, 16777215) AS rank
  FROM (SELECT *, (u / (1 - u)) / (odds * (mean_size / (mean_size + size))) AS pareto
        FROM (SELECT *, p > 0 AND size > 0 AS sampled,
                CASE WHEN p > 0 AND size > 0 THEN p / (1 - p) END AS odds FROM drawn))
), summed AS (
  SELECT *, sum(size) OVER (PARTITION BY number, large, sampled ORDER BY rank, u, doc_id) AS running,
    sum(size) OVER (PARTITION BY number, large, sampled, rank, u, doc_id) AS peers,
    sum(size) OVER (PARTITION BY number, large, sampled) AS all_words,
    coalesce(sum(size) FILTER (sampled AND NOT large) OVER (PARTITION BY number), 0) AS rest
  FROM ranked
), fitted AS (
  SELECT *, coalesce(max(running) FILTER (running <= p * all_words)
    OVER (PARTITION BY number, large, sampled), 0) AS before
  FROM summed
), distant AS (
  SELECT *,
    greatest(0::DOUBLE, before - wanted) + greatest(0::DOUBLE, wanted - before - rest) AS error_without,
    abs(before - p * all_words) AS far_without,
    greatest(0::DOUBLE, before + peers - wanted) + greatest(0::DOUBLE, wanted - (before + peers) - rest) AS error,
    abs(before + peers - p * all_words) AS far
  FROM fitted
), first AS (
  SELECT *, CASE WHEN NOT sampled OR NOT large THEN 0
    WHEN running <= p * all_words THEN 1
    WHEN nth = 1 AND (error < error_without OR (error = error_without AND far < far_without)) THEN 1
    ELSE 0 END AS got
  FROM (SELECT *, rank() OVER (PARTITION BY number, large, sampled, running > p * all_words
          ORDER BY error, far, rank, u, doc_id::VARCHAR NULLS FIRST) AS nth FROM distant)
), budgets AS (
  SELECT *, wanted - coalesce(sum(size * got) OVER (PARTITION BY number), 0) AS budget FROM first
), taken AS (
  SELECT *, CASE WHEN NOT sampled THEN 0 WHEN large THEN got
    WHEN budget < 0 THEN 0
    WHEN running <= budget THEN 1
    WHEN running - peers <= budget AND running - budget < budget - (running - peers) THEN 1
    ELSE 0 END AS extra
  FROM budgets
)
SELECT doc_id, size, source_size, target, size * (whole + extra) AS taken FROM taken
"""
