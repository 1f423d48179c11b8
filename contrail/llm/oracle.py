"""DuckDB SQL of the queries that SQL can express."""

ORACLE_SQL = {
    # Water filling by rounds of the closed form; sizes, key ranges and cuts from the md5 of the id.
    "op8_mix": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
  FROM sized GROUP BY source),
caps AS (SELECT *, 3 * source_size::DOUBLE AS cap FROM per),
fill AS (
  SELECT *, sum(source_size) OVER () * 1.0::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
  FROM caps),
level AS (SELECT *, left_over / weight_left AS lvl, cap <= left_over / weight_left * weight AS capped FROM fill),
goal AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap
              ELSE weight * (SELECT l.lvl FROM level l WHERE NOT l.capped ORDER BY l.cap / l.weight, l.source IS NULL, l.source LIMIT 1) END AS target
  FROM level),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prefix
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN budget // greatest(source_size, 1) ELSE 0 END AS e FROM placed)
SELECT doc_id, size, source_size, target,
       (e * size + least(size, greatest(budget - e * source_size - prefix, 0)))::BIGINT AS taken
FROM epochs
""",
}
