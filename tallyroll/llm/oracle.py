"""SQL of another engine for the numbered queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL = {
    "op1_source_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
),
weighed AS (
  SELECT *, [5, 2, 1][(place % 3)::INT + 1] AS weight, 2 * source_size AS most
  FROM (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source
  )
),
-- Try every set of sources that reach their limit first; the right one leaves no other source above its own.
tried AS (
  SELECT a.place, any_value(a.most) AS most, any_value(a.weight) AS weight,
         ((SELECT sum(source_size) FROM weighed) * 1.5::DOUBLE
           - coalesce(sum(b.most) FILTER (most_before), 0)::DOUBLE) / sum(b.weight) FILTER (NOT most_before)::DOUBLE AS level
  FROM weighed a, LATERAL (
    SELECT w.*, (w.most::DOUBLE / w.weight, w.place) < (a.most::DOUBLE / a.weight, a.place) AS most_before FROM weighed w
  ) b
  GROUP BY a.place
),
final AS (
  SELECT arg_min(level, (most::DOUBLE / weight, place)) AS level FROM tried WHERE level * weight <= most
),
targets AS (
  SELECT source, place, source_size, least(most::DOUBLE, weight * coalesce(level, 'inf'::DOUBLE)) AS target FROM weighed, final
),
queued AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY place ORDER BY turn, key, doc_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE / nullif(target, 0), 0) AS finish
  FROM (
    SELECT s.doc_id, s.size, t.*, turn, md5(concat_ws('-', '7', turn, s.doc_id)) AS key
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, unnest([0, 1]) AS u(turn)
  )
),
merged AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, turn, key, doc_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM queued
)
SELECT doc_id, size, source_size, target,
       (size * count(*) FILTER (used <= (SELECT sum(source_size) FROM weighed) * 1.5::DOUBLE))::BIGINT AS taken
FROM merged GROUP BY doc_id, size, source_size, target
""",
    "op7_minhash": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
-- Fewer than five words are one sequence.
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM worded, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS places(i) WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY x, y
),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON x = a.doc_id JOIN sizes b ON y = b.doc_id
  WHERE 100 * shared.n >= 75 * (a.n + b.n - shared.n)
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT links.y, reached.other FROM reached JOIN links ON links.x = reached.doc_id
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reached r LEFT JOIN sizes ON r.doc_id = sizes.doc_id GROUP BY r.doc_id
""",
}
