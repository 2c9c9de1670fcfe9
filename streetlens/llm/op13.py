"""Query of the conversation prefix trie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streetlens.llm.base import crc32_sql, query, table
from streetlens.llm.prefix_trie import conversation_trie

TRIE_SQL = f"""WITH src AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM src)),
pile AS (SELECT i.conv_id, 0 AS part, p, role, text FROM ids i JOIN src s ON s.conv_id = i.base AND p <= h UNION ALL
  SELECT i.conv_id, 1, p, role, text FROM ids i JOIN src s ON s.conv_id = i.conv_id AND p > h),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d, role, text FROM pile),
pre AS (SELECT conv_id, d, sha256(string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS k, strlen(text) AS b FROM turns
  UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
link AS (SELECT conv_id, d, k, b, lag(k) OVER (PARTITION BY conv_id ORDER BY d) AS up, d = max(d) OVER (PARTITION BY conv_id) AS stop FROM pre),
node AS (SELECT d, k, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * max(b) AS saved,
  coalesce(string_agg(CASE WHEN stop THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends FROM link GROUP BY 1, 2),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
under AS (SELECT DISTINCT a.d, a.k, z.d AS zd, z.k AS zk FROM pre a JOIN pre z ON a.conv_id = z.conv_id AND a.d <= z.d),
sums AS (SELECT u.d, u.k, sum(z.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves FROM under u JOIN node z ON z.d = u.zd AND z.k = u.zk
  LEFT JOIN kids c ON c.d = u.zd AND c.k = u.zk GROUP BY 1, 2)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN sums s USING (d, k) LEFT JOIN kids c USING (d, k) LEFT JOIN node o ON o.d = n.d - 1 AND o.k = n.up"""


@query("op13_prefix_trie", TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return conversation_trie(table(spark, folder, "conversations"))
