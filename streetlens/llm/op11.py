"""Query of the conversation structure repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlens.llm.base import crc32_sql, query, table
from streetlens.llm.turn_repair import conversation_digests, repair

EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of no bytes

REPAIR_SQL = f"""WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS c FROM conversations),
dam AS (SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role,
  CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE c WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p FROM dam),
flt AS (SELECT *, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS j,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM num),
ins(f, g, ic, il, ir) AS (VALUES (0, 0, 0, '', CAST(NULL AS VARCHAR)), (1, 1, 0, '', NULL), (2, 2, 0, '', NULL), (3, 3, 0, '', NULL),
  (0, 2, 5, 'I', 'user:'), (1, 2, 5, 'I', 'user:'), (3, 2, 5, 'I', 'user:'), (2, 3, 5, 'I', 'assistant:')),
ed(l, g, i, t, lc, ro) AS (SELECT 'D', g, CAST(NULL AS VARCHAR), g, 2, CAST(NULL AS VARCHAR) FROM range(4) x(g) UNION ALL
  SELECT 'R', g, NULL, CASE g WHEN 2 THEN 3 ELSE 2 END, 1, CASE g WHEN 2 THEN 'assistant' ELSE 'user' END FROM range(4) x(g) UNION ALL
  SELECT 'K', g, i, t, 0, NULL FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) k(g, i, t)),
mv AS (SELECT f, t, ic + lc AS c, il || l AS l, ed.i, ir, ro FROM ins JOIN ed USING (g)),
walk(conv_id, p, s, cost, audit, body) AS (
  SELECT conv_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), '', CAST([] AS VARCHAR[]) FROM (SELECT DISTINCT conv_id FROM src) UNION ALL
  SELECT conv_id, p, s, cost, audit, body FROM (SELECT w.conv_id, r.p, CAST(m.t AS BIGINT) AS s,
    CAST(w.cost + m.c + CASE WHEN r.fault = 'truncated' AND m.l NOT LIKE '%D' THEN 5 ELSE 0 END AS BIGINT) AS cost, w.audit || m.l AS audit,
    w.body || CASE WHEN m.ir IS NULL THEN [] ELSE [m.ir] END || CASE WHEN m.l LIKE '%D' THEN [] ELSE [coalesce(m.ro, r.role) || ':' || r.text] END AS body
    FROM walk w JOIN flt r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.p = w.p + 1 JOIN mv m ON m.f = w.s AND (m.i IS NULL OR m.i = r.i)
    WHERE r.fault NOT IN ('blank', 'duplicate') OR m.l LIKE '%D')
  QUALIFY row_number() OVER (PARTITION BY conv_id, s ORDER BY cost, audit) = 1),
top AS (SELECT w.* FROM walk w JOIN (SELECT conv_id, max(p) AS p FROM walk GROUP BY 1) m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.p = w.p),
shut AS (SELECT conv_id, cost + CASE s WHEN 2 THEN 5 ELSE 0 END AS cost, audit || CASE s WHEN 2 THEN 'I' ELSE '' END AS audit,
  body || CASE s WHEN 2 THEN ['assistant:'] ELSE [] END AS body FROM top WHERE s <> 1),
fin AS (SELECT * FROM shut
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1),
cnt AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (j IS NOT NULL AND j || i NOT IN ('su', 'ua', 'au')) AS illegal FROM flt GROUP BY 1)
SELECT f.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(array_to_string(body, chr(10))) AS repaired_sha256
FROM fin f LEFT JOIN cnt c ON c.conv_id IS NOT DISTINCT FROM f.conv_id"""


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults of the contract; which row gets which follows from conv_id and turn."""
    one = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    fault = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", one), F.coalesce("text", one)
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))),
    ).drop("col")


@query("op11_conversation_repair", REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired text of every conversation, after the given damage."""
    source = table(spark, folder, "conversations")
    fixed = repair(damaged(source))
    every = source.select("conv_id").distinct()
    known = every.join(fixed.report, every["conv_id"].eqNullSafe(fixed.report["conv_id"]), "left").select(every["conv_id"], *fixed.report.columns[1:])
    digests = conversation_digests(fixed.rows)
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return known.join(digests, known["conv_id"].eqNullSafe(digests["conv_id"]), "left").select(
        known["conv_id"], *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256")
    )
