"""Query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlens.llm.base import query, table
from streetlens.llm.decontamination import contamination

WINDOW = 10
WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op12_decontamination", f"""WITH d AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, unnest(CASE WHEN len(w) < {WINDOW} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {WINDOW - 2}), lambda k: array_to_string(w[k:k + {WINDOW - 1}], ' ')) END) AS x FROM i WHERE len(w) > 0),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS x
  FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n),
m AS (SELECT doc_id, p, n, item_id FROM dw JOIN iw USING (n, x)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, p + unnest(range(0, n)) AS p FROM m) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with words inside 10-word windows of benchmark items."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, folder, "benchmark"), WINDOW, ["doc_id"]).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
