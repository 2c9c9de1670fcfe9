"""Query of the substring dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlens.llm.base import WORDS_SQL, query, table
from streetlens.llm.substring_dedup import remove_repeats

DEPTH = 50

REPEATS_SQL = f"""w AS (SELECT doc_id, coalesce({WORDS_SQL.format(text="text")}, []) AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - {DEPTH - 2})) AS i, unnest(list_transform(range(1, len(w) - {DEPTH - 2}),
  lambda i: sha256(array_to_string(w[i:i + {DEPTH - 1}], ' ')))) AS h FROM w WHERE len(w) >= {DEPTH}),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS d FROM win) WHERE d < doc_id),
pos AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM w),
cov AS (SELECT DISTINCT doc_id, i + unnest(range(0, {DEPTH})) AS p FROM hit),
kept AS (SELECT pos.doc_id, string_agg(x, ' ' ORDER BY p) FILTER (WHERE cov.p IS NULL) AS kept, count(cov.p) AS n_removed
  FROM pos LEFT JOIN cov USING (doc_id, p) GROUP BY 1)"""


@query("op1_substring_dedup", f"""WITH {REPEATS_SQL}
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""")
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that stay when passages of 50 words known from a smaller doc_id go."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(docs, DEPTH).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
