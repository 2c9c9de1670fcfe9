"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streetlens.llm.base import WORDS_SQL, query, table
from streetlens.llm.jaccard_join import jaccard_components

LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINKS_SQL = f"""w AS (SELECT doc_id, {WORDS_SQL.format(text=LOWERED)} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
k AS (SELECT DISTINCT min(doc_id) OVER (PARTITION BY n, h) AS head, doc_id, n FROM (SELECT doc_id, len(s) AS n, list_sort(s) AS h FROM s) WHERE n > 0),
r AS (SELECT u.* FROM u JOIN k ON u.doc_id = k.doc_id AND k.head = k.doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM r a JOIN r b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
  UNION SELECT head, doc_id FROM k WHERE head <> doc_id UNION SELECT doc_id, head FROM k WHERE head <> doc_id)"""

COMPONENTS_SQL = f"""WITH RECURSIVE {LINKS_SQL},
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON reach.other = l.a)"""


@query("op9_jaccard_join", f"""{COMPONENTS_SQL}
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) c ON s.doc_id = c.doc_id""")
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents whose 5-word shingle sets reach a Jaccard similarity of 0.75."""
    return jaccard_components(table(spark, folder, "documents"))
