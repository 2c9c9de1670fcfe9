"""Query of the licence scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlens.llm.base import query, table
from streetlens.llm.licenses import END, LOWER, RULES_OF_NOTICES, UPPER, scan_licenses


def _sql() -> str:
    rules = RULES_OF_NOTICES
    known = ", ".join(f"'{s}': '{c}'" for s, c in rules.known().items())
    steps, left = [], "q"
    for k, (name, licence, needs) in enumerate(rules.rules):
        p, r = rules.pattern(needs), rules.rest(needs, "\\")
        steps.append(f"r{k} AS (SELECT * EXCLUDE (q, f, l), regexp_replace(q, '{p}', '{r}', 'g') AS q,"
                     f" CASE WHEN regexp_matches(q, '{p}') THEN list_append(f, '{name}') ELSE f END AS f,"
                     f" CASE WHEN regexp_matches(q, '{p}') AND NOT list_contains(l, '{licence}') THEN list_append(l, '{licence}') ELSE l END AS l"
                     f" FROM {'start' if k == 0 else f'r{k - 1}'})")
    return f"""WITH lines AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '{END}', '\\1' || chr(10), 'g'), chr(10)) AS s FROM documents),
plain AS (SELECT doc_id, list_filter(list_transform(s, lambda x: trim(regexp_replace(translate(x, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS s FROM lines),
code AS (SELECT doc_id, len(s) AS n, list_filter(list_transform(s, lambda x: MAP {{{known}}}[x]), lambda x: x IS NOT NULL) AS c FROM plain),
start AS (SELECT doc_id, n, len(c) AS k, coalesce(array_to_string(list_transform(c, lambda x: '<' || x || '>'), ''), '') AS q,
  CAST([] AS VARCHAR[]) AS f, CAST([] AS VARCHAR[]) AS l FROM code),
{", ".join(steps)}
SELECT doc_id, CAST(n AS BIGINT) AS n_sentences, CAST(k AS BIGINT) AS n_known, array_to_string(f, ',') AS found_rules,
  array_to_string(l, ',') AS licenses FROM r{len(rules.rules) - 1}"""


@query("op10_license_scan", _sql())
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences that each document's sentences name, by rules over known sentences."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scan_licenses(docs).select(
        "doc_id", "n_sentences", "n_known", F.array_join("found_rules", ",").alias("found_rules"), F.array_join("licenses", ",").alias("licenses")
    )
