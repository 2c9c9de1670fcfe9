"""Query of the language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streetlens.llm.base import query, table
from streetlens.llm.language_cnn import identify_language, learn


@query("op3_language_id")
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document's whole text, by a network learned from the other two thirds."""
    docs = table(spark, folder, "documents")
    return identify_language(docs.select("doc_id", "text"), learn(docs)).select("doc_id", "held_out", "lang_pred", "score")
