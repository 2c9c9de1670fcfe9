"""Query of the embedding near-dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streetlens.llm.base import query, table
from streetlens.llm.vector_links import link_vectors


@query("op8_embedding_neardup")
def op8_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings with a cosine of 0.95 or more."""
    return link_vectors(table(spark, folder, "embeddings"), 0.95)
