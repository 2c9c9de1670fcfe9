"""Query of the mixing of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlens.llm.base import query, table
from streetlens.llm.mixing import mix_sources, word_count


@query("op4_mix_sources")
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda total, p: total + p["n"])
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", taken.alias("taken"))
