"""Query of the document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlens.llm.base import query, table
from streetlens.llm.fingerprints import fingerprints, likeness, minhash, packed, with_next


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its text with the second half taken from the next document."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = with_next(fingerprints(docs), ["text", "fingerprint_bins"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)
    )
    return (
        docs.withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("edited", edited)
        .withColumn("edited_bins", minhash(F.col("edited")))
        .select(
            "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
            packed(F.col("edited_bins")).alias("edited_fingerprint"),
            likeness(F.col("fingerprint_bins"), F.col("edited_bins")).alias("near_edited"),
            likeness(F.col("fingerprint_bins"), F.col("next_fingerprint_bins")).alias("near_next"),
        )
    )
