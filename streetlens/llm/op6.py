"""Query of the SentencePiece encoding and decoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlens.llm.base import query, table
from streetlens.llm.piece_bpe import encode_texts


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document's whole text and what they decode to, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
