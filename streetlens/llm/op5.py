"""Query of the token counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from streetlens.llm.base import query, table
from streetlens.llm.token_trie import count_tokens


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document's whole text under the best unigram segmentation."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
