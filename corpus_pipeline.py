"""From raw documents to token ids: five stages, each a job over all that the stage before kept.

Every stage is written as Parquet to the shared folder and read back as the
next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streetlens.llm.jaccard_join import jaccard_components
from streetlens.llm.language_cnn import identify_language
from streetlens.llm.mixing import mixed_documents
from streetlens.llm.piece_bpe import encode_texts
from streetlens.llm.substring_dedup import remove_repeats
from streetlens.llm.tables import stored
from streetlens.operators.joins import lookup_join

MIN_SCORE = 0.4  # below it, no learned language has a fair majority of the text's windows
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _set_aside(docs: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns of these names renamed, and what gives all its columns their names back."""
    taken = {n.lower() for n in names}
    own = {c: f"_own_{k}_{c}" if c.lower() in taken else c for k, c in enumerate(docs.columns)}
    return docs.toDF(*own.values()), [F.col(f"`{v}`").alias(c) for c, v in own.items()]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without letters or without a clear language go.

    Null and empty texts have no letter and go; long texts count as a whole,
    repeated rows one by one. Own columns named like a result stay as they are.
    """
    docs, columns = _set_aside(docs, ("lang_pred", "score", "held_out", "_text", "_lettered"))
    return identify_language(docs).filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select(*columns)


def _one_row_each(docs: DataFrame) -> DataFrame:
    """Of rows with the same doc_id and text one, the least in the other columns; only repeated doc_ids are shuffled."""
    docs, columns = _set_aside(docs, ("_twice", "_copy"))
    twice = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("_twice"))
    marked = lookup_join(docs, twice, ["doc_id"])
    copies = Window.partitionBy("doc_id", "text").orderBy(F.to_json(F.struct(*docs.columns)))
    first = marked.filter("_twice").withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1")
    return marked.filter("_twice is null").select(*columns).unionByName(first.select(*columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group linked by a Jaccard similarity of 0.75; a null doc_id stays.

    Rows that repeat a doc_id and its text are one document; other rows of one doc_id stay or go together.
    Null and empty texts are linked with nothing.
    """
    docs = _one_row_each(docs)
    groups = jaccard_components(docs.select("doc_id", "text"))
    gone = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words known from an earlier one; the others keep their text as it is.

    Null, empty and short texts lose nothing. Own columns named like a result stay as they are.
    """
    docs, columns = _set_aside(docs, ("kept", "n_words", "n_removed", "_uid", "_spans"))
    cleaned = remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumns({"text": text, "n_chars": n_chars}).select(*columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document occurs once for each pass that takes words of it.

    Texts without words are never taken. Own columns named like a result stay as they are.
    """
    docs, columns = _set_aside(
        docs, ("size", "source_size", "target", "pieces", "_pass", "_source", "_start", "_bucket", "_order", "_inside", "_name", "_b", "_base")
    )
    return mixed_documents(docs).select(*columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, little-endian unsigned 32-bit, with begin and end ids, which is all that a null or empty text has."""
    return encode_texts(docs.select("doc_id", "source", "text"), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "source", "n_tokens", "ids"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mixture", mixture),
    ("tokens", tokens),
]

# the language network cannot be written as SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
