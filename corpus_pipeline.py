"""The corpus pipeline: stages over documents, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, stored, table
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import quality_scores
from tidemark.llm.simhash import simhash_survivors
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.toxicity import toxicity_scores

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
THRESHOLD = 0.3
PASSAGE_WORDS = 51  # a repeated run of so many whole words is a passage ..
PASSAGE_BYTES = 160  # .. and has strings of so many bytes that repeat: 51 words of at least two letters


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; none where it cannot be fitted.

    Null texts read as empty and are scored like any other, as are rows without an id; repeated rows have
    one score and go or stay together; an empty table stays empty.
    """
    labels = table(spark, sf_dir, "labels").where(fold(4) != 2).select("doc_id", F.col("toxic").alias("label"))
    return toxicity_scores(docs, labels, COLUMNS, null_unfitted=True).where(F.col("score").isNull() | (F.col("score") < THRESHOLD)).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; none where it cannot be fitted.

    Null and empty texts, rows without an id and repeated rows are treated as in ``toxicity``.
    """
    labels = table(spark, sf_dir, "labels").where(fold(5) != 0).select("doc_id", F.col("quality").alias("label"))
    return quality_scores(docs, labels, COLUMNS, null_unfitted=True).where(F.col("score").isNull() | (F.col("score") >= THRESHOLD)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one with the smallest id, whatever other rows have that id.

    Texts without words, null ones too, are one group; rows without an id stay only where no row of their
    group has one; repeated rows are one.
    """
    return simhash_survivors(docs, COLUMNS, width=3, radius=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose passages of over 50 words that occur elsewhere too; what a cut leaves of a character goes with it.

    Null and empty texts stay as they are; copies of a row lose all they share; a text that is nothing
    but repeated passages stays as an empty one, of which packing makes its end token.
    """
    cleaned = remove_repeats(docs, PASSAGE_BYTES, COLUMNS, least_words=PASSAGE_WORDS)
    whole = F.size("spans") == 0
    # a cut may leave part of a character, which becomes U+FFFD and is taken out of texts that were cut
    text = F.when(whole, F.col("text")).otherwise(F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "�", ""))
    cleaned = cleaned.withColumn("text", text)
    return cleaned.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces of sequences of at most 1024 tokens.

    Null and empty texts are packed as their end token; repeated rows are packed as often as they stand.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("best_fit_packing", packing),
]

ORACLE_SQL = None  # trained models, shingle hashes and token merges have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
