"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.alignment import alignment_scores
from tidemark.llm.ann import nearest
from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.common import fold, table
from tidemark.llm.embedding_dedup import embedding_groups
from tidemark.llm.licenses import license_labels, license_sql
from tidemark.llm.lm import lm_scores
from tidemark.llm.packing import pack_documents
from tidemark.llm.prefix_trie import prefix_trie, rebuilt
from tidemark.llm.quality import quality_scores
from tidemark.llm.simhash import simhash_groups
from tidemark.llm.sql import LINKS_SQL, REPEATS_SQL
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.toxicity import toxicity_scores
from tidemark.llm.url_sql import URL_SQL
from tidemark.llm.urls import Rule, url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add

# The rules that the url filter is given.
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


@query(REPEATS_SQL)
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that occur elsewhere too."""
    cleaned = remove_repeats(table(spark, sf_dir, "documents"), width=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query(URL_SQL)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES, order=4)


@query(LINKS_SQL)
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of embeddings by cosine."""
    return embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query()
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoding, as digests."""
    coded = bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


def judged(spark: SparkSession, sf_dir: str, docs: DataFrame, column: str, modulus: int, held: int, score) -> DataFrame:
    """Scores of ``docs`` by a classifier that learns ``column`` of labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(fold(modulus) != held).select("doc_id", F.col(column).alias("label"))
    held_out = F.coalesce(fold(modulus) == held, F.lit(False))
    return score(docs, labels).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by compressed sizes."""
    return judged(spark, sf_dir, table(spark, sf_dir, "documents"), "quality", 5, 0, quality_scores)


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a recurrent network over windows."""
    return judged(spark, sf_dir, table(spark, sf_dir, "documents"), "toxic", 4, 2, toxicity_scores)


@query()
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents by SimHash."""
    return simhash_groups(table(spark, sf_dir, "documents"), width=3, radius=2)


@query()
def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by a Kneser-Ney model."""
    scored = lm_scores(table(spark, sf_dir, "documents"), fold(7) != 2)
    return scored.select("doc_id", F.coalesce(fold(7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every embedding whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, tables=16, axes=3)


@query()
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return prefix_trie(*rebuilt(table(spark, sf_dir, "conversations"), donor_every=20, heads=4))


@query(license_sql())
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence passages in every document."""
    return license_labels(table(spark, sf_dir, "documents"))


@query()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, linked by the bytes they share."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment_scores(table(spark, sf_dir, "documents"), *paths)
