"""What several operators share: shared tables, whole rows of text, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch_path

MAX_ROUNDS = 64


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: cuts lineage and recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in ``spark.checkpoint.dir`` (a folder of our own where that is unset)."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def beside_text(docs: DataFrame, columns: tuple[str, ...], more: str) -> tuple[DataFrame, int, StructType]:
    """``columns`` of ``docs`` and its text, the text's place, and the schema of ``columns`` with ``more``."""
    names = [*columns, *({"text"} - set(columns))]
    schema = StructType([*docs.select(*columns).schema.fields, *StructType.fromDDL(more).fields])
    return docs.select(*names), names.index("text"), schema


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the smallest node it is connected with.

    Alternating large-star and small-star rounds; every round is two joins, whose hot nodes AQE
    splits, and a pre-aggregated minimum. Ends when a round changes nothing. Nulls and loops are
    left out; no edges give no rows.
    """
    kind = edges.schema["u"].dataType
    links = (
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    links = cut(links)
    before = None
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        state = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").cast(kind).alias("node"), F.col("v").cast(kind).alias("root")).unionByName(roots)


def fold(modulus: int):
    """crc32 of doc_id as text modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> tuple[DataFrame, float]:
    """(doc_id, text, label) of at most about ``limit`` documents a class, and the share of label 1.

    Documents are taken by a hash of doc_id. The ids, of bounded number, meet the documents by a
    broadcast; a repeated document is used once.
    """
    known = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    count = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    parts = 1 << 30
    bound = F.lit(0)
    for label, n in count.items():
        bound = F.when(F.col("label") == label, int(min(1.0, limit / n) * parts)).otherwise(bound)
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(parts)) < bound)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    total = sum(count.values())
    return sample, count.get(1, 0) / total if total else 0.5
