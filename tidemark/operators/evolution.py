"""Changing schemas: find drift, read old files under a new schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.parse import message_text


def unknown_keys(records: DataFrame, known: list[str]) -> DataFrame:
    """Keys found in messages but not in the schema, with the number of messages."""
    keys = F.array_except(F.json_object_keys(message_text()), F.array(*[F.lit(k) for k in known]))
    return records.select(F.explode(keys).alias("field")).groupBy("field").agg(
        F.count(F.lit(1)).alias("messages")
    )


def unknown_key_set(known: list[str]) -> Column:
    """The message's keys that the schema lacks, sorted, as a JSON array; null where there are none."""
    keys = F.array_sort(F.array_except(F.json_object_keys(message_text()), F.array(*[F.lit(k) for k in known])))
    return F.when(F.size(keys) > 0, F.to_json(keys))


def drift_observed(records: DataFrame, known: list[str], name: str) -> DataFrame:
    """``records``, of whose unknown keys a sketch is observed under ``name`` while something else is done with them.

    It counts the messages of the 64 most frequent sets of unknown keys, exactly for up to 1024 different
    sets; it merges over tasks and its size is bounded for any number of them.
    """
    marked = records.withColumn("_unknown", unknown_key_set(known))
    return marked.observe(name, F.expr("approx_top_k(_unknown, 64, 1024)").alias("sets")).drop("_unknown")


# Parquet types the reader widens without a rewrite
_WIDER = {
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def widens(was: T.DataType, now: T.DataType) -> bool:
    """Whether files of the one type are read as the other without a rewrite."""
    return was == now or now.simpleString() in _WIDER.get(was.simpleString(), ())


def converted(spark: SparkSession, schema: T.StructType, written: T.StructType | None, read) -> DataFrame:
    """Rows of files that hold ``written`` (unknown: ``schema``) under ``schema``; ``read(schema)`` opens them.

    What Parquet does not widen is read as it was written and cast; values that have no counterpart become
    null, as do columns that the files lack.
    """
    was = {f.name: f.dataType for f in written.fields} if written else {}
    other = {f.name for f in schema.fields if f.name in was and not widens(was[f.name], f.dataType)}
    opened = read(T.StructType([T.StructField(f.name, was[f.name] if f.name in other else f.dataType) for f in schema.fields]))
    return opened.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in other else F.col(f.name) for f in schema.fields])


def check_widening(old: T.StructType, new: T.StructType) -> None:
    """Reject a new schema under which files of the old one cannot be read."""
    for field in new.fields:
        if field.name not in old.fieldNames():
            if not field.nullable:
                raise ValueError(f"added column {field.name} must be nullable")
            continue
        was, now = old[field.name].dataType, field.dataType
        if not widens(was, now):
            raise ValueError(f"column {field.name}: {was.simpleString()} to {now.simpleString()} needs a rewrite of the files")


def read_evolved(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Read files of any version under the newest schema.

    Columns a file lacks are null and narrower numbers are widened. The schema
    is given rather than merged, which would read every footer and fails on
    changed types.
    """
    return spark.read.schema(schema).parquet(*paths)
