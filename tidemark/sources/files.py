"""Files: landed broker records, the raw zone, master lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import TableSpec

# The columns of the Kafka source.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Broker records kept as Parquet, as a table."""
    return spark.read.schema(RECORD_SCHEMA).parquet(path)


def stream_records(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Broker records kept as Parquet, as a stream."""
    return stream_table(spark, path, RECORD_SCHEMA, files_per_batch)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet file or folder as a stream of its files.

    The path is given as a glob, for which the source takes single files too.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path)


def raw_schema(spec: TableSpec, extra: list[T.StructField] = ()) -> T.StructType:
    """Raw-zone columns: data and derived columns, then the partition columns."""
    data = [f for f in spec.schema.fields if f.name != "op"]
    if spec.parsed_date:
        data.append(T.StructField(spec.parsed_date, T.DateType()))
    if spec.stamp:
        data.append(T.StructField(spec.stamp, T.TimestampType()))
    parts = [T.StructField("partition_date", T.DateType()), T.StructField("op", T.StringType())]
    return T.StructType([*data, *extra, *parts])


def scan_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: dt.date | None = None,
    last: dt.date | None = None,
    ops: list[str] | None = None,
) -> DataFrame:
    """The raw zone, pruned by partition; the schema is given, so no footer is read for it."""
    rows = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    if first:
        rows = rows.filter(F.col("partition_date") >= F.lit(first))
    if last:
        rows = rows.filter(F.col("partition_date") <= F.lit(last))
    if ops:
        rows = rows.filter(F.col("op").isin(ops))
    return rows


def read_master(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A master list: one JSON array of objects per file."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def read_master_ids(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A master list holding bare ids: one JSON array of strings per file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "array<string>")).alias(name))
