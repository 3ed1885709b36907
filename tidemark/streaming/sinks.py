"""Zones on disk and the writers that fill them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.ingest import PARTITIONS, to_raw
from tidemark.spec import TableSpec


def spread_files(df: DataFrame, by: list[str]) -> DataFrame:
    """Bring the rows of a partition value together before a partitioned write.

    REBALANCE splits values that are too large for a task and joins those that
    are too small, so a day holding most of a batch is still written in parallel.
    """
    return df.hint("rebalance", *by)


def write_batch(df: DataFrame, path: str, by: list[str] = PARTITIONS, rebalance: bool = True) -> None:
    """Replace one folder with ``df``; writing the same batch again leaves no duplicates."""
    rows = spread_files(df, by) if rebalance else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query this callback runs in; stable over restarts."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def epoch_path(root: str, generation: str, epoch: int) -> str:
    """Epochs restart at 0 with a new checkpoint, hence the generation above them."""
    return f"{root.rstrip('/')}/generation={generation}/batch_id={epoch}"


def epoch_writer(
    root: str, by: list[str] = PARTITIONS, rebalance: bool = True
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback with a single action; errors propagate, so the batch is retried."""

    def write(batch: DataFrame, epoch: int) -> None:
        write_batch(batch, epoch_path(root, query_id(batch.sparkSession), epoch), by, rebalance)

    return write


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions present in ``df`` (trusted and quarantine zones)."""
    spread_files(df, by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*by).parquet(path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; empty if it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def latest_run(spark: SparkSession, path: str) -> str | None:
    """The newest folder ``run=N`` below ``path`` whose files are complete."""
    runs = sorted((int(n.split("=")[1]) for n in folders(spark, path) if n.startswith("run=")), reverse=True)
    for n in runs:
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run={n}/_SUCCESS")
        if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            return f"{path}/run={n}"
    return None


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def replace_days(df: DataFrame, path: str, first: dt.date | None, last: dt.date | None) -> None:
    """Rewrite the days from ``first`` to ``last`` of a zone, or all of it.

    New files are written aside and moved in day by day when all of them are
    done. Days without rows are emptied after that, which a dynamic overwrite
    would leave.
    """
    if first is None and last is None:
        write_batch(df, path, ["partition_date"])
        return
    spark = df.sparkSession
    filled = {str(r[0]) for r in df.select("partition_date").distinct().collect()}  # days of the range
    replace_partitions(df, path, ["partition_date"])
    for name in folders(spark, path):
        day = name.removeprefix("partition_date=")
        inside = (first is None or day >= str(first)) and (last is None or day <= str(last))
        if name != day and inside and day not in filled:
            remove(spark, f"{path}/{name}")


def compact(source: DataFrame, target: str, by: list[str] = PARTITIONS) -> None:
    """Rewrite closed days into few files in ``target``, one folder per partition value."""
    kept = [c for c in source.columns if c not in ("generation", "batch_id")]
    replace_partitions(source.select(*kept), target, by)


def register_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, by: list[str] = PARTITIONS
) -> None:
    """An external partitioned table over files written with ``schema``; there may be none yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


def replace_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """An external table over the files of ``path``, instead of those that it stood for."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")


def land_batch(records: DataFrame, spec: TableSpec, path: str, **options) -> None:
    """Batch ingestion: the streaming transform on a table of records."""
    write_batch(to_raw(records, spec, **options), path)
