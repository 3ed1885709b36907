"""Change events as broker records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import key_partition, message_key
from tidemark.operators.diff import snapshot_diff


def iso_text(ts: Column) -> Column:
    """ISO text with microseconds and no offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def stamp_events(rows: DataFrame, op: Column, at: Column) -> DataFrame:
    """Rows of a table as full-row change events."""
    return rows.select("*", at.alias("change_ts"), op.alias("op"))


def to_records(
    events: DataFrame, keys: list[str], topic: str, partitions: int = 3, columns: list[str] | None = None
) -> DataFrame:
    """``key, value, topic, partition`` ready for the Kafka sink.

    Null columns are left out of the JSON, which is the patch encoding.
    """
    ids = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if len(keys) > 1 else F.col(keys[0])
    return events.select(
        message_key(F.col("op"), ids).alias("key"),
        F.to_json(F.struct(*(columns or events.columns))).alias("value"),
        F.lit(topic).alias("topic"),
        key_partition(ids, partitions).alias("partition"),
    )


def change_events(
    old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], at: Column, patch: bool = False
) -> DataFrame:
    """I, U and D events, stamped ``at``, for the keys that differ between two states of a table."""
    return snapshot_diff(old, new, keys, columns, patch).withColumn("change_ts", at)


class Published:
    """What was published of a table: a snapshot per run, of which finished ones are marked.

    The rows of a run are frozen first, then their difference to the last finished run goes out, then the
    run is marked. A run that stops before its mark is done again by the next one: its events may go out
    twice, none is left out.
    """

    MARK = "_PUBLISHED"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _system(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self) -> list[int]:
        """Finished runs in order."""
        where, system = self._system(self.path)
        if not system.exists(where):
            return []
        names = [s.getPath().getName() for s in system.listStatus(where)]
        numbers = sorted(int(n.removeprefix("run=")) for n in names if n.startswith("run="))
        return [n for n in numbers if system.exists(self._system(f"{self.path}/run={n}/{self.MARK}")[0])]

    def snapshot(self, schema) -> DataFrame:
        """Rows of the last finished run; none before the first."""
        done = self.runs()
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/run={done[-1]}")

    def run(self, rows: DataFrame, keys: list[str], topic: str, at: Column, send, patch: bool = False) -> int:
        """Freeze ``rows``, give the records of the keys that changed to ``send(records, run)``, mark the run."""
        done = self.runs()
        number = done[-1] + 1 if done else 0
        path = f"{self.path}/run={number}"
        rows.write.mode("overwrite").parquet(path)
        new = self.spark.read.schema(rows.schema).parquet(path)
        columns = [c for c in rows.columns if c not in keys]
        events = change_events(self.snapshot(rows.schema), new, keys, columns, at, patch)
        send(to_records(events, keys, topic), number)
        mark, system = self._system(f"{path}/{self.MARK}")
        system.create(mark, True).close()
        for old in done[:-1]:  # the last one stays for those who still read it
            where, system = self._system(f"{self.path}/run={old}")
            system.delete(where, True)
        return number


def publish(records: DataFrame, servers: str | None = None, path: str | None = None) -> None:
    """Write to Kafka, or as Parquet where there is no broker."""
    if servers:
        records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    elif path:
        records.write.mode("overwrite").parquet(path)
    else:
        raise ValueError("give broker servers or a path")
