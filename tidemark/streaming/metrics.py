"""Per-batch figures, from observed metrics rather than extra jobs."""

from __future__ import annotations

import datetime as dt
import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.operators.ingest import batch_metrics

log = logging.getLogger("tidemark")

FLUSH = 100  # batches
METRICS_SCHEMA = (
    "table string, query_id string, batch_id bigint, rows bigint, fallback_rows bigint, "
    "malformed_rows bigint, min_change_us bigint, max_change_us bigint, "
    "input_rows bigint, duration_ms bigint, recorded_at timestamp, late_rows bigint"
)
DRIFT_SCHEMA = "table string, query_id string, batch_id bigint, fields array<string>, messages bigint"


def observed(rows: DataFrame, name: str, event_time: str = "change_ts") -> DataFrame:
    """Count while the batch is written; the name is reported with the progress."""
    return rows.observe(name, *batch_metrics(rows, event_time))


def progress_row(progress, name: str) -> tuple | None:
    """One metrics row out of a progress report, or None if it is another query's."""
    seen = progress.observedMetrics.get(name)
    if seen is None:
        return None
    return (
        name,
        str(progress.id),
        progress.batchId,
        seen["rows"],
        seen["fallback_rows"],
        seen["malformed_rows"],
        seen["min_change_us"],
        seen["max_change_us"],
        progress.numInputRows,
        progress.batchDuration,
        dt.datetime.now(dt.timezone.utc),
        late_rows(progress),
    )


def late_rows(progress) -> int:
    """Rows that came after the watermark and were dropped, by all stateful steps of a query."""
    return sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)


def drift_rows(progress, name: str) -> list[tuple]:
    """A row per set of unknown keys in a progress report."""
    seen = progress.observedMetrics.get(drift_name(name))
    sets = (seen["sets"] or []) if seen is not None else []
    return [(name, str(progress.id), progress.batchId, json.loads(s["item"]), s["count"]) for s in sets if s["item"] is not None]


def drift_name(name: str) -> str:
    return f"{name}_drift"


def log_batch(row: tuple) -> None:
    table, _, batch, rows, fallback = row[:5]
    if not rows:
        log.info("[%s batch %s] no rows to write", table, batch)
        return
    log.info("[%s batch %s] wrote %s rows", table, batch, rows)
    if fallback:
        log.warning("[%s batch %s] %s rows without a usable date", table, batch, fallback)


class BatchMetrics(StreamingQueryListener):
    """Logs every batch of one query and appends the figures to a Parquet table, many at a time.

    Rows wait until ``FLUSH`` of them are there or the query ends; the listener
    then takes itself off. Started before its query, it knows it by its name
    and from then on by its id. Unknown keys of messages, where they are observed,
    go to a table of their own beside it.
    """

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, query: str | None = None) -> None:
        self.spark = spark
        self.name = name
        self.path = path
        self.query = query or f"ingest_{name}"
        self.id: str | None = None
        self.waiting: list[tuple] = []
        self.drift: list[tuple] = []

    def flush(self) -> None:
        waiting, self.waiting, self.drift = (self.waiting, self.drift), [], []
        places = (self.path, METRICS_SCHEMA), (drift_path(self.path) if self.path else None, DRIFT_SCHEMA)
        for rows, (path, schema) in zip(waiting, places, strict=True):
            if path and rows:
                self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def onQueryStarted(self, event) -> None:
        if event.name == self.query and self.id is None:
            self.id = str(event.id)
            log.info("[%s] query %s started", self.name, self.id)

    def onQueryProgress(self, event) -> None:
        row = progress_row(event.progress, self.name) if str(event.progress.id) == self.id else None
        if row is None:
            return
        log_batch(row)
        self.waiting.append(row)
        found = drift_rows(event.progress, self.name)
        for _, _, batch, fields, messages in found:
            log.warning("[%s batch %s] %s messages with unknown fields %s", self.name, batch, messages, ", ".join(fields))
        self.drift += found
        if len(self.waiting) >= FLUSH:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) != self.id:
            return
        if event.exception:
            log.error("[%s] query stopped: %s", self.name, event.exception)
        self.flush()
        self.spark.streams.removeListener(self)


def settle(spark: SparkSession) -> None:
    """Wait until listeners have seen everything that has happened."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()


def drift_path(path: str) -> str:
    return f"{path.rstrip('/')}_drift"


def read_drift(spark: SparkSession, path: str) -> DataFrame:
    """Unknown fields of all batches whose figures are at ``path``: messages by table and field."""
    where = spark._jvm.org.apache.hadoop.fs.Path(drift_path(path))
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "table string, field string, messages long")
    rows = spark.read.schema(DRIFT_SCHEMA).parquet(drift_path(path)).dropDuplicates(["query_id", "batch_id", "fields"])
    fields = rows.select("table", F.explode("fields").alias("field"), "messages")
    return fields.groupBy("table", "field").agg(F.sum("messages").alias("messages"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Figures of all batches; a batch that ran again counts once."""
    return spark.read.schema(METRICS_SCHEMA).parquet(path).dropDuplicates(["query_id", "batch_id"])
