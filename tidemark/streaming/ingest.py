"""Streaming ingestion of one or many tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.evolution import drift_observed
from tidemark.operators.ingest import to_raw
from tidemark.spec import TableSpec
from tidemark.streaming.metrics import BatchMetrics, drift_name, observed
from tidemark.streaming.manifest import manifest_writer
from tidemark.streaming.sinks import epoch_writer

TRIGGER = {"processingTime": "10 seconds"}


def start_ingest(
    records: DataFrame,
    spec: TableSpec,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    rebalance: bool = True,
    drift: bool = False,
    **options,
) -> StreamingQuery:
    """Land a stream of broker records; metrics are observed under the table name, with ``drift`` unknown fields too.

    With lineage every epoch is committed to the zone's manifest.
    """
    if drift:
        records = drift_observed(records, spec.columns, drift_name(spec.table))
    rows = observed(to_raw(records, spec, **options), spec.table, spec.event_time)
    writer = manifest_writer if options.get("lineage") else epoch_writer
    return (
        rows.writeStream.queryName(f"ingest_{spec.table}")
        .foreachBatch(writer(out, rebalance=rebalance))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start()
    )


def ingest_tables(
    spark: SparkSession,
    specs: list[TableSpec],
    source,
    root: str,
    trigger: dict | None = None,
    metrics: bool = True,
    **options,
) -> list[StreamingQuery]:
    """One query per table in one application; ``source(spec)`` opens a table's stream."""
    queries = []
    for spec in specs:
        if metrics:
            spark.streams.addListener(BatchMetrics(spark, spec.table, f"{root}/metrics/{spec.table}"))
        queries.append(
            start_ingest(
                source(spec),
                spec,
                f"{root}/raw/{spec.table}",
                f"{root}/checkpoints/{spec.table}",
                trigger,
                **options,
            )
        )
    return queries
