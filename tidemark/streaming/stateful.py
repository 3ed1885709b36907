"""Current state of a patch feed held in Spark's state store.

The alternative to ``state``: every key's row lives in the store and each batch
emits the keys it changed. A key's events meet in one task, so ``state``, which
pre-aggregates, is the choice for feeds with hot keys.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.fold import DELETE

# Executors need not have this package installed: the processor travels whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# transformWithState needs this store; set it before the query starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


def _fields(columns: T.StructType) -> list[T.StructField]:
    fields = [T.StructField("seen", T.StringType()), T.StructField("op", T.StringType()), T.StructField("deleted", T.StringType())]
    for f in columns.fields:
        fields += [f, T.StructField(f"{f.name}_at", T.StringType())]
    return fields


class PatchState(StatefulProcessor):
    """Keeps the latest value of each column with its position, as the batch fold does."""

    def __init__(self, columns: T.StructType, shown: list[str]) -> None:
        self.columns = columns.fieldNames()
        self.shown = shown
        self.schema = T.StructType(_fields(columns))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("row", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.schema.fieldNames()
        held = dict(zip(names, self.state.get())) if self.state.exists() else dict.fromkeys(names)
        for r in rows:
            at = r["position"]
            if held["seen"] is None or at > held["seen"]:
                held["seen"], held["op"] = at, r["op"]
            if r["op"] == DELETE and (held["deleted"] is None or at > held["deleted"]):
                held["deleted"] = at
            for c in self.columns:
                if r[c] is not None and (held[f"{c}_at"] is None or at > held[f"{c}_at"]):
                    held[c], held[f"{c}_at"] = r[c], at
        self.state.update(tuple(held[n] for n in names))
        gone = held["deleted"] or ""
        alive = [held[c] if (held[f"{c}_at"] or "") > gone else None for c in self.columns]
        yield Row(**dict(zip(self.shown, [*key, held["seen"], held["op"], *alive])))

    def close(self) -> None:
        pass


def position(order: list[str]) -> Column:
    """Event time and integer coordinates as text that sorts like them.

    The shift keeps times since year 1 positive.
    """
    at, *rest = order
    micros = F.unix_micros(F.col(at).cast("timestamp")) + F.lit(62_135_596_800_000_000)
    parts = [micros, *[F.col(c) for c in rest]]
    return F.concat_ws(".", *[F.lpad(p.cast("string"), 20, "0") for p in parts])


def live_state(events: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """A stream of upserts: key, position, op of the last event, and the row as it stands."""
    schema = events.schema
    kept = T.StructType([schema[c] for c in columns])
    out = T.StructType(
        [
            *[schema[k] for k in keys],
            T.StructField("position", T.StringType()),
            T.StructField("op", T.StringType()),
            *kept.fields,
        ]
    )
    stamped = events.select(*keys, "op", *columns, position(order).alias("position"))
    return stamped.groupBy(*keys).transformWithState(
        statefulProcessor=PatchState(kept, out.fieldNames()),
        outputStructType=out,
        outputMode="Update",
        timeMode="None",
    )
