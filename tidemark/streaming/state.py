"""Current state of a patch feed, kept up to date by a stream.

Every micro-batch is folded to one state row per key it touches and appended;
reading merges them. The fold is a maximum per column, so batches may be
replayed, late or merged twice without changing the answer, and a batch costs
what it contains rather than what the whole state holds. ``compact_state``
bounds the number of folders to read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.fold import fold_merge, fold_partial
from tidemark.streaming.sinks import epoch_path, folders, query_id


def state_writer(
    root: str, keys: list[str], order: list[str], columns: list[str]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that appends the folded batch."""

    def write(batch: DataFrame, epoch: int) -> None:
        path = epoch_path(f"{root}/level=delta", query_id(batch.sparkSession), epoch)
        fold_partial(batch, keys, order, columns).write.mode("overwrite").parquet(path)

    return write


def _complete(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _base(spark: SparkSession, root: str) -> tuple[str | None, dict[str, int]]:
    """The newest complete base and the last epoch of each generation it covers."""
    versions = sorted((int(v.split("=")[1]), v) for v in folders(spark, f"{root}/level=base"))
    for _, name in reversed(versions):
        path = f"{root}/level=base/{name}"
        if _complete(spark, f"{path}/state") and _complete(spark, f"{path}/covers"):
            covers = spark.read.parquet(f"{path}/covers").collect()  # one row per query ever run
            return path, {r["generation"]: r["epoch"] for r in covers}
    return None, {}


def _deltas(spark: SparkSession, root: str, covers: dict[str, int]) -> dict[str, list[int]]:
    """Epochs written after the base, by generation."""
    found = {}
    for folder in folders(spark, f"{root}/level=delta"):
        generation = folder.split("=", 1)[1]
        path = f"{root}/level=delta/{folder}"
        epochs = [int(b.split("=")[1]) for b in folders(spark, path)]
        found[generation] = sorted(
            e
            for e in epochs
            if e > covers.get(generation, -1) and _complete(spark, f"{path}/batch_id={e}")
        )
    return found


def read_state(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """State rows, merged; apply ``fold_result`` to see live rows."""
    base, covers = _base(spark, root)
    return _merged(spark, root, keys, base, _deltas(spark, root, covers))


def _merged(spark, root, keys, base, deltas) -> DataFrame:
    paths = [f"{base}/state"] if base else []
    for generation, epochs in deltas.items():
        paths += [epoch_path(f"{root}/level=delta", generation, e) for e in epochs]
    if not paths:
        raise ValueError(f"no state below {root}")
    return fold_merge(spark.read.parquet(*paths), keys)


def compact_state(spark: SparkSession, root: str, keys: list[str]) -> str:
    """Merge base and deltas into a new base version; what readers use stays in place."""
    base, covers = _base(spark, root)
    deltas = _deltas(spark, root, covers)
    version = int(base.rsplit("=", 1)[1]) + 1 if base else 0
    target = f"{root}/level=base/version={version}"
    _merged(spark, root, keys, base, deltas).write.mode("overwrite").parquet(f"{target}/state")
    covers |= {g: e[-1] for g, e in deltas.items() if e}
    rows = spark.createDataFrame(sorted(covers.items()), "generation string, epoch bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{target}/covers")
    return target

