"""Arrays in the shared folder that workers write whole and map into memory, and rows dealt as blobs."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.session import scratch_path


def shared_folder(df: DataFrame, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which workers map into memory: it must be mounted."""
    path = scratch_path(df.sparkSession, name)
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"memory-mapped arrays need a mounted shared folder, not {path}")
    return path


def put(folder: str, name: str, rows: np.ndarray) -> None:
    """Write whole or not at all, so that a repeated task does no harm."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as file:
        np.save(file, rows)
    os.replace(part, f"{folder}/{name}.npy")


def mapped(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def blob(rows: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(rows, kind).tobytes()


def joined(blobs: list, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(b[name] for b in blobs), kind)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts[order], np.flatnonzero(first))


def gathered(df: DataFrame, shards: int, write: Callable, schema: str) -> DataFrame:
    """Rows that ``write(shard, rows)`` gives for all rows of a shard, one task for a few of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["shard"], []).append(row)
        for shard in sorted(held):
            yield from write(shard, held.pop(shard))

    return df.repartition(shards, "shard").mapInArrow(run, schema)
