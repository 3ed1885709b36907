"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Every comparison of ISO text assumes UTC; the rest lets AQE size shuffle
# partitions, split skewed join partitions and turn small sides into broadcasts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session somebody else built."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the duration of a block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def state_partitions(spark: SparkSession) -> dict[str, str]:
    """Settings for a stateful stream: in local mode, no more state stores than cores.

    A stream keeps one store per shuffle partition and operator, and AQE cannot
    merge them. On a cluster the session's own setting stands.
    """
    name = "spark.sql.shuffle.partitions"
    asked, cores = int(spark.conf.get(name)), spark.sparkContext.defaultParallelism
    return {name: str(min(asked, cores) if spark.sparkContext.master.startswith("local") else asked)}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    Without that setting a machine-local folder is used in local mode only: on
    a cluster other executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
