"""Which folders of the raw zone are live: a log of commits, and the days and offsets each folder holds.

A folder is written first and becomes visible by its commit, one small file that is moved to the next
version's name and never replaced. Folders that take the place of others come and go in one commit, so
that a reader sees either all of the old ones or all of the new one.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.evolution import converted, widens
from tidemark.operators.ingest import PARTITIONS, to_raw
from tidemark.operators.offsets import RANGES, inside, landed_ranges, merge_ranges, missing_ranges, outside
from tidemark.spec import TableSpec
from tidemark.streaming.sinks import epoch_path, folders, query_id, remove, write_batch

PLACED = "kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, partition_date date, op string"
LANDED = ("kafka_topic", "kafka_partition", "kafka_offset")
STATE_EVERY = 50  # commits after which one states all live folders, and older ones go


class Conflict(RuntimeError):
    """A folder that a commit replaces was replaced by another one meanwhile."""


class Manifest:
    """The live folders of a zone; ``live`` maps a folder to its days, row count, times and last offsets."""

    def __init__(self, spark: SparkSession, zone: str) -> None:
        self.spark = spark
        self.zone = zone.rstrip("/")
        self.path = f"{self.zone}/_manifest"
        self.version = -1
        self.live: dict[str, dict] = {}
        self.gone: list[tuple[str, int]] = []  # folders or days without a reader, and since which version
        self.refresh()

    # --- the log

    def _file(self, version: int) -> str:
        return f"{self.path}/log/{version:020d}.json"

    def _system(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        """Whether anything was ever committed."""
        return self.version >= 0

    def refresh(self) -> Manifest:
        """Read the commits since the last one known."""
        where, system = self._system(f"{self.path}/log")
        if not system.exists(where):
            return self
        names = sorted(s.getPath().getName() for s in system.listStatus(where) if s.getPath().getName().endswith(".json"))
        new = [f"{self.path}/log/{n}" for n in names if int(n.removesuffix(".json")) > self.version]
        if new:
            bodies = [json.loads(r.value) for r in self.spark.read.text(new, wholetext=True).collect()]
            bodies.sort(key=lambda b: b["version"])
            if bodies[0]["version"] != self.version + 1:  # the ones between are gone: begin with a stated one
                bodies = bodies[next(i for i, b in enumerate(bodies) if "state" in b) :]
            for body in bodies:
                self._apply(body)
        return self

    def _apply(self, body: dict) -> None:
        self.version = body["version"]
        if "state" in body:
            self.live = {f: dict(e) for f, e in body["state"].items()}
            self.gone = [(p, n) for p, n in body["gone"]]
            return
        for folder, days in body["drop"].items():
            entry = self.live[folder]
            entry["days"] = [d for d in entry["days"] if d not in days]
            self.gone += [(f"{folder}/partition_date={d}", self.version) for d in days]
            if not entry["days"]:
                del self.live[folder]
                self.gone.append((folder, self.version))
        for folder, entry in body["add"].items():
            self.live[folder] = dict(entry)
        retired = set(body["retired"])
        self.gone = [(p, n) for p, n in self.gone if p not in retired]

    def _create(self, version: int, body: dict) -> bool:
        """Write the file of a version whole, unless there is one."""
        jvm = self.spark._jvm
        target, system = self._system(self._file(version))
        draft, _ = self._system(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = system.create(draft, True)
        try:
            out.write(bytearray(json.dumps(body).encode()))
        finally:
            out.close()
        system.mkdirs(target.getParent())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(target), options)
        except Exception as error:  # py4j wraps the one that says that the file is there
            if "FileAlreadyExists" not in str(error):
                raise
            system.delete(draft, False)
            return False
        return True

    def commit(self, add: dict[str, dict] | None = None, drop: dict[str, list[str]] | None = None, retired: list[str] = ()) -> None:
        """Make folders visible and take days of others out of sight, at once.

        A commit that comes second takes the next version; it fails if what it drops is gone by then.
        """
        while True:
            self.refresh()
            for folder, days in (drop or {}).items():
                if not set(days) <= set(self.live.get(folder, {"days": []})["days"]):
                    raise Conflict(f"{folder} was replaced meanwhile")
            body = {"version": self.version + 1, "add": add or {}, "drop": drop or {}, "retired": list(retired)}
            if self._create(self.version + 1, body):
                self._apply(body)
                break
        stated = {"version": self.version + 1, "state": self.live, "gone": self.gone}
        if self.version % STATE_EVERY == STATE_EVERY - 1 and self._create(self.version + 1, stated):
            self.version += 1
            for old in range(self.version - STATE_EVERY, self.version - 2 * STATE_EVERY, -1):  # a cycle stays for late readers
                where, system = self._system(self._file(old))
                if old >= 0 and system.exists(where):
                    system.delete(where, False)

    # --- folders

    def _rows(self, folder: str) -> DataFrame:
        return self.spark.read.schema(PLACED).option("basePath", self.zone).parquet(f"{self.zone}/{folder}")

    def _side(self, kind: str, folder: str) -> str:
        return f"{self.path}/{kind}/{folder.replace('/', '+').replace('=', '-')}"

    def high(self) -> dict[str, int]:
        """The last offset of each topic and partition among all live folders."""
        out: dict[str, int] = {}
        for entry in self.live.values():
            for place, last in entry["high"].items():
                out[place] = max(last, out.get(place, last))
        return out

    def describe(self, folder: str, schema: T.StructType | None = None) -> dict:
        """Days, rows, times and offsets of a folder, from its narrow columns; its ranges go to a side table.

        ``schema`` is what its files hold, kept as its version.
        """
        rows = self._rows(folder)
        days = rows.groupBy("partition_date").agg(
            F.count("*").alias("rows"), F.min("kafka_timestamp").alias("first"), F.max("kafka_timestamp").alias("last")
        )
        days = days.collect()  # a row a day
        records = rows.select(F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))
        landed_ranges(records).withColumn("folder", F.lit(folder)).coalesce(1).write.mode("overwrite").parquet(self._side("ranges", folder))
        tops = self._ranges([folder]).groupBy("topic", "partition").agg(F.max("last").alias("last")).collect()
        time = lambda values, pick: str(pick(v)) if (v := [v for v in values if v is not None]) else None
        return {
            "days": sorted(str(d.partition_date) for d in days),
            "rows": sum(d.rows for d in days),
            "first_time": time([d["first"] for d in days], min),
            "last_time": time([d["last"] for d in days], max),
            "high": {f"{r.topic}/{r.partition}": r["last"] for r in tops},
            "schema": schema.jsonValue() if schema else None,
        }

    def add(self, folder: str, schema: T.StructType | None = None) -> None:
        """Commit a folder that was written, and note the offsets missing since the ones before it."""
        entry = self.describe(folder, schema)
        carried = [(*_place(p), last, last) for p, last in self.high().items()]
        before = self.spark.createDataFrame(carried, RANGES)
        gaps = missing_ranges(before.unionByName(self._ranges([folder])))
        # what lies below the carried offset was noted by an earlier folder, or is old and landed late
        low = before.select("topic", "partition", F.col("last").alias("_carried"))
        gaps = gaps.join(low, ["topic", "partition"], "left").where("_carried is null or first > _carried").drop("_carried")
        gaps.coalesce(1).write.mode("overwrite").parquet(self._side("lost", folder))
        if entry["days"]:
            self.commit({folder: entry})

    def _ranges(self, some: list[str]) -> DataFrame:
        if not some:
            return self.spark.createDataFrame([], RANGES)
        return self.ranges_by_folder(some).select(*T.StructType.fromDDL(RANGES).names)

    def ranges_by_folder(self, some: list[str]) -> DataFrame:
        return self.spark.read.schema(f"{RANGES}, folder string").parquet(*[self._side("ranges", f) for f in some])

    def ranges(self) -> DataFrame:
        """Offsets of all live folders, as few ranges (``RANGES``)."""
        return merge_ranges(self._ranges(list(self.live)))

    def holding(self, wanted: DataFrame) -> dict[str, list[str]]:
        """Live folders with those of their days that hold offsets of ``wanted`` (``RANGES``)."""
        if not self.live:
            return {}
        w = wanted.select("topic", "partition", F.col("first").alias("_first"), F.col("last").alias("_last"))
        crossing = self.ranges_by_folder(list(self.live)).join(w, ["topic", "partition"]).where("first <= _last and last >= _first")
        hit = [r.folder for r in crossing.select("folder").distinct().collect()]  # no more than live folders
        if not hit:
            return {}
        paths = [f"{self.zone}/{f}/partition_date={d}" for f in hit for d in self.live[f]["days"]]
        rows = self.spark.read.schema(f"{PLACED}, generation string, batch_id string").option("basePath", self.zone).parquet(*paths)
        name = F.format_string("generation=%s/batch_id=%s", "generation", "batch_id").alias("folder")
        days = inside(rows, wanted, LANDED).select(name, F.col("partition_date").cast("string").alias("day")).distinct()
        found: dict[str, list[str]] = {}
        for r in days.collect():  # no more than days of live folders
            found.setdefault(r.folder, []).append(r.day)
        return {f: sorted(d) for f, d in found.items()}

    def lost(self) -> DataFrame:
        """Offsets that were missing when a folder came (``RANGES``), each noted once, by the folder after the gap."""
        kept = folders(self.spark, f"{self.path}/lost")
        if not kept:
            return self.spark.createDataFrame([], RANGES)
        return self.spark.read.schema(RANGES).parquet(*[f"{self.path}/lost/{n}" for n in kept])

    def days(self, first: dt.date | None = None, last: dt.date | None = None) -> dict[str, list[str]]:
        """Live folders with their days in a range, those without any left out."""
        inside = lambda d: (first is None or d >= str(first)) and (last is None or d <= str(last))
        found = {f: [d for d in e["days"] if inside(d)] for f, e in self.live.items()}
        return {f: days for f, days in found.items() if days}

    def adopt(self) -> None:
        """Commit the epoch folders of a zone that was written without a log."""
        for generation in folders(self.spark, self.zone):
            for epoch in folders(self.spark, f"{self.zone}/{generation}") if generation.startswith("generation=") else []:
                if f"{generation}/{epoch}" not in self.live:
                    self.add(f"{generation}/{epoch}")

    def entries(self) -> DataFrame:
        """The live folders as a table: a row per folder and day."""
        rows = [(f, dt.date.fromisoformat(d), e["rows"], e["first_time"], e["last_time"]) for f, e in self.live.items() for d in e["days"]]
        return self.spark.createDataFrame(rows, "folder string, day date, folder_rows long, first_time string, last_time string")

    def scan(self, schema: T.StructType, first: dt.date | None = None, last: dt.date | None = None, some: list[str] | None = None) -> DataFrame:
        """Rows of the live folders, or ``some`` of them; only the folders of the days asked for are listed.

        Folders of an older version are read as they were written and brought to ``schema``.
        """
        wanted = {f: days for f, days in self.days(first, last).items() if some is None or f in some}
        return self._read(schema, wanted)

    def _read(self, schema: T.StructType, wanted: dict[str, list[str]]) -> DataFrame:
        versions: dict[str, list[str]] = {}
        for f, days in wanted.items():
            version = json.dumps(self.live[f].get("schema"), sort_keys=True)
            versions.setdefault(version, []).extend(f"{self.zone}/{f}/partition_date={d}" for d in days)
        rows = None
        for version, paths in versions.items():  # as many as the table had schemas
            written = T.StructType.fromJson(json.loads(version)) if version != "null" else None
            opened = converted(self.spark, schema, written, lambda s, p=paths: self.spark.read.schema(s).option("basePath", self.zone).parquet(*p))
            rows = opened if rows is None else rows.unionByName(opened)
        return self.spark.createDataFrame([], schema) if rows is None else rows

    def outdated(self, schema: T.StructType) -> list[str]:
        """Live folders with a column that ``schema`` has in a type which Parquet does not widen to."""
        found = []
        for folder, entry in self.live.items():
            was = T.StructType.fromJson(entry["schema"]).fields if entry.get("schema") else []
            if any(f.name in schema.fieldNames() and not widens(f.dataType, schema[f.name].dataType) for f in was):
                found.append(folder)
        return found

    def rewrite(self, schema: T.StructType) -> str | None:
        """Write the folders of outdated versions again under ``schema``, as one folder that takes their place."""
        old = self.outdated(schema)
        if not old:
            return None
        covered = {f: self.live[f]["days"] for f in old}
        folder = f"generation=rewritten/batch_id={self.version + 1}"
        write_batch(self._read(schema, covered), f"{self.zone}/{folder}")
        self.commit({folder: self.describe(folder, schema)}, covered)
        return folder

    def merge(self, schema: T.StructType, first: dt.date | None = None, last: dt.date | None = None) -> str | None:
        """Rewrite the days of a range that lie in several folders into one, and let go of what it covers.

        Files are deleted one merge later, for those who still read them.
        """
        spread: dict[str, int] = {}
        for days in self.days(first, last).values():
            for d in days:
                spread[d] = spread.get(d, 0) + 1
        covered = {f: [d for d in days if spread[d] > 1] for f, days in self.days(first, last).items()}
        covered = {f: days for f, days in covered.items() if days}
        doomed = [p for p, _ in self.gone]
        if not covered:
            self.retire(doomed)
            return None
        folder = f"generation=merged/batch_id={self.version + 1}"
        write_batch(self._read(schema, covered), f"{self.zone}/{folder}")
        self.commit({folder: self.describe(folder, schema)}, covered)
        self.retire(doomed)
        return folder

    def retire(self, paths: list[str]) -> None:
        for path in paths:
            remove(self.spark, f"{self.zone}/{path}")
        if paths:
            self.commit(retired=paths)


def _place(text: str) -> tuple[str, int]:
    topic, partition = text.rsplit("/", 1)
    return topic, int(partition)


def manifest_writer(zone: str, by: list[str] = PARTITIONS, rebalance: bool = True) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback: the epoch's folder, then its commit; a repeated batch replaces both."""
    known: list[Manifest] = []

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        generation = query_id(spark)
        write_batch(batch, epoch_path(zone, generation, epoch), by, rebalance)
        if not known:
            known.append(Manifest(spark, zone))
        known[0].refresh().add(f"generation={generation}/batch_id={epoch}", batch.schema)

    return write


def replay_once(records: DataFrame, spec: TableSpec, manifest: Manifest, schema: T.StructType, replace: bool = False, **options) -> str | None:
    """Land records so that every offset is landed once, whatever was landed before; the new folder's name.

    Offsets that are landed already are skipped. With ``replace`` they are taken out of the days of
    folders that hold them instead: what else those days held is written again beside the new rows, and
    one commit swaps them. Records that repeat an offset count once.
    """
    key = ["topic", "partition", "offset"]
    folder = f"generation=replay/batch_id={manifest.refresh().version + 1}"
    path = f"{manifest.zone}/{folder}"
    covered: dict[str, list[str]] = {}
    if not replace:
        new = outside(records, manifest.ranges()).dropDuplicates(key)
        write_batch(to_raw(new, spec, **options).select(*schema.fieldNames()), path)
    else:
        new = to_raw(records.dropDuplicates(key), spec, **options).select(*schema.fieldNames())
        wanted = landed_ranges(records).persist()
        try:
            covered = manifest.holding(wanted)
            if covered:
                kept = outside(manifest._read(schema, covered), wanted, LANDED)
                new = new.unionByName(kept.select(*schema.fieldNames()))
            write_batch(new, path)
        finally:
            wanted.unpersist()
    entry = manifest.describe(folder, schema)
    if not entry["days"]:
        remove(manifest.spark, path)
        return None
    manifest.commit({folder: entry}, covered)
    return folder
