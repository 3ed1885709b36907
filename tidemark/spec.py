"""Table configuration: one JSON file per feed describes schema, keys and rules."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

CONFIG_DIR = Path(__file__).parent / "config" / "tables"

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}
_DECIMAL = re.compile(r"decimal\((\d+),\s*(\d+)\)")


def type_of(name: str) -> T.DataType:
    """The Spark type of a config type name."""
    if name in _TYPES:
        return _TYPES[name]
    decimal = _DECIMAL.fullmatch(name)
    if decimal:
        return T.DecimalType(int(decimal[1]), int(decimal[2]))
    raise ValueError(f"unknown column type {name!r}; use one of {sorted(_TYPES)} or decimal(p,s)")


def schema_of(columns: dict[str, str] | list[dict]) -> T.StructType:
    """Build a schema from ``{name: type}`` or a list of ``{name, type, nullable}``."""
    if isinstance(columns, dict):
        columns = [{"name": name, "type": kind} for name, kind in columns.items()]
    schema = T.StructType()
    for c in columns:
        schema = schema.add(c["name"], type_of(c["type"]), c.get("nullable", True))
    return schema


def load_schema(path: str | Path) -> T.StructType:
    """Read a schema file: either a bare column array or a full table config."""
    config = json.loads(Path(path).read_text())
    return schema_of(config["columns"] if isinstance(config, dict) else config)


@dataclass(frozen=True)
class TableSpec:
    table: str
    schema: T.StructType
    topic: str
    primary_key: tuple[str, ...] = ()
    topic_pattern: str = ""  # subscribe to every topic of this name instead
    event_time: str = "change_ts"
    partition_source: str = "change_ts"
    parsed_date: str = ""  # keep the parsed partition source under this name
    stamp: str = ""  # add the processing time under this name
    mode: str = "full"  # "patch": a null column in an update means "unchanged"
    feeds: str = ""  # canonical table this variant feeds
    aliases: dict[str, str] = field(default_factory=dict)
    upper: tuple[str, ...] = ()
    ids: dict[str, dict] = field(default_factory=dict)
    parents: dict[str, str] = field(default_factory=dict)
    rules: tuple[dict, ...] = ()
    max_share: float = 0.5  # of checked rows that may be rejected before a check aborts

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def payload(self) -> list[str]:
        """Business columns: everything but key, event time and op."""
        return [c for c in self.columns if c not in (*self.primary_key, self.event_time, "op")]


def spec_from(config: dict | list, table: str) -> TableSpec:
    if isinstance(config, list):
        config = {"columns": config}
    if config.get("mode", "full") not in ("full", "patch"):
        raise ValueError(f"{table}: mode must be full or patch")
    event_time = config.get("event_time", "change_ts")
    return TableSpec(
        table=table,
        schema=schema_of(config["columns"]),
        topic=config.get("topic", f"{table}_cdc"),
        primary_key=tuple(config.get("primary_key", ())),
        topic_pattern=config.get("topic_pattern", ""),
        event_time=event_time,
        partition_source=config.get("partition_source", event_time),
        parsed_date=config.get("parsed_date", ""),
        stamp=config.get("stamp", ""),
        mode=config.get("mode", "full"),
        feeds=config.get("feeds", table),
        aliases=config.get("aliases", {}),
        upper=tuple(config.get("upper", ())),
        ids=config.get("ids", {}),
        parents=config.get("parents", {}),
        rules=tuple(config.get("rules", ())),
        max_share=config.get("max_share", 0.5),
    )


def load_spec(table: str, config_dir: str | Path = CONFIG_DIR) -> TableSpec:
    path = Path(config_dir) / f"{table}.json"
    if not path.exists():
        raise ValueError(f"no config for table {table!r} in {config_dir}")
    return spec_from(json.loads(path.read_text()), table)


def load_specs(config_dir: str | Path = CONFIG_DIR) -> dict[str, TableSpec]:
    """Every table in the folder: adding a source is adding a file."""
    return {p.stem: load_spec(p.stem, config_dir) for p in sorted(Path(config_dir).glob("*.json"))}
