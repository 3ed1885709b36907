"""Bring a variant feed to the canonical table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import conform_id
from tidemark.spec import TableSpec


def rename(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Apply a version's column names; unknown names are ignored."""
    return df.withColumnsRenamed(aliases)


def conform(df: DataFrame, variant: TableSpec, canonical: TableSpec) -> DataFrame:
    """Canonical column names, types, codes and ids; columns the feed lacks become null."""
    rows = rename(df, variant.aliases)
    changed = {c: F.upper(c) for c in variant.upper}
    changed |= {c: conform_id(F.col(c), i["prefix"], i["width"]) for c, i in variant.ids.items()}
    rows = rows.withColumns(changed) if changed else rows
    present = set(rows.columns)
    wanted = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in canonical.schema.fields
    ]
    kept = [c for c in rows.columns if c not in canonical.columns and c not in variant.columns]
    return rows.select(*wanted, *kept)


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
