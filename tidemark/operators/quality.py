"""Data-quality rules from config, compiled to column expressions.

A rule is a mapping with ``id``, ``type``, ``severity`` (error or warn) and the
arguments of its type. Nulls pass every rule except ``not_null`` and
``required_on``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parse import CORRUPT
from tidemark.operators.joins import with_parent
from tidemark.operators.skew import Skew

FAILED = "failed_rules"
REJECTED = "rejected"

# type -> condition that is true where the rule is broken, given column types
_BROKEN: dict[str, Callable[[dict, dict[str, str]], Column]] = {
    "not_null": lambda r, _: F.col(r["column"]).isNull(),
    "domain": lambda r, _: ~F.col(r["column"]).isin(r["values"]),
    "range": lambda r, _: ~F.col(r["column"]).between(r["min"], r["max"]),
    "pattern": lambda r, _: ~F.col(r["column"]).rlike(r["regex"]),
    "parseable": lambda r, types: F.col(r["column"]).isNotNull()
    & (F.try_to_timestamp(r["column"]).isNull() if types[r["column"]] == "string" else F.lit(False)),
    "product": lambda r, _: F.abs(
        F.col(r["column"]) - F.col(r["factors"][0]) * F.col(r["factors"][1])
    )
    >= r["tolerance"],
    "days_between": lambda r, types: ~F.datediff(
        _day(r["column"], types), _day(r["from"], types)
    ).between(r["min"], r["max"]),
    "required_on": lambda r, _: (F.col("op") == r["op"])
    & reduce(or_, [F.col(c).isNull() for c in r["columns"]]),
    "well_formed": lambda r, _: F.col(r.get("column", CORRUPT)).isNotNull(),
}
# types that look beyond the row
_ACROSS = ("unique", "referential")


def _day(column: str, types: dict[str, str]) -> Column:
    return F.try_to_date(column) if types[column] == "string" else F.to_date(column)


def _columns_of(rule: dict) -> list[str]:
    named = [rule.get("column"), rule.get("from"), *rule.get("columns", []), *rule.get("factors", [])]
    return [c for c in named if c]


def check(rules: list[dict], columns: list[str]) -> None:
    """Reject rules this module does not know or that name absent columns."""
    seen = set()
    for r in rules:
        if r["type"] not in _BROKEN and r["type"] not in _ACROSS:
            raise ValueError(f"rule {r['id']}: unknown type {r['type']!r}")
        if r.get("severity", "error") not in ("error", "warn"):
            raise ValueError(f"rule {r['id']}: severity must be error or warn")
        if r["id"] in seen:
            raise ValueError(f"rule {r['id']} is defined twice")
        seen.add(r["id"])
        missing = [c for c in _columns_of(r) if c not in columns]
        if missing:
            raise ValueError(f"rule {r['id']}: no column {', '.join(missing)}")


def row_rules(rules: list[dict]) -> list[dict]:
    """The rules that need nothing but the row: usable on a stream."""
    return [r for r in rules if r["type"] in _BROKEN]


def _repeated(df: DataFrame, rule: dict, flag: str) -> DataFrame:
    """Flag rows whose key occurs more than once.

    Copies are counted by a pre-aggregating group-by over the key columns alone, so a key with
    many copies is no burden. Only repeated keys meet the rows again; AQE broadcasts them where
    they are few and splits hot ones where they are not.
    """
    keys = rule["columns"]
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    copies = df.select(*keys).filter(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    names = {k: f"_key_{k}" for k in keys}
    again = copies.filter(F.col("_copies") > 1).select(*[F.col(k).alias(n) for k, n in names.items()])
    same = reduce(and_, [F.col(k) == F.col(n) for k, n in names.items()])
    marked = df.join(again, same, "left").withColumn(flag, F.col(names[keys[0]]).isNotNull())
    return marked.drop(*names.values())


def _dangling(df: DataFrame, rule: dict, parent: DataFrame, flag: str, skew: Skew | None, rows: DataFrame) -> DataFrame:
    column = rule["column"]
    present = parent.select(F.col(rule["parent_column"]).alias(column)).distinct()
    marked = with_parent(df, present.withColumn("_found", F.lit(True)), [column], "left", skew=skew, rows=rows)
    missing = F.col(column).isNotNull() & F.col("_found").isNull()
    return marked.withColumn(flag, missing).drop("_found")


def evaluate(
    df: DataFrame,
    rules: list[dict],
    parents: dict[str, DataFrame] | None = None,
    skew: Skew | None = None,
) -> DataFrame:
    """Add ``failed_rules``, the ids of the rules a row breaks, in rule order,
    and ``rejected``, whether an error rule is among them.

    Row rules are one projection. ``unique`` and ``referential`` rules add a
    join each; ``parents`` holds the parent tables by name.
    """
    check(rules, df.columns)
    rows, kept, types = df, df.columns, dict(df.dtypes)
    broken = []
    for i, rule in enumerate(rules):
        flag = f"_broken_{i}"
        if rule["type"] == "unique":
            df = _repeated(df, rule, flag)
            broken.append((rule, F.col(flag)))
        elif rule["type"] == "referential":
            parent = (parents or {}).get(rule["parent"])
            if parent is None:
                raise ValueError(f"rule {rule['id']} needs the table {rule['parent']!r}")
            df = _dangling(df, rule, parent, flag, skew, rows)
            broken.append((rule, F.col(flag)))
        else:
            broken.append((rule, _BROKEN[rule["type"]](rule, types)))
    named = [F.when(condition, F.lit(rule["id"])) for rule, condition in broken]
    failed = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    errors = [
        F.coalesce(condition, F.lit(False))
        for rule, condition in broken
        if rule.get("severity", "error") == "error"
    ]
    rejected = reduce(or_, errors, F.lit(False))
    return df.select(*kept, failed.alias(FAILED), rejected.alias(REJECTED))


def trusted(evaluated: DataFrame) -> DataFrame:
    """Rows without broken error rules; broken warn rules stay listed."""
    return evaluated.filter(~F.col(REJECTED)).drop(REJECTED)


def quarantined(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col(REJECTED)).drop(REJECTED)


def scorecard(evaluated: DataFrame, rules: list[dict]) -> DataFrame:
    """Checked, failed and pass rate per rule, in one pass over the rows."""
    counts = [
        F.count_if(F.array_contains(FAILED, r["id"])).alias(f"f{i}") for i, r in enumerate(rules)
    ]
    totals = evaluated.agg(F.count(F.lit(1)).alias("checked"), *counts)
    entries = [
        F.struct(
            F.lit(r["id"]).alias("rule_id"),
            F.lit(r["type"]).alias("rule_type"),
            F.lit(r.get("severity", "error")).alias("severity"),
            F.col(f"f{i}").alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return (
        totals.select("checked", F.inline(F.array(*entries)))
        .withColumn("passed", F.col("checked") - F.col("failed"))
        .withColumn("pass_rate", F.round(F.col("passed") / F.nullif("checked", F.lit(0)), 6))
    )


class QualityThresholdExceeded(RuntimeError):
    """Too large a share of a batch is to be quarantined."""


def enforce(checked: int, quarantined_rows: int, max_share: float) -> None:
    """Abort a batch by raising, so that it is not committed and runs again."""
    if checked and quarantined_rows / checked > max_share:
        raise QualityThresholdExceeded(
            f"{quarantined_rows} of {checked} rows break error rules, allowed share {max_share}"
        )
