"""Queries over the given tables."""

from __future__ import annotations

from importlib import import_module

from tidemark.plans.registry import QUERIES, SQL

_MODULES = ("ingest_queries", "zone_queries", "state_queries", "quality_queries", "curate_queries", "stream_queries")


def _load() -> None:
    for name in _MODULES:
        import_module(f"tidemark.plans.{name}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
