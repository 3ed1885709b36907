"""Compare registered queries with DuckDB on the same tables.

    python tests/oracle.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark, con, run, sql: str, sf_dir: str) -> list[str]:
    """What differs; empty when the relations are equal."""
    df = run(spark, sf_dir)
    got = _sorted([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _sorted(cursor.fetchall(), names)
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in df.dtypes:
        expected = _SAME_TYPE.get(kind, kind.upper())
        if name in theirs and theirs[name] != expected:
            problems.append(f"type of {name}: {kind} vs {theirs[name]}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows vs {len(want)}")
    elif got != want:
        n = sum(a != b for a, b in zip(got, want))
        a, b = next((a, b) for a, b in zip(got, want) if a != b)
        problems.append(f"{n} rows differ, e.g. {a} vs {b}")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        if name in sql:
            try:
                problems = compare(spark, con, run, sql[name], sf_dir)
            except Exception as e:  # keep going: report every query
                problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        else:
            problems = [] if run(spark, sf_dir).count() >= 0 else ["no rows"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
