"""Runs queries against their SQL: ``python -m tests.oracle_check [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_cell(row[i]) for i in order) for row in rows
    )


def difference(frame, relation) -> str | None:
    """None when equal, else what differs first."""
    got_columns, got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    want_columns, want = normal(relation.columns, relation.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra = sorted(set(got) - set(want))[:3]
        lacking = sorted(set(want) - set(got))[:3]
        return f"{len(got)} rows against {len(want)}; extra {extra}; lacking {lacking}"
    if not got:
        return "no rows"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from riskloom.session import local_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = DATA / f"sf{sf}"
    con, spark = connect(sf_dir), local_session("oracle-check", cores=8)
    oracles = entry.oracle_sql()
    failures = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, str(sf_dir))
            if name in oracles:
                problem = difference(frame, con.sql(oracles[name]))
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    spark.stop()
    sys.exit(1 if failures else 0)


if __name__ == "__main__":
    main()
