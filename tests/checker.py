"""Runs a query and its SQL check side by side and compares rows without regard to order."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted((tuple(plain(row[at]) for at in order) for row in rows), key=repr)


def difference(frame, connection, sql) -> str | None:
    """What differs, or None if column names, types and all values agree."""
    relation = connection.sql(sql)
    our_types = sorted((name, TYPES[kind]) for name, kind in frame.dtypes)
    their_types = sorted(zip(relation.columns, map(str, relation.types)))
    if our_types != their_types:
        return f"columns {our_types} and {their_types}"
    ours = rows_of(frame.columns, frame.collect())
    theirs = rows_of(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, such as {repr(wrong[0])[:600]}" if wrong else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import local_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    session, connection, checks = local_session(), duck(sf_dir), oracle_sql()
    for name, build in queries().items():
        if chosen and name not in chosen:
            continue
        begun = time.time()
        try:
            frame = build(session, sf_dir)
            result = difference(frame, connection, checks[name]) if name in checks else f"rows {frame.count()}"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{time.time() - begun:6.1f}s  {name}: {result or 'equal'}", flush=True)
