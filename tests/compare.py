"""Run a query on Spark and its SQL in DuckDB, and compare the two tables."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def difference(df, connection, sql) -> str | None:
    """What differs between the Spark result and the SQL result, or None."""
    left = [tuple(row) for row in df.collect()]
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    right = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    ours, theirs = _sorted_rows(df.columns, left), _sorted_rows(names, right)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first differing row: {a} against {b}"
    return None


def main(folder: str, *wanted: str) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as registered
    from holdfast.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    oracles, failed = registered.oracle_sql(), 0
    for name, run in registered.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        started = time.monotonic()
        try:
            df = run(spark, folder)
            if name in oracles:
                outcome = difference(df, connection, oracles[name]) or "ok"
            else:
                outcome = f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        failed += not (outcome == "ok" or outcome.endswith("no SQL"))
        print(f"{name:34s} {time.monotonic() - started:6.2f}s  {outcome}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
