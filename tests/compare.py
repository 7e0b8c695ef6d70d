"""Run queries and their comparison SQL side by side.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from catalogue.roles import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return format(value, "f")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def expected(connection, sql: str):
    connection.execute(sql)
    columns = [d[0] for d in connection.description]
    kinds = {d[0]: str(d[1]) for d in connection.description}
    return columns, kinds, connection.fetchall()


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def kind_of(name: str) -> str:
    return _KINDS.get(name, name.upper().replace(" ", ""))


def difference(df, connection, sql: str) -> str | None:
    """What differs between a frame and a query, or None."""
    columns, kinds, rows = expected(connection, sql)
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    wrong = {
        n: (t, kinds[n])
        for n, t in df.dtypes
        if kind_of(t) != kinds[n].replace(" ", "") and kinds[n] != "NUMBER"
    }
    if wrong:
        return f"types {wrong}"
    a, b = _rows(df.columns, got), _rows(columns, rows)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"columns {sorted(columns)}: {x} != {y}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from starloom import build_session

    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    checks, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = run(spark, sf_dir)
            found = (
                difference(df, connection, checks[name])
                if name in checks
                else (None if df.count() else "no rows")
            )
        except Exception as error:  # report and go on to the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {time.time() - began:6.2f}s {name} {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, arguments) else 0)
