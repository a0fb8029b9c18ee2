"""Run registered queries next to their SQL and compare all values.

    python tests/compare.py [FOLDER] [NAME ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registered  # noqa: E402
from vellumark.sources.catalogue import TABLES  # noqa: E402


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def table_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return df.columns, table_of(df.columns, df.collect())


def sql_rows(connection, sql: str):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return names, table_of(names, cursor.fetchall())


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None if query and SQL agree, else what differs."""
    names, rows = spark_rows(registered.queries()[name](spark, folder))
    expected_names, expected = sql_rows(connection, registered.oracle_sql()[name])
    if sorted(names) != sorted(expected_names):
        return f"columns {sorted(names)} and {sorted(expected_names)}"
    if rows != expected:
        surplus, missing = set(rows) - set(expected), set(expected) - set(rows)
        return (
            f"{len(rows)} and {len(expected)} rows; only in Spark {len(surplus)} {sorted(surplus)[:2]}; "
            f"only in SQL {len(missing)} {sorted(missing)[:2]}"
        )
    return None if rows else "no rows"


def main() -> int:
    from vellumark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registered.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = sql_connection(folder)
    failures = 0
    for name in names:
        start = time.time()
        try:
            if name in registered.oracle_sql():
                found = difference(spark, connection, folder, name)
            else:
                found = None if registered.queries()[name](spark, folder).count() else "no rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failures += found is not None
        kind = "sql " if name in registered.oracle_sql() else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
