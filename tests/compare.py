"""Compare a query's rows with its SQL on the same tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _row(values: tuple) -> tuple:
    return tuple(float(v) if type(v).__name__ == "Decimal" else v for v in values)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[Counter, Counter, int]:
    """Rows only in the query, rows only in the SQL, and the number of rows."""
    columns = sorted(df.columns)
    got = Counter(_row(tuple(row)) for row in df.select(*columns).collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns, (sorted(names), columns)
    order = [names.index(c) for c in columns]
    want = Counter(_row(tuple(row[i] for i in order)) for row in cursor.fetchall())
    return got - want, want - got, sum(got.values())
