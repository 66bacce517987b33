"""Comparison of a query result with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda row: tuple((v is None, v if v is not None else 0) for v in row))


def run_sql(sf_dir: str, sql: str) -> pa.Table:
    with duckdb.connect() as connection:
        for file in Path(sf_dir).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        return connection.sql(sql).to_arrow_table()


def differences(result: pa.Table, sf_dir: str, sql: str) -> str | None:
    """None when columns and all values agree, else a short description."""
    expected = run_sql(sf_dir, sql)
    if sorted(result.column_names) != sorted(expected.column_names):
        return f"columns {sorted(result.column_names)} and {sorted(expected.column_names)}"
    ours, theirs = _rows(result), _rows(expected)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(unequal)} rows differ, first {unequal[0][0]} expected {unequal[0][1]}" if unequal else None
