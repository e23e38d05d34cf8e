"""Order-free comparison of a Spark result with a SQL result."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{name}.parquet')"
        )
    return connection


def _plain(value):
    """Values as they compare across engines; decimals keep their scale."""
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(result: DataFrame, connection, sql: str, shown: int = 3) -> str:
    """Empty when both sides agree, else a description."""
    cursor = connection.execute(sql)
    names, expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    found_names, found = _rows(result.columns, result.collect())
    if found_names != names:
        return f"columns {found_names} instead of {names}"
    missing, extra = expected - found, found - expected
    if not missing and not extra:
        return ""
    return (
        f"{missing.total()} of {expected.total()} rows missing, {extra.total()} unexpected\n"
        f"missing: {list(missing)[:shown]}\nunexpected: {list(extra)[:shown]}"
    )
