"""Incremental extract from the operational source, and its control record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: accounts up to this id are in-house ones.
LAST_HOUSE_ACCOUNT = 8
SUCCESS, FAILURE = "success", "failure"
CONTROL_SCHEMA = T.StructType(
    [T.StructField("last_run", T.StringType()), T.StructField("status", T.StringType())]
)


def extract_window(
    df: DataFrame, last_run: str | None, now: str, min_account_id: int = LAST_HOUSE_ACCOUNT
) -> DataFrame:
    """Rows changed after `last_run` and up to `now`, house accounts left out.

    Without `last_run` there is no lower bound. Rows without `updated_at` are
    never taken. All tests reach the source scan.
    """

    def moment(text: str):
        return F.lit(text).cast("timestamp_ntz")

    rows = df.where(F.col("updated_at") <= moment(now))
    if last_run:
        rows = rows.where(F.col("updated_at") > moment(last_run))
    return rows.where(F.col("merchant_account_id") > min_account_id)


CountCells = Callable[[int, int, int], dict[int, int]]


def plan_splits(count: CountCells, low: int, high: int, splits: int, cells: int = 256, rounds: int = 8) -> list[int]:
    """Where to cut the numbers from `low` to `high` so that all parts hold about as many rows.

    `count(low, high, cells)` counts the rows in equal cells of ``[low, high)``.
    A cell with more rows than a part should have is counted in finer cells,
    down to single numbers; at most `splits` cells of a round are. So a few
    counts are enough, however uneven the numbers lie.
    """
    boxes = [(low, high + 1, None)]
    target = None
    for _ in range(rounds):
        finer = []
        for start, end, rows in boxes:
            if rows is not None and (rows <= target or end - start <= 1):
                finer.append((start, end, rows))
                continue
            found = count(start, end, cells)
            edge = [start + -(-(end - start) * n // cells) for n in range(cells + 1)]
            finer += [(a, b, found.get(n, 0)) for n, (a, b) in enumerate(zip(edge, edge[1:])) if b > a]
        boxes = finer
        target = target or max(1, -(-sum(rows for _, _, rows in boxes) // splits))
        if all(rows <= target or end - start <= 1 for start, end, rows in boxes):
            break
    cuts, held = [], 0
    for start, _, rows in boxes:
        if held and held + rows > target:
            cuts.append(start)
            held = 0
        held += rows
    return cuts


def split_conditions(column: str, cuts: list[int]) -> list[str]:
    """One condition for each part between cuts; every row, nulls too, meets exactly one."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def cell_counts(start: int, end: int, cells: int, column: str) -> tuple[str, str]:
    """The number of a row's cell, and the condition that it lies in one, as SQL any database has."""
    cell = f"FLOOR(({column} - ({start})) * {cells}.0 / {end - start})"
    return cell, f"{column} >= {start} AND {column} < {end}"


def splits_of(rows: DataFrame, column: str, splits: int) -> list[str]:
    """Conditions that part a table into about equal parts by a whole-number column."""
    bounds = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    if bounds.low is None:
        return ["1 = 1"]

    def count(start: int, end: int, cells: int) -> dict[int, int]:
        cell, inside = cell_counts(start, end, cells, column)
        found = rows.where(inside).groupBy(F.expr(f"cast({cell} as int)").alias("cell")).count().collect()
        return {r.cell: r["count"] for r in found}

    return split_conditions(column, plan_splits(count, int(bounds.low), int(bounds.high), splits))


class UnsplitReadError(ValueError):
    """A table would be read in one task."""


def read_source_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    partitions: int = 0,
    small: bool = False,
) -> DataFrame:
    """A table of the operational database, read in about equal parts.

    The database counts the rows of a few ranges of the whole-number column
    `partition_column`; `partitions` parts follow from them, one task for each.
    Filters and column choice of the result are passed on to the database. Only
    a `small` table is read in one task.
    """
    options = {"url": url, "preferTimestampNTZ": "true", **(properties or {})}
    if not partition_column or partitions < 2:
        if not small:
            raise UnsplitReadError(f"name a partition column and the number of parts for {table}, or call it small")
        return spark.read.format("jdbc").options(**options, dbtable=table).load()

    def ask(query: str) -> list:
        return spark.read.format("jdbc").options(**options, query=query).load().collect()

    (low, high), *_ = ask(f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}")
    if low is None:
        return spark.read.format("jdbc").options(**options, dbtable=table).load()

    def count(start: int, end: int, cells: int) -> dict[int, int]:
        cell, inside = cell_counts(start, end, cells, partition_column)
        counted = f"SELECT cell, COUNT(*) AS n FROM (SELECT {cell} AS cell FROM {table} WHERE {inside}) c GROUP BY cell"
        return {int(r[0]): int(r[1]) for r in ask(counted)}

    conditions = split_conditions(partition_column, plan_splits(count, int(low), int(high), partitions))
    reading = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(url, table, predicates=conditions, properties=reading)


def read_control(spark: SparkSession, path: str) -> str | None:
    """End of the last successful extract, or None before the first one."""
    try:
        records = spark.read.schema(CONTROL_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    done = records.where(F.col("status") == SUCCESS)
    return done.agg(F.max("last_run").alias("last_run")).first()["last_run"]


def write_control(spark: SparkSession, path: str, last_run: str, status: str = SUCCESS) -> None:
    """Add a control record. Failures are kept but never move the marker.

    Records are added, not replaced, so a crash cannot lose the marker.
    """
    record = spark.createDataFrame([(last_run, status)], CONTROL_SCHEMA)
    record.coalesce(1).write.mode("append").json(path)
