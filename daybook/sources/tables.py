"""The stored tables: reading, appending, replacing, updating by slice.

A table is what its last commit lists (see `commits`). A folder of plain Parquet
files without commits is read as it is; the first write takes its rows over.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.layout import interleaved
from daybook.operators.metrics import with_month
from daybook.schemas import DAILY_METRICS, MERCHANTS, TRANSACTIONS
from daybook.sources.commits import Commit, commit, last_commit, scan, vacuum, write_folder
from daybook.workspace import materialize

ROWS = "rows"
# How a commit names the month of rows without one.
NO_MONTH = ""


def _partitioned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("month", T.StringType())])


def _plain(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    """A folder of Parquet files without commits; None if there is nothing."""
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _months(names) -> Column:
    """Whether the partition column is one of these months."""
    known = [n for n in names if n != NO_MONTH]
    inside = F.col("month").isin(known)
    return inside | F.col("month").isNull() if NO_MONTH in names else inside


def committed_rows(
    spark: SparkSession, path: str, now: Commit, schema: T.StructType | None = None, folders=None
) -> DataFrame:
    """The rows of a commit, or those of some of its folders, in one scan."""
    listed = now.of(ROWS) if folders is None else {f: now.folders[f] for f in folders}
    full = T.StructType([*schema, T.StructField("batch", T.StringType())]) if schema is not None else None
    rows = scan(spark, path, ROWS, listed, full)
    for folder, known in listed.items():
        if known.get("dropped"):
            # Some months of this folder have been written anew elsewhere.
            rows = rows.where((F.col("batch") != folder.rpartition("=")[2]) | _months(known["months"]))
    return rows.drop("batch")


def _read(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    now = last_commit(spark, path)
    if now is None:
        return _plain(spark, path, schema)
    return committed_rows(spark, path, now, schema) if now.of(ROWS) else None


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    rows = _read(spark, path, schema)
    return rows if rows is not None else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table, with the schema of its files unless one is given."""
    rows = _read(spark, path, schema)
    if rows is None:
        raise FileNotFoundError(f"no table at {path}")
    return rows


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """The stored transactions with their partition column; empty at first."""
    return _read_or_empty(spark, path, _partitioned(TRANSACTIONS))


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The stored daily table with its partition column; empty at first."""
    return _read_or_empty(spark, path, _partitioned(DAILY_METRICS))


def read_merchants(spark: SparkSession, path: str) -> DataFrame:
    """The stored merchants; empty at first."""
    return _read_or_empty(spark, path, MERCHANTS)


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a whole table.

    The new rows are written beside the old ones, and one commit then makes
    them the table. A failure at any moment leaves the old table; readers see
    the old or the new one, never none.
    """
    spark = df.sparkSession
    now = last_commit(spark, path)
    folder = write_folder(df, path, ROWS, partition_by)
    commit(spark, path, now, {folder: {}}, {})
    vacuum(spark, path)


def _laid_out(daily: DataFrame) -> DataFrame:
    """Daily rows spread for writing: by month, then by mid and day alike.

    A month may fill many tasks. Within it rows follow a curve through mid and
    day, so that a file holds a narrow band of both and conditions on either
    one skip files.
    """
    rows = with_month(daily)
    curve = interleaved(rows, F.col("mid").cast("long"), F.dayofmonth("day"))
    order = ("month", "_curve", "mid", "day", "merchant_name")
    return rows.withColumn("_curve", curve).repartitionByRange(*order).sortWithinPartitions(*order).drop("_curve")


def _month_facts(daily: DataFrame) -> dict[str, dict]:
    """Rows, last day and highest number of each month; as many entries as months."""
    number = F.max("id") if "id" in daily.columns else F.lit(None)
    found = daily.groupBy("month").agg(F.count("*").alias("n"), F.max("day").alias("d"), number.alias("i")).collect()
    return {
        r.month if r.month is not None else NO_MONTH: {"rows": r.n, "last_day": r.d and r.d.isoformat(), "top_id": r.i}
        for r in found
    }


@dataclass(frozen=True)
class DailyFacts:
    """What the daily table's commit knows without a look at its rows."""

    last_day: date | None
    top_id: int


def daily_facts(spark: SparkSession, path: str) -> DailyFacts:
    """Last day and highest number of the daily table.

    Every write notes them by month. Only a table that was not written here is
    scanned for them.
    """
    now = last_commit(spark, path)
    months = now.facts.get("months") if now else None
    if months is None:
        rows = _read(spark, path, _partitioned(DAILY_METRICS))
        months = _month_facts(rows) if rows is not None else {}
    days = [m["last_day"] for m in months.values() if m["last_day"]]
    return DailyFacts(
        date.fromisoformat(max(days)) if days else None, max((m["top_id"] or 0 for m in months.values()), default=0)
    )


def _store_months(staged: DataFrame, path: str, now: Commit | None, facts: dict, kept: dict[str, dict]) -> None:
    """Write the months of `staged` and commit them beside the `kept` folders."""
    spark = staged.sparkSession
    folder = write_folder(_laid_out(staged.drop("month")), path, ROWS, ("month",))
    written = _month_facts(committed_rows(spark, path, Commit(0, {folder: {}}), _like(staged), [folder]))
    folders = {**kept, folder: {"months": sorted(written)}}
    commit(spark, path, now, folders, {"months": {**facts, **written}})
    vacuum(spark, path)


def _like(rows: DataFrame) -> T.StructType:
    """The schema of rows with their month last, as a partitioned table gives it back."""
    return _partitioned(T.StructType([f for f in rows.schema if f.name != "month"]))


def write_daily(daily: DataFrame, path: str) -> None:
    """Rebuild the daily table; the old one stays until the new one is whole."""
    now = last_commit(daily.sparkSession, path)
    _store_months(materialize(with_month(daily), "daily"), path, now, {}, {})


class EmptiedMonthError(RuntimeError):
    """A stored month would be left without a row."""


def _without(folders: dict[str, dict], months) -> dict[str, dict]:
    """The folders after some months have been taken out of them."""
    left = {}
    for folder, known in folders.items():
        stay = [m for m in known["months"] if m not in months]
        if stay:
            dropped = known.get("dropped") or len(stay) < len(known["months"])
            left[folder] = {**known, "months": stay, **({"dropped": True} if dropped else {})}
    return left


def replace_months(daily: DataFrame, path: str) -> None:
    """Replace exactly those months of the daily table that `daily` holds.

    The rows may come from the same table. Other months keep their files. A
    stored month at or after the first replaced one that gets no rows is an
    error, as an update only ever adds days to it.
    """
    spark = daily.sparkSession
    staged = materialize(with_month(daily), "months")
    fresh = {r.month for r in staged.select("month").distinct().toLocalIterator()}
    if not fresh:
        return
    now = last_commit(spark, path)
    if now is None or "months" not in now.facts:
        # Not written by month here: the rows are taken over first.
        rows = _read(spark, path, _partitioned(DAILY_METRICS))
        if rows is not None:
            _store_months(rows, path, now, {}, {})
            now = last_commit(spark, path)
    stored = dict(now.facts.get("months", {})) if now else {}
    left = {m for m in stored if m != NO_MONTH and m >= min(fresh)} - fresh
    if left:
        raise EmptiedMonthError(f"no rows for stored months {sorted(left)}")
    kept = _without(now.of(ROWS), fresh) if now else {}
    _store_months(staged, path, now, {m: f for m, f in stored.items() if m not in fresh}, kept)
