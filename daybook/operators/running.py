"""Month-to-date and year-to-date running totals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.workspace import materialize

# Rows of one (mid, year) that a single task may sum in order.
ROWS_PER_TASK = 1_000_000

_KEYS = ("mid", "_year", "_month")
_ORDER = ("day", "merchant_name")


def running_totals(daily: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add `mtd_total` and `ytd_total`: sums of `total` per mid up to each row.

    Rows of a mid are ordered by day, then merchant name, so two names on one
    day always give the same sums. A group of one mid and year is normally a
    few hundred rows and goes through one exchange. Groups above
    `rows_per_task` are cut into ordered chunks instead, see `_in_chunks`; the
    result is the same. `daily` is read twice, so pass a stored table.
    """
    keyed = daily.withColumns({"_year": F.year("day"), "_month": F.month("day")})
    hot = (
        keyed.groupBy("mid", "_year")
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > rows_per_task)
    )
    if hot.isEmpty():
        return _whole_groups(keyed).drop("_year", "_month")
    # Every listed group holds more than `rows_per_task` rows, so the list is
    # shorter than the table by that factor.
    hot = materialize(hot.select("mid", "_year"), "hot-groups")
    usual = keyed.join(hot, ["mid", "_year"], "left_anti")
    large = keyed.join(hot, ["mid", "_year"], "left_semi")
    chunks = -(-large.count() // rows_per_task)
    both = _whole_groups(usual).unionByName(_in_chunks(large, chunks))
    return both.drop("_year", "_month")


def _whole_groups(keyed: DataFrame) -> DataFrame:
    # Ordering the year by month first changes nothing, but lets both sums
    # share one exchange and one sort.
    year = Window.partitionBy("mid", "_year").orderBy("_month", *_ORDER)
    month = Window.partitionBy(*_KEYS).orderBy(*_ORDER)
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    return keyed.select(
        "*",
        F.sum("total").over(month.rowsBetween(*up_to_here)).alias("mtd_total"),
        F.sum("total").over(year.rowsBetween(*up_to_here)).alias("ytd_total"),
    )


def _in_chunks(keyed: DataFrame, chunks: int) -> DataFrame:
    """The same sums with no group in one task.

    Rows are range-partitioned in summing order and each partition becomes a
    chunk; the chunk number is stored so that both passes agree on it. Sums
    inside a chunk are bounded by its size. What a chunk starts from is the
    sum of the chunks before it, a table of a few rows per chunk.
    """
    placed = materialize(
        keyed.repartitionByRange(max(chunks, 2), "mid", "_year", "_month", *_ORDER).withColumn(
            "_chunk", F.spark_partition_id()
        ),
        "running-chunks",
    )
    year = Window.partitionBy("_chunk", "mid", "_year").orderBy("_month", *_ORDER)
    month = Window.partitionBy("_chunk", *_KEYS).orderBy(*_ORDER)
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    inside = placed.select(
        "*",
        F.sum("total").over(month.rowsBetween(*up_to_here)).alias("_mtd"),
        F.sum("total").over(year.rowsBetween(*up_to_here)).alias("_ytd"),
    )
    earlier = (Window.unboundedPreceding, -1)
    before = (
        placed.groupBy("_chunk", *_KEYS)
        .agg(F.sum("total").alias("_sum"))
        .select(
            "_chunk",
            *_KEYS,
            F.sum("_sum")
            .over(Window.partitionBy(*_KEYS).orderBy("_chunk").rangeBetween(*earlier))
            .alias("_mtd_before"),
            F.sum("_sum")
            .over(Window.partitionBy("mid", "_year").orderBy("_chunk").rangeBetween(*earlier))
            .alias("_ytd_before"),
        )
    )
    zero = F.lit(0)
    return (
        inside.join(before, ["_chunk", *_KEYS])
        .withColumn("mtd_total", F.col("_mtd") + F.coalesce("_mtd_before", zero))
        .withColumn("ytd_total", F.col("_ytd") + F.coalesce("_ytd_before", zero))
        .drop("_chunk", "_mtd", "_ytd", "_mtd_before", "_ytd_before")
    )


def opening_balances(history: DataFrame, wm: date) -> DataFrame:
    """What the sums of each mid start from on the watermark day.

    Stored rows all lie before the new ones, so their part in a running total
    is one sum per mid: of the year so far and of the month so far. Only those
    sums are shuffled, not the stored rows, and only the watermark's year is
    read.
    """
    year_start, month_start = wm.replace(month=1, day=1), wm.replace(day=1)
    rows = history.where((F.col("day") >= F.lit(year_start)) & (F.col("day") < F.lit(wm)))
    if "month" in history.columns:
        rows = rows.where(
            (F.col("month") >= f"{year_start:%Y-%m}") & (F.col("month") <= f"{wm:%Y-%m}")
        )
    this_month = F.when(F.col("day") >= F.lit(month_start), F.col("total")).otherwise(0)
    return rows.groupBy("mid").agg(
        F.sum(this_month).alias("_mtd_open"), F.sum("total").alias("_ytd_open")
    )


def continue_totals(fresh: DataFrame, opening: DataFrame, wm: date) -> DataFrame:
    """Add opening balances to the running totals of rows from `wm` on."""
    same_year = F.year("day") == wm.year
    same_month = same_year & (F.month("day") == wm.month)
    zero = F.lit(0)
    opened_month = F.when(same_month, F.coalesce("_mtd_open", zero)).otherwise(0)
    opened_year = F.when(same_year, F.coalesce("_ytd_open", zero)).otherwise(0)
    return (
        fresh.join(opening, "mid", "left")
        .withColumns(
            {
                "mtd_total": F.col("mtd_total") + opened_month,
                "ytd_total": F.col("ytd_total") + opened_year,
            }
        )
        .drop("_mtd_open", "_ytd_open")
    )
