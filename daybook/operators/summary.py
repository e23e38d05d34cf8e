"""Whole-table and slice summaries, watermark, affected pairs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.metrics import in_days

# Fixed value: the watermark of an empty daily table.
NO_DAY = date(1900, 1, 1)


def summary_full(daily: DataFrame) -> DataFrame:
    """Thirteen measures over the whole daily table, in one row."""
    return daily.agg(
        F.min("day").alias("earliest_date"),
        F.max("day").alias("latest_date"),
        F.count("*").alias("total_records"),
        F.countDistinct("mid").alias("unique_merchants"),
        F.sum("amount_sum").alias("total_amount"),
        F.sum("amount_count").alias("total_amount_transactions"),
        F.sum("refund_sum").alias("total_refunds"),
        F.sum("refund_count").alias("total_refund_transactions"),
        F.sum("void_sum").alias("total_voids"),
        F.sum("voidcount").alias("total_void_transactions"),
        F.sum("total").alias("net_total"),
        F.min("first_transaction_date").alias("earliest_transaction"),
        F.min("first_business_transaction_date").alias("earliest_business_transaction"),
    )


def summary_incremental(daily: DataFrame, wm: date) -> DataFrame:
    """Five measures over the days from the watermark on, in one row."""
    return daily.where(F.col("day") >= F.lit(wm)).agg(
        F.min("day").alias("earliest_date_processed"),
        F.max("day").alias("latest_date_processed"),
        F.count("*").alias("new_records_added"),
        F.sum("amount_count").alias("new_amount_transactions"),
        F.sum("refund_count").alias("new_refund_transactions"),
    )


def watermark_row(daily: DataFrame) -> DataFrame:
    """The last stored day as a one-row table; 1900-01-01 when there is none."""
    return daily.agg(F.coalesce(F.max("day"), F.lit(NO_DAY)).alias("last_processed"))


def watermark(daily: DataFrame, lookback_days: int = 0) -> date:
    """The last stored day, read once so that it can prune partitions.

    `lookback_days` lowers it, to pick up transactions that arrived late.
    """
    return watermark_from(watermark_row(daily).first()["last_processed"], lookback_days)


def watermark_from(last_day: date | None, lookback_days: int = 0) -> date:
    """The watermark of a table whose last day is known."""
    if last_day is None or last_day == NO_DAY:
        return NO_DAY
    return last_day - timedelta(days=lookback_days)


def watermark_message(wm: date) -> str:
    """The line a run prints before it starts."""
    return f"Processing data from: {wm.isoformat()}"


def affected_pairs(tx: DataFrame, wm: date, as_of: date | None = None) -> DataFrame:
    """Distinct (day, mid) with transactions from the watermark on."""
    return (
        in_days(tx, wm, as_of)
        .where(F.col("merchant_name").isNotNull())
        .select(F.to_date("transaction_date").alias("day"), "mid")
        .distinct()
    )


def delete_pairs(daily: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stored rows whose (day, mid) is not among `pairs`."""
    return daily.join(pairs, ["day", "mid"], "left_anti")
