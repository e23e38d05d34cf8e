"""Full rebuild and incremental update of the daily table."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import metrics
from daybook.operators.quality import require_constraints
from daybook.operators.running import (
    ROWS_PER_TASK,
    continue_totals,
    opening_balances,
    running_totals,
)
from daybook.operators.summary import (
    delete_pairs,
    summary_full,
    summary_incremental,
    watermark_from,
    watermark_message,
)
from daybook.operators.surrogate import with_surrogate_key
from daybook.schemas import DAILY_KEY, DAILY_NOT_NULL
from daybook.sources.tables import daily_facts, read_daily, read_transactions, replace_months, write_daily
from daybook.sources.transactions import read_first_dates
from daybook.workspace import materialize, scratch

logger = logging.getLogger("daybook")


def full_refresh(
    tx: DataFrame, as_of: date | None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Daily metrics of all days before `as_of`.

    The transactions are scanned and shuffled once, down to one row per day,
    mid and name; everything after works on that stored result. First dates
    are joined last, so that the engine can still split a hot mid.
    """
    grain = materialize(metrics.day_grain(tx, as_of), "day-grain")
    daily = metrics.with_net(metrics.named_days(grain))
    summed = running_totals(daily, rows_per_task)
    return metrics.to_sink(metrics.with_first_dates(summed, metrics.first_dates_of(grain)))


def incremental_rows(
    tx: DataFrame,
    stored: DataFrame,
    wm: date,
    as_of: date | None = None,
    first: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[DataFrame, DataFrame]:
    """The new rows from the watermark day on, and the (day, mid) they replace.

    Stored rows before the watermark enter only as opening balances of its
    year. First dates look at all time; pass a kept table of them as `first`
    (see `merge_first_dates`) to spare that scan.
    """
    fresh = materialize(metrics.daily_aggregates(tx, as_of, wm), "fresh-days")
    pairs = fresh.select("day", "mid").distinct()
    summed = running_totals(metrics.with_net(fresh), rows_per_task)
    opening = opening_balances(metrics.from_sink(stored), wm)
    continued = continue_totals(summed, opening, wm)
    if first is None:
        first = metrics.first_dates(tx, as_of)
    elif as_of is not None:
        # A kept date is the earliest there is: at or after the bound, none is before.
        first = first.withColumns({c: F.when(F.col(c) < F.lit(as_of), F.col(c)) for c in metrics.FIRST_DATES})
    return metrics.to_sink(metrics.with_first_dates(continued, first)), pairs


def incremental_update(
    tx: DataFrame,
    stored: DataFrame,
    wm: date,
    as_of: date | None = None,
    first: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The daily table after the update: untouched rows and new ones.

    Rows before the watermark keep everything, also first dates that are out
    of date by now. A stored pair on the watermark day that has no source rows
    any more stays, but no longer counts in later totals.
    """
    new, pairs = incremental_rows(tx, stored, wm, as_of, first, rows_per_task)
    before = stored.where(F.col("day") < F.lit(wm))
    reached = stored.where(F.col("day") >= F.lit(wm))
    kept = before.unionByName(
        delete_pairs(reached, pairs.withColumn("mid", F.col("mid").cast("string")))
    )
    return kept.select(*new.columns).unionByName(new)


def rebuild_daily(
    spark: SparkSession, tx: DataFrame, path: str, as_of: date, run_ts: str
) -> DataFrame:
    """Rebuild the stored daily table; returns its summary.

    Rows that break a rule of the table stop the rebuild before it is touched.
    """
    with scratch(spark):
        rows = materialize(metrics.to_sink(with_surrogate_key(full_refresh(tx, as_of)), run_ts), "rebuilt")
        require_constraints(rows, DAILY_KEY, DAILY_NOT_NULL)
        write_daily(rows, path)
    return summary_full(read_daily(spark, path))


def update_daily(
    spark: SparkSession,
    tx: DataFrame | str,
    path: str,
    run_ts: str,
    as_of: date | None = None,
    lookback_days: int = 0,
    first: DataFrame | None = None,
) -> DataFrame:
    """Update the stored daily table in place; returns the slice summary.

    Only the months from the watermark on are rewritten. Kept rows keep their
    number, new ones continue after the highest; the table's commit knows it
    and the last day. `tx` is the stored transactions table's path, which knows
    its first dates, so that only months from the watermark on are read; or any
    transactions, over all of which first dates are then taken unless `first`
    has them.
    """
    stored, facts = read_daily(spark, path), daily_facts(spark, path)
    if isinstance(tx, str):
        first = read_first_dates(spark, tx) if first is None else first
        tx = read_transactions(spark, tx)
    wm = watermark_from(facts.last_day, lookback_days)
    logger.info(watermark_message(wm))
    with scratch(spark):
        new, pairs = incremental_rows(tx, stored, wm, as_of, first)
        numbered = materialize(metrics.to_sink(with_surrogate_key(new, facts.top_id + 1), run_ts), "numbered-days")
        require_constraints(numbered, DAILY_KEY, DAILY_NOT_NULL)
        touched = stored.where(F.col("month") >= f"{wm:%Y-%m}")
        pairs = pairs.withColumn("mid", F.col("mid").cast("string"))
        kept = touched.where(F.col("day") < F.lit(wm)).unionByName(
            delete_pairs(touched.where(F.col("day") >= F.lit(wm)), pairs)
        )
        replace_months(kept.select(*numbered.columns).unionByName(numbered), path)
    return summary_incremental(read_daily(spark, path), wm)
