"""Daily figures per merchant: first dates, day aggregates, totals, sums."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.values import dollars, month_of, round_money
from daybook.schemas import DAILY_COLUMNS

# What the figures look at.
SUCCEEDED = "succeeded"
CHARGE, REFUND, VOID = "charge", "refund", "void"
BUSINESS_ABOVE_CENTS = 1000

FIRST_DATES = ("first_transaction_date", "first_business_transaction_date")
_STAMPS = ("created_at", "updated_at")
_MONEY = ("amount_sum", "refund_sum", "void_sum", "total", "mtd_total", "ytd_total")
_COUNTS = ("amount_count", "refund_count", "voidcount", "totalcount")


def in_days(tx: DataFrame, from_day: date | None = None, as_of: date | None = None) -> DataFrame:
    """Dated transactions with a mid, from `from_day` on and before `as_of`.

    Both bounds reach the scan. Where the table is partitioned by ``month``
    the implied months are named too, so older partitions are not opened.
    """
    rows = tx.where(F.col("transaction_date").isNotNull() & F.col("mid").isNotNull())
    if from_day is not None:
        start = F.lit(from_day)
        rows = rows.where(F.col("transaction_date") >= start.cast("timestamp_ntz"))
        if "month" in tx.columns:
            rows = rows.where(F.col("month") >= f"{from_day:%Y-%m}")
    if as_of is not None:
        end = F.lit(as_of)
        rows = rows.where(F.col("transaction_date") < end.cast("timestamp_ntz"))
        if "month" in tx.columns:
            rows = rows.where(F.col("month") <= f"{as_of:%Y-%m}")
    return rows


def _first_aggregates() -> list[Column]:
    ok = F.col("status") == SUCCEEDED
    moment, amount = F.col("transaction_date"), F.col("amount")
    return [
        F.min(F.when(ok & (amount > 0), moment)).alias(FIRST_DATES[0]),
        F.min(F.when(ok & (amount > BUSINESS_ABOVE_CENTS), moment)).alias(FIRST_DATES[1]),
    ]


def _day_aggregates() -> list[Column]:
    """Per-kind sums in dollars and counts of positive amounts.

    Sums take every amount, also zero and negative ones; counts only positive
    ones. A refund counts its refunded amount. Cents are summed first and
    scaled once per group.
    """
    out = [F.max("SourceAccountCreated").alias("sourceAccountCreated")]
    for kind, value, total, count in (
        (CHARGE, "amount", "amount_sum", "amount_count"),
        (REFUND, "refunded_amount", "refund_sum", "refund_count"),
        (VOID, "amount", "void_sum", "voidcount"),
    ):
        chosen = (F.col("status") == SUCCEEDED) & (F.col("transaction_type") == kind)
        cents = F.col(value)
        out.append(dollars(F.sum(F.when(chosen, cents).otherwise(0))).alias(total))
        out.append(F.count(F.when(chosen & (cents > 0), 1)).cast("int").alias(count))
    return out


def first_dates(tx: DataFrame, as_of: date | None = None) -> DataFrame:
    """First succeeded and first business transaction per mid.

    Looks at every transaction type and needs no merchant name. Only the
    partial minima of each task are shuffled, so a hot mid costs nothing.
    """
    return in_days(tx, as_of=as_of).groupBy("mid").agg(*_first_aggregates())


def merge_first_dates(known: DataFrame, fresh: DataFrame) -> DataFrame:
    """First dates of a stored table brought up to date with newer rows.

    Stored transactions never change, so the minimum over all time is the
    smaller of both sides. Keeping this table spares the daily update its scan
    over all transactions.
    """
    both = known.unionByName(fresh)
    return both.groupBy("mid").agg(*(F.min(c).alias(c) for c in FIRST_DATES))


def daily_aggregates(
    tx: DataFrame, as_of: date | None = None, from_day: date | None = None
) -> DataFrame:
    """Sums and counts per (day, mid, merchant name)."""
    return (
        in_days(tx, from_day, as_of)
        .where(F.col("merchant_name").isNotNull())
        .groupBy(F.to_date("transaction_date").alias("day"), "mid", "merchant_name")
        .agg(*_day_aggregates())
    )


def day_grain(tx: DataFrame, as_of: date | None = None) -> DataFrame:
    """Day aggregates and first dates of each group from one scan.

    Groups without a merchant name stay in: they count for the first dates of
    their mid. `first_dates_of` and `named_days` split the result.
    """
    return (
        in_days(tx, as_of=as_of)
        .groupBy(F.to_date("transaction_date").alias("day"), "mid", "merchant_name")
        .agg(*_day_aggregates(), *_first_aggregates())
    )


def first_dates_of(grain: DataFrame) -> DataFrame:
    """First dates per mid from the groups of `day_grain`."""
    return grain.groupBy("mid").agg(*(F.min(c).alias(c) for c in FIRST_DATES))


def named_days(grain: DataFrame) -> DataFrame:
    """The day aggregates proper from the groups of `day_grain`."""
    return grain.where(F.col("merchant_name").isNotNull()).drop(*FIRST_DATES)


def with_net(daily: DataFrame) -> DataFrame:
    """Add net total and its transaction count; voids are in neither."""
    return daily.withColumns(
        {
            "total": F.col("amount_sum") - F.col("refund_sum"),
            "totalcount": F.col("amount_count") + F.col("refund_count"),
        }
    )


def with_first_dates(daily: DataFrame, first: DataFrame) -> DataFrame:
    """Attach the first dates of each mid.

    The engine broadcasts `first` when its run-time size allows and otherwise
    splits hot mids between tasks.
    """
    return daily.join(first, "mid", "left")


def daily_totals(daily: DataFrame, first: DataFrame) -> DataFrame:
    """Day aggregates with net totals and first dates."""
    return with_first_dates(with_net(daily), first)


def to_sink(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Rows in the form and column order of the daily table.

    Money is rounded only here, after the running sums. A sum over nothing but
    NULL becomes 0, as the table requires a value. Mid becomes text. `run_ts`
    fills the two time stamps.
    """
    known = set(df.columns)
    out = []
    for name, declared in DAILY_COLUMNS:
        if name in _STAMPS:
            if run_ts is not None:
                out.append(F.lit(run_ts).cast("timestamp_ntz").alias(name))
        elif name not in known:
            continue
        elif name in _MONEY:
            out.append(F.coalesce(round_money(F.col(name)), F.lit(0).cast("decimal(18,2)")).alias(name))
        elif name in _COUNTS:
            out.append(F.coalesce(F.col(name).cast("int"), F.lit(0)).alias(name))
        elif name == "mid":
            out.append(F.col(name).cast("string").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def from_sink(daily: DataFrame) -> DataFrame:
    """Stored daily rows with a numeric mid, ready to join and union."""
    return daily.withColumn("mid", F.col("mid").cast("bigint"))


def with_month(df: DataFrame, day: str = "day") -> DataFrame:
    """Add the partition column of a table stored by month."""
    return df.withColumn("month", month_of(F.col(day)))
