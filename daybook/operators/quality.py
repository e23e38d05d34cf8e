"""Checks of landed and cleaned rows: problems, rejects, constraints, profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.values import blank_to_null, dollars, to_number
from daybook.operators.metrics import VOID
from daybook.schemas import MONEY_COLUMNS

REASON = "reject_reason"
# Wide enough for landed amounts with a fraction of a cent.
_CENTS = "decimal(28,4)"


def money_problems(raw: DataFrame, key: str = "transaction_uuid") -> DataFrame:
    """Money texts that are missing, no number, or have over two decimals.

    Works on the landed text, before coercion hides the fault.
    """
    checks = []
    for name in MONEY_COLUMNS:
        value = blank_to_null(F.col(name))
        problem = (
            F.when(value.isNull(), "missing")
            .when(to_number(value).isNull(), "not a number")
            .when(value.rlike("\\.\\d{3,}"), "too many decimals")
        )
        checks.append(
            F.struct(F.lit(name).alias("column_name"), F.col(name).alias("value"), problem.alias("problem"))
        )
    return (
        raw.select(key, F.explode(F.array(*checks)).alias("check"))
        .where(F.col("check.problem").isNotNull())
        .select(key, "check.column_name", "check.value", "check.problem")
    )


def split_rejects(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without a reject reason, and rows with one.

    Both parts read `cleaned`, so pass a stored table.
    """
    accepted = cleaned.where(F.col(REASON).isNull()).drop(REASON)
    return accepted, cleaned.where(F.col(REASON).isNotNull())


def control_totals(df: DataFrame, by: str = "source_file") -> DataFrame:
    """Void, charge and refund sums and positive counts per landed file.

    A control figure over all rows whatever their status, typed or landed
    text; what is not a number is left out. A row without a type counts as not
    void.
    """
    void = F.col("transaction_type").eqNullSafe(VOID)
    measures = []
    for rows, value, total, count in (
        (void, "amount", "void_sum", "voidcount"),
        (~void, "amount", "amount_sum", "amount_count"),
        (~void, "refunded_amount", "refund_sum", "refund_count"),
    ):
        cents = F.col(value).try_cast(_CENTS)
        kept = F.coalesce(F.sum(F.when(rows, cents)), F.lit(0))
        measures.append(dollars(kept).cast("decimal(38,6)").alias(total))
        measures.append(F.count(F.when(rows & (cents > 0), 1)).alias(count))
    return df.groupBy(by).agg(*measures)


def load_report(
    accepted: DataFrame, ignored: DataFrame, rejected: DataFrame, by: str | None = None
) -> DataFrame:
    """Row counts of the three outcomes, over all or per value of `by`."""
    outcomes = (("accepted", accepted), ("duplicates", ignored), ("rejected", rejected))
    keys = [by] if by else []
    tagged = None
    for outcome, rows in outcomes:
        part = rows.select(*keys, F.lit(outcome).alias("outcome"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = [F.count(F.when(F.col("outcome") == o, 1)).alias(f"{o}_rows") for o, _ in outcomes]
    return tagged.groupBy(*keys).agg(*counts, F.count("*").alias("rows_read"))


def check_constraints(df: DataFrame, primary_key: str | None = None, not_null=()) -> DataFrame:
    """Violated constraints with the number of rows that break each.

    A key row counts as breaking when its key occurs more than once. Repeats
    are counted from per-task partial counts.
    """
    columns = [*([primary_key] if primary_key else []), *not_null]
    nulls = df.agg(*(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns))
    found = nulls.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit("not null").alias("rule"),
                        F.lit(c).alias("column_name"),
                        F.col(c).alias("broken_rows"),
                    )
                    for c in columns
                )
            )
        ).alias("v")
    ).select("v.*")
    if primary_key:
        repeats = (
            df.where(F.col(primary_key).isNotNull())
            .groupBy(primary_key)
            .count()
            .where(F.col("count") > 1)
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("broken_rows"))
            .select(F.lit("primary key").alias("rule"), F.lit(primary_key).alias("column_name"), "broken_rows")
        )
        found = found.unionByName(repeats)
    return found.where(F.col("broken_rows") > 0)


class ConstraintError(ValueError):
    """Rows break a key or NOT NULL rule of the table they are meant for."""


def require_constraints(df: DataFrame, primary_key: str | None = None, not_null=()) -> None:
    """Raise `ConstraintError` when any constraint is violated.

    Brings back one row per declared constraint at most.
    """
    broken = check_constraints(df, primary_key, not_null).collect()
    if broken:
        text = "; ".join(f"{v.rule} on {v.column_name}: {v.broken_rows} rows" for v in broken)
        raise ConstraintError(text)


def profile(df: DataFrame, order, sample_rows: int = 3) -> DataFrame:
    """Type, filled and empty counts and first values of every column.

    One pass counts all columns; the first rows in the given order come from a
    distributed top-n.
    """
    order = list(order)

    def entry(name: str, *values: Column) -> Column:
        return F.struct(F.lit(name).alias("column_name"), *values)

    counts = df.agg(
        F.count("*").alias("_rows"), *(F.count(F.col(c)).alias(c) for c in df.columns)
    ).select(
        F.explode(
            F.array(
                *(
                    entry(
                        name,
                        F.lit(kind).alias("data_type"),
                        F.col(name).alias("filled_rows"),
                        (F.col("_rows") - F.col(name)).alias("empty_rows"),
                    )
                    for name, kind in df.dtypes
                )
            )
        ).alias("c")
    ).select("c.*")
    first = df.orderBy(*order).limit(sample_rows)
    samples = (
        first.select(
            F.struct(*order).alias("_at"),
            F.explode(
                F.array(
                    *(
                        entry(c, F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias("value"))
                        for c in df.columns
                    )
                )
            ).alias("s"),
        )
        .groupBy(F.col("s.column_name").alias("column_name"))
        .agg(F.sort_array(F.collect_list(F.struct("_at", "s.value"))).alias("_ordered"))
        .select("column_name", F.array_join(F.col("_ordered.value"), " | ").alias("samples"))
    )
    return counts.join(samples, "column_name", "left")
