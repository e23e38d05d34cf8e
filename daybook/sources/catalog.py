"""Loading, rebuilding and updating tables of the catalog, see `schemas.create_table`.

Inserts go by column name through the table's definition: declared lengths are
enforced, missing columns take their defaults, transactions are dealt into the
buckets of their key, so that a later load compares keys without shuffling the
stored side. Rules that file tables only declare, keys and NOT NULL, are checked
before anything is written. The writes are Spark's own: unlike those of the
tables by path, an overwrite of several months is not one step.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import metrics
from daybook.operators.quality import require_constraints
from daybook.operators.summary import delete_pairs, summary_full, summary_incremental, watermark
from daybook.operators.surrogate import with_surrogate_key
from daybook.plans.load import LoadResult, load_transactions
from daybook.plans.refresh import full_refresh, incremental_rows
from daybook.schemas import DAILY_KEY, DAILY_NOT_NULL, TRANSACTION_KEY
from daybook.workspace import materialize, scratch


@contextmanager
def _overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def insert_rows(rows: DataFrame, table: str, replace: str | None = None) -> None:
    """Insert rows by column name; columns of the table that they lack take their defaults.

    They `replace` nothing, the ``months`` that they hold, or ``all`` rows.
    """
    spark = rows.sparkSession
    columns = ", ".join(f"`{c}`" for c in rows.columns)
    view = f"rows_{uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        with _overwriting(spark, "static" if replace == "all" else "dynamic"):
            spark.sql(f"INSERT {'OVERWRITE' if replace else 'INTO'} {table} ({columns}) SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def load_into(spark: SparkSession, raw: DataFrame, table: str, compat: bool = False) -> LoadResult:
    """Load landed rows into a transactions table; stored keys win."""
    result = load_transactions(raw, spark.table(table), compat)
    require_constraints(result.to_append, TRANSACTION_KEY)
    insert_rows(result.to_append, table)
    return result


def rebuild_daily_in(spark: SparkSession, tx: DataFrame, table: str, as_of: date, run_ts: str) -> DataFrame:
    """Rebuild a daily table; returns its summary."""
    with scratch(spark):
        rows = materialize(metrics.to_sink(with_surrogate_key(full_refresh(tx, as_of)), run_ts), "rebuilt")
        require_constraints(rows, DAILY_KEY, DAILY_NOT_NULL)
        insert_rows(metrics.with_month(rows), table, "all")
    return summary_full(spark.table(table))


def update_daily_in(
    spark: SparkSession, tx: DataFrame, table: str, run_ts: str, as_of: date | None = None, lookback_days: int = 0
) -> DataFrame:
    """Update a daily table from its watermark on; returns the slice summary."""
    stored = spark.table(table)
    wm = watermark(stored, lookback_days)
    with scratch(spark):
        new, pairs = incremental_rows(tx, stored, wm, as_of)
        top = stored.agg(F.coalesce(F.max(DAILY_KEY), F.lit(0)).alias("top")).first()["top"]
        numbered = materialize(metrics.to_sink(with_surrogate_key(new, top + 1), run_ts), "numbered-days")
        require_constraints(numbered, DAILY_KEY, DAILY_NOT_NULL)
        touched = stored.where(F.col("month") >= f"{wm:%Y-%m}")
        pairs = pairs.withColumn("mid", F.col("mid").cast("string"))
        kept = touched.where(F.col("day") < F.lit(wm)).unionByName(
            delete_pairs(touched.where(F.col("day") >= F.lit(wm)), pairs)
        )
        months = materialize(metrics.with_month(kept.select(*numbered.columns).unionByName(numbered)), "months")
        insert_rows(months, table, "months")
    return summary_incremental(spark.table(table), wm)
