"""Loading landed files into the stored tables, and the extracts behind them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.operators.cleaning import clean_merchants, clean_transactions
from daybook.operators.dedup import dedup_first, known_keys
from daybook.operators.layout import fixed_first
from daybook.operators.quality import (
    REASON,
    ConstraintError,
    control_totals,
    load_report,
    require_constraints,
    split_rejects,
)
from daybook.schemas import MERCHANT_KEY, MERCHANTS, MONEY_COLUMNS, TRANSACTION_KEY
from daybook.sources.extract import FAILURE, extract_window, read_control, write_control
from daybook.sources.files import (
    LINEAGE,
    SOURCE_BLOCK,
    SOURCE_FILE,
    SOURCE_ROW,
    export_csv,
    export_of,
    merchant_files,
    read_csv_files,
)
from daybook.sources.tables import replace_table
from daybook.workspace import materialize, move_path, scratch

_COPIES, _DEALT, _FRESH = "_copies", "_dealt", "_fresh"
# Landed rows of one key that a single task may hold.
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class LoadResult:
    """What became of the rows of a load."""

    to_append: DataFrame
    ignored: DataFrame
    rejected: DataFrame
    totals: DataFrame
    report: DataFrame


def _decided(cleaned: DataFrame, known: DataFrame, hot: bool) -> DataFrame:
    """The first row of each key in its file, and whether it is to be stored (`_FRESH`).

    All rows of a key meet in one task, sorted by file and place; the known keys
    come to them. Rows without a key have nothing to meet and are dealt by place.
    """
    place = [SOURCE_BLOCK, SOURCE_ROW]
    columns, missing = cleaned.columns, F.col(TRANSACTION_KEY).isNull()
    at = F.when(missing, F.xxhash64(SOURCE_FILE, *place)).otherwise(F.xxhash64(TRANSACTION_KEY))
    group = [TRANSACTION_KEY, _DEALT]
    if hot:
        first = dedup_first(cleaned, [SOURCE_FILE, TRANSACTION_KEY], place, _COPIES).withColumn(_DEALT, at)
    else:
        # The other columns make the choice among rows of one place the same in every run.
        rest = [c for c in columns if c not in (TRANSACTION_KEY, SOURCE_FILE, *place)]
        own = [F.when(missing, F.col(c)) for c in place]
        in_file = Window.partitionBy(*group, SOURCE_FILE, *own).orderBy(*place, *rest)
        whole = in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        dealt = cleaned.withColumn(_DEALT, at)
        first = (
            dealt.select(*fixed_first(dealt))
            .repartition(*group)
            .withColumns({"_place": F.row_number().over(in_file), _COPIES: F.count("*").over(whole)})
            .where(F.col("_place") == 1)
            .drop("_place")
        )
    so_far = Window.partitionBy(*group).orderBy(SOURCE_FILE).rowsBetween(Window.unboundedPreceding, 0)
    nth = F.sum(F.col(REASON).isNull().cast("long")).over(so_far)
    stored = known.select(TRANSACTION_KEY, F.xxhash64(TRANSACTION_KEY).alias(_DEALT)).distinct().withColumn("_known", F.lit(True))
    fresh = F.col(REASON).isNull() & (F.col("_nth") == 1) & F.col("_known").isNull()
    return first.withColumn("_nth", nth).join(stored, group, "left").select(*columns, _COPIES, fresh.alias(_FRESH))


def load_transactions(
    raw: DataFrame,
    existing: DataFrame | Callable[[DataFrame], DataFrame],
    compat: bool = False,
    hot_rows: int = HOT_ROWS,
) -> LoadResult:
    """Decide about every landed row: append, ignore or reject.

    `existing` is the stored table, or looks up which of some keys are stored.

    Inside a file the first row of a key counts, even where it is then
    rejected. Across files the first accepted one does, in order of file
    names. A key that is already stored wins over all of them. Both decisions
    are stored before anything is returned, so appending cannot change them.
    Whole rows are shuffled and stored once; all else goes by keys. Only a load
    with more than `hot_rows` rows of a key has each task keep one candidate
    first.
    """
    # The control totals sum what landed, not what typing made of it.
    landed = raw.withColumns({f"_landed_{c}": F.col(c) for c in (*MONEY_COLUMNS, "transaction_type") if c in raw.columns})
    cleaned = clean_transactions(landed, compat)
    keys = cleaned.where(F.col(TRANSACTION_KEY).isNotNull()).groupBy(TRANSACTION_KEY)
    keys = materialize(keys.agg(F.count("*").alias("_rows")), "landed-keys")
    most = keys.agg(F.max("_rows")).first()[0] or 0
    new = keys.select(TRANSACTION_KEY)
    known = existing(new) if callable(existing) else known_keys(new, existing, TRANSACTION_KEY)
    staged = materialize(_decided(cleaned, known, most > hot_rows), "landed")
    as_landed = [c for c in staged.columns if c.startswith("_landed_")]
    totals = control_totals(
        staged.select(SOURCE_FILE, *(F.col(c).alias(c.removeprefix("_landed_")) for c in as_landed))
    )
    staged = staged.drop(*as_landed)
    accepted, rejected = split_rejects(staged)
    to_append = accepted.where(_FRESH).drop(_FRESH, _COPIES)
    ignored = accepted.where(~F.col(_FRESH)).drop(_FRESH)
    outcomes = load_report(to_append, ignored, rejected, by=SOURCE_FILE)
    repeats = staged.groupBy(SOURCE_FILE).agg(
        F.sum(F.col(_COPIES) - 1).alias("repeated_in_file"), F.sum(_COPIES).alias("lines")
    )
    report = (
        repeats.join(outcomes, SOURCE_FILE)
        .select(
            SOURCE_FILE,
            F.col("lines").alias("rows_read"),
            "accepted_rows",
            "duplicates_rows",
            "repeated_in_file",
            "rejected_rows",
        )
    )
    return LoadResult(
        to_append.drop(*LINEAGE),
        ignored.drop(_COPIES),
        rejected.drop(_COPIES, _FRESH),
        totals,
        report,
    )


def load_merchants(
    spark: SparkSession, folder: str, path: str, pattern: str = "*.csv", archive_dir: str | None = None
) -> int:
    """Replace the merchants table by the newest export; returns its row count.

    Without an export the table stays as it is, and 0 is returned. A repeated
    or missing key, or a row that cannot be stored, stops the load before the
    table is touched. After success the export goes to `archive_dir`.
    """
    files = merchant_files(spark, folder, pattern)
    if not files:
        return 0
    with scratch(spark):
        landed = read_csv_files(spark, files, MERCHANTS, (), multi_line=True)[0]
        cleaned = materialize(clean_merchants(landed), "merchants")
        # There are only as many reasons as checks.
        bad = cleaned.where(F.col(REASON).isNotNull()).groupBy(REASON).count().orderBy(REASON)
        reasons = [f"{r[REASON]} ({r['count']} rows)" for r in bad.collect()]
        if reasons:
            raise ConstraintError("; ".join(reasons))
        require_constraints(cleaned, MERCHANT_KEY)
        replace_table(cleaned.select(*MERCHANTS.fieldNames()), path)
        rows = cleaned.count()
    if archive_dir:
        for export in sorted({export_of(f) for f in files}):
            move_path(spark, export, f"{archive_dir.rstrip('/')}/{export.rpartition('/')[2]}")
    return rows


def export_transactions(
    spark: SparkSession, source: DataFrame, control_path: str, folder: str, now: str
) -> str:
    """Extract what changed since the last success and land it as CSV.

    The marker moves only after the files are written; a failure is recorded
    and raised again, and its window is extracted next time.
    """
    last_run = read_control(spark, control_path)
    try:
        path = export_csv(extract_window(source, last_run, now), folder, now)
    except Exception:
        write_control(spark, control_path, now, FAILURE)
        raise
    write_control(spark, control_path, now)
    return path
