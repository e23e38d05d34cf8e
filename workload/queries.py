"""Every operator as a query over the test tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import daybook as db
from daybook.functions.values import COMPARED_TEXT, ignoring_case, tidy_number
from daybook.operators.dedup import has_hot_key
from daybook.operators.layout import fixed_first
from daybook.operators.metrics import day_grain, first_dates_of, named_days, with_net
from daybook.operators.running import continue_totals, opening_balances
from daybook.operators.summary import watermark_row
from daybook.operators.surrogate import with_positions
from daybook.schemas import MERCHANT_KEY, TRANSACTION_KEY, create_daily_table, create_transactions_table
from daybook.sources import catalog
from daybook.sources.extract import splits_of
from daybook.sources.files import export_csv
from daybook.workspace import fresh_path, materialize
from workload import fixtures as fx

AS_OF = date(2001, 6, 1)
CUT = date(2001, 3, 1)
EARLY_CUT = date(1995, 1, 4)
RUN = "2001-06-01 06:00:00"
WINDOW = ("1998-01-01 00:00:00", "2000-06-30 12:00:00")
STORED_BEFORE = date(1999, 1, 1)
# Small enough that the groups of the test data are cut into chunks.
FEW_ROWS = 200
# Rows of a landed file, about.
FILE_ROWS = 500_000
# How the files of the stream are landed, and their names: plain text takes about ten times the disk.
LANDED_AS, LANDED = "gzip", "*.csv.gz"

REFRESHED = (
    "day", "mid", "merchant_name", "amount_sum", "amount_count", "refund_sum", "refund_count",
    "total", "totalcount", "void_sum", "voidcount", "first_transaction_date",
    "first_business_transaction_date", "mtd_total", "ytd_total", "sourceAccountCreated",
)
# Columns of a stored transaction that the fixture fills.
FILLED = (
    "transaction_uuid", "merchant_account_id", "merchant_name", "mid", "amount",
    "refunded_amount", "status", "transaction_date", "transaction_type",
    "SourceAccountCreated", "updated_at",
)
# Of those, the ones a landed row has as well.
LOADED = (
    "transaction_uuid", "merchant_account_id", "merchant_name", "mid", "amount",
    "refunded_amount", "status", "transaction_date", "transaction_type", "updated_at",
)


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.full_refresh(fx.transactions(spark, sf_dir), AS_OF)


def full_refresh_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.full_refresh(fx.transactions(spark, sf_dir), AS_OF, rows_per_task=FEW_ROWS)


def first_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.first_dates(fx.transactions(spark, sf_dir), AS_OF)


def first_dates_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.transactions(spark, sf_dir)
    known = db.first_dates(tx, STORED_BEFORE)
    later = tx.where(F.col("transaction_date") >= F.lit(STORED_BEFORE))
    return db.merge_first_dates(known, db.first_dates(later))


def daily_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = db.daily_aggregates(fx.transactions(spark, sf_dir), AS_OF)
    return rows.select(
        "day", "mid", "merchant_name", "sourceAccountCreated",
        *(F.col(c).cast("decimal(18,4)").alias(c) for c in ("amount_sum", "refund_sum", "void_sum")),
        "amount_count", "refund_count", "voidcount",
    )


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.transactions(spark, sf_dir)
    rows = db.daily_totals(db.daily_aggregates(tx, AS_OF), db.first_dates(tx, AS_OF))
    return rows.select(
        "day", "mid", "merchant_name", F.col("total").cast("decimal(18,4)").alias("total"),
        "totalcount", "first_transaction_date", "first_business_transaction_date",
    )


def _running(spark: SparkSession, sf_dir: str, **limit: int) -> DataFrame:
    daily = materialize(with_net(db.daily_aggregates(fx.transactions(spark, sf_dir))), "daily")
    return db.running_totals(daily, **limit).select(
        "day", "mid", "merchant_name",
        *(F.col(c).cast("decimal(18,4)").alias(c) for c in ("total", "mtd_total", "ytd_total")),
    )


def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running(spark, sf_dir)


def running_totals_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running(spark, sf_dir, rows_per_task=FEW_ROWS)


def summary_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.summary_full(materialize(full_refresh(spark, sf_dir), "daily"))


def distinct_day_mid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.affected_pairs(fx.transactions(spark, sf_dir), date(1900, 1, 1))


def _stored(spark: SparkSession, sf_dir: str, cut: date) -> tuple[DataFrame, DataFrame, str]:
    """A daily table built before `cut`, and the transactions it came from."""
    tx = fx.transactions(spark, sf_dir)
    path = fresh_path(spark, "daily-table")
    db.write_daily(db.full_refresh(tx, cut), path)
    return tx, db.read_table(spark, path), path


def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark_row(_stored(spark, sf_dir, CUT)[1])


def delete_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, stored, _ = _stored(spark, sf_dir, CUT)
    pairs = db.affected_pairs(tx, db.watermark(stored))
    rows = db.delete_pairs(stored, pairs.withColumn("mid", F.col("mid").cast("string")))
    return rows.select("day", "mid", "merchant_name", "total")


def _updated(spark: SparkSession, sf_dir: str, cut: date) -> DataFrame:
    tx, stored, _ = _stored(spark, sf_dir, cut)
    wm = db.watermark(stored)
    return db.incremental_update(tx, stored, wm).select(*REFRESHED)


def incremental_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir, CUT)


def incremental_stale_first_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir, EARLY_CUT)


def incremental_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, stored, _ = _stored(spark, sf_dir, CUT)
    wm = db.watermark(stored, lookback_days=40)
    return db.incremental_update(tx, stored, wm).select(*REFRESHED)


def incremental_from_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.transactions(spark, sf_dir)
    stored = db.read_daily(spark, fresh_path(spark, "no-table"))
    return db.incremental_update(tx, stored, db.watermark(stored)).select(*REFRESHED)


def opening_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals continued from stored balances, checked against sums over all rows."""
    tx = fx.transactions(spark, sf_dir)
    daily = materialize(with_net(db.daily_aggregates(tx)), "daily")
    fresh = daily.where(F.col("day") >= F.lit(CUT))
    opened = opening_balances(daily, CUT)
    return continue_totals(db.running_totals(fresh), opened, CUT).select(
        "day", "mid", "merchant_name",
        *(F.col(c).cast("decimal(18,4)").alias(c) for c in ("mtd_total", "ytd_total")),
    )


def summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, stored, _ = _stored(spark, sf_dir, CUT)
    wm = db.watermark(stored)
    return db.summary_incremental(db.incremental_update(tx, stored, wm), wm)


def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after an update in place, surrogate keys included."""
    tx = fx.transactions(spark, sf_dir)
    path = fresh_path(spark, "daily-table")
    db.rebuild_daily(spark, tx, path, CUT, RUN)
    db.update_daily(spark, tx, path, RUN)
    return db.read_daily(spark, path).select("id", *REFRESHED)


def update_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `dynamic_overwrite`, from a stored table that knows its first dates."""
    tx = fx.transactions(spark, sf_dir)
    table, path = fresh_path(spark, "transactions-table"), fresh_path(spark, "daily-table")
    for rows in (tx.where(F.col("transaction_date") < F.lit(CUT)), tx.where(F.col("transaction_date") >= F.lit(CUT))):
        db.append_transactions(rows, table)
    db.rebuild_daily(spark, db.read_transactions(spark, table), path, CUT, RUN)
    db.update_daily(spark, table, path, RUN)
    return db.read_daily(spark, path).select("id", *REFRESHED)


def _defined(spark: SparkSession, create, *options) -> str:
    """A new table of the catalog, its files in the workspace."""
    path = fresh_path(spark, "defined")
    name = f"defined_{path.rpartition('-')[2]}"
    create(spark, name, *options, location=path)
    return name


def catalog_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `dynamic_overwrite`, in a table of the catalog."""
    tx, name = fx.transactions(spark, sf_dir), _defined(spark, create_daily_table)
    catalog.rebuild_daily_in(spark, tx, name, CUT, RUN)
    catalog.update_daily_in(spark, tx, name, RUN)
    return spark.table(name).select("id", *REFRESHED)


def catalog_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows loaded into a bucketed table of the catalog, which holds older ones."""
    name = _defined(spark, create_transactions_table, 8)
    catalog.insert_rows(
        fx.transactions(spark, sf_dir).where(F.col("transaction_date") < F.lit(STORED_BEFORE)).select(*FILLED), name
    )
    catalog.load_into(spark, fx.landed(spark, sf_dir), name)
    return spark.table(name).select(*LOADED)


def daily_aggregates_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day rows where status, type and name differ in case and trailing blanks only."""
    odd = F.col("transaction_uuid").endswith("1")
    mixed = {c: F.when(odd, F.concat(F.upper(c), F.lit("  "))).otherwise(F.col(c)) for c in COMPARED_TEXT}
    rows = db.daily_aggregates(ignoring_case(fx.transactions(spark, sf_dir).withColumns(mixed)), AS_OF)
    return rows.select(
        "day", "mid", F.rtrim(F.lower(F.collate("merchant_name", "UTF8_BINARY"))).alias("merchant_name"),
        *(F.col(c).cast("decimal(18,4)").alias(c) for c in ("amount_sum", "refund_sum", "void_sum")),
        "amount_count", "refund_count", "voidcount",
    )


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = db.daily_aggregates(fx.transactions(spark, sf_dir))
    return db.with_surrogate_key(daily.select("day", "mid", "merchant_name"))


def single_scan_first_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First dates and day rows from one scan, side by side."""
    grain = materialize(day_grain(fx.transactions(spark, sf_dir), AS_OF), "day-grain")
    rows = named_days(grain).groupBy("mid").agg(F.count("*").alias("day_rows"))
    return first_dates_of(grain).join(rows, "mid", "left")


def merchant_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.merchant_export(*fx.merchant_sources(spark, sf_dir))


def merchant_export_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each account in the order the listing really has."""
    return with_positions(merchant_export(spark, sf_dir)).select("position", MERCHANT_KEY)


def clean_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.clean_merchants(fx.landed_merchants(spark, sf_dir))


def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants replaced twice; the second content is what stays."""
    path = fresh_path(spark, "merchants-table")
    export = db.merchant_export(*fx.merchant_sources(spark, sf_dir))
    db.replace_table(export.unionByName(export), path)
    db.replace_table(export, path)
    return db.read_table(spark, path)


def merchants_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merchant listing exported as CSV and loaded from there.

    The second load finds the folder emptied and leaves the table.
    """
    folder, path = fresh_path(spark, "landing"), fresh_path(spark, "merchants-table")
    export_csv(db.merchant_export(*fx.merchant_sources(spark, sf_dir)), folder, RUN)
    for _ in range(2):
        db.load_merchants(spark, folder, path, archive_dir=f"{folder}-archive")
    return db.read_merchants(spark, path)


_TYPED = (
    "transaction_uuid", "merchant_account_id", "merchant_name", "mid", "amount", "currency",
    "refunded_amount", "status", "source_first6", "payment_method_details", "transaction_date",
    "transaction_type", "created_at", "updated_at", "reject_reason",
)


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.clean_transactions(fx.landed(spark, sf_dir)).select(*_TYPED)


def clean_transactions_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.clean_transactions(fx.landed(spark, sf_dir), compat=True).select(*_TYPED)


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = materialize(db.clean_transactions(fx.landed(spark, sf_dir)), "cleaned")
    _, rejected = db.split_rejects(cleaned)
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("row_count"))


def money_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.money_problems(fx.landed(spark, sf_dir))


def tidy_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.landed(spark, sf_dir).select(
        "transaction_uuid", "amount", tidy_number(F.col("amount")).cast("decimal(18,2)").alias("tidy")
    )


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.profile(fx.transactions(spark, sf_dir).select(*FILLED), ("transaction_uuid", *fx.ROW_ORDER))


def control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.control_totals(fx.landed(spark, sf_dir))


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.dedup_first(
        fx.transactions(spark, sf_dir).select(*FILLED), [TRANSACTION_KEY], fx.ROW_ORDER, "copies"
    )


def _append(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tx = fx.transactions(spark, sf_dir).select(*FILLED)
    first = db.dedup_first(tx, [TRANSACTION_KEY], fx.ROW_ORDER)
    stored = tx.where(F.col("transaction_date") < F.lit(STORED_BEFORE))
    return db.append_ignore(first, stored, TRANSACTION_KEY)


def append_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _append(spark, sf_dir)[0]


def ignored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _append(spark, sf_dir)[1].select(TRANSACTION_KEY)


def append_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `append_ignore`, with stored keys from the table's index."""
    tx, path = fx.transactions(spark, sf_dir), fresh_path(spark, "transactions-table")
    db.append_transactions(tx.where(F.col("transaction_date") < F.lit(STORED_BEFORE)), path)
    first = db.dedup_first(tx.select(*FILLED), [TRANSACTION_KEY], fx.ROW_ORDER)
    known = db.stored_keys(spark, path, first).select(TRANSACTION_KEY)
    return first.join(known, TRANSACTION_KEY, "left_anti")


def _loaded(spark: SparkSession, sf_dir: str):
    stored = fx.transactions(spark, sf_dir).where(F.col("transaction_date") < F.lit(STORED_BEFORE))
    return db.load_transactions(fx.landed(spark, sf_dir), stored)


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).to_append.select(*_TYPED[:-1])


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).report


def constraint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.transactions(spark, sf_dir)
    return db.check_constraints(tx, TRANSACTION_KEY, ("mid", "merchant_name", "status"))


def merchant_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = db.clean_merchants(fx.landed_merchants(spark, sf_dir))
    return db.check_constraints(rows, MERCHANT_KEY)


def extract_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.extract_window(fx.transactions(spark, sf_dir), *WINDOW).select(*FILLED)


def extract_in_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `extract_window`, read in parts of about equal size by account."""
    tx = fx.transactions(spark, sf_dir)
    parts = [tx.where(p) for p in splits_of(tx, "merchant_account_id", 4)]
    return db.extract_window(reduce(DataFrame.unionByName, parts), *WINDOW).select(*FILLED)


def extract_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db.extract_window(fx.transactions(spark, sf_dir), None, WINDOW[1]).select(*FILLED)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract landed as CSV, its control record, and the rows read back."""
    tx = fx.transactions(spark, sf_dir)
    control, folder = fresh_path(spark, "control"), fresh_path(spark, "landing")
    db.write_control(spark, control, WINDOW[0])
    db.export_transactions(spark, tx, control, folder, WINDOW[1])
    back = db.clean_transactions(db.read_transactions_csv(spark, folder))
    return back.select(*FILLED, "reject_reason")


def files_for(rows: int, least: int) -> int:
    """How many files some rows are landed in: `least`, and more as they grow, so that no task gets more than its share."""
    return max(least, -(-rows // FILE_ROWS))


def _land_in_order(spark: SparkSession, sf_dir: str) -> str:
    """Transactions as several CSV files whose names follow the row order."""
    folder = fresh_path(spark, "landing")
    order = (TRANSACTION_KEY, *fx.ROW_ORDER)
    tx = fx.transactions(spark, sf_dir)
    # All rows of a key in one file, wherever the ranges are cut.
    dealt = tx.select(*fixed_first(tx)).repartitionByRange(files_for(tx.count(), 4), TRANSACTION_KEY)
    export_csv(dealt.sortWithinPartitions(*order).select(*tx.columns), folder, RUN, LANDED_AS)
    return folder


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, table = _land_in_order(spark, sf_dir), fresh_path(spark, "transactions-table")
    query = db.ingest_stream(spark, folder, table, None, fresh_path(spark, "progress"), pattern=LANDED)
    query.awaitTermination()
    return db.read_transactions(spark, table).select(*FILLED)


def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over several batches, newest days first, and its one daily update."""
    tx = db.dedup_first(fx.transactions(spark, sf_dir).select(*FILLED), [TRANSACTION_KEY], fx.ROW_ORDER)
    tx = materialize(tx, "first-rows")
    folder, day = fresh_path(spark, "landing"), F.col("transaction_date")
    parts = files_for(tx.count(), 2)
    cuts = [date(1900, 1, 1), STORED_BEFORE, CUT, date(2100, 1, 1)]
    for n, (start, end) in enumerate(reversed(list(zip(cuts, cuts[1:])))):
        rows = tx.where((day >= F.lit(start)) & (day < F.lit(end)))
        dealt = rows.select(*fixed_first(rows)).repartitionByRange(parts, TRANSACTION_KEY)
        export_csv(dealt.select(*tx.columns), folder, f"2001-06-01 06:00:0{n}", LANDED_AS)
    home = fresh_path(spark, "stream")
    db.load_new_files(
        spark, folder, f"{home}/table", f"{home}/archive", f"{home}/progress", f"{home}/daily",
        run_ts=RUN, files_per_batch=parts, pattern=LANDED,
    )
    return db.read_daily(spark, f"{home}/daily").select(*REFRESHED)


def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream notes about each file it loads."""
    folder, home = _land_in_order(spark, sf_dir), fresh_path(spark, "stream")
    db.ingest_stream(
        spark, folder, f"{home}/table", None, f"{home}/progress", reports=f"{home}/reports", pattern=LANDED
    ).awaitTermination()
    noted = spark.read.json(f"{home}/reports/files")
    counts = ("rows_read", "accepted_rows", "duplicates_rows", "repeated_in_file", "rejected_rows")
    return noted.agg(*(F.sum(c).alias(c) for c in counts))


def load_control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).totals


def upsert_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.transactions(spark, sf_dir).select(*FILLED)
    stored = db.dedup_first(tx, [TRANSACTION_KEY], fx.ROW_ORDER).where(
        F.col("transaction_date") < F.lit(STORED_BEFORE)
    )
    return db.upsert_latest(tx, stored, TRANSACTION_KEY, "updated_at")


def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `upsert_transactions`, in the stored table, by the months its index names."""
    tx, path = fx.transactions(spark, sf_dir), fresh_path(spark, "transactions-table")
    hot = has_hot_key(tx, TRANSACTION_KEY)
    stored = db.dedup_first(tx, [TRANSACTION_KEY], fx.ROW_ORDER, hot=hot).where(
        F.col("transaction_date") < F.lit(STORED_BEFORE)
    )
    db.append_transactions(stored, path)
    db.upsert_transactions(tx, path)
    return db.read_transactions(spark, path).select(*FILLED)


def _ids(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    formatted = db.format_ids(F.col("id_text"), **options).alias("formatted")
    return fx.id_lists(spark, sf_dir).select("list_id", formatted)


def id_list_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir)


def id_list_bracketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir, mode="bracketed")


def id_list_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir, mode="other")


def id_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir, strip=True)


def id_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir, mode="plain", pad=True, width=5)


def id_strip_and_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir, mode="bracketed", strip=True, pad=True, width="no number")


def id_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.posexplode(db.parse_ids(F.col("id_text"))).alias("position", "token")
    return fx.id_lists(spark, sf_dir).select("list_id", tokens)


QUERIES = {
    f.__name__: f
    for f in (
        full_refresh, full_refresh_in_chunks, first_dates, first_dates_merged,
        single_scan_first_dates, daily_aggregates, daily_totals, running_totals,
        running_totals_in_chunks, opening_totals, summary_full, distinct_day_mid, watermark,
        delete_pairs, incremental_update, incremental_stale_first_dates, incremental_lookback,
        incremental_from_empty, summary_incremental, dynamic_overwrite, surrogate_key,
        merchant_export, clean_merchants, replace_table, merchants_csv_load, merchant_constraints,
        clean_transactions, clean_transactions_compat, rejects, money_problems, tidy_numbers,
        column_profile, control_totals, dedup_first, append_ignore, ignored_keys,
        load_transactions, load_report, constraint_check, extract_window, extract_first_run,
        csv_round_trip, stream_ingest, stream_daily, stream_report, load_control_totals,
        upsert_transactions, upsert_stored, append_indexed, update_from_table, catalog_daily, catalog_load,
        extract_in_splits, merchant_export_positions, daily_aggregates_ignoring_case, id_list_quoted, id_list_bracketed, id_list_plain,
        id_strip, id_pad, id_strip_and_pad, id_tokens,
    )
}
