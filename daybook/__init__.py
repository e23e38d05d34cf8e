"""Daily merchant metrics from payment transactions, on Spark DataFrames."""

from daybook.functions.idlist import format_ids, pad_zeros, parse_ids, strip_zeros
from daybook.operators.cleaning import clean_merchants, clean_transactions
from daybook.operators.dedup import append_ignore, dedup_first, known_keys, upsert_latest
from daybook.operators.merchants import merchant_export
from daybook.operators.metrics import (
    daily_aggregates,
    daily_totals,
    first_dates,
    merge_first_dates,
    to_sink,
)
from daybook.operators.quality import (
    ConstraintError,
    check_constraints,
    control_totals,
    load_report,
    money_problems,
    profile,
    require_constraints,
    split_rejects,
)
from daybook.operators.running import running_totals
from daybook.operators.summary import (
    affected_pairs,
    delete_pairs,
    summary_full,
    summary_incremental,
    watermark,
)
from daybook.operators.surrogate import with_surrogate_key
from daybook.plans.load import export_transactions, load_merchants, load_transactions
from daybook.plans.refresh import full_refresh, incremental_update, rebuild_daily, update_daily
from daybook.session import build_session
from daybook.sources.extract import (
    extract_window,
    read_control,
    read_source_table,
    write_control,
)
from daybook.sources.files import export_csv, read_merchants_csv, read_transactions_csv
from daybook.sources.tables import (
    daily_facts,
    read_daily,
    read_merchants,
    read_table,
    read_transactions,
    replace_months,
    replace_table,
    write_daily,
)
from daybook.sources.transactions import (
    append_transactions,
    read_first_dates,
    stored_keys,
    upsert_transactions,
)
from daybook.streaming.ingest import ingest_stream, load_new_files

__all__ = [name for name in dir() if not name.startswith("_")]
