"""Rules and properties of the incremental update."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import daybook as db
from daybook.sources.tables import EmptiedMonthError
from daybook.workspace import fresh_path
from workload import fixtures as fx
from workload.queries import REFRESHED

D = Decimal
RUN = "2024-05-01 00:00:00"


def store(spark, tx, cut):
    path = fresh_path(spark, "daily")
    db.write_daily(db.full_refresh(tx, cut), path)
    return db.read_table(spark, path)


def by_key(df):
    return {(r.day, r.mid, r.merchant_name): r for r in df.collect()}


def test_from_empty_equals_full(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    empty = db.read_daily(spark, fresh_path(spark, "none"))
    updated = db.incremental_update(tx, empty, db.watermark(empty)).select(*REFRESHED)
    full = db.full_refresh(tx, None).select(*REFRESHED)
    assert updated.exceptAll(full).isEmpty() and full.exceptAll(updated).isEmpty()


def test_twice_is_once(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    path = fresh_path(spark, "daily")
    db.rebuild_daily(spark, tx, path, date(2000, 5, 5), RUN)
    db.update_daily(spark, tx, path, RUN)
    once = db.read_daily(spark, path).select(*REFRESHED).collect()
    db.update_daily(spark, tx, path, RUN)
    twice = db.read_daily(spark, path).select(*REFRESHED).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, twice))


def test_equals_full_but_for_stored_first_dates(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    columns = [c for c in REFRESHED if not c.startswith("first_")]
    stored = store(spark, tx, date(1998, 7, 15))
    updated = db.incremental_update(tx, stored, db.watermark(stored)).select(*columns)
    full = db.full_refresh(tx, None).select(*columns)
    assert updated.exceptAll(full).isEmpty() and full.exceptAll(updated).isEmpty()


def test_kept_first_dates_table_gives_the_same_update(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    cut = date(2000, 1, 1)
    stored = store(spark, tx, cut)
    wm = db.watermark(stored)
    later = tx.where(F.col("transaction_date") >= F.lit(cut))
    first = db.merge_first_dates(db.first_dates(tx, cut), db.first_dates(later))
    kept = db.incremental_update(tx, stored, wm, first=first).select(*REFRESHED)
    scanned = db.incremental_update(tx, stored, wm).select(*REFRESHED)
    assert kept.exceptAll(scanned).isEmpty() and scanned.exceptAll(kept).isEmpty()


def test_late_transactions_below_the_watermark_are_not_seen(spark, make_tx):
    early = {"transaction_date": "2024-01-10 10:00:00", "amount": 2000}
    last = {"transaction_date": "2024-01-20 10:00:00"}
    stored = store(spark, make_tx(early, last), date(2024, 2, 1))
    late = {"transaction_date": "2024-01-10 11:00:00", "amount": 100}
    tx = make_tx(early, last, late)
    key = (date(2024, 1, 10), "1", "Shop")
    assert by_key(db.incremental_update(tx, stored, db.watermark(stored)))[key].amount_sum == D("20.00")
    lowered = db.watermark(stored, lookback_days=10)
    assert by_key(db.incremental_update(tx, stored, lowered))[key].amount_sum == D("21.00")


def test_history_keeps_its_first_dates(spark, make_tx):
    small = {"transaction_date": "2024-01-10 10:00:00", "amount": 500}
    stored = store(spark, make_tx(small, {"transaction_date": "2024-01-11 10:00:00", "amount": 500}), date(2024, 2, 1))
    big = {"transaction_date": "2024-01-12 10:00:00", "amount": 5000}
    tx = make_tx(small, {"transaction_date": "2024-01-11 10:00:00", "amount": 500}, big)
    rows = by_key(db.incremental_update(tx, stored, db.watermark(stored)))
    assert rows[(date(2024, 1, 10), "1", "Shop")].first_business_transaction_date is None
    assert rows[(date(2024, 1, 11), "1", "Shop")].first_business_transaction_date == datetime(2024, 1, 12, 10)


def test_stored_pair_without_source_survives_but_is_not_summed(spark, make_tx):
    day = "2024-01-20 10:00:00"
    stored = store(spark, make_tx({"mid": 7, "transaction_date": day}, {"transaction_date": day}), date(2024, 2, 1))
    tx = make_tx({"transaction_date": day}, {"mid": 7, "transaction_date": "2024-01-21 10:00:00", "amount": 100})
    rows = by_key(db.incremental_update(tx, stored, db.watermark(stored)))
    assert (date(2024, 1, 20), "7", "Shop") in rows
    assert rows[(date(2024, 1, 21), "7", "Shop")].mtd_total == D("1.00")


def test_no_upper_bound_unless_given(spark, make_tx):
    first = {"transaction_date": "2024-01-10 10:00:00"}
    stored = store(spark, make_tx(first), date(2024, 2, 1))
    tx = make_tx(first, {"transaction_date": "2024-03-01 10:00:00"})
    wm = db.watermark(stored)
    assert db.incremental_update(tx, stored, wm).count() == 2
    assert db.incremental_update(tx, stored, wm, as_of=date(2024, 3, 1)).count() == 1


def test_update_in_place_touches_only_later_months_and_keeps_numbers(spark, make_tx):
    days = ("2024-01-05", "2024-02-05", "2024-02-10")
    base = [{"transaction_date": f"{d} 10:00:00"} for d in days]
    path = fresh_path(spark, "daily")
    db.rebuild_daily(spark, make_tx(*base), path, date(2024, 3, 1), RUN)

    def january():
        rows = db.read_daily(spark, path).where("month = '2024-01'")
        return {r[0] for r in rows.select("_metadata.file_path").collect()}

    before = january()
    summary = db.update_daily(
        spark, make_tx(*base, {"transaction_date": "2024-03-02 10:00:00"}), path, RUN
    ).first()
    assert summary.new_records_added == 2
    table = db.read_daily(spark, path)
    assert january() == before
    ids = {str(r.day): r.id for r in table.collect()}
    assert ids == {"2024-01-05": 1, "2024-02-05": 2, "2024-02-10": 4, "2024-03-02": 5}


def test_month_that_would_be_emptied_is_refused(spark, make_tx):
    path = fresh_path(spark, "daily")
    rows = db.full_refresh(
        make_tx({"transaction_date": "2024-01-05 10:00:00"}, {"transaction_date": "2024-02-05 10:00:00"}), None
    )
    db.write_daily(rows, path)
    with pytest.raises(EmptiedMonthError):
        db.replace_months(rows.where("day < date'2024-02-01'"), path)
    assert db.read_table(spark, path).count() == 2
