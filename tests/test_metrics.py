"""Rules of the daily figures, one small case each."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import daybook as db
from daybook.operators.metrics import day_grain, first_dates_of
from daybook.workspace import fresh_path, materialize

AS_OF = date(2024, 2, 1)
D = Decimal


def full(tx, as_of=AS_OF, **options):
    return {(r.day, r.mid, r.merchant_name): r for r in db.full_refresh(tx, as_of, **options).collect()}


def only(rows):
    assert len(rows) == 1
    return next(iter(rows.values()))


def test_as_of_day_is_left_out(make_tx):
    tx = make_tx({"transaction_date": "2024-02-01 00:00:00"}, {"transaction_date": "2024-01-31 23:59:59"})
    assert list(full(tx)) == [(date(2024, 1, 31), "1", "Shop")]


def test_sums_take_all_amounts_and_counts_only_positive(make_tx):
    row = only(full(make_tx({"amount": -50}, {"amount": 0}, {"amount": 1})))
    assert (row.amount_sum, row.amount_count) == (D("-0.49"), 1)


def test_refunds_and_voids(make_tx):
    tx = make_tx(
        {"amount": 1000, "refunded_amount": 400},
        {"amount": 700, "refunded_amount": 300, "transaction_type": "refund"},
        {"amount": 900, "transaction_type": "void"},
        {"amount": 800, "status": "failed"},
    )
    row = only(full(tx))
    assert (row.amount_sum, row.refund_sum, row.void_sum) == (D("10.00"), D("3.00"), D("9.00"))
    assert (row.total, row.totalcount, row.voidcount) == (D("7.00"), 2, 1)


def test_business_date_needs_more_than_ten_dollars(make_tx):
    tx = make_tx(
        {"amount": 1000, "transaction_date": "2024-01-01 08:00:00"},
        {"amount": 1001, "transaction_date": "2024-01-02 08:00:00"},
    )
    row = full(tx)[(date(2024, 1, 1), "1", "Shop")]
    assert row.first_transaction_date == datetime(2024, 1, 1, 8)
    assert row.first_business_transaction_date == datetime(2024, 1, 2, 8)


def test_first_dates_see_rows_without_name_and_any_type(make_tx):
    tx = make_tx(
        {"merchant_name": None, "transaction_type": "void", "transaction_date": "2024-01-01 08:00:00"},
        {"transaction_date": "2024-01-05 08:00:00"},
    )
    row = only(full(tx))
    assert row.day == date(2024, 1, 5)
    assert row.first_transaction_date == datetime(2024, 1, 1, 8)


def test_one_scan_gives_the_same_first_dates(make_tx, rows_of):
    tx = make_tx(
        {"merchant_name": None, "transaction_date": "2024-01-01 08:00:00"},
        {"mid": 2, "amount": 10},
        {"mid": None},
        {"transaction_date": None},
    )
    columns = ("mid", "first_transaction_date", "first_business_transaction_date")
    assert rows_of(first_dates_of(day_grain(tx)), *columns) == rows_of(db.first_dates(tx), *columns)


def test_renamed_merchant_has_two_rows_and_ordered_sums(make_tx):
    rows = full(make_tx({"merchant_name": "B", "amount": 200}, {"merchant_name": "A", "amount": 100}))
    day = date(2024, 1, 10)
    assert rows[(day, "1", "A")].mtd_total == D("1.00")
    assert rows[(day, "1", "B")].mtd_total == D("3.00")


def test_null_amounts_give_zero(make_tx):
    row = only(full(make_tx({"amount": None})))
    assert (row.amount_sum, row.total, row.ytd_total) == (D("0.00"),) * 3


def test_totals_restart_by_month_and_year(make_tx):
    days = ("2023-12-31", "2024-01-01", "2024-01-31", "2024-02-01")
    rows = full(make_tx(*({"transaction_date": f"{d} 01:00:00", "amount": 100} for d in days)), date(2025, 1, 1))
    sums = [(r.mtd_total, r.ytd_total) for _, r in sorted(rows.items())]
    assert sums == [(D(1), D(1)), (D(1), D(1)), (D(2), D(2)), (D(1), D(3))]


def test_month_end_total_is_the_sum_of_the_month(spark, sf_dir):
    from workload import fixtures as fx

    rows = materialize(db.full_refresh(fx.transactions(spark, sf_dir), None), "rows")
    monthly = rows.groupBy("mid", F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.sum("total").alias("sum"),
        F.max_by("mtd_total", F.struct("day", "merchant_name")).alias("last"),
    )
    assert monthly.where(F.col("sum") != F.col("last")).isEmpty()


@pytest.mark.parametrize("rows_per_task", [1, 3, 10])
def test_hot_merchant_in_chunks_equals_plain_sums(spark, rows_of, rows_per_task):
    """A third of all rows on one merchant and day, each under its own name."""
    hot = spark.range(60).selectExpr(
        "1L AS mid", "date'2024-03-05' AS day", "concat('n', lpad(id, 3, '0')) AS merchant_name", "id AS cents"
    )
    rest = spark.range(120).selectExpr(
        "id % 4 AS mid", "date_add(date'2023-12-20', cast(id AS int)) AS day", "'x' AS merchant_name", "id AS cents"
    )
    daily = materialize(
        hot.unionByName(rest).withColumn("total", F.col("cents").cast("decimal(31,4)")), "hot"
    )
    columns = ("mid", "day", "merchant_name", "mtd_total", "ytd_total")
    plain = rows_of(db.running_totals(daily), *columns)
    assert rows_of(db.running_totals(daily, rows_per_task), *columns) == plain


def test_surrogate_key_continues_and_follows_mid_as_number(spark):
    rows = spark.createDataFrame(
        [(date(2024, 1, 2), "2", "a"), (date(2024, 1, 1), "10", "a"), (date(2024, 1, 1), "9", "b"), (date(2024, 1, 1), "9", "a")],
        "day date, mid string, merchant_name string",
    )
    numbered = db.with_surrogate_key(rows, start=5).orderBy("id").collect()
    assert [(r.id, r.mid, r.merchant_name) for r in numbered] == [
        (5, "9", "a"), (6, "9", "b"), (7, "10", "a"), (8, "2", "a"),
    ]


def test_surrogate_key_has_no_gaps_over_many_partitions(spark):
    rows = spark.range(5000).selectExpr(
        "date_add(date'2020-01-01', cast(id % 700 AS int)) AS day", "cast(id % 13 AS string) AS mid",
        "cast(id AS string) AS merchant_name",
    )
    ids = db.with_surrogate_key(rows).agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(ids) == (1, 5000, 5000)


def test_empty_transactions(make_tx, spark):
    tx = make_tx({}).where("1 = 0")
    assert db.full_refresh(tx, AS_OF).count() == 0
    summary = db.summary_full(db.full_refresh(tx, AS_OF)).first()
    assert summary.total_records == 0 and summary.earliest_date is None
    stored = db.read_daily(spark, fresh_path(spark, "nothing"))
    assert db.watermark(stored) == date(1900, 1, 1)


def test_no_time_zone_moves_a_transaction(spark, make_tx):
    """02:30 does not exist on this day in that zone; 23:30 is another day in UTC."""
    from daybook.functions.values import month_of, stamp

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        tx = make_tx({"transaction_date": "2024-03-10 02:30:00"}, {"transaction_date": "2024-03-31 23:30:00"})
        assert sorted(str(k[0]) for k in full(tx, date(2024, 5, 1))) == ["2024-03-10", "2024-03-31"]
        stamps = tx.select(stamp(F.col("transaction_date")), month_of(F.col("transaction_date"))).collect()
        assert sorted(map(tuple, stamps)) == [("20240310_023000", "2024-03"), ("20240331_233000", "2024-03")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
