"""What the engine is asked to do: scans, shuffles, pruning, table rules."""

import re
from datetime import date

import pytest

import daybook as db
from daybook import schemas
from daybook.operators.metrics import day_grain
from daybook.workspace import fresh_path, materialize
from workload import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    path = fresh_path(spark, "transactions")
    db.append_transactions(fx.transactions(spark, sf_dir), path)
    return db.read_transactions(spark, path)


def test_one_scan_and_one_shuffle_of_the_transactions(stored):
    text = plan(day_grain(stored, date(2001, 6, 1)))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert "updated_at" not in schema and "currency" not in schema


def test_day_bounds_reach_the_scan_and_prune_months(stored):
    text = plan(db.daily_aggregates(stored, date(2001, 6, 1), date(2001, 3, 5)))
    assert re.search(r"PartitionFilters: \[.*month.*>= 2001-03.*month.*<= 2001-06", text)
    assert "GreaterThanOrEqual(transaction_date,2001-03-05" in text


def test_both_running_sums_share_one_shuffle_and_sort(spark, sf_dir):
    rows = materialize(
        db.daily_totals(
            db.daily_aggregates(fx.transactions(spark, sf_dir)), db.first_dates(fx.transactions(spark, sf_dir))
        ),
        "daily",
    )
    text = plan(db.running_totals(rows))
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1 and text.count("Window ") == 2


def test_refresh_has_no_single_partition_step(stored):
    text = plan(db.full_refresh(stored, date(2001, 6, 1)))
    assert "SinglePartition" not in text and "CartesianProduct" not in text


def test_update_reads_only_the_watermarks_year_of_history(spark, stored, tmp_path):
    path = str(tmp_path / "daily")
    db.write_daily(db.full_refresh(stored, date(2001, 3, 1)), path)
    text = plan(db.incremental_update(stored, db.read_table(spark, path), date(2001, 2, 28)))
    assert re.search(r"month.*>= 2001-01.*month.*<= 2001-02", text)


def test_extract_conditions_reach_the_scan(stored):
    text = plan(db.extract_window(stored, "1999-01-01 00:00:00", "1999-02-01 00:00:00"))
    for pushed in ("GreaterThan(updated_at", "LessThanOrEqual(updated_at", "GreaterThan(merchant_account_id,8)"):
        assert pushed in text


def test_stored_keys_stay_in_their_buckets(spark, stored, tmp_path):
    db.schemas.create_transactions_table(spark, "tx_bucketed", 4, str(tmp_path / "bucketed"))
    columns = schemas.TRANSACTIONS.fieldNames()
    first = db.dedup_first(stored.select(*columns), [schemas.TRANSACTION_KEY], ["transaction_date", "amount", "mid"])
    first.write.insertInto("tx_bucketed")
    new = materialize(first, "new")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(db.known_keys(new, spark.table("tx_bucketed"), schemas.TRANSACTION_KEY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1
    scan = re.search(r"Bucketed: true.*?ReadSchema: struct<([^>]*)>", text)[1]
    assert scan == "transaction_uuid:string"
    spark.sql("DROP TABLE tx_bucketed")


def test_daily_table_rules(spark, stored, tmp_path):
    schemas.create_daily_table(spark, "daily_rules", str(tmp_path / "rules"))
    rows = db.to_sink(db.with_surrogate_key(db.full_refresh(stored, date(1996, 1, 1))), "2024-01-01 00:00:00")
    rows.selectExpr("*", "date_format(day, 'yyyy-MM') AS month").write.insertInto("daily_rules")
    assert spark.table("daily_rules").count() == rows.count() > 0
    spark.sql(
        "INSERT INTO daily_rules (id, day, mid, merchant_name, created_at, updated_at, month) VALUES "
        "(1, date'2024-01-01', '1', 'x', now(), now(), '2024-01')"
    )
    added = spark.table("daily_rules").where("month = '2024-01'").first()
    assert (added.amount_count, float(added.ytd_total)) == (0, 0.0)
    with pytest.raises(Exception, match="(?i)length"):
        spark.sql(
            "INSERT INTO daily_rules (id, day, mid, merchant_name, created_at, updated_at, month) VALUES "
            "(1, date'2024-01-01', repeat('1', 51), 'x', now(), now(), '2024-01')"
        )
    spark.sql("DROP TABLE daily_rules")


def test_merchants_table(spark, tmp_path):
    schemas.create_merchants_table(spark, "merchants_rules", str(tmp_path / "merchants"))
    assert spark.table("merchants_rules").columns == schemas.MERCHANTS.fieldNames()
    spark.sql("DROP TABLE merchants_rules")


def test_constraints(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, v string")
    found = {(r.rule, r.column_name): r.broken_rows for r in db.check_constraints(rows, "k", ["v"]).collect()}
    assert found == {("not null", "k"): 1, ("not null", "v"): 1, ("primary key", "k"): 2}
    with pytest.raises(db.ConstraintError, match="primary key on k"):
        db.require_constraints(rows, "k")
    db.require_constraints(rows.where("v = 'a'"), "k", ["v"])
