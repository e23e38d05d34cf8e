"""Splits of a source read, positions in an order, collation, the run's log line."""

import logging
import random

import pytest
from pyspark.sql import functions as F

import daybook as db
from daybook.functions.values import ignoring_case
from daybook.operators.surrogate import order_digest, with_positions
from daybook.sources.extract import UnsplitReadError, plan_splits, read_source_table, split_conditions, splits_of


def counter(values, asked):
    def count(start, end, cells):
        asked.append((start, end))
        found = {}
        for v in values:
            if start <= v < end:
                cell = (v - start) * cells // (end - start)
                found[cell] = found.get(cell, 0) + 1
        return found

    return count


@pytest.mark.parametrize("shape", ["even", "skewed", "cluster", "one"])
def test_parts_are_about_equal_however_the_numbers_lie(shape):
    rng = random.Random(1)
    values = {
        "even": lambda: rng.randrange(-10**6, 10**6),
        "skewed": lambda: int(rng.paretovariate(0.3)) % 10**12,
        "cluster": lambda: 10**11 + rng.randrange(5000) if rng.random() < 0.99 else rng.randrange(10**12),
        "one": lambda: 7,
    }[shape]
    values = [values() for _ in range(20_000)]
    asked = []
    cuts = plan_splits(counter(values, asked), min(values), max(values), 16)
    edges = [-(10**18), *cuts, 10**18]
    sizes = [sum(a <= v < b for v in values) for a, b in zip(edges, edges[1:])]
    most = max(values.count(v) for v in set(values[:200]) | {min(values)})
    assert sum(sizes) == len(values) and max(sizes) <= 2 * 20_000 / 16 + most
    assert len(asked) <= 1 + 16 * 8 and len(sizes) <= 32


def test_every_row_is_in_exactly_one_part(spark):
    rows = spark.createDataFrame([(None,), (None,), *((n * n * n,) for n in range(-50, 300))], "id long")
    conditions = splits_of(rows, "id", 6)
    assert 4 <= len(conditions) <= 12
    parts = [rows.where(c).count() for c in conditions]
    assert sum(parts) == rows.count() and max(parts) <= 2 * rows.count() / 6
    assert splits_of(rows.limit(0), "id", 6) == ["1 = 1"] == split_conditions("id", [])
    assert splits_of(rows.where("id = 8"), "id", 6) == ["1 = 1"]


def test_a_large_table_is_not_read_in_one_task(spark):
    with pytest.raises(UnsplitReadError, match="orders"):
        read_source_table(spark, "jdbc:none", "orders")


def test_positions_follow_the_order_the_rows_have(spark):
    rows = spark.range(5000).repartition(7).orderBy((F.col("id") * 7919) % 5000)
    placed = with_positions(rows).collect()
    assert {r.position: r.id for r in placed} == {n + 1: i for n, i in enumerate(sorted(range(5000), key=lambda i: i * 7919 % 5000))}
    one, same, other = (order_digest(spark.range(100).orderBy(o)).first() for o in ("id", "id", F.desc("id")))
    assert one == same and one.rows == other.rows and one.digest != other.digest
    assert tuple(order_digest(spark.range(0)).first()) == (0, 0)


def test_collation_is_an_option(spark, make_tx):
    tx = make_tx(
        {"status": "SUCCEEDED", "merchant_name": "shop "}, {"transaction_type": "Charge "}, {"status": "succeeded"}
    )
    assert [r.amount_count for r in db.daily_aggregates(tx).orderBy("amount_count").collect()] == [0, 1]
    assert [r.amount_count for r in db.daily_aggregates(ignoring_case(tx)).collect()] == [3]
    assert db.first_dates(ignoring_case(tx.where("status = 'SUCCEEDED'"))).first().first_transaction_date is not None


def test_an_update_logs_its_watermark(spark, make_tx, tmp_path, caplog):
    table, daily = str(tmp_path / "tx"), str(tmp_path / "daily")
    db.append_transactions(make_tx({"transaction_date": "2024-03-04 00:00:00"}), table)
    with caplog.at_level(logging.INFO, logger="daybook"):
        db.update_daily(spark, table, daily, "2024-04-01 00:00:00")
        db.update_daily(spark, table, daily, "2024-04-02 00:00:00", lookback_days=3)
    told = [r.getMessage() for r in caplog.records if r.name == "daybook"]
    assert told == ["Processing data from: 1900-01-01", "Processing data from: 2024-03-01"]
