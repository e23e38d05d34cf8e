"""Stored tables: commits, key index, first dates, merges, upserts, layout."""

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import daybook as db
from daybook.operators import metrics
from daybook.schemas import TRANSACTION_KEY
from daybook.sources import commits, transactions
from daybook.sources.commits import ConcurrentWriteError, Commit, commit, due, last_commit, vacuum
from daybook.workspace import list_names


class Lost(RuntimeError):
    pass


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Rows of a result, and how many files its scans opened."""
    rows = df.collect()
    opened, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if node.metrics().contains("numFiles"):
            opened += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows, opened


def daily_rows(spark, *rows):
    columns = "id long, day date, mid string, merchant_name string, total decimal(18,2)"
    return spark.createDataFrame([(i, date.fromisoformat(d), m, "x", None) for i, d, m in rows], columns)


@pytest.mark.parametrize("step", ["write_folder", "commit", "vacuum"])
def test_a_failure_at_any_step_leaves_a_whole_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "table")
    db.replace_table(spark.range(5), path)
    db.write_daily(daily_rows(spark, (1, "2024-01-02", "1")), f"{path}-daily")

    def fail(*args, **kwargs):
        raise Lost

    monkeypatch.setattr(f"daybook.sources.tables.{step}", fail)
    with pytest.raises(Lost):
        db.replace_table(spark.range(7), path)
    with pytest.raises(Lost):
        db.replace_months(daily_rows(spark, (2, "2024-01-03", "1")), f"{path}-daily")
    monkeypatch.undo()
    # Only what comes after the commit may fail without undoing it.
    assert db.read_table(spark, path).count() == (7 if step == "vacuum" else 5)
    assert [r.id for r in db.read_daily(spark, f"{path}-daily").collect()] == ([2] if step == "vacuum" else [1])
    db.replace_table(spark.range(9), path)
    assert db.read_table(spark, path).count() == 9


@pytest.mark.parametrize("step", ["_write_rows", "_write_keys", "_write_first", "commit"])
def test_a_failed_append_is_not_there_and_can_be_repeated(spark, make_tx, tmp_path, monkeypatch, step):
    path = str(tmp_path / "tx")
    db.append_transactions(make_tx({"transaction_uuid": "a"}), path)
    new = make_tx({"transaction_uuid": "b"})

    def fail(*args, **kwargs):
        raise Lost

    monkeypatch.setattr(transactions, step, fail)
    with pytest.raises(Lost):
        db.append_transactions(new, path)
    monkeypatch.undo()
    assert [r[0] for r in db.read_transactions(spark, path).select(TRANSACTION_KEY).collect()] == ["a"]
    assert db.stored_keys(spark, path, new).count() == 0
    db.append_transactions(new, path)
    assert db.read_transactions(spark, path).count() == 2
    assert db.stored_keys(spark, path, new).count() == 1


def test_two_writers_do_not_commit_the_same_number(spark, tmp_path):
    path = str(tmp_path / "table")
    db.replace_table(spark.range(5), path)
    seen = last_commit(spark, path)
    db.replace_table(spark.range(6), path)
    with pytest.raises(ConcurrentWriteError):
        commit(spark, path, seen, {"rows/batch=x": {}}, {})
    assert db.read_table(spark, path).count() == 6


def test_old_folders_go_and_the_last_commits_stay_readable(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(6):
        db.replace_table(spark.range(n), path)
    assert len(list_names(spark, f"{path}/rows")) == 3
    vacuum(spark, path, keep=1)
    assert len(list_names(spark, f"{path}/rows")) == 1 and db.read_table(spark, path).count() == 5


def test_plain_parquet_is_read_and_taken_over(spark, make_tx, tmp_path):
    path = str(tmp_path / "tx")
    rows = make_tx({"transaction_uuid": "a", "transaction_date": "2024-03-04 00:00:00"})
    rows.selectExpr("*", "'2024-03' AS month").write.partitionBy("month").parquet(path)
    assert db.read_transactions(spark, path).count() == 1
    assert db.stored_keys(spark, path, rows).count() == 1
    db.append_transactions(make_tx({"transaction_uuid": "b"}), path)
    assert sorted(r[0] for r in db.read_transactions(spark, path).select(TRANSACTION_KEY).collect()) == ["a", "b"]
    daily = str(tmp_path / "daily")
    old = daily_rows(spark, (1, "2024-01-02", "1"), (4, "2024-02-02", "1"))
    metrics.with_month(old).write.partitionBy("month").parquet(daily)
    assert db.daily_facts(spark, daily) == db.daily_facts(spark, daily).__class__(date(2024, 2, 2), 4)
    db.replace_months(daily_rows(spark, (5, "2024-02-03", "1")), daily)
    assert sorted(r.id for r in db.read_daily(spark, daily).collect()) == [1, 5]


def test_folders_due_for_a_merge():
    assert due({f"f{n}": 1 for n in range(7)}, fan=8) == []
    assert len(due({f"f{n}": 1 for n in range(8)}, fan=8)) == 8
    assert sorted(due({"big": 10_000, "small": 1, **{f"f{n}": 9 for n in range(8)}}, fan=8)) == [*(f"f{n}" for n in range(8)), "small"]
    sizes = {}
    for n in range(3000):
        sizes[f"f{n}"] = 5
        if old := due(sizes):
            sizes[f"f{n}"] = sum(sizes.pop(f) for f in old)
        assert len(sizes) <= 8 * 6
    assert sum(sizes.values()) == 15_000


def test_many_appends_leave_few_folders_and_the_same_table(spark, make_tx, tmp_path):
    path, rows = str(tmp_path / "tx"), []
    for n in range(20):
        new = [{"transaction_uuid": f"k{n}", "mid": n % 3, "transaction_date": f"2024-0{1 + n % 4}-10 0{n % 10}:00:00"}]
        rows += new
        db.append_transactions(make_tx(*new), path)
    whole = make_tx(*rows)
    now = last_commit(spark, path)
    for kind in ("rows", "keys", "first"):
        assert len(now.of(kind)) < 10
    names = whole.columns
    assert sorted(db.read_transactions(spark, path).select(names).collect(), key=str) == sorted(whole.collect(), key=str)
    assert db.stored_keys(spark, path, whole).count() == 20
    assert sorted(db.read_first_dates(spark, path).collect()) == sorted(db.first_dates(whole).collect())


@pytest.mark.parametrize("sent", [500_000, 3, 1])
def test_index_finds_exactly_the_stored_keys(spark, make_tx, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(transactions, "BUCKET_KEYS", 4)
    path = str(tmp_path / "tx")
    for start in (0, 40, 43):
        db.append_transactions(make_tx(*({"transaction_uuid": f"k{n}"} for n in range(start, start + 40))), path)
    some = make_tx(*({"transaction_uuid": k} for k in ("k3", "k41", "k82", "k99", "nope", None, "k3")))
    found = db.stored_keys(spark, path, some, sent_keys=sent)
    assert {r[0] for r in found.collect()} == {"k3", "k41", "k82"}
    assert db.stored_keys(spark, path, some.limit(0)).count() == 0


def test_a_batch_opens_only_its_buckets_and_shuffles_no_stored_key(spark, make_tx, tmp_path, monkeypatch):
    monkeypatch.setattr(transactions, "BUCKET_KEYS", 2)
    path = str(tmp_path / "tx")
    db.append_transactions(make_tx(*({"transaction_uuid": f"k{n}"} for n in range(100))), path)
    (folder,) = last_commit(spark, path).of("keys")
    stored = len(list_names(spark, f"{path}/{folder}"))
    raw = make_tx({"transaction_uuid": "k5"}, {"transaction_uuid": "new"})
    known = db.stored_keys(spark, path, raw)
    text = plan(known)
    assert text.count("FileScan") == 2 and "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    scan = next(t for t in text.split("FileScan") if "bucket" in t)
    filters = scan.split("PartitionFilters: ")[1].split(", PushedFilters")[0]
    assert "batch" in filters and "bucket" in filters and f"struct<{TRANSACTION_KEY}:string,month:string>" in scan
    rows, opened = files_read(known)
    assert [r[0] for r in rows] == ["k5"] and opened <= 3 < stored


def test_update_reads_first_dates_and_facts_not_history(spark, make_tx, tmp_path):
    table, daily = str(tmp_path / "tx"), str(tmp_path / "daily")
    days = [f"2023-{m:02d}-{d:02d} 10:00:00" for m in range(1, 13) for d in (3, 17)]
    db.append_transactions(make_tx(*({"transaction_uuid": f"k{n}", "transaction_date": d} for n, d in enumerate(days))), table)
    db.update_daily(spark, table, daily, "2024-01-01 00:00:00")
    facts = db.daily_facts(spark, daily)
    assert (facts.last_day, facts.top_id) == (date(2023, 12, 17), 24)
    # Whoever opened a month before the watermark would fail.
    for month in Path(table, "rows").glob("batch=*/month=2023-*"):
        if not month.name.endswith("-12"):
            for name in [*month.glob("*.parquet"), *month.glob(".*.crc")]:
                name.write_bytes(b"broken")
    with pytest.raises(Exception):
        db.first_dates(db.read_transactions(spark, table)).collect()
    before = db.read_daily(spark, daily).drop("updated_at", "created_at").collect()
    db.update_daily(spark, table, daily, "2024-01-02 00:00:00")
    after = db.read_daily(spark, daily).drop("updated_at", "created_at")
    assert sorted((r.day, r.mid, r.ytd_total) for r in after.collect()) == sorted((r.day, r.mid, r.ytd_total) for r in before)


def test_upsert_rewrites_only_the_months_of_its_keys(spark, make_tx, tmp_path):
    path = str(tmp_path / "tx")
    old = [{"transaction_uuid": f"k{n}", "transaction_date": f"2024-0{n}-05 00:00:00", "updated_at": "2024-06-01 00:00:00"} for n in range(1, 6)]
    db.append_transactions(make_tx(*old), path)
    before = {f: k["months"] for f, k in last_commit(spark, path).of("rows").items()}
    new = [
        {"transaction_uuid": "k2", "amount": 77, "transaction_date": "2024-02-05 00:00:00", "updated_at": "2024-07-01 00:00:00"},
        {"transaction_uuid": "k3", "amount": 88, "transaction_date": "2024-03-05 00:00:00", "updated_at": "2024-05-01 00:00:00"},
        {"transaction_uuid": "k4", "amount": 99, "transaction_date": "2024-01-09 00:00:00", "updated_at": "2024-08-01 00:00:00"},
        {"transaction_uuid": "n1", "amount": 11, "transaction_date": "2024-09-05 00:00:00"},
        {"transaction_uuid": None},
    ]
    assert db.upsert_transactions(make_tx(*new), path) == ["2024-02", "2024-03", "2024-04"]
    folders = {f: k["months"] for f, k in last_commit(spark, path).of("rows").items()}
    (first,) = before
    assert folders[first] == ["2024-01", "2024-05"] and len(folders) == 2
    rows = {r[0]: (int(r.amount), r.month) for r in db.read_transactions(spark, path).collect()}
    assert rows == {
        "k1": (5000, "2024-01"), "k2": (77, "2024-02"), "k3": (5000, "2024-03"), "k4": (99, "2024-01"),
        "k5": (5000, "2024-05"), "n1": (11, "2024-09"),
    }
    assert db.stored_keys(spark, path, make_tx(*new)).select(TRANSACTION_KEY).distinct().count() == 4
    whole = db.read_transactions(spark, path)
    assert sorted(db.read_first_dates(spark, path).collect()) == sorted(db.first_dates(whole).collect())
    assert len(last_commit(spark, path).of("first")) == 1
    assert db.upsert_transactions(make_tx({"transaction_uuid": "z"}), path) == []
    assert db.read_transactions(spark, path).count() == 7
    db.upsert_transactions(make_tx({"transaction_uuid": "k1", "transaction_date": "2025-01-01 00:00:00", "updated_at": "2025-01-01 00:00:00"}), path)
    db.append_transactions(make_tx({"transaction_uuid": "late", "transaction_date": "2026-01-01 00:00:00"}), path)
    assert not last_commit(spark, path).of("first")
    assert sorted(db.read_first_dates(spark, path).collect()) == sorted(db.first_dates(db.read_transactions(spark, path)).collect())


@pytest.mark.parametrize("case", ["marks", "repeated", "hot"])
def test_upsert_stores_what_whole_rows_decide(spark, make_tx, tmp_path, monkeypatch, case):
    """Marks of replaced rows give the same table as comparing whole rows."""
    def row(n, key, month, version, amount):
        date = month and f"2024-{month:02d}-0{1 + n % 9} 00:00:00"
        stamp = version and f"2024-{version:02d}-01 00:00:00"
        return {"transaction_uuid": key, "transaction_date": date, "updated_at": stamp, "amount": amount}

    old = [row(n, f"k{n}", 1 + n % 5 if n % 6 else None, 6 if n % 4 else None, n) for n in range(20)]
    old += [{**row(0, None, 2, 6, 1)}, row(1, "apart", 9, 6, 1)]
    if case == "repeated":
        old += [row(7, "k1", 3, 7, 70), row(7, "k2", 3, 6, 1), row(7, "apart", 9, 6, 2), row(3, "twice", 1, 1, 1), row(4, "twice", 1, 1, 2)]
    new = [row(n + n % 2, f"k{n}", 1 + n % 4, [None, 5, 6, 7][n % 4], 100 + n) for n in range(4, 24)]
    new += [row(n, f"k{n % 25}", 1 + n % 3, [None, 6, 8][n % 3], 200 + n) for n in range(0, 50, 3)]
    new += [row(1, None, 2, 9, 5)]
    path = str(tmp_path / "tx")
    db.append_transactions(make_tx(*old), path)
    if case == "hot":
        monkeypatch.setattr(transactions, "has_hot_key", lambda rows, key: True)
    before = db.read_transactions(spark, path)
    names = [c for c in before.columns if c != "month"]
    wide = spark.createDataFrame(before.collect(), before.schema)
    touched = db.upsert_transactions(make_tx(*new), path)
    inside = F.coalesce("month", F.lit("")).isin(touched)
    expected = db.upsert_latest(make_tx(*new), wide.where(inside).select(*names), TRANSACTION_KEY, "updated_at")
    expected = expected.unionByName(wide.where(~inside).select(*names))
    got = db.read_transactions(spark, path)
    assert sorted(map(repr, got.select(*names).collect())) == sorted(map(repr, expected.collect()))
    places = got.where("transaction_uuid IS NOT NULL").select(TRANSACTION_KEY, "month")
    index = db.stored_keys(spark, path, places).select(TRANSACTION_KEY, "month")
    assert places.subtract(index).isEmpty()
    if case != "repeated":
        assert index.count() == index.distinct().count()


def test_upsert_shuffles_stored_rows_by_key_without_their_columns(spark, make_tx, tmp_path):
    path = str(tmp_path / "stored")
    make_tx({"transaction_uuid": "a"}, {"transaction_uuid": "b"}).write.parquet(path)
    stored = spark.read.parquet(path)
    decided = transactions._replacing(make_tx({"transaction_uuid": "a", "updated_at": "2030-01-01 00:00:00"}), stored, "updated_at")
    text = decided._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert sorted(c.partition(":")[0] for c in read.split(",")) == ["transaction_date", TRANSACTION_KEY, "updated_at"]
    below = text[text.index("Exchange") :]
    assert text.count("Exchange") == 1 and "Sort" not in below
    assert [r["_origin"] for r in decided.orderBy("_origin").collect()] == [0, 2]


def test_a_daily_table_put_in_place_as_a_whole_can_be_updated(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = metrics.with_month(daily_rows(spark, (1, "2024-01-02", "1"), (4, "2024-02-02", "1")))
    db.replace_table(rows, path, ("month",))
    assert db.daily_facts(spark, path).top_id == 4
    db.replace_months(daily_rows(spark, (5, "2024-02-03", "1")), path)
    assert sorted(r.id for r in db.read_daily(spark, path).collect()) == [1, 5]


def test_either_condition_skips_files_of_the_daily_table(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = spark.range(31 * 400).selectExpr(
        "id", "date_add(date'2024-01-01', cast(id % 31 as int)) AS day", "cast(id div 31 as string) AS mid", "'x' AS merchant_name"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        db.write_daily(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    (folder,) = last_commit(spark, path).of("rows")
    from glob import glob

    import pyarrow.parquet as pq

    names = glob(f"{path}/{folder}/month=2024-01/*.parquet")
    bands = []
    for name in names:
        meta = pq.ParquetFile(name).metadata
        table = pq.read_table(name, columns=["mid", "day"]).to_pydict()
        bands.append((min(map(int, table["mid"])), max(map(int, table["mid"])), min(table["day"]), max(table["day"])))
        assert meta.num_rows
    assert len(names) >= 40
    for mid in (3, 200, 399):
        assert sum(a <= mid <= b for a, b, _, _ in bands) <= len(names) / 3
    for day in (date(2024, 1, 2), date(2024, 1, 16), date(2024, 1, 30)):
        assert sum(a <= day <= b for _, _, a, b in bands) <= len(names) / 3


def test_commit_reading_is_cheap_to_follow(spark, tmp_path):
    assert last_commit(spark, str(tmp_path / "nothing")) is None
    assert Commit().of("rows") == {}
    assert commits.FAN > 1
