"""The file stream against the batch load."""

import gzip
import os
from datetime import date
from pathlib import Path

import pytest

import daybook as db
from daybook.sources.commits import write_folder
from daybook.sources.files import list_files, read_headers
from daybook.workspace import fresh_path, materialize, workspace

HEADER = "transaction_uuid,merchant_account_id,merchant_name,mid,amount,refunded_amount,status,transaction_type,transaction_date"


def line(key, day, amount="1000"):
    return f"{key},9,Shop,1,{amount},0,succeeded,charge,{day} 10:00:00"


def land(folder: Path, name: str, *lines: str, header: str = HEADER) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join((header, *lines)) + "\n", encoding="utf-8")


def run(spark, tmp_path, **options):
    places = [str(tmp_path / n) for n in ("in", "table", "archive", "progress")]
    if "daily" in options:
        return db.load_new_files(spark, *places, options.pop("daily"), **options)
    query = db.ingest_stream(spark, *places, **options)
    query.awaitTermination()
    return query


def keys(spark, tmp_path):
    return sorted(r.transaction_uuid for r in db.read_transactions(spark, str(tmp_path / "table")).collect())


def test_each_file_is_loaded_once_and_archived(spark, tmp_path):
    land(tmp_path / "in", "a.csv", line("k1", "2024-01-01"), line("k1", "2024-01-02"), line("k2", "2024-01-01"))
    run(spark, tmp_path)
    assert keys(spark, tmp_path) == ["k1", "k2"]
    land(tmp_path / "in", "b.csv", line("k2", "2024-01-03"), line("k3", "2024-01-03"))
    run(spark, tmp_path)
    assert keys(spark, tmp_path) == ["k1", "k2", "k3"]
    run(spark, tmp_path)
    assert keys(spark, tmp_path) == ["k1", "k2", "k3"]
    land(tmp_path / "in", "c.csv", line("k4", "2024-01-03"))
    run(spark, tmp_path)
    assert "a.csv" in {p.name for p in (tmp_path / "archive").rglob("*.csv")}


def test_many_batches_equal_one(spark, tmp_path):
    for n in range(4):
        for side in ("one", "many"):
            land(tmp_path / side / "in", f"f{n}.csv", *(line(f"k{n}-{i}", "2024-01-01") for i in range(5)))
    run(spark, tmp_path / "one")
    query = run(spark, tmp_path / "many", files_per_batch=1)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    assert keys(spark, tmp_path / "one") == keys(spark, tmp_path / "many")


def test_replayed_batch_adds_nothing(spark, tmp_path):
    land(tmp_path / "in", "a.csv", line("k1", "2024-01-01"), line("k2", "2024-01-01", "1.5"))
    options = {"rejects": str(tmp_path / "rejects")}
    run(spark, tmp_path, **options)
    for commit in (tmp_path / "progress" / "commits").glob("*0*"):
        commit.unlink()
    run(spark, tmp_path, **options)
    assert keys(spark, tmp_path) == ["k1"]
    rejected = spark.read.json(str(tmp_path / "rejects"))
    assert [r.reject_reason for r in rejected.collect()] == ["amount: fraction of a cent"]


def test_file_without_key_column_is_noted_not_loaded(spark, tmp_path):
    land(tmp_path / "in", "a.csv", "1,2,3", header="mid,amount,refunded_amount")
    land(tmp_path / "in", "b.csv", line("k1", "2024-01-01"))
    run(spark, tmp_path, rejects=str(tmp_path / "rejects"))
    assert keys(spark, tmp_path) == ["k1"]
    noted = spark.read.json(str(tmp_path / "rejects")).collect()
    assert [(r.source_file.rsplit("/", 1)[1], r.reject_reason) for r in noted] == [("a.csv", "no column transaction_uuid")]


def test_daily_table_follows_the_load(spark, tmp_path):
    daily = fresh_path(spark, "daily")
    land(tmp_path / "in", "a.csv", line("k1", "2024-01-01"))
    run(spark, tmp_path, daily=daily)
    land(tmp_path / "in", "b.csv", line("k2", "2024-01-01"), line("k3", "2024-01-02"))
    run(spark, tmp_path, daily=daily)
    rows = {r.day: r for r in db.read_daily(spark, daily).collect()}
    assert float(rows[date(2024, 1, 1)].amount_sum) == 20.0
    assert float(rows[date(2024, 1, 2)].mtd_total) == 30.0


def test_noted_first_dates_are_those_of_a_scan(spark, tmp_path):
    daily, table = str(tmp_path / "daily"), str(tmp_path / "table")
    land(tmp_path / "in", "a.csv", line("k1", "2024-01-05", "500"), line("k2", "2024-01-05", "900"))
    run(spark, tmp_path, daily=daily)
    land(tmp_path / "in", "b.csv", line("k3", "2024-01-03", "2000"), line("k4", "2024-01-06"))
    run(spark, tmp_path, daily=daily)
    land(tmp_path / "in", "c.csv", line("k5", "2024-01-07", "3000"))
    run(spark, tmp_path, daily=daily)
    scanned = db.first_dates(db.read_transactions(spark, table))
    assert sorted(db.read_first_dates(spark, table).collect()) == sorted(scanned.collect())
    rows = db.read_daily(spark, daily).orderBy("day").collect()
    assert len(rows) == 3 and str(rows[-1].first_business_transaction_date) == "2024-01-03 10:00:00"


def test_daily_table_does_not_depend_on_batches(spark, tmp_path):
    tables = {}
    for files in (1, 1000):
        home = tmp_path / str(files)
        land(home / "in", "a.csv", line("k1", "2024-01-05"))
        os.utime(home / "in" / "a.csv", (1, 1))
        land(home / "in", "b.csv", line("k2", "2024-01-03", "2000"))
        run(spark, home, daily=str(home / "daily"), files_per_batch=files)
        rows = db.read_daily(spark, str(home / "daily")).orderBy("day").collect()
        tables[files] = [(r.day.day, r.amount_sum, r.mtd_total) for r in rows]
    assert tables[1] == tables[1000] and [r[0] for r in tables[1]] == [3, 5]


def test_late_days_come_in_with_lookback(spark, tmp_path):
    daily = str(tmp_path / "daily")
    land(tmp_path / "in", "a.csv", line("k1", "2024-01-05"))
    run(spark, tmp_path, daily=daily)
    land(tmp_path / "in", "b.csv", line("k2", "2024-01-04"), line("k3", "2024-01-09"))
    run(spark, tmp_path, daily=daily, as_of=date(2024, 1, 8), lookback_days=2)
    assert [r.day.day for r in db.read_daily(spark, daily).orderBy("day").collect()] == [4, 5]


def test_reports_stand_after_a_replay(spark, tmp_path):
    land(tmp_path / "in", "a.csv", line("k1", "2024-01-01"), line("k1", "2024-01-02"), line("k2", "2024-01-01", "1.5"))
    options = {"reports": str(tmp_path / "reports")}
    run(spark, tmp_path, **options)
    for commit in (tmp_path / "progress" / "commits").glob("*0*"):
        commit.unlink()
    run(spark, tmp_path, **options)
    (row,) = spark.read.json(str(tmp_path / "reports" / "files")).collect()
    assert (row.rows_read, row.accepted_rows, row.repeated_in_file, row.rejected_rows) == (3, 1, 1, 1)
    (totals,) = spark.read.json(str(tmp_path / "reports" / "totals")).collect()
    assert totals.amount_count == 2 and float(totals.amount_sum) == 10.015


def test_batches_leave_no_scratch_tables(spark, tmp_path):
    before = set(os.listdir(workspace(spark))) if os.path.isdir(workspace(spark)) else set()
    for n in range(3):
        land(tmp_path / "in", f"f{n}.csv", line(f"k{n}", f"2024-01-0{n + 1}"))
    run(spark, tmp_path, daily=str(tmp_path / "daily"), files_per_batch=1)
    assert set(os.listdir(workspace(spark))) == before


def test_broken_files_are_noted_and_the_others_loaded(spark, tmp_path):
    land(tmp_path / "in", "a b%20c#.csv", line("k1", "2024-01-01"))
    (tmp_path / "in" / "bad.csv.gz").write_bytes(b"no gzip at all")
    whole = "\n".join((HEADER, *(line(f"g{n}", "2024-01-01", str(n * 7919 % 10007)) for n in range(20_000))))
    packed = gzip.compress(whole.encode())
    (tmp_path / "in" / "cut % off.csv.gz").write_bytes(packed[: len(packed) // 2])
    (tmp_path / "in" / "empty.csv").write_text("")
    (tmp_path / "in" / "good.csv.gz").write_bytes(gzip.compress(f"{HEADER}\n{line('k2', '2024-01-01')}\n".encode()))
    run(spark, tmp_path, rejects=str(tmp_path / "rejects"), pattern="*.csv*")
    assert keys(spark, tmp_path) == ["k1", "k2"]
    noted = {r.source_file.rpartition("/")[2]: r.reject_reason for r in spark.read.json(str(tmp_path / "rejects")).collect()}
    unread = "no header that can be read"
    assert noted.pop("empty.csv", unread) == unread
    assert noted == {"bad.csv.gz": unread, "cut % off.csv.gz": "cannot be read to its end"}


def test_headers_of_any_number_of_files_take_the_same_jobs(spark, tmp_path):
    context = spark.sparkContext
    jobs = {}
    for n in (40, 160):
        for i in range(n):
            land(tmp_path / str(n), f"{i}.csv", line(f"k{i}", "2024-01-01"), header=HEADER if i % 2 else HEADER + ",extra")
        paths = list_files(spark, str(tmp_path / str(n)))
        context.setJobGroup(f"headers-{n}", "")
        headers = read_headers(spark, paths)
        context.setLocalProperty("spark.jobGroup.id", None)
        jobs[n] = len(context.statusTracker().getJobIdsForGroup(f"headers-{n}"))
        assert len(headers) == n and {len(h) for h in headers.values()} == {9, 10}
    assert jobs[40] == jobs[160] <= 6
    assert read_headers(spark, []) == {}


def test_landed_files_grow_in_number_not_in_size():
    from workload.queries import files_for

    assert [files_for(n, 4) for n in (0, 10, 2_000_000, 216_000_000)] == [4, 4, 4, 432]


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllBlocks().mkString(",").split(",") if name.startswith("shuffle_")}


@pytest.mark.parametrize("step", ["intermediate", "folder", "export"])
def test_a_write_leaves_no_shuffle_files(spark, tmp_path, step):
    rows, there = spark.range(1000).repartition(4, "id"), shuffle_files(spark)
    if step == "intermediate":
        materialize(rows, "rows")
    elif step == "folder":
        write_folder(rows, str(tmp_path), "rows")
    else:
        db.export_csv(rows, str(tmp_path), "2024-01-02 03:04:05")
    assert not shuffle_files(spark) - there
    # The same rows may be asked for again.
    assert rows.count() == 1000


def test_landed_files_of_the_queries_are_compressed(spark, sf_dir):
    from workload.queries import LANDED, _land_in_order

    folder = _land_in_order(spark, sf_dir)
    assert len(list_files(spark, folder, LANDED)) == 4 and not list_files(spark, folder)


def test_compressed_exports_are_loaded_like_plain_ones(spark, tmp_path, make_tx):
    rows = make_tx({"merchant_name": 'a "b", c'}, {"amount": "5"}, {"mid": None}, {})
    for kind, options in (("none", {}), ("gzip", {"pattern": "*.csv.gz"})):
        db.export_csv(rows, str(tmp_path / kind / "in"), "2024-01-02 03:04:05", kind)
        run(spark, tmp_path / kind, **options)
    plain, packed = (db.read_transactions(spark, str(tmp_path / kind / "table")) for kind in ("none", "gzip"))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, packed.collect())) and plain.count() == 4
