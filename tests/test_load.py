"""Rules of landing, cleaning, rejecting and loading."""

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import daybook as db
from daybook.operators.dedup import has_hot_key
from daybook.schemas import MERCHANTS, TRANSACTIONS
from daybook.sources.extract import FAILURE
from daybook.functions.values import has_fraction, to_whole
from daybook.sources.files import list_files, read_csv_files
from daybook.workspace import fresh_path, materialize

HEADER = "transaction_uuid,mid,amount,refunded_amount,transaction_type,transaction_date"


def raw(spark, *rows):
    """Landed rows from dicts; what is not given is plain."""
    base = {"transaction_uuid": "u", "mid": "1", "amount": "100", "refunded_amount": "0",
            "merchant_account_id": "9", "transaction_date": "2024-01-01 00:00:00"}
    names = TRANSACTIONS.fieldNames()
    values = [
        (*({**base, **r}.get(n) for n in names), r.get("file", "f1"), 0, i) for i, r in enumerate(rows)
    ]
    ddl = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(values, f"{ddl}, source_file string, source_block long, source_row long")


def cleaned(spark, compat=False, **values):
    return db.clean_transactions(raw(spark, values), compat).first()


def none_stored(spark):
    return spark.createDataFrame([], TRANSACTIONS)


def test_ids(spark):
    texts = ["", "abc", None, "nan", "NONE", "12.0", " 12 ", "1e3"]
    rows = raw(spark, *({"mid": t} for t in texts))

    def mids(compat):
        cleaned_rows = db.clean_transactions(rows, compat).orderBy("source_row").collect()
        return [r.mid for r in cleaned_rows]

    assert mids(False) == [None] * 5 + [12, 12, 1000]
    assert mids(True) == [0] * 5 + [12, 12, 1000]


def test_card_fields_stay_text(spark):
    assert cleaned(spark, source_first6="004321").source_first6 == "004321"
    assert cleaned(spark, compat=True, source_first6="004321").source_first6 == "4321"
    assert cleaned(spark, compat=True, payment_method_details="Visa").payment_method_details == "0"


def test_money(spark):
    assert cleaned(spark, amount="ten").amount == Decimal("0.00")
    assert cleaned(spark, amount=None).amount == Decimal("0.00")
    assert cleaned(spark, amount="-50").amount == Decimal("-50.00")
    row = cleaned(spark, amount="7.00")
    assert row.amount == Decimal("7.00") and row.reject_reason is None


REASONS = [
    ({"transaction_uuid": None}, "transaction_uuid: missing"),
    ({"transaction_uuid": "NULL"}, "transaction_uuid: missing"),
    ({"transaction_uuid": "x" * 51}, "transaction_uuid: longer than 50"),
    ({"amount": "10.5"}, "amount: fraction of a cent"),
    ({"amount": "1" + "0" * 17}, "amount: out of range"),
    ({"amount": "1e60"}, "amount: out of range"),
    ({"refunded_amount": "inf"}, "refunded_amount: out of range"),
    ({"mid": "12.5"}, "mid: not whole"),
    ({"mid": "9" * 19}, "mid: out of range"),
    ({"merchant_account_id": "2147483648"}, "merchant_account_id: out of range"),
    ({"transaction_date": "soon"}, "transaction_date: not a date"),
    ({"currency": "x" * 11}, "currency: longer than 10"),
    ({"updated_at": "2024-02-30 00:00:00"}, "updated_at: not a date"),
]


def test_reject_reasons(spark):
    rows = raw(spark, *(values for values, _ in REASONS))
    found = db.clean_transactions(rows).orderBy("source_row").collect()
    assert [r.reject_reason for r in found] == [reason for _, reason in REASONS]


def test_first_row_in_file_counts_even_if_rejected(spark):
    rows = raw(
        spark,
        {"transaction_uuid": "a", "amount": "1"},
        {"transaction_uuid": "a", "amount": "2"},
        {"transaction_uuid": "b", "amount": "1.5"},
        {"transaction_uuid": "b", "amount": "3"},
        {"transaction_uuid": "b", "amount": "4", "file": "f2"},
        {"transaction_uuid": "a", "amount": "5", "file": "f2"},
    )
    result = db.load_transactions(rows, none_stored(spark))
    kept = {(r.transaction_uuid, int(r.amount)) for r in result.to_append.collect()}
    assert kept == {("a", 1), ("b", 4)}
    assert [r.transaction_uuid for r in result.ignored.collect()] == ["a"]
    assert [r.reject_reason for r in result.rejected.collect()] == ["amount: fraction of a cent"]


def test_every_row_is_accounted_for(spark, sf_dir):
    from workload import fixtures as fx

    result = db.load_transactions(fx.landed(spark, sf_dir), none_stored(spark))
    gap = result.report.where(
        "rows_read <> accepted_rows + duplicates_rows + repeated_in_file + rejected_rows"
    )
    assert gap.isEmpty()
    total = result.report.agg(F.sum("rows_read")).first()[0]
    assert total == fx.landed(spark, sf_dir).count()


def test_stored_key_wins_over_newer_version(spark, make_tx):
    stored = make_tx({"transaction_uuid": "a", "updated_at": "2024-01-01 00:00:00"})
    rows = raw(spark, {"transaction_uuid": "a", "updated_at": "2025-01-01 00:00:00"}, {"transaction_uuid": "z"})
    result = db.load_transactions(rows, stored)
    assert [r.transaction_uuid for r in result.to_append.collect()] == ["z"]
    assert [r.transaction_uuid for r in result.ignored.collect()] == ["a"]


def test_whole_rows_are_dealt_once(spark):
    from daybook.operators.dedup import known_keys
    from daybook.plans.load import _decided

    cleaned = materialize(db.clean_transactions(raw(spark, {"transaction_uuid": "a"}, {"transaction_uuid": None})), "cleaned")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = known_keys(cleaned, none_stored(spark), "transaction_uuid")
        text = _decided(cleaned, known, False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # What moves whole rows is the one that deals them by key; no task sorts them before.
    assert "SortAggregate" not in text
    left = text.split("SortMergeJoin", 1)[1].split("HashAggregate", 1)[0]
    assert left.count("Exchange hashpartitioning") - left.count("ENSURE_REQUIREMENTS") == 1
    assert "WindowGroupLimit" not in text and text.count("REPARTITION_BY_COL") == 1


def test_hot_and_plain_loads_decide_alike(spark, make_tx):
    rows = raw(
        spark,
        *({"transaction_uuid": k, "file": f, "amount": a}
          for f in ("f2", "f1", "f3") for k, a in (("a", "1"), ("a", "2"), ("b", "1.5"), ("b", "3"), ("s", "7"), (None, "1"), (f, "4"))),
    )
    stored = make_tx({"transaction_uuid": "s"}, {"transaction_uuid": "s"}, {"transaction_uuid": "other"})
    seen = []
    for hot_rows in (0, 1_000_000):
        result = db.load_transactions(rows, stored, hot_rows=hot_rows)
        parts = (result.to_append, result.ignored, result.rejected, result.totals, result.report)
        seen.append([(sorted(p.columns), sorted(map(str, p.select(*sorted(p.columns)).collect()))) for p in parts])
    assert seen[0] == seen[1]
    assert [len(p[1]) for p in seen[1]] == [4, 5, 6, 3, 3]


def test_rows_without_key_are_all_rejected(spark):
    rows = raw(spark, *({"transaction_uuid": None} for _ in range(5)))
    result = db.load_transactions(rows, none_stored(spark))
    assert result.rejected.count() == 5 and result.to_append.count() == 0


def test_hot_key_leaves_one_candidate_per_task(spark):
    """Rows of a key are combined before the shuffle, not gathered by it."""
    rows = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS k", "id AS at"
    )
    first = db.dedup_first(rows, ["k"], ["at"], "copies")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") and plan.index("partial_min") > plan.index("Exchange")
    hot = first.where("k = 'hot'").first()
    assert (hot["at"], hot["copies"], first.count()) == (0, 3000, 6001)


def test_without_a_hot_key_rows_are_sorted_after_the_shuffle_only(spark):
    rows = spark.range(600).selectExpr(
        "CASE WHEN id % 7 > 0 THEN cast(id % 50 AS string) END AS k", "cast(id % 3 AS int) AS at", "id % 11 AS x", "id AS y"
    )
    rows = rows.unionByName(rows.where("y < 90"))
    slow, fast = (db.dedup_first(rows, ["k"], ["at", "x", "y"], "copies", hot=hot) for hot in (True, False))
    text = fast._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Exchange") :]
    assert text.count("Exchange") == 1 and "Sort" not in below and "partial" not in below
    assert fast.columns == slow.columns and sorted(map(repr, fast.collect())) == sorted(map(repr, slow.collect()))
    assert has_hot_key(rows.selectExpr("'a' AS k"), "k", 600) and not has_hot_key(rows, "k", 600)
    assert not has_hot_key(rows.selectExpr("cast(NULL AS string) AS k"), "k", 1)
    assert not has_hot_key(rows.limit(0), "k", 0)


def test_control_totals_ignore_status_and_count_untyped_as_not_void(spark):
    rows = raw(
        spark,
        {"transaction_type": "void", "amount": "100"},
        {"transaction_type": None, "amount": "50", "refunded_amount": "20"},
        {"transaction_type": "charge", "amount": "-10"},
    )
    t = db.control_totals(rows).first()
    assert (t.void_sum, t.voidcount) == (Decimal("1.000000"), 1)
    assert (t.amount_sum, t.amount_count) == (Decimal("0.400000"), 1)
    assert (t.refund_sum, t.refund_count) == (Decimal("0.200000"), 1)


def test_money_problems(spark, rows_of):
    rows = raw(
        spark, {"transaction_uuid": "a", "amount": ""}, {"transaction_uuid": "b", "amount": "x"},
        {"transaction_uuid": "c", "amount": "1.234"}, {"transaction_uuid": "d", "amount": "1.23"},
    )
    assert rows_of(db.money_problems(rows), "transaction_uuid", "problem") == [
        ("a", "missing"), ("b", "not a number"), ("c", "too many decimals"),
    ]


def test_profile(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "n int, t string")
    entry = db.profile(rows, ["n"]).where("column_name = 't'").first()
    assert entry.asDict() == {
        "column_name": "t", "data_type": "string", "filled_rows": 3, "empty_rows": 1, "samples": "a | NULL | c",
    }


# --- files ------------------------------------------------------------------


def land(folder: Path, name: str, *lines: str) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder / name)


def test_columns_are_matched_by_name_per_file(spark, tmp_path):
    land(tmp_path, "a.csv", HEADER, "k1,1,100,0,charge,2024-01-01 00:00:00")
    land(tmp_path, "b.csv", "amount,extra,refunded_amount,transaction_uuid", "200,x,0,k2")
    rows = {r.transaction_uuid: r for r in db.read_transactions_csv(spark, str(tmp_path)).collect()}
    assert (rows["k1"].amount, rows["k2"].amount, rows["k2"].mid) == ("100", "200", None)


@pytest.mark.parametrize("copies", [1, 12])
def test_odd_headers_are_read_alike_for_few_and_many_files(spark, tmp_path, copies):
    data = "k1,1,100,0,charge,2024-01-01 00:00:00"
    for n in range(copies):
        land(tmp_path, f"{n}-blank.csv", "", HEADER, data)
        land(tmp_path, f"{n} name.csv", HEADER, data)
        land(tmp_path, f"{n}-twice.csv", HEADER + ",x,x", data + ",a,b")
        land(tmp_path, f"{n}-amounts.csv", "transaction_uuid,amount,amount,refunded_amount", "k1,1,2,3")
        (tmp_path / f"{n}-empty.csv").write_text("")
    paths = list_files(spark, str(tmp_path))
    # A file without a byte has nothing to load and is not listed.
    assert len(paths) == 4 * copies
    rows, skipped = read_csv_files(spark, paths, TRANSACTIONS, ("transaction_uuid", "amount", "refunded_amount"))
    assert sorted({r.amount for r in rows.collect()}) == ["100"] and rows.count() == 3 * copies
    assert sorted(s.path.rsplit("-", 1)[1] for s in skipped) == ["amounts.csv"] * copies


def test_file_without_required_column_is_skipped(spark, tmp_path):
    good = land(tmp_path, "a.csv", HEADER, "k1,1,100,0,charge,2024-01-01 00:00:00")
    bad = land(tmp_path, "b.csv", "mid,amount,refunded_amount", "1,2,3")
    rows, skipped = read_csv_files(spark, [good, bad], TRANSACTIONS, ("transaction_uuid", "amount"))
    assert rows.count() == 1
    assert [(s.path, s.reason) for s in skipped] == [(bad, "no column transaction_uuid")]


def test_rows_keep_the_order_of_their_file(spark, tmp_path):
    lines = [f"dup,1,{n},0,charge,2024-01-01 00:00:00" for n in range(1, 4000)]
    land(tmp_path, "a.csv", HEADER, "dup,1,777,0,charge,2024-01-01 00:00:00", *lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = db.read_transactions_csv(spark, str(tmp_path))
        result = db.load_transactions(rows, none_stored(spark))
        assert [int(r.amount) for r in result.to_append.collect()] == [777]
        assert result.report.first().repeated_in_file == 3999
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_malformed_line_is_rejected_whole(spark, tmp_path):
    land(tmp_path, "a.csv", HEADER, "k1,1,100,0,charge,2024-01-01 00:00:00,x,y", "k2,1,5,0,void,2024-01-01 00:00:00")
    result = db.load_transactions(db.read_transactions_csv(spark, str(tmp_path)), none_stored(spark))
    assert [r.reject_reason for r in result.rejected.collect()] == ["line: wrong number of fields"]
    assert [r.transaction_uuid for r in result.to_append.collect()] == ["k2"]


def test_empty_folder(spark, tmp_path):
    assert db.read_transactions_csv(spark, str(tmp_path)).count() == 0


def test_quotes_and_line_breaks_survive_export(spark, tmp_path):
    rows = spark.createDataFrame([('a "b", c', "x\ny", None, "")], "p string, q string, r string, s string")
    path = db.export_csv(rows, str(tmp_path / "out"), "2024-01-02 03:04:05")
    assert path.endswith("run=20240102_030405")
    back = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path).first()
    assert tuple(back)[:3] == ('a "b", c', "x\ny", None)


# --- extract and control ----------------------------------------------------


def test_window_bounds(make_tx, rows_of):
    tx = make_tx(
        {"updated_at": "2024-01-01 00:00:00"}, {"updated_at": "2024-01-01 00:00:01"},
        {"updated_at": "2024-01-02 00:00:00"}, {"updated_at": "2024-01-02 00:00:01"},
        {"updated_at": None}, {"merchant_account_id": 8, "updated_at": "2024-01-01 12:00:00"},
    )
    taken = db.extract_window(tx, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert rows_of(taken, "transaction_uuid") == [("u1",), ("u2",)]
    assert db.extract_window(tx, None, "2024-01-02 00:00:00").count() == 3


def test_marker_moves_only_on_success(spark):
    path = fresh_path(spark, "control")
    assert db.read_control(spark, path) is None
    db.write_control(spark, path, "2024-01-01 00:00:00")
    db.write_control(spark, path, "2024-01-02 00:00:00", FAILURE)
    assert db.read_control(spark, path) == "2024-01-01 00:00:00"


def test_failed_extract_is_taken_again(spark, make_tx):
    control, folder = fresh_path(spark, "control"), fresh_path(spark, "landing")
    broken = make_tx({}).withColumn("mid", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        db.export_transactions(spark, broken, control, folder, "2024-02-01 00:00:00")
    assert db.read_control(spark, control) is None
    db.export_transactions(spark, make_tx({}), control, folder, "2024-02-02 00:00:00")
    assert db.read_control(spark, control) == "2024-02-02 00:00:00"
    assert db.read_transactions_csv(spark, folder).count() == 1


# --- merchants --------------------------------------------------------------

MERCHANT_HEADER = "MerchantAccountDatabaseID,MerchantAccountName,MerchantAccountCreated"


def test_newest_merchant_file_wins(spark, tmp_path):
    land(tmp_path / "in", "M_20240101_000000.csv", MERCHANT_HEADER, "1,old,")
    land(tmp_path / "in", "M_20240301_000000.csv", MERCHANT_HEADER, '2,"new\nname",2024-01-01 10:00:00', "3.0,x,soon")
    table = str(tmp_path / "table")
    assert db.load_merchants(spark, str(tmp_path / "in"), table) == 2
    rows = db.read_merchants(spark, table).orderBy("MerchantAccountDatabaseID").collect()
    assert [r.MerchantAccountDatabaseID for r in rows] == [2, 3]
    assert rows[0].MerchantAccountName == "new\nname"
    assert [r.MerchantAccountCreated for r in rows] == [datetime(2024, 1, 1, 10), None]


@pytest.mark.parametrize("lines", [("1,a,", "1,b,"), (",a,",), ("1.5,a,",)])
def test_bad_merchant_file_leaves_the_table(spark, tmp_path, lines):
    table = str(tmp_path / "table")
    land(tmp_path / "in", "M_1.csv", MERCHANT_HEADER, "7,kept,")
    db.load_merchants(spark, str(tmp_path / "in"), table)
    land(tmp_path / "in", "M_2.csv", MERCHANT_HEADER, *lines)
    with pytest.raises(db.ConstraintError):
        db.load_merchants(spark, str(tmp_path / "in"), table)
    assert [r.MerchantAccountDatabaseID for r in db.read_merchants(spark, table).collect()] == [7]


def test_empty_folder_leaves_the_merchants(spark, tmp_path):
    table, folder = str(tmp_path / "table"), str(tmp_path / "in")
    land(tmp_path / "in", "M_20240101_000000.csv", MERCHANT_HEADER, "7,kept,")
    assert db.load_merchants(spark, folder, table, archive_dir=str(tmp_path / "done")) == 1
    assert [p.name for p in (tmp_path / "done").iterdir() if p.suffix == ".csv"] == ["M_20240101_000000.csv"]
    assert db.load_merchants(spark, folder, table) == 0
    assert [r.MerchantAccountDatabaseID for r in db.read_merchants(spark, table).collect()] == [7]


def test_newest_is_told_by_stamp_and_only_whole_runs_count(spark, tmp_path):
    table, folder = str(tmp_path / "table"), str(tmp_path / "in")
    ids = lambda: [r.MerchantAccountDatabaseID for r in db.read_merchants(spark, table).collect()]
    land(tmp_path / "in", "Zzz_20240101_000000.csv", MERCHANT_HEADER, "1,old,")
    land(tmp_path / "in" / "run=20250101_000000", "part-0.csv", MERCHANT_HEADER, "2,new,")
    db.load_merchants(spark, folder, table)
    assert ids() == [1]
    (tmp_path / "in" / "run=20250101_000000" / "_SUCCESS").write_text("")
    db.load_merchants(spark, folder, table)
    assert ids() == [2]


def test_failed_write_leaves_the_whole_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    db.replace_table(spark.range(5), path)
    broken = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        db.replace_table(broken, path)
    assert db.read_table(spark, path).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["table"]
    db.replace_table(spark.range(3), path)
    assert db.read_table(spark, path).count() == 3


def test_upsert_keeps_the_newest_version(spark):
    schema = "k string, v long, x string"
    stored = spark.createDataFrame([("a", 5, "old"), ("b", 5, "old"), ("c", None, "old")], schema)
    new = spark.createDataFrame([("a", 6, "new"), ("b", 5, "new"), ("c", 1, "new"), ("d", 1, "p"), ("d", 1, "q"), (None, 9, "z")], schema)
    out = {r.k: (r.v, r.x) for r in db.upsert_latest(new, stored, "k", "v").collect()}
    assert out == {"a": (6, "new"), "b": (5, "old"), "c": (1, "new"), "d": (1, "q")}


@pytest.mark.parametrize("text, whole", [("1.0000001", False), ("1e-7", False), ("1.000", True), ("12e1", True), ("1.5e1", True), (".", None), ("7", True)])
def test_fractions_of_any_size_are_seen(spark, text, whole):
    row = spark.createDataFrame([(text,)], "c string").select(has_fraction(F.col("c")).alias("f"), to_whole(F.col("c")).alias("w")).first()
    assert row.f == (whole is False)
    assert (row.w is not None) == (whole is True)


def test_merchant_filters(spark):
    names = ["test", "TEST co", "Contest", "Team Co", "Co Team", "co team", None, "Plain"]
    columns = "address_line1 string, address_city string, address_state string, address_postal_code string"
    groups = spark.createDataFrame(
        [(i, i, n, "ACTIVE", None, None, None, None) for i, n in enumerate(names)],
        f"id long, merchant_group_id long, name string, status string, {columns}",
    )
    accounts = spark.createDataFrame(
        [(i, i, 1 if i != 7 else None, "A", "Active") for i in range(len(names))]
        + [(99, 3, 1, "B", "active"), (98, 7, 1, "C", "closed")],
        "id long, merchant_id long, location_contact_user_id long, name string, status string",
    ).selectExpr(
        "*", "'g' AS gateway_id", "'u' AS uuid", "1L AS mid", "'m' AS gateway_merchant_id", "2L AS fiserv_sales_id",
        "'l' AS address_line1", "'c' AS address_city", "'s' AS address_state", "'p' AS address_postal_code",
        "timestamp_ntz'2024-01-01 00:00:00' AS created_at",
    )
    users = spark.createDataFrame([(1, "e", "f", "l")], "id long, email string, first_name string, last_name string")
    listed = db.merchant_export(accounts, groups, users)
    assert [f.name for f in listed.schema] == MERCHANTS.fieldNames()
    assert [r.MerchantAccountDatabaseID for r in listed.collect()] == [3, 99]


def test_append_is_partitioned_and_readable(spark, make_tx, tmp_path):
    path = str(tmp_path / "tx")
    assert db.read_transactions(spark, path).count() == 0
    db.append_transactions(make_tx({"transaction_date": "2024-03-04 00:00:00"}, {"transaction_date": None}), path)
    db.append_transactions(make_tx({"transaction_date": "2024-04-04 00:00:00"}), path)
    months = {r.month for r in db.read_transactions(spark, path).select("month").collect()}
    assert months == {"2024-03", "2024-04", None}
    stored = materialize(db.read_transactions(spark, path), "copy")
    assert stored.count() == 3
