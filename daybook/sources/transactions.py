"""The stored transactions, with an index of their keys and their first dates.

Beside the rows the table has two kinds of folders: `keys`, the key of every row
with its month, dealt by a hash of the key, and `first`, the first dates per
mid of the rows they were noted with. One commit lists rows, keys and first
dates together, so they always tell of the same rows. Each append adds a folder
of each kind; folders of about one size are merged from time to time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.values import month_of
from daybook.operators.dedup import has_hot_key, known_keys, upsert_latest
from daybook.operators.layout import fixed_first
from daybook.operators.metrics import FIRST_DATES, first_dates, first_dates_of
from daybook.schemas import TRANSACTION_KEY, TRANSACTIONS
from daybook.sources.commits import Commit, commit, due, last_commit, scan, vacuum, write_folder
from daybook.sources.tables import NO_MONTH, ROWS, _months, _partitioned, _plain, _without, committed_rows
from daybook.workspace import materialize, scratch

KEYS, FIRST = "keys", "first"
# Keys in a bucket of the index, and buckets of a folder at most.
BUCKET_KEYS, MOST_BUCKETS = 500_000, 4096
# New keys sent to every task in one go, and how many goes are worth it.
SENT_KEYS, MOST_GOES = 500_000, 16
# Of an upsert: a new row, a stored one, the mark of a stored one that is replaced.
_ORIGIN, _NEW, _STORED, _REPLACED = "_origin", 0, 1, 2

_KEY_SCHEMA = T.StructType(
    [
        T.StructField(TRANSACTION_KEY, T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
_FIRST_SCHEMA = T.StructType(
    [
        T.StructField("mid", T.LongType()),
        *(T.StructField(name, T.TimestampNTZType()) for name in FIRST_DATES),
        T.StructField("batch", T.StringType()),
    ]
)


def _bucket(buckets: int) -> Column:
    """The bucket of a key; with twice the buckets each one is cut in two."""
    return F.pmod(F.xxhash64(TRANSACTION_KEY), F.lit(buckets)).cast("int")


def _write_rows(rows: DataFrame, path: str) -> tuple[str, dict]:
    """Rows by month and in time order inside it, as a folder not listed yet.

    The key ends the range order, so rows of one instant still spread over
    tasks and every file covers a narrow span of time. With `_ORIGIN`, stored
    rows that are marked as replaced are left out, see `_replacing`.
    """
    order = ("month", "transaction_date", TRANSACTION_KEY)
    marks = [c for c in rows.columns if c == _ORIGIN]
    month = month_of(F.col("transaction_date")).alias("month")
    laid_out = rows.select(*TRANSACTIONS.fieldNames(), month, *marks)
    laid_out = laid_out.select(*fixed_first(laid_out)).repartitionByRange(*order)
    if marks:
        # A mark meets its row in the task that the range order gives both.
        last = F.max(_ORIGIN).over(Window.partitionBy(*order))
        stays = (F.col(_ORIGIN) == _NEW) | ((F.col(_ORIGIN) == _STORED) & (F.col("_last") != _REPLACED))
        laid_out = laid_out.withColumn("_last", last).where(stays)
    laid_out = laid_out.select(*TRANSACTIONS.fieldNames(), "month")
    folder = write_folder(laid_out.sortWithinPartitions(*order), path, ROWS, ("month",))
    written = committed_rows(rows.sparkSession, path, Commit(0, {folder: {}}), _partitioned(TRANSACTIONS))
    counts = written.groupBy("month").count().collect()
    months = [r.month if r.month is not None else NO_MONTH for r in counts]
    return folder, {"rows": sum(r["count"] for r in counts), "months": sorted(months)}


def _write_keys(keys: DataFrame, path: str, n: int) -> tuple[str, dict]:
    """Keys with their months, in as many buckets as their number asks for."""
    buckets = 1
    while buckets < MOST_BUCKETS and n > buckets * BUCKET_KEYS:
        buckets *= 2
    dealt = keys.select(TRANSACTION_KEY, "month", _bucket(buckets).alias("bucket"))
    ordered = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", TRANSACTION_KEY)
    return write_folder(ordered, path, KEYS, ("bucket",)), {"rows": n, "buckets": buckets}


def _merged(spark: SparkSession, path: str, folders: dict[str, dict]) -> dict[str, dict]:
    """The folders after those that are due have been merged."""
    now = Commit(0, folders)
    out = dict(folders)
    for kind in (ROWS, KEYS, FIRST):
        old = due({f: known["rows"] for f, known in now.of(kind).items()})
        if not old:
            continue
        n = sum(folders[f]["rows"] for f in old)
        if kind == ROWS:
            folder, known = _write_rows(committed_rows(spark, path, now, _partitioned(TRANSACTIONS), old), path)
        elif kind == KEYS:
            folder, known = _write_keys(scan(spark, path, KEYS, old, _KEY_SCHEMA), path, n)
        else:
            folder, known = _write_first(first_dates_of(scan(spark, path, FIRST, old, _FIRST_SCHEMA)), path)
        for f in old:
            del out[f]
        out[folder] = known
    return out


def _write_first(first: DataFrame, path: str) -> tuple[str, dict]:
    folder = write_folder(first.select("mid", *FIRST_DATES), path, FIRST)
    return folder, {"rows": scan(first.sparkSession, path, FIRST, [folder], _FIRST_SCHEMA).count()}


def _added(spark: SparkSession, rows: DataFrame, path: str) -> dict[str, dict]:
    """New rows with their keys and first dates, as folders that are not listed yet."""
    folder, known = _write_rows(rows, path)
    if not known["rows"]:
        return {}
    written = committed_rows(spark, path, Commit(0, {folder: known}), _partitioned(TRANSACTIONS))
    keys, known_keys = _write_keys(written, path, known["rows"])
    first, known_first = _write_first(first_dates(written), path)
    return {folder: known, keys: known_keys, first: known_first}


def _adopted(spark: SparkSession, path: str) -> Commit | None:
    """The table's commit; a plain folder's rows are taken over first."""
    now = last_commit(spark, path)
    if now is None and (plain := _plain(spark, path, _partitioned(TRANSACTIONS))) is not None:
        now = commit(spark, path, None, _added(spark, plain, path), {})
    return now


def append_transactions(rows: DataFrame, path: str) -> None:
    """Append rows; keys, first dates and rows become visible together."""
    spark = rows.sparkSession
    now = _adopted(spark, path)
    added = _added(spark, rows, path)
    if now and now.of(ROWS) and not now.of(FIRST):
        # They are unknown since an upsert; those of the new rows alone would pass for all.
        added = {f: known for f, known in added.items() if not f.startswith(f"{FIRST}/")}
    if added:
        folders = _merged(spark, path, {**(now.folders if now else {}), **added})
        commit(spark, path, now, folders, {})
        vacuum(spark, path)


def _index_rows(spark: SparkSession, path: str, now: Commit, present: list[int], most: int) -> DataFrame:
    """The index at the buckets where new keys are; `present` are those of `most` buckets."""
    folders = now.of(KEYS)
    index = scan(spark, path, KEYS, folders, _KEY_SCHEMA)
    wanted = F.lit(False)
    for buckets in sorted({known["buckets"] for known in folders.values()}):
        members = [f.rpartition("=")[2] for f, known in folders.items() if known["buckets"] == buckets]
        here = sorted({b % buckets for b in present})
        wanted = wanted | (F.col("batch").isin(members) & F.col("bucket").isin(here))
    return index.where(wanted).select(TRANSACTION_KEY, "month")


def stored_keys(
    spark: SparkSession, path: str, new: DataFrame, sent_keys: int = SENT_KEYS, staged: bool = False
) -> DataFrame:
    """Those keys of the stored table that `new` carries, with the months of their rows.

    Only the buckets of the index that hold a new key are opened, and only
    their key column. The new keys go to the tasks that read them, some at a
    time if they are many, so the stored side is never shuffled; above
    `MOST_GOES` times `sent_keys` both sides are. The new keys are written
    first, unless `new` is `staged` and may be read more than once.
    """
    now = _adopted(spark, path)
    folders = now.of(KEYS) if now else {}
    if not folders:
        return spark.createDataFrame([], T.StructType(_KEY_SCHEMA.fields[:2]))
    keys = new.select(TRANSACTION_KEY).where(F.col(TRANSACTION_KEY).isNotNull())
    if not staged:
        keys = materialize(keys.distinct(), "new-keys")

    def once(some: DataFrame) -> DataFrame:
        return some.distinct() if staged else some

    most = max(known["buckets"] for known in folders.values())
    # At most one row for each bucket.
    found = {r.b: r["count"] for r in keys.groupBy(_bucket(most).alias("b")).count().collect()}
    if not found:
        return spark.createDataFrame([], T.StructType(_KEY_SCHEMA.fields[:2]))
    goes = -(-sum(found.values()) // sent_keys)
    if goes > min(MOST_GOES, most):
        return _index_rows(spark, path, now, list(found), most).join(once(keys), TRANSACTION_KEY, "left_semi")
    known = None
    for go in range(goes):
        present = [b for b in found if b % goes == go]
        if not present:
            continue
        some = keys.where(F.pmod(_bucket(most), F.lit(goes)) == go) if goes > 1 else keys
        part = _index_rows(spark, path, now, present, most).join(F.broadcast(once(some)), TRANSACTION_KEY, "left_semi")
        known = part if known is None else known.unionByName(part)
    return known


def read_first_dates(spark: SparkSession, path: str) -> DataFrame | None:
    """First dates per mid over all stored transactions; None without any.

    They are noted with every append. Where an upsert has made them unknown,
    they are taken from the rows once more and noted again.
    """
    now = _adopted(spark, path)
    if now is None or not now.of(ROWS):
        return None
    if not now.of(FIRST):
        rows = committed_rows(spark, path, now, _partitioned(TRANSACTIONS))
        folder, known = _write_first(first_dates(rows), path)
        now = commit(spark, path, now, {**now.folders, folder: known}, now.facts)
    return first_dates_of(scan(spark, path, FIRST, now.of(FIRST), _FIRST_SCHEMA))


def _replacing(staged: DataFrame, stored: DataFrame, version: str) -> DataFrame:
    """New rows that win over the stored ones of their key, and marks of the stored rows they replace.

    Of the stored rows only key, version and date are shuffled; a mark has no
    more. `_known_month` is the month of the key's stored row, `_repeats` tells
    that a key has more than one, which marks cannot tell apart.
    """
    names = TRANSACTIONS.fieldNames()
    own = (TRANSACTION_KEY, version, "transaction_date")
    slim = [F.col(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in TRANSACTIONS]
    tagged = staged.withColumn(_ORIGIN, F.lit(_NEW)).unionByName(stored.select(*slim).withColumn(_ORIGIN, F.lit(_REPLACED)))
    of_key = Window.partitionBy(TRANSACTION_KEY)
    rest = [c for c in names if c not in (TRANSACTION_KEY, version)]
    is_stored = F.col(_ORIGIN) == _REPLACED
    found = {
        "_nth": F.row_number().over(of_key.orderBy(*(F.desc(c) for c in (version, _ORIGIN, *rest)))),
        "_repeats": F.count(F.when(is_stored, 1)).over(of_key) > 1,
        "_known_month": F.min(F.when(is_stored, month_of(F.col("transaction_date")))).over(of_key),
    }
    decided = tagged.select(*fixed_first(tagged)).repartition(TRANSACTION_KEY).withColumns(found)
    return decided.where((F.col("_nth") == 1) != is_stored).drop("_nth")


def upsert_transactions(new: DataFrame, path: str, version: str = "updated_at") -> list[str]:
    """Store new rows, each in place of an older one of its key; see `upsert_latest`.

    The index tells the months in which stored versions of the new keys lie.
    Only those are read and written anew, all others keep their files. Returns
    the months written anew.
    """
    spark = new.sparkSession
    names = TRANSACTIONS.fieldNames()
    with scratch(spark):
        now = _adopted(spark, path)
        staged = materialize(new.select(*names).where(F.col(TRANSACTION_KEY).isNotNull()), "upsert")
        known = materialize(stored_keys(spark, path, staged, staged=True), "known-keys")
        # At most as many as the table has months.
        touched = [r.month if r.month is not None else NO_MONTH for r in known.select("month").distinct().collect()]
        if not touched:
            append_transactions(upsert_latest(staged, staged.limit(0), TRANSACTION_KEY, version), path)
            return []
        stored = committed_rows(spark, path, now, _partitioned(TRANSACTIONS)).where(_months(touched)).select(*names)
        stored = stored.where(F.col(TRANSACTION_KEY).isNotNull())
        at = month_of(F.col("transaction_date"))
        both = stored.select(TRANSACTION_KEY).unionByName(staged.select(TRANSACTION_KEY))
        decided = None if has_hot_key(both, TRANSACTION_KEY) else materialize(_replacing(staged, stored, version), "decided")
        if decided is None or not decided.where("_repeats").isEmpty():
            # Whole rows are compared, with one candidate per key and task.
            result = materialize(upsert_latest(staged, stored, TRANSACTION_KEY, version), "upserted")
            own = result.join(staged.select(TRANSACTION_KEY).distinct(), TRANSACTION_KEY, "left_semi")
        else:
            result = stored.withColumn(_ORIGIN, F.lit(_STORED)).unionByName(decided.select(*names, _ORIGIN))
            own = decided.where((F.col(_ORIGIN) == _NEW) & ~at.eqNullSafe(F.col("_known_month")))
        folder, rows = _write_rows(result, path)
        # The index has all keys of the rows that stay; only moved and new ones are added.
        own = own.select(TRANSACTION_KEY, at.alias("month"))
        there = known.select(F.col(TRANSACTION_KEY).alias("key"), F.col("month").alias("stored"))
        same = (F.col(TRANSACTION_KEY) == F.col("key")) & F.col("month").eqNullSafe(F.col("stored"))
        moved = materialize(own.join(there, same, "left_anti"), "moved-keys")
        keys, index = _write_keys(moved, path, moved.count())
        # First dates may have gone with an older version: none are listed.
        kept = {**_without(now.of(ROWS), set(touched)), **now.of(KEYS)}
        commit(spark, path, now, _merged(spark, path, {**kept, folder: rows, keys: index}), {})
        vacuum(spark, path)
    return sorted(touched)
