import hashlib
import re

import pytest
from pyspark.sql import functions as F

from daybook.llm.stream_dedup import deduplicate

ROWS = [
    (4, "a  b"), (2, "a b"), (9, "a\n\tb"), (1, " a b"), (3, None), (7, ""), (5, "é b"), (6, "é b"),
    (None, "a b"), (None, "lone"), (2, "a b"), (8, "x" * 100_000), (10, "x" * 100_000),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    docs = spark.createDataFrame([(*r, "k") for r in ROWS], "doc_id long, text string, digest string")
    docs.repartition(4).write.parquet(path)
    return path


def expected():
    groups = {}
    for n, t in ROWS:
        key = re.sub("[\x20\x09-\x0d]+", " ", t or "")
        groups.setdefault(key, []).append(n)
    out = []
    for key, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        left = [i for i in ids]
        kept = [False] * len(left)
        kept[left.index(keep)] = True
        digest = hashlib.sha256(key.encode()).hexdigest()
        out += [(i or -1, keep or -1, len(ids), k, digest) for i, k in zip(left, kept)]
    return sorted(out)


def rows(df):
    return sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept, r.digest) for r in df.collect())


@pytest.mark.parametrize("files", [1, 1000])
def test_against_plain_grouping_in_one_batch_or_many(spark, folder, files):
    assert rows(deduplicate(spark, folder, files_per_batch=files)) == expected()


def test_full_bytes_tell_texts_of_one_digest_apart(spark, folder):
    weak = lambda text: F.concat(F.lit("d"), (F.length(text) % 2).cast("string"))
    found = rows(deduplicate(spark, folder, digest=weak))
    assert [r[:4] for r in found] == [r[:4] for r in expected()]


def test_state_goes_on_without_expiry(spark, tmp_path):
    path, table, state = (str(tmp_path / n) for n in ("docs", "table", "state"))
    write = lambda *r: spark.createDataFrame(list(r), "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    write((5, "a"), (6, "b"))
    first = deduplicate(spark, path, table=table, state_dir=state)
    assert [r[:4] for r in rows(first)] == [(5, 5, 1, True), (6, 6, 1, True)]
    write((1, "a"), (7, "b"))
    second = deduplicate(spark, path, table=table, state_dir=state)
    assert [r[:4] for r in rows(second)] == [(1, 1, 2, True), (5, 1, 2, False), (6, 6, 2, True), (7, 6, 2, False)]


def test_empty_table_and_single_file(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(path)
    assert deduplicate(spark, path).count() == 0


def test_no_python_in_the_plan(spark, folder):
    plan = deduplicate(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
