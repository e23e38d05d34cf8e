"""No operator that gives back whole rows loses a column or trips over its name."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from daybook.llm.decontaminate import drop_contaminated
from daybook.llm.grading import grades_of, keep_good
from daybook.llm.mixing import mix, take
from daybook.llm.rows import unused
from daybook.llm.sharding import shard
from daybook.llm.simhash import keep_one_of_each
from daybook.llm.stream_dedup import deduplicate

NAMES = """__copy __copies __rows __id __md5 _copy _copies _rows _id _md5 __grade __tail _grade _tail __kept_id __kept_md5
    _kept_id _kept_md5 __bad_id __bad_md5 _bad_id _bad_md5 order row_id kept rank _b _n _in _before p bucket extra luck luck2
    key rate sure features text_md5 fp root n u v words hit_words items m window chosen row digest place keep rows batch""".split()


@pytest.fixture
def docs(spark):
    rows = [(n, f"word{n} some text number {n} that goes on for a while {n * 7}", "en", "abc"[n % 3], 9) for n in range(40)]
    rows += [(40, "benchmark passage " + " ".join(f"b{i}" for i in range(12)), "en", "a", 9), rows[1], (41, None, "en", None, None)]
    rows += [(42, rows[2][1], "en", "b", 9), (None, "", None, "a", 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in NAMES))


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(12)))], "item_id long, text string")


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_rows_come_back_whole(spark, docs, benchmark):
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(40)], "doc_id long, quality int, toxic int")
    ratings = grades_of(labels, F.col("quality"), F.col("toxic"))
    every = set(rows_of(docs))
    for kept in (keep_good(docs, ratings), keep_one_of_each(docs), drop_contaminated(docs, benchmark), take(docs)):
        assert kept.columns == docs.columns
        assert set(rows_of(kept)) <= every and kept.count()
    assert drop_contaminated(docs, benchmark).count() == docs.count() - 1
    assert take(docs).count() == mix(docs).where("size > 0").agg(F.sum("copies")).first()[0]


def test_shard_carries_columns_of_any_name(docs):
    keep = tuple(c for c in NAMES if c != "text_md5")
    out = shard(docs, 4, keep=keep)
    assert sorted((r.doc_id, r.row_id, r.order) for r in out.where("doc_id < 40").collect()) == sorted(
        (r.doc_id, r.row_id, r.order) for r in docs.where("doc_id < 40").collect()
    )


def test_pipeline_with_every_name_nulls_and_repeats(spark, docs, benchmark, tmp_path):
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = spark.createDataFrame([(n, 1, 0) for n in range(30)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    found = {r.doc_id for r in out}
    # Rows without words are in no mix, copies and contaminated ones are gone.
    assert found <= set(range(40)) and len(found) >= 20 and 40 not in found
    assert max(r.slot for r in out) - min(r.slot for r in out) <= len(out)
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    benchmark.write.parquet(f"{empty}/benchmark.parquet")
    labels.write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_stream_reads_odd_paths_and_columns(spark, docs, tmp_path):
    path = str(tmp_path / "a[b]{c} d" / "documents.parquet")
    docs.withColumn("_metadata", F.lit("mine")).repartition(3).write.parquet(path)
    out = deduplicate(spark, path)
    assert out.count() == docs.count() and out.where("group_size > 1 AND NOT kept").count() == 3


def test_unused_names():
    assert unused("a", ["b"]) == "a" and unused("_a", ["_A", "_a_"]) == "_a__"
