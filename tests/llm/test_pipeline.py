import importlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm.decontaminate import find_contamination
from daybook.llm.mixing import mix
from daybook.llm.simhash import find_near_duplicates


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    """Documents before and after each stage, written and read between them."""
    folder = str(tmp_path_factory.mktemp("stages"))
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{n}")
        out.append(spark.read.parquet(f"{folder}/{n}"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_stage_return_the_columns_of_documents(steps):
    assert all(df.dtypes == steps[0].dtypes for df in steps[1:-1])


def test_each_stage_does_what_its_operator_decides(spark, sf_dir, steps):
    docs, good, single, clean, mixed, sharded = steps
    assert set(ids(good)) < set(ids(docs))
    near = find_near_duplicates(good)
    assert ids(single) == sorted({r.component_id for r in near.collect()})
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(single, bench).collect()
    assert ids(clean) == sorted(r.doc_id for r in found if not r.hit_words)
    copies = mix(clean).where("size > 0").collect()
    assert ids(mixed) == sorted(r.doc_id for r in copies for _ in range(r.copies))
    assert ids(sharded) == ids(mixed)
    sizes = [r["count"] for r in sharded.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == mixed.count()


def test_run_gives_the_rows_of_the_last_stage(spark, sf_dir, steps):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == steps[-1].columns
    assert abs(out.count() - steps[-1].count()) == 0
    assert out.agg(F.count_distinct("shard", "slot")).first()[0] == steps[-1].count()


def test_registered(spark):
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n[2:3].isdigit()} == {f"op{k}" for k in range(1, 11)}
