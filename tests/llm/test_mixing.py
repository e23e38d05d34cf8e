from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from daybook.llm.mixing import mix, source_targets, take


def plain_targets(sizes, weights=(5, 2, 1), most=3.0):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        got = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if got[s] > most * sizes[s]]
        if not over:
            return {**fixed, **got}
        fixed |= {s: most * sizes[s] for s in over}


@pytest.fixture(scope="module")
def docs(spark):
    sizes = {"a": 40, "b": 900, "c": 3000, "é": 7, "zz": 200, None: 500}
    rows, n = [], 0
    for source, count in sizes.items():
        for k in range(count):
            rows.append((n, " ".join(["w"] * (1 + (k * 7919) % 60)), source, n))
            n += 1
    rows += [(n, None, "a", 0), (n + 1, "", "c", 0), (None, "x y", "b", 0), (n + 2, "same", "b", 1), (n + 2, "same", "b", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(6)


@pytest.mark.parametrize("bucket_rows", [25, 2000])
def test_each_source_meets_its_target(docs, bucket_rows):
    out = mix(docs, bucket_rows=bucket_rows).collect()
    assert len(out) == docs.count()
    words, taken, largest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in out:
        words[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        target[r.source] = r.target
        assert r.taken == r.copies * r.size <= 3 * r.size
        rate = r.target / r.source_size
        assert int(rate) <= r.copies <= int(rate) + 1
    assert all(words[r.source] == r.source_size for r in out)
    expected = plain_targets(words)
    for s in words:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6


def test_reruns_agree_whatever_the_partitions(docs):
    rows = lambda d: sorted((r.doc_id or -1, r.taken) for r in mix(d).collect())
    assert rows(docs) == rows(docs.repartition(3, "text"))


def test_chances_are_fair_on_average(spark):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"), F.lit("a").alias("source"))
    total = defaultdict(int)
    for seed in range(12):
        for r in mix(docs, seed=seed, share=0.4).collect():
            total[r.doc_id] += r.copies
    mean = sum(total.values()) / 12 / 60
    assert mean == pytest.approx(0.4, abs=0.06)


def test_bounds_hold_when_all_sources_are_small(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 10), (None, 1000)], "source string, source_size long")
    found = {r.source: r.target for r in source_targets(sizes).collect()}
    assert found == pytest.approx(plain_targets({"a": 10, "b": 10, None: 1000}))


def test_take_gives_rows_as_often_as_counted(docs):
    mixed = mix(docs)
    taken = take(docs)
    assert taken.columns == docs.columns
    want = {r.doc_id: r.n for r in mixed.where("size > 0").groupBy("doc_id").agg(F.sum("copies").alias("n")).where("n > 0").collect()}
    got = {r.doc_id: r.n for r in taken.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_empty_table(docs):
    assert mix(docs.limit(0)).count() == 0
    assert take(docs.limit(0)).count() == 0
    assert mix(docs.limit(3).withColumn("text", F.lit(None).cast("string"))).agg(F.sum("taken")).first()[0] == 0
