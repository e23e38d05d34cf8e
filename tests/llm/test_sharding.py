from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from daybook.llm.sharding import cut_share, ranked, shard


def check(out, n, shards):
    sizes = Counter(r.shard for r in out)
    assert len(out) == n and set(sizes) <= set(range(shards))
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, f"text {n}") for n in range(900)]
    rows += [(1000 + n, f"copy {n // 3}") for n in range(240)]
    rows += [(2000 + n, "giant") for n in range(600)]
    rows += [(None, None), (None, ""), (5000, None), (5001, "é" * 9), (5001, "é" * 9)]
    return spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, shard string").repartition(5)


def test_counts_slots_sizes_and_cut(docs):
    out = shard(docs, 10)
    rows = out.collect()
    check(rows, docs.count(), 10)
    sizes = {r.doc_id: r.size for r in rows}
    assert sizes[5001] == 9 * 2 + 16 and sizes[5000] == 16
    # The giant group needs four shards; small ones lie together.
    by_text = defaultdict(Counter)
    for r in rows:
        by_text[r.text_md5][r.shard] += 1
    small = [c for c in by_text.values() if 1 < sum(c.values()) < 100]
    together = sum(max(c.values()) for c in small) / sum(sum(c.values()) for c in small)
    assert together > 0.85
    giant = max(by_text.values(), key=lambda c: sum(c.values()))
    top = sum(n for _, n in giant.most_common(4)) / sum(giant.values())
    assert top > 0.8
    start = cut_share(shard(docs, 10, rounds=0)).first().apart
    assert cut_share(out).first().apart < start


def test_reruns_agree_whatever_the_partitions(docs):
    key = lambda d: sorted((r.doc_id or -1, r.text_crc32, r.shard, r.slot) for r in shard(d, 7).collect())
    assert key(docs) == key(docs.repartition(3, "text"))


def test_everything_linked_still_moves(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") / 2).cast("int").cast("string").alias("text"))
    out = shard(docs, 4)
    check(out.collect(), 400, 4)
    assert cut_share(out).first().apart < cut_share(shard(docs, 4, rounds=0)).first().apart / 2


def test_given_links_pull_documents_together(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    links = spark.createDataFrame([(2 * n, 2 * n + 1) for n in range(60)], "x long, y long")
    where = {r.doc_id: r.shard for r in shard(docs, 5, links=links).collect()}
    assert sum(where[2 * n] == where[2 * n + 1] for n in range(60)) > 45


def test_few_rows_and_none(docs, spark):
    assert shard(docs.limit(0), 40).count() == 0
    few = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    check(shard(few, 40).collect(), 3, 40)


def test_ranks_are_gapless_over_buckets(spark):
    rows = spark.range(1000).select(F.col("id").alias("row_id"), F.xxhash64("id").alias("order"), (F.col("id") % 3).alias("g"))
    for bucket in (7, 5000):
        found = ranked(rows, "g", bucket).groupBy("g").agg(F.sort_array(F.collect_list("rank")).alias("r"))
        assert all(r.r == list(range(len(r.r))) for r in found.collect())
        assert sorted(r["rank"] for r in ranked(rows, None, bucket).collect()) == list(range(1000))


def test_sizes_sums_and_cuts_written_down(spark):
    import zlib
    from collections import Counter, defaultdict

    texts = [None, "", "é" * 3, "same", "same", "same", "other", "other", *(f"t{n}" for n in range(60))]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    assigned = shard(docs, 7)
    rows = assigned.collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        n: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for n, t in enumerate(texts)
    }
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    assert max(map(len, places.values())) - min(map(len, places.values())) <= 1
    homes = defaultdict(Counter)
    for r in rows:
        homes[texts[r.doc_id] or ""][r.shard] += 1
    groups = [c for c in homes.values() if sum(c.values()) > 1]
    cut = cut_share(assigned).first()
    assert cut.linked == sum(sum(c.values()) for c in groups) == 7
    assert cut.apart == sum(sum(c.values()) - max(c.values()) for c in groups)
