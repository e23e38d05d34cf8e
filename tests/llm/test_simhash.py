import random

import numpy as np
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.components import components
from daybook.llm.simhash import find_near_duplicates, fingerprint, keep_one_of_each, links
from daybook.workspace import materialize

FP = T.StructType([T.StructField("fp", T.LongType())])


def plain_fingerprint(text, k=3):
    words = text.encode().lower().split()
    runs = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_by_the_definition(monkeypatch):
    texts = ["", " \t", "One", "a b", "A b c d e f g", "é x y\x0bz", "x y z " * 50]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr("daybook.llm.simhash._AT_ONCE", 7)
    assert fingerprint(texts[-1]) == plain_fingerprint(texts[-1])


def near_numbers(rng, n):
    """Numbers around a few centres, so that many differ by up to four bits."""
    out = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        while len(out) % n < n - 1:
            x = centre
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(int(np.uint64(x).view(np.int64)) for x in out)


def test_links_are_those_of_all_pairs_paired_or_refined(spark):
    rng = random.Random(5)
    numbers = near_numbers(rng, 90)
    frame = spark.createDataFrame([(x,) for x in numbers], FP)
    bits = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1")
    for max_bits in (1, 2, 3):
        true = {(a, b) for a in numbers for b in numbers if a < b and bits(a, b) <= max_bits}
        paired = {tuple(r) for r in links(frame, max_bits, 1 << 30).collect()}
        assert paired == true
        if max_bits < 3:
            refined = {tuple(r) for r in links(frame, max_bits, 4).collect()}
            assert refined <= true
            assert roots(refined, numbers) == roots(true, numbers)


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 140)] + [(7, 7), (200, 199), (199, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == roots(pairs, {n for p in pairs for n in p})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def documents(spark):
    base = [f"w{n}" for n in range(400)]
    other = [f"v{n}" for n in range(400)]
    changed = base[:399] + ["zz"]
    rows = [
        (5, " ".join(base), "x"), (3, " ".join(base), "y"), (9, " ".join(changed), "z"), (4, " ".join(other), "q"),
        (None, None, "n"), (8, "", "e"), (7, " \n", "e"), (None, " ".join(other), "r"), (3, " ".join(base), "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, fp string")


def test_operator_against_all_pairs(spark):
    docs = documents(spark)
    rows = docs.collect()
    prints = [plain_fingerprint(r.text or "") for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    root = roots(near, set(range(len(rows))))
    least = {}
    for i, r in root.items():
        if rows[i].doc_id is not None:
            least[r] = min(least.get(r, 10**9), rows[i].doc_id)
    expected = sorted((rows[i].doc_id or -1, prints[i], least[root[i]]) for i in range(len(rows)))
    for paired in (64, 1):
        found = find_near_duplicates(docs, paired_up_to=paired).collect()
        assert sorted((r.doc_id or -1, r.fp & (1 << 64) - 1, r.component_id) for r in found) == expected
    assert find_near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays_with_all_its_columns(spark):
    docs = documents(spark)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    found = find_near_duplicates(docs).collect()
    assert kept.count() == len({r.root for r in found})
    by_id = [r.doc_id for r in kept.collect()]
    assert set(by_id) == {r.component_id for r in found} and len(by_id) == len(set(by_id))
    assert keep_one_of_each(docs.limit(0)).count() == 0


def test_variants_are_not_sent_to_every_task(spark, monkeypatch):
    # Any number of fingerprints will do: their files are small beside the variants.
    fps = materialize(spark.range(2_000).select(F.xxhash64("id").alias("fp")), "distinct")
    stored = {}

    def keep(df, label):
        stored[label] = df
        return materialize(df, label)

    monkeypatch.setattr("daybook.llm.simhash.materialize", keep)
    links(fps, 2).collect()
    met = stored["variants"]
    met.collect()
    plan = met._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
