import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm.grading import Model, _loss, _minimise, featurise, fit, grade, grades_of, keep_good


def test_features_are_distinct_and_whole_texts_count():
    texts = ["", "a a A", "é b", "x " * 5000 + "last"]
    found, counts = featurise(texts)
    assert len(found) == counts.sum() and len(counts) == 4
    assert counts[0] == 1
    alone, _ = featurise(["last"])
    assert set(alone[:3]) & set(found[-counts[3] :])


def test_slope_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 5, 30)
    features = rng.integers(0, 6, counts.sum())
    grades = rng.integers(0, 3, 30)
    at = rng.normal(size=8)
    value, slope = _loss(at, features, counts, grades, 3, 0.5)
    for i in range(len(at)):
        step = np.zeros(8)
        step[i] = 1e-6
        numeric = (_loss(at + step, features, counts, grades, 3, 0.5)[0] - _loss(at - step, features, counts, grades, 3, 0.5)[0]) / 2e-6
        assert slope[i] == pytest.approx(numeric, abs=1e-5)


def test_minimiser_finds_the_bottom():
    f = lambda x: (((x - 3) ** 2 * np.arange(1, 6)).sum(), 2 * (x - 3) * np.arange(1, 6))
    assert _minimise(f, np.zeros(5)) == pytest.approx(np.full(5, 3.0), abs=1e-2)


def test_tails_are_ordered_and_sum_to_the_expected_grade():
    model = Model(np.zeros(4), np.array([-1.0, 0.5, 2.0]))
    tails = model.tails(np.array([-2.0, 0.0, 3.0]))
    assert (np.diff(tails, axis=1) <= 0).all() and (np.diff(tails, axis=0) >= 0).all()


def test_nothing_learned_from_one_grade():
    features, counts = featurise(["a b", "c d"])
    assert fit(features, counts, np.array([2, 2]), 3).weights is None


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    read = lambda n: spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/{n}.parquet")
    docs, labels = read("documents"), read("labels")
    return docs, grades_of(labels, F.col("quality"), F.col("toxic"))


def test_held_out_accuracy(tables):
    docs, ratings = tables
    seen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    out = grade(docs, ratings.where(seen)).join(ratings.where(~seen), "doc_id").toPandas()
    good, low, toxic = (out[out["grade"] == g] for g in (2, 1, 0))
    assert good.kept.mean() > 0.9
    assert low.kept.mean() < 0.3
    assert toxic.expected_grade.mean() < good.expected_grade.mean() - 0.3


def test_reruns_agree_and_sample_is_bounded(tables):
    docs, ratings = tables
    rows = lambda d: sorted((r.doc_id, round(r.tail, 6)) for r in grade(d, ratings, max_rated=100).collect())
    assert rows(docs) == rows(docs.repartition(5, "lang"))


def test_odd_rows(spark, tables):
    _, ratings = tables
    docs = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (2, "w " * 50_000, "z"), (2, "w " * 50_000, "z")], "doc_id long, text string, tail string")
    none = ratings.limit(0)
    out = grade(docs, none).collect()
    assert len(out) == 4 and all(r.kept for r in out)
    kept = keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4
    assert grade(docs.limit(0), ratings).count() == 0


def test_slices_cover_a_batch_in_order():
    import pyarrow as pa

    from daybook.llm.rows import slices

    texts = ["", None, "abcd", "x" * 50, "efgh", "ijkl", "", "y" * 9]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "n": list(range(len(texts)))})
    parts = list(slices(batch, "text", 10))
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(len(texts)))
    assert len(parts) > 3 and max(sum(len(t or "") for t in p.column("text").to_pylist()) for p in parts) < 70
    assert list(slices(batch.slice(0, 0), "text", 10)) == []


def test_scores_written_down_text_by_text(spark):
    import math
    import zlib

    from daybook.llm import grading as G

    rows = [(n, t) for n, t in enumerate(["good clear words here", "bad BAD 99!! bad", "", None, "Good  Words\there", "x" * 50_000])]
    model = G.Model(np.random.default_rng(3).normal(size=G.FEATURES), np.array([-0.4, 0.7]))

    def hashed(kind, value):
        return zlib.crc32(kind.encode() + value) % G.FEATURES

    def shape(word):
        out = ""
        for b in word:
            c = "a" if 97 <= b <= 122 else "A" if 65 <= b <= 90 else "0" if 48 <= b <= 57 else "x" if b >= 128 else chr(b)
            out += c if out[-1:] != c else ""
        return out[:8].encode("latin-1")

    def plain(text):
        words = (text or "").encode().split()
        features = {hashed("w", w.lower()) for w in words} | {hashed("b", w.lower()[:5]) for w in words}
        features |= {hashed("s", shape(w)) for w in words}
        n, d = len(words), len(set(words))
        features.add(hashed("r", f"{n.bit_length()}:{round(8 * d / n)}".encode() if n else b"empty"))
        total = sum(model.weights[f] for f in features) / math.sqrt(len(features))
        tails = [1 / (1 + math.exp(t - total)) for t in model.thresholds]
        return sum(tails), tails[1]

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r[0]: r[1:] for r in G.score(docs, model, 2, ["doc_id"], "text").collect()}
    for n, text in rows:
        assert tuple(out[n]) == pytest.approx(plain(text), rel=1e-9)
