import math
import random
import zlib
from collections import Counter
from itertools import product

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm.lattice import (
    MARK, Pieces, Trie, expected, expected_many, frequent, read_vocabulary, score_documents, spelled, spelled_many,
)
from daybook.llm.queries import vocabulary_path

VOCABULARY = [MARK + "a", MARK + "ab", "b", "ba", "bab", MARK + "b", "a", "c"]


def all_ways(word, pieces):
    """Probability of a word by listing every segmentation."""
    total = 0.0
    for cuts in product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for i, cut in enumerate([*cuts, 1], 1):
            if cut:
                parts.append((start, i))
                start = i
        ways = 1.0
        for a, b in parts:
            piece = word[a:b] if a else MARK + word[:b]
            p = math.exp(pieces.scores[piece]) if piece in pieces.scores else 0.0
            if b == a + 1:
                p += math.exp(sum(pieces.byte_scores[x] for x in word[a].encode()))
            ways *= p
        total += ways
    return total * math.exp(pieces.end)


def test_forward_sum_equals_all_segmentations():
    counts = {f"piece:{p}": n + 1.0 for n, p in enumerate(VOCABULARY)} | {"end": 5.0, "byte:195": 2.0}
    for pieces in (Pieces.even(VOCABULARY), Pieces.from_counts(VOCABULARY, counts)):
        for word in ("a", "ab", "abab", "babab", "é", "aéb", "cccc", "zab"):
            assert math.exp(spelled(word, pieces, 4)) == pytest.approx(all_ways(word, pieces))


def test_expected_counts_cover_each_word():
    pieces, sums = Pieces.even(VOCABULARY), {}
    expected("abab", pieces, 4, sums)
    letters = sum(n * len(k.removeprefix("piece:").removeprefix(MARK)) for k, n in sums.items() if k.startswith("piece:"))
    letters += sum(n for k, n in sums.items() if k.startswith("byte:"))
    assert letters == pytest.approx(4) and sums["end"] == 1


def test_scores_of_pieces_sum_to_one():
    pieces = Pieces.from_counts(VOCABULARY, {"piece:a": 3.0, "end": 2.0})
    total = sum(map(math.exp, [*pieces.scores.values(), *pieces.byte_scores, pieces.end]))
    assert total == pytest.approx(1)


def test_many_words_at_once_equal_one_by_one():
    counts = {f"piece:{p}": n + 1.0 for n, p in enumerate(VOCABULARY)} | {"end": 5.0, "byte:195": 2.0}
    words = ["a", "ab", "abab", "babab", "é", "aéb", "cccc", "zab", "a" + MARK + "b", "𝄞ba", "ab" * 16, "ab" * 17, "c" * 300, "", "ab"]
    for pieces in (Pieces.even(VOCABULARY), Pieces.from_counts(VOCABULARY, counts), Pieces.even([])):
        trie, widest = Trie(pieces), pieces.widest()
        one_by_one = [spelled(w, pieces, widest) for w in words]
        assert spelled_many(words, pieces, trie).tolist() == pytest.approx(one_by_one)
        plain, together = {}, {}
        for w in words:
            expected(w, pieces, widest, plain)
        expected_many(words, pieces, trie, together)
        for key in plain.keys() | together.keys():
            assert together.get(key, 0) == pytest.approx(plain.get(key, 0), abs=1e-6), key


def plain_base(rows):
    tokens = [[*(t or "").encode().lower().split(), b" "] for _, t in rows]
    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, out) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = lambda w: math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1)))
    return sorted(
        (-1 if i is None else i, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(map(base, ws)), 6))
        for (i, _), h, ws in zip(rows, out, tokens)
    )


def plain_scores(rows, passes):
    """(score, lattice score) of each row: the model written down word by word."""
    tokens = [[*(t or "").encode().lower().split(), b" "] for _, t in rows]
    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, out) if not h for w in ws)
    n, n1, n2 = sum(counts.values()), *(sum(c == k for c in counts.values()) for k in (1, 2))
    discount = min(0.95, n1 / (n1 + 2 * n2)) if n1 else 0.5
    pieces = Pieces.even(VOCABULARY)
    for _ in range(passes):
        sums = {}
        for w in counts:
            if w != b" ":
                expected(w.decode(), pieces, 4, sums)
        pieces = Pieces.from_counts(VOCABULARY, sums)

    def ways(word):
        return all_ways(word, pieces) if len(word) < 10 else math.exp(spelled(word, pieces, 4))

    def one(w):
        whole = (counts[w] - discount) / n if counts[w] else 0.0
        if w == b" ":
            return math.log10(whole), math.log10(whole)
        alone = ways(w.decode())
        return math.log10(whole + alone * discount * len(counts) / n), math.log10(alone)

    known = {w: one(w) for ws in tokens for w in ws if len(w) < 100}
    return [tuple(sum(known[w][k] for w in ws) for k in (0, 1)) for ws in tokens if all(w in known for w in ws)]


@pytest.mark.parametrize("passes", [0, 2])
def test_scores_equal_the_model_written_down(spark, rows, passes):
    rows = [r for r in rows if len(r[1] or "") < 400]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = score_documents(docs, VOCABULARY, passes=passes, broadcast_words=30).collect()
    found = sorted((r.score, r.lattice_score) for r in out)
    for f, e in zip(found, sorted(plain_scores(rows, passes)), strict=True):
        assert f == pytest.approx(e, rel=1e-9)


def test_long_texts_are_read_in_parts(spark, rows, monkeypatch):
    from daybook.llm import lattice, words

    batch = pa.RecordBatch.from_pydict({"text": [t or "" for _, t in rows], "held_out": [n % 3 == 0 for n in range(len(rows))]})

    def tally():
        sums = Counter()
        for b in lattice._count_words(iter([batch])):
            for r in b.to_pylist():
                sums[r["token"], "c"] += r["c"]
                sums[r["token"], "n"] += r["n_all"]
        return sums

    whole = tally()
    for step in (1, 10, 100):
        monkeypatch.setattr(lattice, "_STEP", step)
        assert tally() == whole
    assert [len(w) for w, _ in words.words_in(pa.RecordBatch.from_pydict({"text": ["", " "]}), 5, lattice._KINDS)] == [0]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 7))) for _ in range(120)]
    rows = [(n, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for n in range(150)]
    rows += [(500, None), (501, ""), (502, "A a\tA\x0bb"), (None, "a b"), (503, "x y"), (503, "x y"), (504, "q" * 500)]
    return rows


@pytest.mark.parametrize("bound", [0, 20, 100_000])
def test_counts_and_base_scores(spark, rows, bound):
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, token string").repartition(4)
    out = score_documents(docs, VOCABULARY, broadcast_words=bound).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert found == plain_base(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_words_sent_by_broadcast_are_bounded(spark):
    scored = spark.range(1, 500).select(F.col("id").cast("string").alias("token"), F.col("id").alias("n_all"))
    assert 0 < frequent(scored, 100).count() <= 100
    assert frequent(scored, 0).count() == 0


def test_training_makes_held_out_texts_likelier(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = read_vocabulary(vocabulary_path("piece_bpe_32k.model"))
    held = lambda n: score_documents(docs, pieces, passes=n).where("held_out").agg(F.sum("score")).first()[0]
    trained, even = held(2), held(0)
    assert trained > 0.8 * even and trained > even


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    (r,) = score_documents(docs, VOCABULARY).collect()
    assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score)
    assert score_documents(docs.limit(0), VOCABULARY).count() == 0
