import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import collocations as C
from daybook.llm.collocations import Summary, mine_collocations
from daybook.llm.queries import ORACLES, op11_collocations
from workload.compare import connect, differences


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, least=10, longest=3, share=50, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    key = (lang, tuple(words[i : i + m]))
                    f[key] = f.get(key, 0) + 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = Counter()
    for (lang, words), a in candidates.items():
        for w in range(2, len(words)):
            for i in range(len(words) - w + 1):
                covered[lang, words[i : i + w]] = max(covered[lang, words[i : i + w]], a)
    out = []
    for (lang, words), a in candidates.items():
        if 100 * covered[lang, words] >= share * a:
            continue
        cuts = [(1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(ranked)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_rows(rng, n):
    words = ["The", "of", "Ünit", "x", "y\x00", "état", "z-z", "ab", "\x85", "q"]
    joins = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "! "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randrange(40)))
        rows.append((rng.choice([text, text, text, "", None]), rng.choice(["en", "de", None, "und"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


@pytest.mark.parametrize("least, longest, share", [(10, 3, 50), (2, 4, 80), (1, 2, 100)])
def test_same_as_plain(spark, least, longest, share):
    rows = random_rows(random.Random(least), 400)
    out = mine_collocations(frame(spark, rows).repartition(7), least=least, longest=longest, share=share)
    assert found(out) == plain(rows, least, longest, share)


def test_many_buckets_small_steps_and_a_full_filter(spark, monkeypatch):
    rows = random_rows(random.Random(8), 300)
    expected = plain(rows, 3)
    for step, dealt, bits in ((64, 512, 27), (7, 4096, 6), (1 << 20, 1 << 20, 3)):
        monkeypatch.setattr(C, "_STEP", step)
        monkeypatch.setattr(C, "_DEALT", dealt)
        monkeypatch.setattr(C, "FILTER_BITS", bits)
        monkeypatch.setattr(C, "_MOST_BUCKETS", 1 << min(bits, 3))
        monkeypatch.setattr(C, "_HELD", 50)
        batch = pa.RecordBatch.from_pydict({"text": [t or "" for t, _ in rows], "lang": [l or "und" for _, l in rows]})
        batches = [batch.slice(a, 37) for a in range(0, len(rows), 37)]
        size = sum(len((t or "").encode()) for t, _ in rows)
        n = min(C._MOST_BUCKETS, max(1, -(-size // dealt)) - 1).bit_length()
        parts = [r for b in C._deal(3, n)(iter(batches)) for r in b.to_pylist()]
        parts.sort(key=lambda r: (r["bucket"], r["mass"] is None))
        made = list(C._summarise(3, n)(iter([pa.RecordBatch.from_pylist(parts, pa.schema(
            [("bucket", pa.int32()), ("mass", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))])))
        if bits - n < 3:
            continue
        bits_of = {b.column(0)[0].as_py(): b.column(1)[0].as_py() for b in made}
        known = type("Known", (), {"value": b"".join(bits_of.get(b, bytes(1 << (bits - n - 3))) for b in range(1 << n))})
        counts = Counter()
        for b in C._count(3, known)(iter(batches)):
            for r in b.to_pylist():
                counts[r["lang"], r["m"], r["phrase"]] += r["n"]
        for lang, _, phrase, a, l, r, total, _ in expected:
            assert counts[lang, len(phrase.split(" ")), phrase] == a
            assert counts[lang, 0, ""] == total


def test_summaries_keep_every_frequent_key_in_any_order():
    rng = np.random.default_rng(9)
    for threshold in (2, 10, 50):
        stream = (rng.zipf(1.3, 20_000) % 5_000).astype(np.uint64)
        exact = Counter(stream.tolist())
        capacity = len(stream) // threshold + 1
        leaves = []
        for part in np.array_split(stream, 37):
            leaf = Summary(capacity)
            keys, counts = np.unique(part, return_counts=True)
            leaf.merge(keys, counts)
            leaves.append(leaf)
        rng.shuffle(leaves)
        while len(leaves) > 1:  # a tree of merges
            a, b = leaves.pop(), leaves.pop(0)
            a.merge(b.keys, b.counts, b.error)
            leaves.append(a)
        whole = leaves[0]
        assert len(whole.keys) <= capacity and whole.error < threshold
        assert {k for k, n in exact.items() if n >= threshold} <= set(whole.may_have(threshold).tolist())
        for k, n in zip(whole.keys.tolist(), whole.counts.tolist()):
            assert n <= exact[k] <= n + whole.error


def test_long_texts_repeats_empty_table_and_clashing_names(spark):
    names = "m n phrase a l r k best salt rank score most bucket mass keys counts".split()
    long = "alpha beta gamma " * 700_000 + "w" * 9_000_000 + " alpha beta"
    rows = [(long, "en", *"x" * len(names)), (None, None, *"x" * len(names)), (None, None, *"x" * len(names))]
    docs = spark.createDataFrame(rows, "text string, lang string, " + ", ".join(f"{c} string" for c in names))
    out = found(mine_collocations(docs))
    assert out == plain([(long, "en")])
    assert {r[2]: r[3] for r in out}["alpha beta gamma"] == 700_000
    assert mine_collocations(docs.limit(0)).count() == 0
    assert mine_collocations(docs.where("lang is null")).count() == 0


def test_same_as_sql(spark, sf_dir):
    assert differences(op11_collocations(spark, sf_dir), connect(sf_dir), ORACLES["op11_collocations"]) == ""
