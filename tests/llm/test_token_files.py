import random
import zlib

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from tokenizers import AddedToken, Tokenizer

from daybook.llm import elias_fano
from daybook.llm.queries import vocabulary_path
from daybook.llm.token_files import Encoder, Segment, pack, read_documents, tokenize, write_tokens

PATH = vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    return Encoder(PATH)


@pytest.fixture(scope="module")
def library():
    """The tokenizer as its library gives it, nothing set."""
    return Tokenizer.from_file(PATH)


def plain(library, text):
    return library.encode(text, add_special_tokens=False).ids


PARTS = [
    "a", "Word", "don't", ",", ".", "?)", '("', ":'s", "'ll", "é,", "é", "à", "12", "..", "\n", " ", "  ", "\t", "\x1c", "\x85", "\xa0", "\u2003", "　", "\u2028", "\r\n", "'s",
    "<|endoftext|>", "<|endof", "漢字", "€", "𝄞", "\u2060", "x" * 60,
]


@pytest.mark.parametrize("together", [40, 8 << 20])
def test_pieces_give_the_ids_of_the_whole_text(coder, library, monkeypatch, together):
    monkeypatch.setattr("daybook.llm.token_files._TOGETHER", together)
    rng = random.Random(11)
    texts = ["", " ", "\n", "a\nb", " a", "a ", "a\n b", "a \nb", "one two\nthree four.", "<|endoftext|>", "x <|endoftext|> y"]
    texts += ["".join(rng.choice(PARTS + [" "] * 8 + ["\n"] * 2) for _ in range(rng.randrange(30))) for _ in range(10_000)]
    for a in range(0, len(texts), 100):
        for text, found in zip(texts[a : a + 100], coder.encode(texts[a : a + 100])):
            assert found.tolist() == plain(library, text), repr(text)


def test_names_that_reach_over_blanks(tmp_path):
    odd = Tokenizer.from_file(PATH)
    odd.add_special_tokens(["<two words>", AddedToken("<left>", lstrip=True), AddedToken("<word>", single_word=True)])
    odd.save(str(tmp_path / "odd.json"))
    coder = Encoder(str(tmp_path / "odd.json"))
    rng = random.Random(12)
    parts = ["a", " ", " ", "\n", "<two words>", "<left>", "<word>", "b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2000)]
    assert [f.tolist() for f in coder.encode(texts)] == [plain(odd, t) for t in texts]


def test_a_tokenizer_with_other_rules_is_not_cut_for(tmp_path):
    from tokenizers.pre_tokenizers import ByteLevel

    other = Tokenizer.from_file(PATH)
    other.pre_tokenizer = ByteLevel(add_prefix_space=True, use_regex=False)
    other.save(str(tmp_path / "other.json"))
    texts = ["one two, three\nfour", " a", "b.c d"]
    assert [f.tolist() for f in Encoder(str(tmp_path / "other.json")).encode(texts)] == [plain(other, t) for t in texts]


def test_cache_is_bounded(library, monkeypatch):
    monkeypatch.setattr("daybook.llm.token_files._CACHED_PIECES", 5)
    small = Encoder(PATH)
    for text in ("a b c d e f g h", "i j k l", "a b\nc d e f g"):
        assert small.encode([text])[0].tolist() == plain(library, text)


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_elias_fano_round_trip(n):
    rng = random.Random(n)
    for universe in (0, 1, n, 10 * n + 7, 1 << 40, (1 << 63) - 1):
        values = np.array(sorted(rng.randint(0, universe) for _ in range(n)), dtype=np.int64)
        data = elias_fano.encode(values, universe)
        read = elias_fano.Sequence(data + b"more")
        assert read.size == len(data)
        assert read.all().tolist() == values.tolist()
        some = range(n) if n < 300 else rng.sample(range(n), 200)
        assert [read.select(i) for i in some] == [int(values[i]) for i in some]
        if n >= 255:
            bits = 2 + max(0, np.log2(universe / n)) if universe else 3
            assert 8 * len(data) / n < bits + 1 + 32 / 256 + 8 * 41 / n
    with pytest.raises(IndexError):
        read.select(n)


def test_equal_values_and_long_gaps():
    values = np.array([0] * 700 + [5] * 700 + [10**9] * 3, dtype=np.int64)
    read = elias_fano.Sequence(elias_fano.encode(values, 10**9))
    assert [read.select(i) for i in range(len(values))] == values.tolist()


def test_segment_access():
    s = Segment(pack(np.array([7, 8, 2, 2, 9, 2], dtype="<u2").tobytes(), 2, [3, 1, 2], [None, -5, 40]))
    assert [s.tokens(i).tolist() for i in range(3)] == [[7, 8, 2], [2], [9, 2]]
    assert [s.doc_id(i) for i in range(3)] == [None, -5, 40] and s.boundary(2) == 4
    with pytest.raises(ValueError):
        Segment(b"x" * 64)


def test_files_hold_all_documents_in_order(spark, library, tmp_path):
    rng = random.Random(2)
    rows = [(rng.randrange(-500, 500) * 1_000_003, "w" * rng.randrange(4) + " tok en" * rng.randrange(30), "k") for _ in range(300)]
    rows += [(None, "no id", "k"), (5, None, "k"), (6, "", "k"), (7, "same", "k"), (7, "same", "k"), (8, "long " * 5000, "k")]
    rows += [(9, "before <|endoftext|> after<|endoftext|>", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    out = tokenize(docs, PATH, str(tmp_path / "files"), segment_ids=700).collect()
    found = sorted(out, key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    ids = lambda t: [*plain(library, t or ""), 2]
    sums = lambda t: (len(ids(t)), zlib.crc32(np.array(ids(t), dtype="<u4").tobytes()))
    assert sorted((r.doc_id or 0.5, r.n_tokens, r.ids_crc32) for r in out) == sorted((i or 0.5, *sums(t)) for i, t, _ in rows)


def test_writing_again_and_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").coalesce(1)
    folder = str(tmp_path / "files")
    write_tokens(docs, folder, PATH)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_tokens(docs, folder, PATH)
    write_tokens(docs, folder, PATH, mode="overwrite")
    assert read_documents(spark, folder).count() == 2
    assert tokenize(docs.limit(0), PATH).count() == 0
    with pytest.raises(TypeError, match="whole numbers"):
        write_tokens(docs.selectExpr("cast(doc_id as string) doc_id", "text"), str(tmp_path / "text"), PATH)
