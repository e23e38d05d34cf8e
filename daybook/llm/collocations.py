"""Collocations: phrases whose words belong together, by language.

Texts are cut into pieces at ``.,;:!?`` and line ends, A-Z in lower case, and
pieces into words at blanks and tabs. A phrase is 2 to `longest` neighbouring
words of a piece with at least `least` occurrences ``a``. Cut after its first
``k`` words, the parts have ``l`` and ``r`` occurrences and the cut scores
``floor(1000000 * a * a / (l * r))``; the lowest-scoring cut counts, of equal
ones that with the smallest ``k``. A phrase inside a longer one that has at
least `share` percent of its occurrences is dropped. All counts are exact and by
language; a null language is `und`, null texts are empty.

Method: every n-gram up to `longest` words is hashed. Tasks count what they have
and deal hashes and counts by hash. For each hash partition the counts become a
Misra-Gries summary: capacity above the partition's mass divided by `least`, so
no n-gram with `least` occurrences can be lost, whatever is merged in whichever
order. The masses come first in each partition, hence the capacity is known
before the first merge, and memory never exceeds it by more than one merge. The
survivors set bits of a filter of fixed size, sent to the second pass, which
counts the n-grams whose bit is set, by their words and not by hashes. With more
survivors than the filter can tell apart the second pass only counts more.

Frequent parts of frequent phrases are frequent, so that one pass finds all
counts that scores need. Texts of any length are read in windows. Repeated rows
count as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import column
from daybook.llm.words import Words, byte_kinds, words_in
from daybook.workspace import materialize

FILTER_BITS = 27
MASS = 1_000_000
# Text of one hash partition, and of one step of a task, in bytes.
_DEALT, _STEP = 4 << 20, 2 << 20
# Counted n-grams a task holds before it hands them on; rows of a batch.
_HELD, _ROWS = 1_000_000, 50_000
_SALTS = 32
_MOST_BUCKETS = 1 << 18

_KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")


def _steps(batch: pa.RecordBatch, longest: int) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """The words of some texts at a time, the language of each word, and the languages by number."""
    # Freed memory goes back at once: workers live on between tasks.
    pa.set_memory_pool(pa.system_memory_pool())
    coded = batch.column("lang").dictionary_encode()
    langs, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
    for found, rows in words_in(batch, _STEP, _KINDS, longest - 1):
        yield found, langs[rows[found.text]], names


def _runs(found: Words, m: int) -> np.ndarray:
    """Where the n-grams of `m` words start."""
    n = len(found) - m + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    inside = found.piece[:n] == found.piece[m - 1 :]
    inside[: max(0, found.counted - m + 1)] = False
    return np.flatnonzero(inside)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(
    found: Words, langs: np.ndarray, names: list[str], longest: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of words: where n-grams start, and their hashes."""
    digest = xxhash.xxh3_64_intdigest
    word = np.fromiter(map(digest, found.words.to_pylist()), dtype=np.uint64, count=len(found.words))[found.code]
    lang = np.fromiter((digest(n.encode(), 1) for n in names), dtype=np.uint64, count=len(names))[langs]
    h = _mixed(word ^ lang)
    for m in range(1, longest + 1):
        if m > 1:
            h = _mixed(h[: len(found) - m + 1] * np.uint64(0x9E3779B97F4A7C15) + word[m - 1 :])
        at = _runs(found, m)
        yield m, at, h[at]


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """A mergeable Misra-Gries summary.

    Of a total mass M, a key's count is too low by at most ``error``, which is
    at most M / (capacity + 1).
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, error: int = 0) -> None:
        keys, counts = _counted(np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts)))
        self.error += error
        if len(keys) > self.capacity:
            at = len(counts) - self.capacity - 1
            cut = int(np.partition(counts, at)[at])
            left = counts > cut
            keys, counts = keys[left], counts[left] - cut
            self.error += cut
        self.keys, self.counts = keys, counts

    def may_have(self, least: int) -> np.ndarray:
        """The keys that can have `least` occurrences."""
        return self.keys[self.counts + self.error >= least]


_DEAL = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("mass", T.LongType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)


def _deal(longest: int, bits: int):
    """Count the hashes of a task and deal them into 2 ** `bits` buckets by their highest bits."""
    buckets = 1 << bits
    edges = (np.arange(buckets, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, np.uint64)

    def rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cuts = np.append(np.searchsorted(keys, edges), len(keys))
        full = [b for b in range(buckets) if cuts[b + 1] > cuts[b]]
        cells = [(keys[cuts[b] : cuts[b + 1]], counts[cuts[b] : cuts[b + 1]]) for b in full]
        mass = [int(c.sum()) for _, c in cells]
        blank = [None] * len(full)
        # One row tells the mass, another has the counts.
        return pa.RecordBatch.from_pydict(
            {
                "bucket": [*full, *full],
                "mass": [*mass, *blank],
                "keys": [*blank, *(k.tobytes() for k, _ in cells)],
                "counts": [*blank, *(c.astype(np.uint32).tobytes() for _, c in cells)],
            },
            pa.schema([("bucket", pa.int32()), ("mass", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for found, langs, names in _steps(batch, longest):
                held.append(_counted(np.concatenate([h for _, _, h in gram_hashes(found, langs, names, longest)])))
                if sum(len(k) for k, _ in held) >= _HELD:
                    yield rows(*_counted(*map(np.concatenate, zip(*held))))
                    held = []
        if held:
            yield rows(*_counted(*map(np.concatenate, zip(*held))))

    return run


_BITS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("bits", T.BinaryType())])


def _summarise(least: int, bits: int):
    """The filter's part of each bucket; the rows with masses come first."""
    here = FILTER_BITS - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("bits", pa.binary())])
        bucket, mass, summary = None, 0, None
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> None:
            if waiting:
                summary.merge(*map(np.concatenate, zip(*waiting)))
                waiting.clear()

        def close() -> pa.RecordBatch:
            merge()
            flags = np.zeros(1 << here, dtype=bool)
            place = (summary.may_have(least) >> np.uint64(64 - FILTER_BITS)) & np.uint64((1 << here) - 1)
            flags[place.astype(np.int64)] = True
            return pa.RecordBatch.from_pydict({"bucket": [bucket], "bits": [np.packbits(flags).tobytes()]}, schema)

        for batch in batches:
            for b, m, keys, counts in zip(*(batch.column(n).to_pylist() for n in range(4))):
                if b != bucket:
                    if summary is not None:
                        yield close()
                    bucket, mass, summary = b, 0, None
                if m is not None:
                    mass += m
                    continue
                if summary is None:
                    summary = Summary(mass // least + 1)
                waiting.append((np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.uint32).astype(np.int64)))
                if sum(len(k) for k, _ in waiting) >= summary.capacity:
                    merge()
        if summary is not None:
            yield close()

    return run


_COUNT = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("m", T.IntegerType()),
        T.StructField("phrase", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def _phrases(
    found: Words, lang: np.ndarray, at: np.ndarray, m: int, langs: int
) -> tuple[np.ndarray, np.ndarray]:
    """A place for each distinct n-gram of those at `at`, by language and words, and its number."""
    size = len(found.words)
    parts = [lang[at], *(found.code[at + k] for k in range(m))]
    if langs * size**m < 1 << 63:
        key = parts[0]
        for part in parts[1:]:
            key = key * size + part
        _, place, count = np.unique(key, return_index=True, return_counts=True)
    else:
        _, place, count = np.unique(np.stack(parts, axis=1), axis=0, return_index=True, return_counts=True)
    return at[place], count


def _count(longest: int, known):
    """Exact counts of the n-grams whose bit is set; with `m` 0, of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        bits = np.frombuffer(known.value, dtype=np.uint8)
        schema = pa.schema([("lang", pa.string()), ("m", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
        for batch in batches:
            for found, langs, names in _steps(batch, longest):
                lang_names = pa.array(names, pa.string())
                every = np.bincount(langs[found.counted :], minlength=len(names))
                yield pa.RecordBatch.from_arrays(
                    [lang_names, pa.array([0] * len(names), pa.int32()), pa.array([""] * len(names)), pa.array(every, pa.int64())],
                    schema=schema,
                )
                words = found.words.cast(pa.string())
                for m, at, h in gram_hashes(found, langs, names, longest):
                    place = h >> np.uint64(64 - FILTER_BITS)
                    set_ = (bits[(place >> np.uint64(3)).astype(np.int64)] >> (7 - (place & np.uint64(7))).astype(np.uint8)) & 1
                    at, count = _phrases(found, langs, at[set_.astype(bool)], m, len(names))
                    for a in range(0, len(at), _ROWS):
                        some = at[a : a + _ROWS]
                        spelled = [words.take(pa.array(found.code[some + k])) for k in range(m)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                lang_names.take(pa.array(langs[some])),
                                pa.array(np.full(len(some), m, np.int32)),
                                pc.binary_join_element_wise(*spelled, " "),
                                pa.array(count[a : a + _ROWS].astype(np.int64)),
                            ],
                            schema=schema,
                        )

    return run


def frequent_phrases(docs: DataFrame, least: int = 10, longest: int = 3) -> DataFrame:
    """`lang`, `m` (words), `phrase`, `n` of all n-grams with `least` occurrences; `docs` has `text` and `lang`.

    Rows with `m` 0 have the number of all words of a language.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(_MOST_BUCKETS, max(1, -(-size // _DEALT)) - 1).bit_length()
    dealt = docs.mapInArrow(_deal(longest, bits), _DEAL)
    ready = dealt.repartition(1 << bits, "bucket").sortWithinPartitions("bucket", F.col("mass").isNull())
    # Buckets are equal parts of the filter: its size is fixed, whatever the input.
    parts = {r.bucket: r.bits for r in ready.mapInArrow(_summarise(least, bits), _BITS).toLocalIterator()}
    blank = bytes(max(1, (1 << (FILTER_BITS - bits)) // 8))
    known = spark.sparkContext.broadcast(b"".join(parts.get(b, blank) for b in range(1 << bits)))
    counted = docs.mapInArrow(_count(longest, known), _COUNT).groupBy("lang", "m", "phrase").agg(F.sum("n").alias("n"))
    return materialize(counted.where((F.col("m") == 0) | (F.col("n") >= least)), "phrase-counts")


def _score(counts: DataFrame) -> DataFrame:
    """`lang`, `phrase`, `m`, `a`, `l`, `r`, `score` of every phrase, by its lowest-scoring cut."""
    words = lambda n: F.call_function("substring_index", F.col("phrase"), F.lit(" "), n)
    cut = lambda k: F.struct(k.alias("k"), words(k).alias("left"), words(k - F.col("m")).alias("right"))
    cuts = (
        counts.where("m >= 2")
        .withColumn("cut", F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - 1), cut)))
        .select("lang", "phrase", "m", F.col("n").alias("a"), "cut.*")
    )
    parts = counts.where("m >= 1")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    exact = f"({MASS}BD * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0)))"
    return (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .withColumn("score", F.expr(exact))
        .groupBy("lang", "phrase", "m", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        .select("lang", "phrase", "m", "a", "best.l", "best.r", "best.score")
    )


def _covered(counts: DataFrame) -> DataFrame:
    """`lang`, `phrase`, `most`: the occurrences of the most frequent longer phrase around each."""
    inner = F.expr(
        """flatten(transform(sequence(2, m - 1), w ->
               transform(sequence(1, m - w + 1), i -> array_join(slice(split(phrase, ' '), i, w), ' '))))"""
    )
    return (
        counts.where("m >= 3")
        .select("lang", F.explode(inner).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("most"))
    )


def mine_collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 10,
    longest: int = 3,
    share: int = 50,
    top: int = 2000,
) -> DataFrame:
    """The best `top` phrases of each language: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`.

    Order: score and occurrences descending, then phrase by bytes.
    """
    slim = docs.select(
        F.coalesce(column(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )
    counts = frequent_phrases(slim, least, longest)
    scored = _score(counts).join(_covered(counts), ["lang", "phrase"], "left")
    scored = scored.where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("a")))
    order = "lang {} order by score desc, a desc, phrase"
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    place = lambda by: F.expr(f"row_number() over (partition by {order.format(by)})").cast("long")
    first = salted.withColumn("rank", place(", salt")).where(F.col("rank") <= top)
    best = first.withColumn("rank", place("")).where(F.col("rank") <= top)
    words = counts.where("m = 0").select("lang", F.col("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
