"""Text quality by ordinal regression on graded ratings.

Ratings are ordered grades 0, 1, ... A text has hashed features: its words,
beginnings of words, the shapes of words (case, digits, signs) and how often it
repeats itself. One weight for each feature is shared by all grades; ordered
thresholds turn the weighted sum into probabilities (cumulative logit):
P(grade <= k) = logistic(threshold[k] - weights . features). The expected grade
orders texts, the tail probability P(grade >= wanted) selects them.

The model is fitted on a sample of at most `MAX_RATED` rated documents and
`MAX_ENTRIES` feature entries, chosen by the hash of the id; features seen in
fewer than `MIN_DOCUMENTS` of them have no weight. Scoring covers every whole
text.

Null text counts as empty and has only the feature of emptiness. Ratings that
are null or of unknown documents are ignored; a document rated twice counts
twice. Without ratings, or with one grade only, nothing can be learned: the
model then gives every text the same grade and rejects none. Repeated rows and
null ids are scored like others. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import column, id_and_text, slices, unused
from daybook.workspace import materialize

FEATURES = 1 << 18
MAX_RATED = 10_000
MAX_ENTRIES = 20_000_000
MIN_DOCUMENTS = 3
RIDGE = 3e-3
# Texts are taken apart together up to this length, longer ones alone.
_SLICE_BYTES = 2_000_000
_SHAPE = bytes(
    97 if 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 120 if b >= 128 else b
    for b in range(256)
)


def _hashed(kind: bytes, value: bytes) -> int:
    return zlib.crc32(kind + value) % FEATURES


@lru_cache(maxsize=100_000)
def _word_features(word: bytes) -> tuple[int, int, int]:
    """Features of one word: itself, its beginning, its shape."""
    lower = word.lower()
    shape, last = bytearray(), None
    for c in word.translate(_SHAPE):
        if c != last:
            shape.append(c)
            last = c
        if len(shape) >= 8:
            break
    return _hashed(b"w", lower), _hashed(b"b", lower[:5]), _hashed(b"s", bytes(shape))


def featurise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, one after the other, and their counts."""
    data = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    lengths = np.array([len(w) for w in data], dtype=np.int64)
    flat = pa.chunked_array([pa.array(w, pa.binary()) for w in data] or [pa.array([], pa.binary())]).combine_chunks()
    coded = pc.dictionary_encode(flat)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    table = np.array([_word_features(w) for w in coded.dictionary.to_pylist()], dtype=np.int64).reshape(-1, 3)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of_doc = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    words = np.unique(of_doc << 32 | codes)
    docs_of, codes = words >> 32, words & 0xFFFFFFFF
    keys = (docs_of[:, None] * FEATURES + table[codes]).reshape(-1)
    distinct = np.bincount(docs_of, minlength=len(texts))
    # One feature for how much a text repeats itself, by its length.
    extra = []
    for n, d in zip(lengths.tolist(), distinct.tolist()):
        level = f"{n.bit_length()}:{round(8 * d / n)}" if n else "empty"
        extra.append(_hashed(b"r", level.encode()))
    extra = np.array(extra, dtype=np.int64) + np.arange(len(texts)) * FEATURES
    keys = np.unique(np.concatenate([keys, extra]))
    return (keys % FEATURES).astype(np.int32), np.bincount(keys // FEATURES, minlength=len(texts))


@dataclass
class Model:
    """Shared weights and ordered thresholds; `None`: nothing was learned."""

    weights: np.ndarray | None
    thresholds: np.ndarray

    def score(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        return np.add.reduceat(self.weights[features], starts) / np.sqrt(counts) if len(counts) else np.zeros(0)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each text and each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -700, 700)))


def _loss(params: np.ndarray, features, counts, grades, grades_n: int, ridge: float):
    """Mean negative log likelihood with a ridge, and its slope."""
    k = grades_n - 1
    weights, first, steps = params[:-k], params[-k], np.exp(params[len(params) - k + 1 :])
    thresholds = first + np.concatenate([[0.0], np.cumsum(steps)])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    scale = 1 / np.sqrt(counts)
    score = np.add.reduceat(weights[features], starts) * scale
    below = np.concatenate([[-np.inf], thresholds, [np.inf]])
    cdf = lambda t: 1 / (1 + np.exp(np.clip(-t, -700, 700)))
    up, lo = cdf(below[grades + 1] - score), cdf(below[grades] - score)
    p = np.maximum(up - lo, 1e-12)
    d_up, d_lo = up * (1 - up), lo * (1 - lo)
    n = len(grades)
    value = -np.log(p).mean() + ridge / (2 * n) * (weights @ weights)
    d_score = (d_up - d_lo) / p / n
    slope = np.zeros_like(params)
    slope[:-k] = np.bincount(features, np.repeat(d_score * scale, counts), minlength=len(weights)) + ridge / n * weights
    d_threshold = np.zeros(k)
    for g in range(k):
        d_threshold[g] = -(np.where(grades == g, d_up / p, 0).sum() - np.where(grades == g + 1, d_lo / p, 0).sum()) / n
    slope[len(params) - k] = d_threshold.sum()
    for j in range(1, k):
        slope[len(params) - k + j] = d_threshold[j:].sum() * steps[j - 1]
    return value, slope


def _minimise(f, start: np.ndarray, rounds: int = 60, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with a backtracking line search."""
    x, (value, slope) = start, f(start)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, alphas = slope.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (y @ s)
            alphas.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(alphas)):
            q += s * (a - (y @ q) / (y @ s))
        step, down = 1.0 if pairs else min(1.0, 1 / max(1e-12, np.abs(slope).sum())), slope @ q
        while True:
            new = x - step * q
            new_value, new_slope = f(new)
            if new_value <= value - 1e-4 * step * down or step < 1e-10:
                break
            step /= 2
        s, y = new - x, new_slope - slope
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        done = abs(value - new_value) < 1e-7
        x, value, slope = new, new_value, new_slope
        if done:
            break
    return x


def fit(features: np.ndarray, counts: np.ndarray, grades: np.ndarray, grades_n: int, ridge: float = RIDGE) -> Model:
    """Weights and thresholds from the features of rated texts."""
    k = grades_n - 1
    if len(np.unique(grades)) < 2:
        return Model(None, np.zeros(k))
    share = np.clip([(grades <= g).mean() for g in range(k)], 1e-3, 1 - 1e-3)
    thresholds = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(k) * 1e-3)
    known = np.bincount(features, minlength=FEATURES) >= MIN_DOCUMENTS
    # Only known features get columns; the others stay at weight zero.
    where = np.cumsum(known) - 1
    use = known[features]
    of_doc = np.repeat(np.arange(len(counts)), counts)[use]
    kept = np.bincount(of_doc, minlength=len(counts))
    some = kept > 0
    columns = where[features[use]]
    scale_counts = kept[some]
    start = np.concatenate([np.zeros(int(known.sum())), thresholds[:1], np.log(np.diff(thresholds))])
    if not some.any():
        return Model(None, thresholds)
    found = _minimise(lambda p: _loss(p, columns, scale_counts, grades[some], grades_n, ridge), start)
    weights = np.zeros(FEATURES)
    weights[known] = found[:-k]
    return Model(weights, found[-k] + np.concatenate([[0.0], np.cumsum(np.exp(found[len(found) - k + 1 :]))]))


def rated_sample(docs: DataFrame, ratings: DataFrame, max_rated: int) -> DataFrame:
    """`text`, `grade` of at most `max_rated` rated documents, by hash of the id.

    `docs` has doc_id and text, `ratings` has doc_id and grade.
    """
    rated = ratings.where("grade IS NOT NULL AND doc_id IS NOT NULL").withColumn(
        "order", F.xxhash64("doc_id", "grade").bitwiseAND((1 << 53) - 1) / float(1 << 53)
    )
    n = rated.count()
    chosen = materialize(
        rated.where(F.col("order") < min(1.0, 1.3 * max_rated / max(1, n)) if n > max_rated else F.lit(True))
        .orderBy("order", "doc_id", "grade").limit(max_rated),
        "rated",
    )
    # At most `max_rated` rows of two numbers.
    return docs.join(F.broadcast(chosen), "doc_id").select("text", "grade", "order")


def train(
    docs: DataFrame, ratings: DataFrame, grades: int, max_rated: int = MAX_RATED, max_entries: int = MAX_ENTRIES
) -> Model:
    """Fit on a bounded sample; the driver receives its hashed features only."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", _SLICE_BYTES)):
            found, counts = featurise(batch.column("text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), batch.column("order"), pa.ListArray.from_arrays(offsets, pa.array(found))],
                names=["grade", "order", "features"],
            )

    sample = rated_sample(docs, ratings, max_rated).select("text", F.col("grade").cast("int").alias("grade"), "order")
    hashed = materialize(sample.mapInArrow(features, "grade int, order double, features array<int>"), "features")
    # Beyond the entries the driver may hold, the rows latest in the order go.
    n, entries = hashed.agg(F.count("*"), F.sum(F.size("features"))).first()
    if n and entries > max_entries:
        hashed = hashed.where(F.col("order") < max_entries / entries * hashed.agg(F.max("order")).first()[0])
    rows = hashed.orderBy("order", "grade", F.size("features")).toArrow()
    if not rows.num_rows:
        return Model(None, np.zeros(grades - 1))
    lists = rows.column("features").combine_chunks()
    return fit(
        pc.list_flatten(lists).to_numpy(zero_copy_only=False),
        pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64),
        rows.column("grade").to_numpy().astype(np.int64),
        grades,
    )


def score(rows: DataFrame, model: Model, wanted: int, keep: list[str], text: str) -> DataFrame:
    """`keep` plus the expected grade and the tail P(grade >= wanted), row by row.

    They are called `_grade` and `_tail`, or as `unused` says. Without anything
    learned the tail is 1.
    """
    held = rows.sparkSession.sparkContext.broadcast(model)
    made = [T.StructField(unused(c, keep), T.DoubleType()) for c in ("_grade", "_tail")]
    schema = T.StructType([*(rows.schema[c] for c in keep), *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in (part for whole in batches for part in slices(whole, text, _SLICE_BYTES)):
            n = batch.num_rows
            if model.weights is None:
                grade, tail = np.full(n, float(len(model.thresholds))), np.ones(n)
            else:
                texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
                tails = model.tails(model.score(*featurise(texts)))
                grade, tail = tails.sum(axis=1), tails[:, wanted - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in keep), pa.array(grade), pa.array(tail)],
                names=schema.names,
            )

    columns = keep if text in keep else [*keep, text]
    return rows.select(*(column(c) for c in columns)).mapInArrow(run, schema)


def grades_of(labels: DataFrame, quality: Column, toxic: Column, id_col: str = "doc_id") -> DataFrame:
    """Grades from two marks: 0 toxic, 1 of low quality, 2 good."""
    grade = F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)
    return labels.select(column(id_col).alias("doc_id"), grade.alias("grade"))


def grade(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grades: int = 3,
    wanted: int = 2,
    min_tail: float = 0.5,
    max_rated: int = MAX_RATED,
) -> DataFrame:
    """`doc_id`, `expected_grade`, `tail`, `kept` for each row of `docs`.

    A row is kept when its probability of at least grade `wanted` is `min_tail`
    or more.
    """
    rows = id_and_text(docs, id_col, text_col)
    model = train(rows, ratings, grades, max_rated)
    return score(rows, model, wanted, ["doc_id"], "text").select(
        "doc_id",
        F.col("_grade").alias("expected_grade"),
        F.col("_tail").alias("tail"),
        (F.col("_tail") >= min_tail).alias("kept"),
    )


def keep_good(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grades: int = 3,
    wanted: int = 2,
    min_tail: float = 0.5,
    max_rated: int = MAX_RATED,
) -> DataFrame:
    """The rows of `docs`, all columns, that the model does not reject."""
    model = train(id_and_text(docs, id_col, text_col), ratings, grades, max_rated)
    scored = score(docs, model, wanted, list(docs.columns), text_col)
    return scored.where(F.col(unused("_tail", docs.columns)) >= min_tail).select(*(column(c) for c in docs.columns))
