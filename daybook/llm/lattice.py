"""Scoring texts by a subword lattice: all segmentations weigh in.

The model. A text is a row of words (runs of characters that are not ASCII white
space, A-Z in lower case) and one end. A word is drawn whole with its discounted
frequency in the training texts, or else spelled by pieces of an existing
subword vocabulary: pieces are drawn one after the other by their scores until
the end-of-word piece comes. Characters outside the vocabulary are spelled by
their bytes. The probability of a word is the sum over all ways to produce it;
the forward recursion in log space along the word's characters gives it, the
whole word being one more edge of the lattice. As no piece crosses a word, the
document's forward value is the sum of its words' values.

Training. Words are counted over all training documents; the discount follows
from the numbers of words seen once and twice, and what it frees is the weight
of spelling. The scores of the pieces are expected counts over all
segmentations of all training words, each word once, as new words resemble rare
ones; a few forward-backward passes in Spark refine them.

Scoring. Every distinct word is scored once, in Spark. Texts are taken apart
twice: to count their words, and to look up the words that are as frequent as a
bound on their number allows, which every task gets. Only the other words of a
text are shuffled, each with its number, and joined with their scores; the
result is the same wherever the bound lies.

Beside the model's score stands that of the lattice alone, which spells every
word by pieces.

Null text counts as empty: one end token. A null id counts as the empty string
when documents are held out. Repeated rows give one result row each. Texts of
any length are read in parts. Without training documents every word is spelled
by evenly weighted pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import id_and_text
from daybook.llm.words import byte_kinds, words_in
from daybook.workspace import materialize

# No word contains a blank, so this is a token of its own.
END = " "
# The vocabulary's mark for the start of a word.
MARK = "▁"
SMOOTHING = 0.1
MAX_PIECES = 200_000
BROADCAST_WORDS = 300_000
BROADCAST_WORD_BYTES = 64
# Words up to this length are scored many at a time, longer ones one by one.
LONGEST_TOGETHER = 32
# Text taken apart at a time, in bytes; the six white characters part words.
_STEP = 4 << 20
_KINDS = byte_kinds(b" \t\n\x0b\x0c\r")
_TINY = -1e300
_CHARACTER_BITS = 21


def read_vocabulary(path: str, max_pieces: int = MAX_PIECES) -> list[str]:
    """The pieces of a subword model file, lower-cased, without special ones.

    A piece that starts a word carries the mark in front.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = set()
    for n in range(model.get_piece_size()):
        if model.is_unknown(n) or model.is_control(n) or model.is_byte(n) or model.is_unused(n):
            continue
        piece = model.id_to_piece(n)
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in piece)
        # The mark only at the start; a word has no white space.
        if MARK not in lower[1:] and lower != MARK and not lower.encode().split() == []:
            pieces.add(lower)
    if len(pieces) > max_pieces:
        raise ValueError(f"{len(pieces)} pieces; the vocabulary is sent to every task, {max_pieces} at most")
    return sorted(pieces)


@dataclass
class Pieces:
    """Natural-log scores of pieces, of single bytes, and of the end of a word."""

    scores: dict[str, float]
    byte_scores: list[float]
    end: float

    @classmethod
    def even(cls, pieces: list[str]) -> Pieces:
        flat = -math.log(len(pieces) + 257)
        return cls(dict.fromkeys(pieces, flat), [flat] * 256, flat)

    @classmethod
    def from_counts(cls, pieces: list[str], counts: dict[str, float], smoothing: float = SMOOTHING) -> Pieces:
        """`counts` by piece, ``byte:n`` and ``end``, all smoothed alike."""
        total = sum(counts.values()) + smoothing * (len(pieces) + 257)
        score = lambda k: math.log((counts.get(k, 0.0) + smoothing) / total)
        return cls(
            {p: score(f"piece:{p}") for p in pieces}, [score(f"byte:{b}") for b in range(256)], score("end")
        )

    def widest(self) -> int:
        return max(map(len, self.scores), default=1)


def edges(word: str, pieces: Pieces, widest: int) -> Iterator[tuple[int, int, float, str | None]]:
    """(from, to, score, piece or None for the bytes of a character), by `to`.

    Place 0 is before the word's mark, which the first piece holds.
    """
    scores, n = pieces.scores, len(word)
    for to in range(1, n + 1):
        for start in range(max(0, to - widest), to):
            piece = word[start:to] if start else MARK + word[:to]
            score = scores.get(piece)
            if score is not None:
                yield start, to, score, piece
        spelled = sum(pieces.byte_scores[b] for b in word[to - 1].encode("utf-8", "surrogatepass"))
        yield to - 1, to, spelled, None


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > _TINY else a


def spelled(word: str, pieces: Pieces, widest: int) -> float:
    """Log probability of a word by pieces: the forward value at its end."""
    forward = [_TINY] * (len(word) + 1)
    forward[0] = 0.0
    for start, to, score, _ in edges(word, pieces, widest):
        if forward[start] > _TINY:
            forward[to] = _add(forward[to], forward[start] + score)
    return forward[-1] + pieces.end


def expected(word: str, pieces: Pieces, widest: int, into: dict[str, float]) -> None:
    """Add the expected use of each piece in one word, over all segmentations."""
    all_edges = list(edges(word, pieces, widest))
    forward = [_TINY] * (len(word) + 1)
    backward = [_TINY] * (len(word) + 1)
    forward[0] = backward[-1] = 0.0
    for start, to, score, _ in all_edges:
        forward[to] = _add(forward[to], forward[start] + score)
    for start, to, score, _ in reversed(all_edges):
        backward[start] = _add(backward[start], backward[to] + score)
    whole = forward[-1]
    for start, to, score, piece in all_edges:
        part = math.exp(forward[start] + score + backward[to] - whole)
        if part < 1e-9:
            continue
        if piece is not None:
            key = f"piece:{piece}"
            into[key] = into.get(key, 0.0) + part
        else:
            for b in word[to - 1].encode("utf-8", "surrogatepass"):
                key = f"byte:{b}"
                into[key] = into.get(key, 0.0) + part
    into["end"] = into.get("end", 0.0) + 1.0


class Trie:
    """The pieces as steps from node to node by a character, for many words at once."""

    def __init__(self, pieces: Pieces):
        steps: dict[int, int] = {}
        scores, names = [-np.inf], [""]
        for piece, score in pieces.scores.items():
            at = 0
            for c in piece:
                key = at << _CHARACTER_BITS | ord(c)
                if key not in steps:
                    steps[key] = len(scores)
                    scores.append(-np.inf)
                    names.append("")
                at = steps[key]
            scores[at], names[at] = score, piece
        self.keys = np.array(sorted(steps), dtype=np.int64)
        self.to = np.array([steps[k] for k in self.keys.tolist()], dtype=np.int64)
        self.scores, self.names = np.array(scores), names
        self.after_mark = steps.get(ord(MARK), -1)
        self.byte_scores, self.end = pieces.byte_scores, pieces.end

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The next nodes; -1 where no piece goes on."""
        wanted = nodes << _CHARACTER_BITS | chars
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.to[at], -1)

    def edges(self, chars: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(to, words, nodes) of the pieces from place `start`; see `edges` above."""
        words = np.arange(len(chars))
        first = 0 if start else self.after_mark
        if first < 0 or not len(self.keys):
            return
        nodes = np.full(len(words), first, dtype=np.int64)
        for to in range(start + 1, chars.shape[1] + 1):
            nodes = self.step(nodes, chars[words, to - 1])
            go_on = nodes >= 0
            words, nodes = words[go_on], nodes[go_on]
            if not len(words):
                return
            ends = self.scores[nodes] > -np.inf
            yield to, words[ends], nodes[ends]


def _of_one_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, characters as a matrix) of the words of each length."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for n in np.unique(lengths[lengths <= LONGEST_TOGETHER]).tolist():
        where = np.flatnonzero(lengths == n)
        text = "".join(words[i] for i in where.tolist()).encode("utf-32-le", "surrogatepass")
        yield where, np.frombuffer(text, dtype="<u4").astype(np.int64).reshape(len(where), n)


def _forward(chars: np.ndarray, trie: Trie) -> tuple[np.ndarray, np.ndarray, list, np.ndarray, np.ndarray]:
    """Forward values by place and word, scores of single characters, all edges.

    The last two are the different characters and where each stands.
    """
    known, at = np.unique(chars, return_inverse=True)
    by_bytes = np.array([sum(trie.byte_scores[b] for b in chr(c).encode("utf-8", "surrogatepass")) for c in known])
    at = at.reshape(chars.shape)
    single = by_bytes[at] if len(known) else np.zeros(chars.shape)
    forward = np.full((chars.shape[1] + 1, len(chars)), -np.inf)
    forward[0] = 0.0
    found = []
    for start in range(chars.shape[1]):
        for to, words, nodes in trie.edges(chars, start):
            forward[to, words] = np.logaddexp(forward[to, words], forward[start, words] + trie.scores[nodes])
            found.append((start, to, words, nodes))
        forward[start + 1] = np.logaddexp(forward[start + 1], forward[start] + single[:, start])
    return forward, single, found, known, at


def spelled_many(words: list[str], pieces: Pieces, trie: Trie) -> np.ndarray:
    """`spelled` for each word."""
    out = np.zeros(len(words))
    for where, chars in _of_one_length(words):
        out[where] = _forward(chars, trie)[0][-1] + trie.end
    widest = pieces.widest()
    for i, word in enumerate(words):
        if len(word) > LONGEST_TOGETHER:
            out[i] = spelled(word, pieces, widest)
    return out


def expected_many(words: list[str], pieces: Pieces, trie: Trie, into: dict[str, float]) -> None:
    """`expected` of all words."""
    uses = np.zeros(len(trie.scores))
    for where, chars in _of_one_length(words):
        forward, single, found, known, at = _forward(chars, trie)
        backward = np.full(forward.shape, -np.inf)
        backward[-1] = 0.0
        at_start: dict[int, list] = {}
        for edge in found:
            at_start.setdefault(edge[0], []).append(edge)
        by_bytes = np.zeros(len(known))
        for start in range(chars.shape[1] - 1, -1, -1):
            backward[start] = backward[start + 1] + single[:, start]
            part = np.exp(forward[start] + backward[start] - forward[-1])
            by_bytes += np.bincount(at[:, start], part, minlength=len(known))
            for _, to, some, nodes in at_start.get(start, ()):
                way = trie.scores[nodes] + backward[to, some]
                backward[start, some] = np.logaddexp(backward[start, some], way)
                uses += np.bincount(nodes, np.exp(forward[start, some] + way - forward[-1, some]), minlength=len(uses))
        for c, n in zip(known.tolist(), by_bytes.tolist()):
            for b in chr(c).encode("utf-8", "surrogatepass"):
                into[f"byte:{b}"] = into.get(f"byte:{b}", 0.0) + n
        into["end"] = into.get("end", 0.0) + float(len(where))
    for node in np.flatnonzero(uses).tolist():
        key = f"piece:{trie.names[node]}"
        into[key] = into.get(key, 0.0) + float(uses[node])
    widest = pieces.widest()
    for word in words:
        if len(word) > LONGEST_TOGETHER:
            expected(word, pieces, widest, into)


def _train_pieces(words: DataFrame, pieces: list[str], passes: int) -> Pieces:
    """Scores from the distinct training words; one Spark job for each pass.

    The driver gets one sum for each piece of the vocabulary at most.
    """
    model = Pieces.even(pieces)
    spark = words.sparkSession
    for _ in range(passes):
        held = spark.sparkContext.broadcast((model, Trie(model)))

        def count(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            (model, trie), sums = held.value, {}
            for batch in batches:
                expected_many(batch.column(0).to_pylist(), model, trie, sums)
            yield pa.RecordBatch.from_pydict(
                {"piece": pa.array(list(sums), pa.string()), "n": pa.array(list(sums.values()), pa.float64())}
            )

        counted = words.select("token").mapInArrow(count, "piece string, n double")
        # In a fixed order, so that reruns add up alike.
        totals = counted.groupBy("piece").agg(F.aggregate(F.array_sort(F.collect_list("n")), F.lit(0.0), lambda a, b: a + b).alias("n"))
        model = Pieces.from_counts(pieces, {r.piece: r.n for r in totals.collect()})
        held.unpersist()
    return model


def score_words(counts: DataFrame, vocabulary: list[str], passes: int) -> tuple[DataFrame, int]:
    """`token`, `n_all`, `c`, `base`, `score`, `lattice` (log10) per word; training tokens.

    `counts` has `token`, `c` (count in training documents), `n_all`. The
    lattice alone has no other way to the end of a text than the model.
    """
    seen = F.col("c") > 0
    n, v, n1, n2 = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(seen), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
    ).first()
    discount = min(0.95, n1 / (n1 + 2 * n2)) if n1 else 0.5
    spelling = discount * v / n if n else 1.0
    train = counts.where(seen & (F.col("token") != END))
    pieces = _train_pieces(train, vocabulary, passes if n else 0)
    spark = counts.sparkSession
    held = spark.sparkContext.broadcast((pieces, Trie(pieces)))
    log_spelling = math.log(spelling)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, trie = held.value
        for batch in batches:
            scores, alone = [], []
            tokens = batch.column("token").to_pylist()
            spellings = spelled_many(tokens, model, trie).tolist()
            for token, c, spelling in zip(tokens, batch.column("c").to_pylist(), spellings):
                whole = math.log((c - discount) / n) if c else _TINY
                by_pieces = _TINY if token == END else spelling + log_spelling
                least = -1e4 * (len(token) + 1)
                scores.append(max(_add(whole, by_pieces), least) / math.log(10))
                alone.append(max(whole if token == END else spelling, least) / math.log(10))
            made = [pa.array(scores, pa.float64()), pa.array(alone, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    schema = T.StructType([*counts.schema, T.StructField("score", T.DoubleType()), T.StructField("lattice", T.DoubleType())])
    base = F.log10((F.col("c") + SMOOTHING) / F.lit(n + SMOOTHING * (v + 1)))
    return counts.mapInArrow(score, schema).withColumn("base", base), n


def frequent(scored: DataFrame, at_most: int = BROADCAST_WORDS) -> DataFrame:
    """The most frequent short words, as many as the bound allows.

    Words of equal frequency go in together or not at all.
    """
    short = F.octet_length("token") <= BROADCAST_WORD_BYTES
    # Frequencies by their two leading binary digits: some hundred rows.
    level = F.floor(F.log2("n_all") * 4)
    tally = sorted(scored.where(short).groupBy(level.alias("level")).count().collect(), reverse=True)
    total, lowest = 0, None
    for r in tally:
        total += r["count"]
        if total > at_most:
            break
        lowest = r["level"]
    return scored.where(short & (level >= F.lit(lowest).cast("long"))) if lowest is not None else scored.limit(0)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`token`, `c`, `n_all` of some texts at a time, and of their ends."""
    schema = pa.schema([("token", pa.string()), ("c", pa.int64()), ("n_all", pa.int64())])
    for batch in batches:
        trained = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        yield pa.RecordBatch.from_pydict({"token": [END], "c": [int(trained.sum())], "n_all": [len(trained)]}, schema)
        for found, rows in words_in(batch, _STEP, _KINDS):
            size = len(found.words)
            use = trained[rows[found.text]]
            counts = [np.bincount(code, minlength=size) for code in (found.code[use], found.code)]
            yield pa.RecordBatch.from_arrays([found.words.cast(pa.string()), *map(pa.array, counts)], schema=schema)


_SUMS = ("base", "score", "lattice")


def _look_up(common, names: list[str]):
    """Sums over the common words of each text, and its other words with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = common.value
        words = table.column("token").combine_chunks().cast(pa.binary())
        values = {c: np.append(table.column(c).to_numpy(), 0.0) for c in _SUMS}
        known = np.append(table.column("c").to_numpy() > 0, False).astype(float)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for found, rows in words_in(batch, _STEP, _KINDS):
                n, size = len(rows), max(1, len(found.words))
                at = pc.index_in(found.words, value_set=words).fill_null(len(words)).to_numpy(zero_copy_only=False)
                place = at[found.code]
                add = lambda v: np.bincount(found.text, v[place], minlength=n)  # noqa: B023, E731
                rare = place == len(words)
                pairs, times = np.unique(found.text[rare] * size + found.code[rare], return_counts=True)
                ends = np.cumsum(np.bincount(pairs // size, minlength=n))
                others = pa.StructArray.from_arrays(
                    [found.words.take(pa.array(pairs % size)).cast(pa.string()), pa.array(times.astype(np.int64))],
                    ["token", "times"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + rows),
                        *(batch.column(c).take(pa.array(rows)) for c in ("doc_id", "held_out")),
                        pa.array(np.bincount(found.text[~rare], minlength=n).astype(np.int64)),
                        pa.array(add(known).astype(np.int64)),
                        *(pa.array(add(values[c])) for c in _SUMS),
                        pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), others),
                    ],
                    names=names,
                )
            row += batch.num_rows

    return run


def score_documents(
    docs: DataFrame,
    vocabulary: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    hold_out: int = 10,
    passes: int = 2,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """Train on most documents, score all.

    Documents whose crc32 of the id as text is divisible by `hold_out` are held
    out of training. Returns `doc_id`, `held_out`, `n_tokens`, `n_known`,
    `train_tokens`, `base_score`, `score`, `lattice_score` (log10 probabilities).
    """
    rows = id_and_text(docs, id_col, text_col)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % hold_out == 0
    rows = rows.withColumn("held_out", held_out)
    counted = rows.select("held_out", "text").mapInArrow(_count_words, "token string, c long, n_all long")
    counts = materialize(counted.groupBy("token").agg(F.sum("c").alias("c"), F.sum("n_all").alias("n_all")), "words")
    scored, n = score_words(counts, vocabulary, passes)
    scored = materialize(scored, "scored-words").select("token", "n_all", "c", *_SUMS)
    words = scored.where(F.col("token") != END)
    # At most `broadcast_words` rows of bounded length.
    common = frequent(words, broadcast_words).select("token", "c", *_SUMS).toArrow()
    end = scored.where(F.col("token") == END).first()
    if end is None:
        end = {"c": 0, **dict.fromkeys(_SUMS, 0.0)}

    others = T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("times", T.LongType())]))
    schema = T.StructType(
        [
            T.StructField("row_id", T.LongType()), rows.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
            *(T.StructField(c, T.DoubleType()) for c in _SUMS), T.StructField("others", others),
        ]
    )
    look_up = _look_up(rows.sparkSession.sparkContext.broadcast(common), schema.names)
    # Row numbers become fixed when the rows are written.
    near = materialize(rows.select("doc_id", "held_out", "text").mapInArrow(look_up, schema), "looked-up")
    totals = ("n_tokens", "n_known", *_SUMS)
    far = (
        near.select("row_id", F.explode("others").alias("o"))
        .select("row_id", "o.token", "o.times")
        .join(words, "token")
        .groupBy("row_id")
        .agg(
            F.sum("times").alias("n_tokens"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
            *(F.sum(F.col(c) * F.col("times")).alias(c) for c in _SUMS),
        )
        .select("row_id", F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"), *totals)
    )
    both = (
        near.select("row_id", "doc_id", "held_out", *totals)
        .unionByName(far)
        .groupBy("row_id")
        .agg(
            F.first("doc_id", ignorenulls=True).alias("doc_id"), F.first("held_out", ignorenulls=True).alias("held_out"),
            *(F.sum(c).alias(c) for c in totals),
        )
    )
    return both.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + int(end["c"] > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end["base"])).alias("base_score"),
        (F.col("score") + F.lit(end["score"])).alias("score"),
        (F.col("lattice") + F.lit(end["lattice"])).alias("lattice_score"),
    )
