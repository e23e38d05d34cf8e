"""Token ids of a corpus in files, with Elias-Fano document boundaries.

Documents are put in order by id over range partitions. Each task encodes its
documents into segments: the ids one after the other, then the document
boundaries and the document ids as Elias-Fano sequences. No table of 64-bit
offsets exists; `Segment.boundary(i)` selects an offset from the sequence.

A segment is a file. Spark writes it, so that any store Spark reaches will do
and a task that is run again leaves no second copy. Layout (little endian):
magic, bytes per id (2 or 4), number of ids, number of documents with a null id,
smallest document id, number of the part and of the segment in it, in the order
of the documents; the ids; the boundaries (one more than documents, from 0 to
the number of ids); the document ids above the smallest one; a line feed.

Document ids are whole numbers; other types are refused. Null text counts as
empty: its document holds the end id only. Null ids come first. Documents with
equal ids stand by their text. An empty table gives no segment and an empty
result. A segment has a bounded number of ids unless one document alone has
more.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm import elias_fano
from daybook.llm.rows import id_and_text, slices
from daybook.workspace import fresh_path, materialize

MAGIC = b"EFTOKID2"
_HEAD = struct.Struct("<8sBQQqII")
SEGMENT_IDS = 2_000_000
_CACHED_PIECES = 1_000_000
# Texts are cut up together up to this size in bytes, longer ones in parts.
_TOGETHER = 8 << 20
# New pieces that go through the tokenizer in one text.
_ENCODED_TOGETHER = 2_000
_LETTER, _SIGN = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN[list(b',.;:!?)("')] = True
# First bytes of the characters that are white space beyond ASCII.
_SPACE_LEADS = np.array([0xC2, 0xE1, 0xE2, 0xE3], dtype=np.uint8)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Whether a text may be cut before a byte.

    Single line feeds are cut out and single blanks lead what follows, both
    only between other characters; one that may be white space beyond ASCII
    never counts as such. Signs are cut from the letters before them.
    """
    n = len(data)
    solid = data > 0x20
    wide = np.isin(data, _SPACE_LEADS)
    # A text's last bytes may end, and its first ones may begin, such a character.
    before = solid.copy()
    before[1:] &= ~(wide[:-1] & (data[1:] >= 0x80))
    before[2:] &= ~(wide[:-2] & (data[2:] >= 0x80))
    after = solid & ~wide
    joint = np.zeros(n, dtype=bool)
    joint[1:-1] = before[:-2] & after[2:]
    cut = joint & (data <= 0x20)
    cut &= (data == 0x20) | (data == 0x0A)
    cut[1:] |= cut[:-1] & (data[:-1] == 0x0A)
    cut[1:] |= _LETTER[data[:-1]] & _SIGN[data[1:]]
    return cut


class Encoder:
    """Texts to ids with a byte-level tokenizer, one word at a time.

    The ids are those of the tokenizer's plain call on the whole text, without
    special tokens around it. A byte-level tokenizer cuts a text before it
    merges anything, and at the places of `_cuts` it always does. So texts are
    cut there, and each different piece goes through the tokenizer once; many
    new pieces together, a line feed between them, whose id no other piece has.
    Names of the tokenizer's own tokens inside a text are those tokens; texts
    with names that reach over blanks are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        before = rules["pre_tokenizer"] or {}
        # Only these rules are known to cut a text at the places of `_cuts`.
        self.cuttable = rules["normalizer"] is None and before.get("type") == "ByteLevel" and (
            before.get("use_regex", True) and not before.get("add_prefix_space", True)
        )
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.width = int(self.kind[-1])
        added = self.tokenizer.get_added_tokens_decoder().values()
        plain = lambda t: not (t.lstrip or t.rstrip or t.single_word or t.normalized and not t.special)
        self.names = [t.content for t in added]
        self.odd = [t.content.encode() for t in added if not plain(t) or len(t.content.split()) != 1]
        self.known: dict[bytes, bytes] = {}
        feed = self._ids("\n")
        self.cuttable = self.cuttable and len(feed) == 1
        self.line_feed = feed[0]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces that are new, those that are one word together."""
        if len(self.known) + len(pieces) > _CACHED_PIECES:
            self.known.clear()
        together: list[bytes] = []
        for piece in pieces:
            text = piece.decode("utf-8", "replace")
            if text.split() == [text[text[0] == " " :]] and not any(name in text for name in self.names):
                together.append(piece)
            else:
                self.known[piece] = self._packed(self._ids(text))
        for a in range(0, len(together), _ENCODED_TOGETHER):
            some = together[a : a + _ENCODED_TOGETHER]
            ids = np.array(self._ids(b"\n".join(some).decode("utf-8", "replace")), dtype=self.kind)
            ends = np.append(np.flatnonzero(ids == self.line_feed), len(ids)).tolist()
            packed, width = ids.tobytes(), self.width
            starts = [0, *(e + 1 for e in ends[:-1])]
            self.known.update((p, packed[width * x : width * y]) for p, x, y in zip(some, starts, ends, strict=True))

    def _pieces(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, which begin at `starts`, and where the ids of each begin."""
        cut = _cuts(data)
        cut[starts] = True
        cuts = np.flatnonzero(cut)
        offsets = np.append(cuts, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(
            pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        pieces, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        self._learn([p for p in pieces if p not in self.known])
        if len(pieces) > len(self.known):  # the cache was emptied meanwhile
            self._learn([p for p in pieces if p not in self.known])
        found = [self.known[p] for p in pieces]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.width
        all_ids = np.frombuffer(b"".join(found), dtype=self.kind)
        first = np.cumsum(sizes) - sizes
        lengths = sizes[code]
        at = np.cumsum(lengths) - lengths
        ids = all_ids[np.repeat(first[code] - at, lengths) + np.arange(int(lengths.sum()))]
        return ids, np.append(at, len(ids))[np.searchsorted(cuts, starts)]

    def _long(self, data: np.ndarray) -> np.ndarray:
        """The ids of one text, in parts that end at cuts."""
        out, start = [], 0
        while start < len(data):
            size = _TOGETHER
            while True:
                end = min(start + size, len(data))
                if end == len(data):
                    break
                # A cut near the end could depend on what follows.
                cuts = np.flatnonzero(_cuts(data[start:end])[:-4])
                if len(cuts):
                    end = start + int(cuts[-1])
                    break
                size *= 2
            out.append(self._pieces(data[start:end], np.zeros(1, dtype=np.int64))[0])
            start = end
        return np.concatenate(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, d in enumerate(data):
            if not d:
                out[i] = np.zeros(0, dtype=self.kind)
            elif not self.cuttable or any(name in d for name in self.odd):
                out[i] = np.array(self._ids(texts[i]), dtype=self.kind)
            elif len(d) > _TOGETHER:
                out[i] = self._long(np.frombuffer(d, dtype=np.uint8))
            else:
                plain.append(i)
        if plain:
            sizes = np.array([len(data[i]) for i in plain], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            ids, at = self._pieces(np.frombuffer(b"".join(data[i] for i in plain), dtype=np.uint8), starts)
            for i, own in zip(plain, np.split(ids, at[1:])):
                out[i] = own
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(
    ids: bytes, width: int, lengths: list[int], doc_ids: list[int | None], part: int = 0, number: int = 0
) -> bytes:
    """A segment from its ids, the documents' lengths and their sorted ids."""
    bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    known = np.array([i for i in doc_ids if i is not None], dtype=object)
    least = int(known[0]) if len(known) else 0
    above = np.array([int(i) - least for i in known], dtype=np.uint64)
    head = _HEAD.pack(MAGIC, width, int(bounds[-1]), len(doc_ids) - len(known), least, part, number)
    return b"".join(
        [
            head,
            ids,
            elias_fano.encode(bounds, int(bounds[-1])),
            elias_fano.encode(above, int(above[-1]) if len(above) else 0),
        ]
    )


class Segment:
    """Read access to a segment's bytes."""

    def __init__(self, data: bytes):
        magic, self.width, n, self.null_ids, self.least, self.part, self.number = _HEAD.unpack(data[: _HEAD.size])
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = _HEAD.size
        self.ids = np.frombuffer(data, dtype=f"<u{self.width}", count=n, offset=at)
        at += n * self.width
        self.bounds = elias_fano.Sequence(memoryview(data)[at:])
        self.above = elias_fano.Sequence(memoryview(data)[at + self.bounds.size :])
        self.n_docs = self.bounds.n - 1

    def boundary(self, i: int) -> int:
        """Where document `i` of the segment starts."""
        return self.bounds.select(i)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.null_ids else self.least + self.above.select(i - self.null_ids)

    def tokens(self, i: int) -> np.ndarray:
        """The ids of document `i` of the segment."""
        return self.ids[self.boundary(i) : self.boundary(i + 1)]


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    segment_ids: int = SEGMENT_IDS,
    mode: str = "errorifexists",
) -> None:
    """Encode all documents into segments, the files of `folder`.

    `tokenizer` is the path of a byte-level tokenizer's file, the same on every
    machine. `mode` is that of Spark's writers.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} has to be a column of whole numbers")
    rows = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        end = np.array([end_id], dtype=coder.kind).tobytes()
        part, segment = TaskContext.get().partitionId(), 0
        held, lengths, names = [], [], []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, lengths, names, size, segment
            content = pack(b"".join(held), coder.width, lengths, names, part, segment)
            held, lengths, names, size, segment = [], [], [], 0, segment + 1
            return pa.RecordBatch.from_pydict({"content": pa.array([content], pa.binary())})

        for batch in (part for whole in batches for part in slices(whole, 1, _TOGETHER)):
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                n = len(ids) + 1
                if names and size + n > segment_ids:
                    yield flush()
                held += [ids.tobytes(), end]
                lengths.append(n)
                names.append(doc_id)
                size += n
        if names:
            yield flush()

    # The writer of text files writes the bytes as they are, one row to a file.
    segments = ordered.mapInArrow(run, "content binary").select(F.col("content").cast("string").alias("value"))
    segments.write.mode(mode).option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


_DOCUMENTS = "part long, segment long, place long, doc_id long, offset long, n_tokens long, ids_crc32 long, n_ids long"


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            s = Segment(content.as_py())
            starts = [s.boundary(i) for i in range(s.n_docs + 1)]
            wide = s.ids.astype("<u4").view(np.uint8)
            n = s.n_docs
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([s.part] * n, pa.int64()),
                    "segment": pa.array([s.number] * n, pa.int64()),
                    "place": pa.array(range(n), pa.int64()),
                    "doc_id": pa.array([s.doc_id(i) for i in range(n)], pa.int64()),
                    "offset": pa.array(starts[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(starts), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(starts, starts[1:])], pa.int64()),
                    "n_ids": pa.array([starts[-1]] * n, pa.int64()),
                }
            )


def segment_starts(segments: DataFrame) -> DataFrame:
    """`part`, `segment` and `base`, the ids of all segments before, from rows with `n_ids`.

    Sums go part by part: one number for each part meets in one task.
    """
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("n").over(over_parts), F.lit(0)).alias("before"))
    return segments.join(before, "part").select(
        "part", "segment", (F.col("before") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base")
    )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """What the files of `folder` hold, document by document.

    Returns `doc_id`, `start` (ids of all documents before), `n_tokens` and
    `ids_crc32` (over the ids as unsigned 32-bit numbers, little endian).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    found = materialize(files.where("length > 1").select("content").mapInArrow(_read_segments, _DOCUMENTS), "token-documents")
    starts = segment_starts(found.where("place = 0").select("part", "segment", "n_ids"))
    return found.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenize(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write the segments of `docs` and read them back; see `read_documents`."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    write_tokens(docs, folder, tokenizer, **options)
    return read_documents(spark, folder)
