"""Words of many texts at once, as codes into a list of the different ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from daybook.llm.rows import slices

_WORD, _GAP, _BREAK = range(3)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def byte_kinds(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """A table of the bytes: those that part words, and those that part pieces of a text as well."""
    kinds = np.full(256, _WORD, dtype=np.uint8)
    kinds[list(gaps)] = _GAP
    kinds[list(breaks)] = _BREAK
    return kinds


class Words:
    """The words of some texts, A-Z in lower case.

    For each word in order: `code` (its place in `words`), `text` (the text's
    number) and `piece`, which differs between words that a break or the end of
    a text parts.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> None:
        kind = kinds[data]
        letter = kind == _WORD
        begins = letter.copy()
        begins[1:] &= ~letter[:-1]
        starts = ends[:-1]
        starts = starts[starts < len(data)]
        begins[starts] = letter[starts]
        at = np.flatnonzero(begins)
        self.text = np.searchsorted(ends, at, side="right") - 1
        self.piece = np.cumsum(kind == _BREAK)[at] + self.text
        before = np.cumsum(letter)[at] - 1
        spelled = _LOWER[data[letter]]
        offsets = np.append(before, len(spelled)).astype(np.int32)
        coded = pa.Array.from_buffers(
            pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(spelled)]
        ).dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = coded.dictionary
        self.counted = 0  # words at the start that the part of the text before has counted

    def __len__(self) -> int:
        return len(self.code)


def _parts(text: np.ndarray, step: int, overlap: int, kinds: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """A long text in parts, cut between words; parts begin with the last `overlap` words before them."""
    separators = kinds[text] != _WORD
    start, counted = 0, 0
    while start < len(text):
        end, firsts = start, np.zeros(0, dtype=np.int64)
        # Each part has a word that the one before did not have, however long.
        while end < len(text) and len(firsts) <= overlap:
            end += step
            while end < len(text) and not separators[end - 1]:
                gap = np.flatnonzero(separators[end : end + step])
                end += int(gap[0]) + 1 if len(gap) else step
            end = min(end, len(text))
            letter = ~separators[start:end]
            firsts = np.flatnonzero(letter & ~np.concatenate(([False], letter[:-1])))
        yield text[start:end], counted
        if end == len(text):
            return
        counted = overlap
        start = start + int(firsts[-overlap]) if overlap else end


def words_in(
    batch: pa.RecordBatch, step: int, kinds: np.ndarray, overlap: int = 0
) -> Iterator[tuple[Words, np.ndarray]]:
    """The words of the column `text`, some `step` bytes at a time, and the row of each text.

    A longer text comes alone, in parts that share `overlap` words.
    """
    row = 0
    for part in slices(batch, "text", step):
        text = part.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        body = text.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
        rows = np.arange(row, row + len(text))
        row += len(text)
        long = np.flatnonzero(np.diff(offsets) > step)
        for a, b in zip([0, *(long + 1)], [*long, len(text)]):
            if b > a:
                yield Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], kinds), rows[a:b]
            if b < len(text):
                whole = data[offsets[b] : offsets[b + 1]]
                for some, counted in _parts(whole, step, overlap, kinds):
                    found = Words(some, np.array([0, len(some)]), kinds)
                    found.counted = counted
                    yield found, rows[b : b + 1]
