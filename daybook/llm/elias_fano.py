"""Elias-Fano coding of a non-decreasing sequence of whole numbers.

A value is cut into low bits, stored side by side, and a high part, stored as
the number of zeros before the value's one in a bit vector. That takes about
2 + log2(universe / count) bits for each value. Samples of the ones' places let
`select` find a value by looking at a few bytes.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QBQQQ")


def encode(values: np.ndarray, universe: int) -> bytes:
    """`values` (sorted, from 0 to `universe`) as bytes."""
    n = len(values)
    values = values.astype(np.uint64)
    low = max(0, (universe // n).bit_length() - 1) if n else 0
    bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    lows = np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
    high[ones] = 1
    highs = np.packbits(high, bitorder="little").tobytes()
    # Places of every 256th one, in 32 bits unless the vector is longer.
    samples = ones[::SAMPLE].astype("<u4" if len(high) < 1 << 32 else "<u8").tobytes()
    return _HEAD.pack(n, low, len(lows), len(highs), len(samples)) + lows + highs + samples


class Sequence:
    """Read access to an encoded sequence, one value or all."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        self.n, self.low, a, b, c = _HEAD.unpack(data[: _HEAD.size])
        at = _HEAD.size
        self.lows, self.highs, samples = data[at : at + a], data[at + a : at + a + b], data[at + a + b : at + a + b + c]
        wide = self.n and c == 8 * -(-self.n // SAMPLE)
        self.samples = np.frombuffer(samples, dtype="<u8" if wide else "<u4")
        self.size = at + a + b + c

    def select(self, i: int) -> int:
        """Value number `i`, from 0."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.samples[i // SAMPLE])
        missing = i % SAMPLE  # ones to go after that place
        byte = place >> 3
        rest = self.highs[byte] >> (place & 7) >> 1
        if missing:
            place += 1
            while True:
                ones = rest.bit_count()
                if ones >= missing:
                    while True:
                        if rest & 1:
                            missing -= 1
                            if not missing:
                                break
                        rest >>= 1
                        place += 1
                    break
                missing -= ones
                byte += 1
                place = byte << 3
                rest = self.highs[byte]
        first = i * self.low
        end = first + self.low
        raw = int.from_bytes(self.lows[first >> 3 : (end + 7) >> 3], "little") >> (first & 7)
        return (place - i) << self.low | raw & ((1 << self.low) - 1)

    def all(self) -> np.ndarray:
        """All values in order, as int64."""
        if not self.n:
            return np.zeros(0, dtype=np.int64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.highs, dtype=np.uint8), bitorder="little"))
        values = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bits = np.unpackbits(np.frombuffer(self.lows, dtype=np.uint8), bitorder="little", count=self.n * self.low)
            weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
            values |= (bits.reshape(self.n, self.low).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
        return values.astype(np.int64)
