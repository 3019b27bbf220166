"""Elias-Fano coding of non-decreasing integer sequences, with a sampled select structure.

Layout of the bytes (little-endian): ``<QQBxxxI`` count, upper bound, low bits per value,
number of select samples; then the samples (``uint32`` bit positions of every 256th one),
the packed low bits and the high part in unary: value ``i`` sets bit ``(v >> low) + i``.
About ``2 + log2(bound / count)`` bits a value, and no table of 64-bit offsets.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQBxxxI")
SAMPLE = 256


def encode(values) -> bytes:
    """The code of a non-decreasing sequence of integers from 0 to 2**62."""
    v = np.asarray(values, np.int64)
    n = len(v)
    if n and (v[0] < 0 or (np.diff(v) < 0).any()):
        raise ValueError("Elias-Fano needs a non-decreasing sequence of non-negative integers")
    bound = int(v[-1]) if n else 0
    low = max(0, (bound // n).bit_length() - 1) if n else 0
    ones = (v >> low) + np.arange(n)
    high = np.zeros((int(ones[-1]) + 8) // 8 if n else 0, np.uint8)
    np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
    bits = ((v[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    lows = np.packbits(bits.ravel(), bitorder="little")
    samples = ones[::SAMPLE].astype("<u4")
    return _HEAD.pack(n, bound, low, len(samples)) + samples.tobytes() + lows.tobytes() + high.tobytes()


class EliasFano:
    """Reader over the bytes: ``select(i)`` is the i-th value, ``values()`` all of them."""

    def __init__(self, data: bytes):
        self.count, self.bound, self.low, samples = _HEAD.unpack_from(data)
        at = _HEAD.size
        self.samples = np.frombuffer(data, "<u4", samples, at)
        at += 4 * samples
        size = (self.count * self.low + 7) // 8
        self.lows = np.frombuffer(data, np.uint8, size, at)
        self.high = np.frombuffer(data, np.uint8, len(data) - at - size, at + size)

    def __len__(self) -> int:
        return self.count

    def _low(self, i: int) -> int:
        start = i * self.low
        part = self.lows[start >> 3:(start + self.low + 7) >> 3].tobytes()
        return (int.from_bytes(part, "little") >> (start & 7)) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it and the ones up to it."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        pos = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte, skip = pos >> 3, pos & 7
        word = int(self.high[byte]) >> skip << skip
        while left >= (ones := word.bit_count()):
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        pos = (byte << 3) + (word & -word).bit_length() - 1
        return ((pos - i) << self.low) | self._low(i)

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.count]
        high = (ones - np.arange(self.count)) << self.low
        if not self.low:
            return high
        bits = np.unpackbits(self.lows, bitorder="little")[:self.count * self.low].reshape(self.count, self.low)
        return high | (bits.astype(np.int64) << np.arange(self.low)).sum(axis=1)
