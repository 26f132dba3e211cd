"""Elias-Fano encoded ascending numbers with select, in numpy."""

from __future__ import annotations

import numpy as np

SAMPLE = 256


class EliasFano:
    """Ascending numbers in about two bits each plus the bits below their mean gap.

    The low bits lie packed side by side; the high bits are written in unary, a one for each
    number behind a zero for each step. The place of every 256th one is kept, so the i-th
    number is found by reading on from there.
    """

    def __init__(self, count: int, width: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.width = count, width
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        shift = np.uint64(width)
        if width:
            bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        else:
            low = b""
        ones = (values >> shift).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little").tobytes()
        return cls(n, width, low, high, ones[::SAMPLE].astype(np.uint32).tobytes())

    def select(self, i: int) -> int:
        """The i-th number, from the nearest sample on."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        place = int(np.frombuffer(self.samples, np.uint32)[i // SAMPLE])
        left = i % SAMPLE
        high = np.frombuffer(self.high, np.uint8)
        byte = place // 8
        ones = np.flatnonzero(np.unpackbits(high[byte : byte + 1], bitorder="little"))
        ones = ones[ones >= place % 8]
        while left >= len(ones):
            left -= len(ones)
            byte += 1
            ones = np.flatnonzero(np.unpackbits(high[byte : byte + 1], bitorder="little"))
        upper = byte * 8 + int(ones[left]) - i
        lower = 0
        for k in range(self.width):
            bit = i * self.width + k
            lower |= (self.low[bit // 8] >> (bit % 8) & 1) << k
        return upper << self.width | lower

    def values(self) -> np.ndarray:
        """All numbers."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        upper = (ones[: self.count] - np.arange(self.count)).astype(np.uint64)
        if not self.width or not self.count:
            return upper
        bits = np.unpackbits(
            np.frombuffer(self.low, np.uint8), bitorder="little", count=self.count * self.width
        ).reshape(self.count, self.width)
        lower = bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.width, dtype=np.uint64))
        return upper << np.uint64(self.width) | lower
