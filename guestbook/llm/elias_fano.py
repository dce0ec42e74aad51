"""Elias-Fano encoding of ascending positions, with a select structure."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EVERY = 64


@dataclass
class EliasFano:
    """``count`` ascending positions up to ``universe``: about 2 + log2(universe / count) bits for each.

    The ``low_bits`` lowest bits of every position are packed; the rest is a bit vector in which the k-th set
    bit stands at (position >> low_bits) + k. ``samples`` holds the place of every 64th set bit, so that one
    position is read by scanning a few bytes.
    """

    count: int
    universe: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def of(cls, positions: np.ndarray, universe: int) -> EliasFano:
        positions = np.asarray(positions, np.int64)
        count = len(positions)
        low_bits = max(0, (universe // max(1, count)).bit_length() - 1)
        low = (positions[:, None] >> np.arange(low_bits)) & 1
        places = (positions >> low_bits) + np.arange(count)
        high = np.zeros((universe >> low_bits) + count + 1, np.uint8)
        high[places] = 1
        return cls(
            count,
            universe,
            low_bits,
            np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            places[::EVERY].astype("<u4").tobytes(),
        )

    def _low(self, first: int, count: int) -> np.ndarray:
        start, end = first * self.low_bits, (first + count) * self.low_bits
        packed = np.frombuffer(self.low, np.uint8)[start // 8 : -(-end // 8)]
        bits = np.unpackbits(packed, bitorder="little")[start % 8 :][: end - start].reshape(count, self.low_bits)
        return bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, k: int) -> int:
        """The k-th position, from the sample before it."""
        if not 0 <= k < self.count:
            raise IndexError(k)
        place, left = int(np.frombuffer(self.samples, "<u4")[k // EVERY]), k % EVERY
        bits, at = np.frombuffer(self.high, np.uint8), place // 8
        byte = int(bits[at]) & (0xFF << place % 8)
        while left >= byte.bit_count():
            left -= byte.bit_count()
            at += 1
            byte = int(bits[at])
        for _ in range(left):
            byte &= byte - 1
        place = at * 8 + (byte & -byte).bit_length() - 1
        return ((place - k) << self.low_bits) + int(self._low(k, 1)[0])

    def all(self) -> np.ndarray:
        """Every position in order."""
        places = np.nonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[0][: self.count]
        return ((places - np.arange(self.count)) << self.low_bits) + self._low(0, self.count)

    def n_bytes(self) -> int:
        return len(self.low) + len(self.high) + len(self.samples)
