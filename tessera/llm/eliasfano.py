"""Elias-Fano coding of sorted numbers, with select.

n numbers below 2**64 in nondecreasing order, less the first of them: the low bits of each
one packed, the high bits as a bit vector in which the i-th one stands at the high part plus
i. That is at most 2 + log2(range / n) bits a number. For select, the place of every 256th
one is kept in 32 bits, an eighth of a bit a number; no offset is stored whole.
"""

from __future__ import annotations

import struct

import numpy as np

EVERY = 256
_HEAD = struct.Struct("<QQBQ")  # numbers, the first one, low bits, bytes of high bits


def build(values: np.ndarray) -> bytes:
    """The code of nondecreasing unsigned numbers; fewer than 2**30 of them."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0, 0)
    if n >= 1 << 30:
        raise ValueError("too many numbers for 32-bit places")
    first = int(values[0])
    rest = values - values[0]
    low_bits = max(0, (int(rest[-1]) // n).bit_length() - 1)
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = b"".join(
        np.packbits(((rest[at : at + 65_536, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        for at in range(0, n, 65_536)  # a multiple of 8 numbers, so pieces end with whole bytes
    )
    ones = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(ones[-1]) + 1, np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    return _HEAD.pack(n, first, low_bits, len(high)) + low + high + ones[::EVERY].astype("<u4").tobytes()


class EliasFano:
    """The numbers of a code that ``build`` made; reads the buffer in place."""

    def __init__(self, code: bytes | memoryview):
        self.n, self.first, self.low_bits, n_high = _HEAD.unpack_from(code)
        low_end = _HEAD.size + (self.n * self.low_bits + 7) // 8
        self.low = np.frombuffer(code, np.uint8, low_end - _HEAD.size, _HEAD.size)
        self.high = np.frombuffer(code, np.uint8, n_high, low_end)
        self.samples = np.frombuffer(code, "<u4", -(-self.n // EVERY), low_end + n_high)

    def __len__(self) -> int:
        return self.n

    def _ones(self, block: int, blocks: int) -> np.ndarray:
        """Places of the ones from one sample on."""
        lo = int(self.samples[block])
        hi = int(self.samples[block + blocks]) if block + blocks < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[lo >> 3 : (hi + 7) >> 3], bitorder="little")
        bits[: lo & 7] = 0
        return np.flatnonzero(bits) + (lo & ~7)

    def select(self, start: int, stop: int | None = None) -> np.ndarray | int:
        """The number at ``start``, or those from start to before stop."""
        if stop is None:
            return int(self.select(start, start + 1)[0])
        if not 0 <= start <= stop <= self.n:
            raise IndexError(start)
        if start == stop:
            return np.zeros(0, np.uint64)
        block = start // EVERY
        ones = self._ones(block, (stop - 1) // EVERY - block + 1)[start - block * EVERY :][: stop - start]
        at = np.arange(start, stop)
        out = (ones - at).astype(np.uint64) << np.uint64(self.low_bits)
        for k in range(self.low_bits):
            bit = at * self.low_bits + k
            out |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & np.uint8(1)).astype(np.uint64) << np.uint64(k)
        return out + np.uint64(self.first)

    def locate(self, value: int) -> int:
        """The largest index whose number is at most ``value``; -1 if all are larger."""
        lo, hi = -1, self.n - 1
        while lo < hi:
            middle = (lo + hi + 1) // 2
            lo, hi = (middle, hi) if self.select(middle) <= value else (lo, middle - 1)
        return lo
