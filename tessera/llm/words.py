"""Vectorised words of whole texts, shared by the operators of this subpackage.

A word is a run of bytes other than 0x20 and 0x09-0x0D. An Arrow batch is cut
into blocks of whole documents of about a megabyte, so the memory of a task
depends on the block and on the longest document alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

BLOCK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LONG = 64
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _ODD) -> np.ndarray:
    """base**i for i in 0..n-1, modulo 2**64; one table is kept per base."""
    table = _powers.get(int(base))
    if table is None or len(table) < n:
        table = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        if n <= 4 * BLOCK_BYTES:
            _powers[int(base)] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Block:
    """Some whole documents: their bytes and words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.n_docs = len(offsets) - 1
        full = offsets[1:] > offsets[:-1]
        self.doc_start, self.doc_end = offsets[:-1], offsets[1:]
        self.space = SPACE[data]
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:], after[:-1] = self.space[:-1], self.space[1:]
        before[self.doc_start[full]] = True
        after[self.doc_end[full] - 1] = True
        self.start = np.flatnonzero(~self.space & before)
        self.end = np.flatnonzero(~self.space & after) + 1
        #: word_offsets[d]: the number of words in the documents before d
        self.word_offsets = np.searchsorted(self.start, offsets)
        self.n_words = np.diff(self.word_offsets)
        self._codes: tuple[np.ndarray, pa.Array] | None = None

    @property
    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.n_words)

    def word_codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words alone, and the different words."""
        if self._codes is not None:
            return self._codes
        sizes = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=sizes[1:])
        letters = np.ascontiguousarray(self.data[~self.space])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(sizes), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        self._codes = coded.indices.to_numpy(), coded.dictionary
        return self._codes

    def word_hash(self) -> np.ndarray:
        """A hash of each word: eight bytes after the other, long words by XXH64."""
        size = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        out = mix(size.astype(np.uint64) + _ODD)
        left = np.flatnonzero(size <= _LONG)
        for at in range(0, _LONG, 8):
            left = left[size[left] > at]
            if not len(left):
                break
            some = np.minimum(size[left] - at, 8)
            out[left] = pair_hash(out[left], eight[self.start[left] + at] & _FIRST[some])
        for i in np.flatnonzero(size > _LONG).tolist():
            out[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.end[i]])
        return out

    def joined(self, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The words, each followed by one space, and where each starts (and all end)."""
        size = self.end - self.start
        place = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size + 1, out=place[1:])
        out = np.full(place[-1], 0x20, np.uint8)
        at = np.flatnonzero(~self.space)
        out[at + np.repeat(place[:-1] - self.start, size)] = LOWER[self.data[at]] if lower else self.data[at]
        return out, place

    def per_doc(self, flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The sum of flags (one for each byte, word or line) in every document."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of whole documents, in order; ``first`` is the row of a block's first."""
    yield from blocks_of(*utf8(column), block_bytes)


def blocks_of(data: np.ndarray, offsets: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + block_bytes, "right")) - 1)
        yield Block(data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row], row)
        row = to


def window_hash(words: np.ndarray, n: int) -> np.ndarray:
    """A rolling hash of each run of n values; len(words) - n + 1 of them. Equal hashes
    only propose equal runs: sums of powers have collisions that can be constructed."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(len(words)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * powers(len(words) + 1, _INVERSE)[: len(words) - n + 1])


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes; not linear, so no sums cancel along a chain of them."""
    x = a * _ODD + b
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def run_hashes(values: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """For each length, a hash of each run of so many values: runs of powers of two are
    hashed as pairs of halves, others as two of these that overlap. There must be a run
    of every length."""
    out: dict[int, np.ndarray] = {}
    size, level = 1, values
    for n in sorted(set(lengths)):
        while 2 * size <= n:
            level = pair_hash(level[:-size], level[size:])
            size *= 2
        out[n] = level if size == n else pair_hash(level[: len(values) - n + 1], level[n - size :])
    return [out[n] for n in lengths]


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in [s, s + length) for some start s."""
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, starts, 1) if len(starts) < 64 else step.__iadd__(np.bincount(starts, minlength=size + 1)[: size + 1].astype(np.int32))
    stop = np.minimum(starts + length, size)
    step -= np.bincount(stop, minlength=size + 1)[: size + 1].astype(np.int32)
    return np.cumsum(step[:-1]) > 0
