"""Suffix-array dedup on bytes by a common-prefix-aware distributed merge sort.

Removes every byte that a string of ``window`` bytes covers which also starts earlier:
in a document of smaller id, or further ahead in the same one. The suffixes that are
sorted start at the anchors of ``repeats`` (a sparse suffix array: equal strings have
equal anchors, so none is lost) and are led by the hash of their first ``GRAM``
bytes, which keeps equal prefixes together and cuts the order into even ranges
without sampling it: a suffix array grouped by that hash, in byte order within a group,
which is all that reading off repeats needs.

Every task sorts its suffixes and sends each range a run: front-coded, a suffix is the
length it has in common with the one before and the bytes after that. A range merges
its runs with a loser tree. Each head carries the length it has in common with the
last winner: the longer one wins unread, and only equal lengths are compared, from
there on. The merged order comes with the common prefixes of neighbours, the array's
LCP table, from which repeats are read off.

Defined cases: null and empty texts have no bytes; texts shorter than the window lose
none; long texts are taken whole; rows of one id, with equal or different texts, count
as one document for the order: equal starts are one place, so neither is earlier; null
ids come first, as one id, together with the least long; ids that are no integers are
an error; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .words import _BYTE, blocks

WINDOW = 100
GRAM = 32
_HEAD = np.dtype([("id", "<i8"), ("th", "<i8"), ("pos", "<u4"), ("back", "<u2"), ("span", "<u2"), ("common", "<u2"), ("tail", "<u2")])
_BLOCK = 1 << 18


def byte_units(column: pa.Array):
    for block in blocks(column, _BLOCK):
        yield block.first, _BYTE[block.data], block.offsets, block.data, np.arange(len(block.data) + 1)


def common(a: bytes, b: bytes, start: int) -> int:
    """The length of the common prefix of a and b, known to be start at least."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    x = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted suffixes, what each has in common with the one before, and the rest."""
    shared, tails, last = [], [], b""
    for s in suffixes:
        n = common(last, s, 0)
        shared.append(n)
        tails.append(s[n:])
        last = s
    return shared, tails


class Run:
    """A front-coded sorted run, read suffix by suffix."""

    __slots__ = ("shared", "sizes", "data", "at", "offset", "first", "head", "lcp")

    def __init__(self, shared: list[int], sizes: list[int], data: bytes, first: int):
        self.shared, self.sizes, self.data, self.first = shared, sizes, data, first
        self.at, self.offset, self.head, self.lcp = -1, 0, b"", 0

    def advance(self) -> bool:
        self.at += 1
        if self.at == len(self.shared):
            self.head = None
            return False
        n, size = self.shared[self.at], self.sizes[self.at]
        self.head = self.head[:n] + self.data[self.offset : self.offset + size]
        self.offset += size
        self.lcp = n
        return True


def merge(runs: list[Run]) -> Iterator[tuple[int, int]]:
    """(place in the concatenated runs, common prefix with the one before), in order."""
    width = 1 << max(0, (len(runs) - 1).bit_length())
    for r in runs:
        r.advance()
        r.lcp = 0
    players: list[Run | None] = [*runs, *[None] * (width - len(runs))]

    def play(a: Run | None, b: Run | None) -> tuple[Run | None, Run | None]:
        """winner, loser; the loser keeps its common prefix with the winner."""
        if a is None or a.head is None:
            return b, a
        if b is None or b.head is None or a.lcp > b.lcp:
            return a, b
        if a.lcp < b.lcp:
            return b, a
        n = common(a.head, b.head, a.lcp)
        if a.head[n:] <= b.head[n:]:
            b.lcp = n
            return a, b
        a.lcp = n
        return b, a

    losers: list[Run | None] = [None] * width

    def build(node: int) -> Run | None:
        if node >= width:
            return players[node - width]
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    seat = {id(r): width + i for i, r in enumerate(runs)}
    winner = build(1)
    while winner is not None and winner.head is not None:
        yield winner.first + winner.at, winner.lcp
        node = seat[id(winner)] >> 1
        winner.advance()
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1


def _runs(rows: DataFrame, window: int, buckets: int) -> DataFrame:
    """Front-coded sorted runs of the suffixes of a task, one for each range of keys."""
    width = -(-(1 << 64) // buckets)

    def pack(suffixes: list[bytes], heads: list[tuple], lefts: list[bytes]) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1)
        order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
        target = [int.from_bytes(suffixes[i][:8], "big") // width for i in order]
        cuts = [0, *[i for i in range(1, len(order)) if target[i] != target[i - 1]], len(order)]
        bucket, bodies = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            part = order[lo:hi]
            shared, tails = front_code([suffixes[i] for i in part])
            head = np.array([heads[i] + (n, len(t)) for i, n, t in zip(part, shared, tails, strict=True)], _HEAD)
            bucket.append(target[lo])
            bodies.append(squeeze.compress(np.int64(len(head)).tobytes() + head.tobytes() + b"".join(lefts[i] for i in part) + b"".join(tails)))
        n = len(bodies)
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([b""] * n, pa.binary()), pa.array(bodies, pa.binary())], ["bucket", "id", "th", "rows", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes, heads, lefts = [], [], []
        hot, held = repeats.HotWindows(window, True), 0

        def add(lead: int, head: tuple, text: bytes) -> None:
            suffixes.append(lead.to_bytes(8, "big") + text[head[3] :])
            heads.append(head)
            lefts.append(text[: head[3]][::-1])

        def flush() -> Iterator[pa.RecordBatch]:
            for text, head in hot.rows():  # led by the hash of a whole window
                add(xxhash.xxh64_intdigest(text), head, text)
            yield from hot.covered(buckets)
            if suffixes:
                yield pack(suffixes, heads, lefts)

        for batch in batches:
            known = [[], [], []]
            for i in range(batch.num_rows):
                records = repeats.records_of(batch.column(batch.num_columns - 1)[i])
                doc, th = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                done = records[records["kind"] == repeats.COVER]
                if len(done):
                    known[0].append(doc), known[1].append(th), known[2].append(done.tobytes())
                records = records[records["kind"] != repeats.COVER]
                if not len(records):
                    continue
                data = batch.column(2)[i].as_py().encode()
                for key, pos, back, span, kind in records.tolist():
                    if kind == repeats.HOT_ANCHOR:
                        for b in range(back - span, back + 1):
                            held += hot.add(data[pos - b : pos - b + window], doc, th, pos - b, (doc, th, pos, b, 0))
                    else:
                        # an anchor is the least of many hashes, so its low half is the even one
                        add((key & 0xFFFFFFFF) << 32 | key >> 32, (doc, th, pos, back, span), data[pos - back : pos - back + span + window])
                        held += 300
                if held > 200_000_000:
                    yield from flush()
                    suffixes, heads, lefts = [], [], []
                    hot, held = repeats.HotWindows(window, True), 0
            if known[0]:
                yield repeats.pass_on(np.array(known[0], np.int64), np.array(known[1], np.int64), pa.array(known[2], pa.binary()), buckets)
        yield from flush()

    return rows.mapInArrow(run, repeats.BUCKETED)


def _left_order(keys: np.ndarray, lefts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes of what stands before the anchors, read backwards."""
    whole = np.concatenate([keys, lefts], axis=1)
    order = np.argsort(np.ascontiguousarray(whole).view(f"S{whole.shape[1]}").reshape(-1))
    m = whole[order]
    differ = m[1:] != m[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), whole.shape[1])
    return order, np.concatenate([[-1], lcp - 8])


def _merged(runs: DataFrame, window: int, gram: int) -> DataFrame:
    """Covered runs, from the merged order of each range."""

    def settle(bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
        heads, pieces, lefts, first = [], [], [], 0
        for body in bodies:
            n = int(np.frombuffer(body, np.int64, 1)[0])
            head = np.frombuffer(body, _HEAD, n, 8)
            at = 8 + n * _HEAD.itemsize
            left = int(head["back"].sum(dtype=np.int64))
            lefts.append(body[at : at + left])
            pieces.append(Run(head["common"].tolist(), head["tail"].tolist(), body[at + left :], first))
            heads.append(head)
            first += n
        head = np.concatenate(heads)
        order, lcp = np.empty(first, np.int64), np.empty(first, np.int64)
        keys = np.zeros((first, 8), np.uint8)
        by_run = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
        spot = {r.first: r for r in pieces}
        starts = [h.first for h in pieces]
        for i, (at, shared) in enumerate(merge(pieces)):
            order[i], lcp[i] = at, shared - 8
            if shared < 8:
                key = spot[starts[by_run[at]]].head[:8]
            keys[at] = memoryview(key)
        back = head["back"].astype(np.int64)
        width = max(window - gram, 1)
        raw = np.frombuffer(b"".join(lefts), np.uint8)
        inside = np.arange(width)[None, :] < back[:, None]
        left = np.zeros((first, width), np.uint8)
        left[inside] = raw
        ids, ths, start, end = repeats.settle(order, lcp, *_left_order(keys, left), head["id"], head["th"], head["pos"].astype(np.int64), back, head["span"].astype(np.int64), window, True)
        if len(ids):
            i, t, b = repeats.covers(ids, ths, start, end)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(t), b], ["id", "th", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for bucket in repeats.by_bucket(batches):
            if isinstance(bucket, pa.RecordBatch):
                yield bucket
            else:
                yield from settle([expand.decompress(body) for _, body in bucket])

    return runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, repeats.PLACED)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """id, n_bytes, n_removed, spans (start, end of each removed run) and kept, the
    remaining bytes as binary: cuts may fall inside a character."""
    rows = repeats.identified(docs, id_col, text_col)
    buckets = repeats.n_buckets(rows)
    placed = repeats.candidates(rows, byte_units, window, gram, True, buckets)
    runs = _runs(repeats.with_text(rows, placed, "inner"), window, buckets)
    covered = _merged(runs, window, gram)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                sizes, removed, spans, kept = [], [], [], []
                for i in range(part.num_rows):
                    text = part.column(1)[i].as_py().encode()
                    records = repeats.records_of(part.column(2)[i])
                    _, start, end = repeats.merge_runs(np.zeros(len(records), np.int64), records["pos"].astype(np.int64), records["key"].astype(np.int64))
                    edges = [0, *np.stack([start, end], axis=1).reshape(-1).tolist(), len(text)]
                    kept.append(b"".join(text[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2)))
                    sizes.append(len(text))
                    removed.append(len(text) - len(kept[-1]))
                    spans.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "spans", "kept"])

    found = repeats.with_text(rows, covered, "left").select(F.when(~F.col("nil"), F.col("id")).alias("id"), "text", "bodies")
    out = found.mapInArrow(cut, "id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
    return out.withColumnRenamed("id", id_col)
