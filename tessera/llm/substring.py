"""Substring dedup on words by prefix-partitioned suffix trees.

Removes every word that a window of ``window`` consecutive words covers whose word
sequence starts anywhere else too. Suffixes start at the anchors of ``repeats`` (a
sparse suffix tree: equal windows have equal anchors, so no repeat is lost) and are
split into groups by a prefix of variable length: the first ``GRAM`` words, or a whole
window where more suffixes share those than a group may hold. Each partition orders
its suffixes by words and has the common prefix of neighbours, which is its tree cut
at the window's depth: the leaves below an internal node are the places of one
repeat. The words before the anchor extend the repeats to the left in the same way.

Shuffled: anchors once (about 25 bytes in 14 words), the text once, and of the
anchors with company the words around them.

Defined cases: null and empty texts have no words and lose none; texts shorter than
the window lose none; long texts are taken whole; a row that repeats another, and
another row of the same id, counts as a second place; null ids stay null; ids that are
no integers are an error; an empty table gives an empty result; the columns of the input
beside id and text are not looked at.
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
from .words import Block, blocks, utf8

WINDOW = 35
GRAM = 8
_HEAD = np.dtype([("key", "<u8"), ("id", "<i8"), ("th", "<i8"), ("pos", "<u4"), ("back", "<u2"), ("span", "<u2"), ("size", "<u4")])


def word_units(column: pa.Array):
    for block in blocks(column):
        text, place = block.joined()
        yield block.first, block.word_hash(), block.word_offsets, text, place


def _stretches(rows: DataFrame, window: int, buckets: int) -> DataFrame:
    """The words around each anchor, packed for the partition of its prefix."""

    def pack(found: dict[int, tuple[list, list]]) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1)
        bodies = []
        for heads, texts in found.values():
            head = np.array(heads, _HEAD)
            bodies.append(squeeze.compress(np.int64(len(head)).tobytes() + head.tobytes() + b"".join(texts)))
        n = len(bodies)
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([b""] * n, pa.binary()), pa.array(bodies, pa.binary())], ["bucket", "id", "th", "rows", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[list, list]] = {}
        hot, held = repeats.HotWindows(window, False), 0

        def add(to: int, head: tuple, text: bytes) -> None:
            heads, texts = found.setdefault(to, ([], []))
            heads.append((*head, len(text)))
            texts.append(text)

        def flush() -> Iterator[pa.RecordBatch]:
            for text, head in hot.rows():
                add(xxhash.xxh64_intdigest(text) % buckets, head, text)
            yield from hot.covered(buckets)
            if found:
                yield pack(found)

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
                words = batch.column(2)[i].as_py().encode().split()
                for key, pos, back, span, kind in records.tolist():
                    if kind == repeats.HOT_ANCHOR:  # the prefix is the whole window
                        for b in range(back - span, back + 1):
                            text = b" ".join(words[pos - b : pos - b + window])
                            held += hot.add(text, doc, th, pos - b, (key, doc, th, pos, b, 0))
                    else:
                        text = b" ".join(words[pos - back : pos - back + span + window])
                        add(key % buckets, (key, doc, th, pos, back, span), text)
                        held += len(text) + 40
                if held > 64_000_000:
                    yield from flush()
                    found, hot, held = {}, repeats.HotWindows(window, False), 0
            if known[0]:
                yield repeats.pass_on(np.array(known[0], np.int64), np.array(known[1], np.int64), pa.array(known[2], pa.binary()), buckets)
        yield from flush()

    return rows.mapInArrow(run, repeats.BUCKETED)


def _matrix(words: np.ndarray, start: np.ndarray, step: int, width: int, size: np.ndarray) -> np.ndarray:
    """Rows of words[start], words[start + step], ...: size[i] of them, then zeros."""
    at = start[:, None] + step * np.arange(width)[None, :]
    inside = np.arange(width)[None, :] < size[:, None]
    return np.where(inside, words[np.clip(at, 0, max(len(words) - 1, 0))], np.uint64(0))


def ordered(keys: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of the suffix tree in order, and the depth at which each branches
    off the one before (0 where the prefix of the group differs)."""
    order = np.lexsort((*matrix.T[::-1], keys))
    m, k = matrix[order], keys[order]
    differ = m[1:] != m[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    lcp = np.where(k[1:] != k[:-1], -1, lcp)
    return order, np.concatenate([[-1], lcp])


def _trees(stretches: DataFrame, window: int, gram: int) -> DataFrame:
    """Covered runs of the suffixes of each partition."""

    def settle(heads: list, texts: list) -> Iterator[pa.RecordBatch]:
        head = np.concatenate(heads)
        sizes = np.concatenate([[0], np.cumsum(head["size"], dtype=np.int64)])
        block = Block(np.frombuffer(b"".join(texts), np.uint8), sizes, 0)
        words = block.word_codes()[0].astype(np.uint64) + np.uint64(1)  # equal for equal words alone
        first = block.word_offsets[:-1]
        pos, back, span = (head[c].astype(np.int64) for c in ("pos", "back", "span"))
        at = first + back
        width = window - gram
        right = ordered(head["key"], _matrix(words, at, 1, window, window - back + span))
        left = ordered(head["key"], _matrix(words, at - 1, -1, width, back)) if width else (right[0], right[1])
        ids, ths, start, end = repeats.settle(*right, *left, head["id"], head["th"], pos, back, span, window, False)
        if len(ids):
            i, t, b = repeats.covers(ids, ths, start, end)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(t), b], ["id", "th", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for bucket in repeats.by_bucket(batches):
            if isinstance(bucket, pa.RecordBatch):
                yield bucket
                continue
            heads, texts = [], []
            for _, body in bucket:
                body = expand.decompress(body)
                n = int(np.frombuffer(body, np.int64, 1)[0])
                heads.append(np.frombuffer(body, _HEAD, n, 8))
                texts.append(body[8 + n * _HEAD.itemsize :])
            yield from settle(heads, texts)

    return stretches.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, repeats.PLACED)


def _covered(rows: DataFrame, window: int, gram: int) -> DataFrame:
    buckets = repeats.n_buckets(rows)
    placed = repeats.candidates(rows, word_units, window, gram, False, buckets)
    return _trees(_stretches(repeats.with_text(rows, placed, "inner"), window, buckets), window, gram)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """id, n_words, n_removed and kept, the words that stay joined by one space."""
    rows = repeats.identified(docs, id_col, text_col)
    found = repeats.with_text(rows, _covered(rows, window, gram), "left")
    return _cut(found, True).select(F.when(~F.col("nil"), F.col("id")).alias(id_col), "n_words", "n_removed", "kept")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """docs with the repeated words, and the space after each, cut out of the texts; all
    else as it was, also the texts that lose nothing."""
    rows = repeats.identified(docs, id_col, text_col, carry=True)
    out = _cut(repeats.with_text(rows, _covered(rows, window, gram), "left"), False)
    text = F.when(F.col("rest.null"), F.lit(None)).otherwise(F.col("kept"))
    return out.select(*[text.alias(c) if c == text_col else F.col(f"rest.row.`{c}`").alias(c) for c in docs.columns])


def _without(column: pa.Array, stay: np.ndarray) -> str:
    data, offsets = utf8(column)
    block = Block(data, offsets, 0)
    gone = np.zeros(len(data) + 1, np.int32)
    np.add.at(gone, block.start[~stay], 1)
    np.add.at(gone, np.append(block.start[1:], len(data))[~stay], -1)
    return data[np.cumsum(gone[:-1]) == 0].tobytes().decode()


def _cut(found: DataFrame, single_spaces: bool) -> DataFrame:
    """id, nil, rest (if there), n_words, n_removed and kept of texts and their covered runs."""
    rest = [c for c in found.columns if c in ("nil", "rest")]
    picked = found.select("id", *rest, "text", "bodies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                texts, bodies = part.column(part.num_columns - 2), part.column(part.num_columns - 1)
                counts, removed, kept = [], [], []
                for i in range(part.num_rows):
                    text = texts[i].as_py()
                    words = text.encode().split()
                    records = repeats.records_of(bodies[i])
                    cut = np.zeros(len(words) + 1, np.int32)
                    np.add.at(cut, records["pos"].astype(np.int64), 1)
                    np.add.at(cut, records["key"].astype(np.int64), -1)
                    stay = np.cumsum(cut[:-1]) == 0
                    counts.append(len(words))
                    removed.append(int(len(words) - stay.sum()))
                    if single_spaces:
                        kept.append(b" ".join(words if removed[-1] == 0 else [words[j] for j in np.flatnonzero(stay)]).decode())
                    else:
                        kept.append(text if removed[-1] == 0 else _without(texts.slice(i, 1), stay))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["id", *rest, "n_words", "n_removed", "kept"])

    carried = "".join(f", {c} {picked.schema[c].dataType.simpleString()}" for c in rest)
    return picked.mapInArrow(run, f"id long{carried}, n_words long, n_removed long, kept string")
