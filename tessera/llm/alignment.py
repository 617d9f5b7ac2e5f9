"""Token groups and links between two tokenizers of one text.

Texts become strings with one label a byte: 0 no token ends here, 1 one of A, 2 one of B, 3
both. A regular expression takes spans up to each 3; the labels 1 and 3 of a span count its
A tokens, 2 and 3 its B tokens, and that cuts both token lists into groups. Texts are cut
into stretches that end with a 3 (units.py); equal ones are labelled and scanned once.
Between two neighbouring ends lie bytes of exactly one A and one B token, so every label
but 0 closes one link.

How often a pair of ids is linked in the whole corpus is found without a row for each
document and pair. Tasks write blocks of about ``BLOCK_UNITS`` stretches: the documents' figures, their
stretches as numbers, the links of each different stretch as places in the block's sorted
list of different pairs. Pairs are summed over the blocks (partial sums first), each block
gets the totals of its own pairs, and blocks meet their totals again by number. A pair that
every text has is one row a block, and skewed joins may split those; what meets in one task
is a block.

Defined cases: null and empty texts, and texts whose tokens' bytes are not the text's with
a blank before it, have no tokens and count nowhere; rows that repeat an id or text are rows
of their own; a text longer than a block is a block alone; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ids import require_integers
from .lineage import stored
from .units import Units, load_library, spaced

BLOCK_UNITS = 1 << 19
#: Documents of a block at most, so that one of empty texts ends, too.
BLOCK_DOCS = 1 << 14
#: Units of a generation of a worker's memory.
MOST_UNITS = 160_000
_JOINED = 256
_SPAN = re.compile(rb"[012]*3")


def byte_table() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable Latin-1
    stands for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Unit(NamedTuple):
    """A stretch of text: its groups written out, A's id times 2**32 plus B's id of every
    link (64 bits each), and how many tokens of A, of B and groups it has."""

    groups: str
    links: bytes
    a: int
    b: int
    n: int


_NONE = Unit("", b"", 0, 0, 0)


class Pair:
    """Both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = load_library(path_a, special_as_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = byte_table()
        self.bytes_a = [b""] * (1 + max(self.a.get_vocab().values()))
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            if all(c in of for c in token):
                self.bytes_a[i] = bytes(of[c] for c in token)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.sizes = [np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b)]
        self.units = Units(self._encoded, spaced, MOST_UNITS)
        self.differs = False  # has any stretch had tokens of other bytes?
        #: No piece of B has a blank after another character, so none reaches across one.
        self.joins = not any(b" " in piece.lstrip(b" ") for piece in self.bytes_b)
        most = max(len(self.bytes_a), len(self.bytes_b))
        #: The text of an id followed by a comma, by the end of A's part, by the end of a group.
        self.strings, self.ends = [f"{i}{end}" for end in ",|;" for i in range(most)], most

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def _encoded(self, new: list[str]) -> list[Unit]:
        """Stretches without blanks at their ends are given to the libraries some hundred at
        a time, a blank between two of them: their tokens end where they do."""
        tidy = [u for u in new if self.joins and u.strip() == u and "\u2581" not in u]
        rest = list(set(new) - set(tidy))
        known = dict(zip(tidy, self._aligned(tidy, True), strict=True)) | dict(zip(rest, self._aligned(rest, False), strict=True))
        return [known[u] for u in new]

    def _aligned(self, units: list[str], joined: bool) -> list[Unit]:
        """All at once: the stretches' labels in one string, scanned for groups, their links
        in one array. If any token's bytes differ from the text's, halves are looked at for
        themselves."""
        if not units:
            return []
        strings = [" ".join(units[k : k + _JOINED]) for k in range(0, len(units), _JOINED)] if joined else units
        found_a = [e.ids for e in self.a.encode_batch_fast([" " + x for x in strings], add_special_tokens=False)]
        found_b = self.b.encode(strings, num_threads=1)
        flat = [np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids))) for ids in (found_a, found_b)]
        data = "".join([" " + x for x in strings]).encode()
        at = _cuts(np.fromiter(map(len, map(str.encode, units)), np.int64, len(units)) + 1)
        if all(b"".join([table[i] for i in x.tolist()]) == data for table, x in zip((self.bytes_a, self.bytes_b), flat, strict=True)):
            ends = [np.cumsum(size[x]) for size, x in zip(self.sizes, flat, strict=True)]
            marks = np.full(len(data), 48, np.uint8)
            marks[ends[0] - 1] += 1
            marks[ends[1] - 1] += 2
            if (marks[at[1:] - 1] == 51).all():
                linked = links(marks, *flat).tobytes()
                groups = self.written(*flat, *cut(marks.tobytes())).split(";")
                n_groups = _sums(marks == 51, at)
                texts = [";".join(groups[lo:hi]) for lo, hi in pairwise(_cuts(n_groups).tolist())]
                blobs = [linked[lo:hi] for lo, hi in pairwise((8 * _cuts(_sums(marks > 48, at))).tolist())]
                counts = [np.diff(np.searchsorted(e, at, "right")).tolist() for e in ends]
                return list(map(Unit, texts, blobs, *counts, n_groups.tolist()))
        if len(units) == 1:
            self.differs = True
            return [_NONE]
        half = len(units) // 2
        return self._aligned(units[:half], joined) + self._aligned(units[half:], joined)

    def of(self, texts: list[str]) -> Iterator[list[Unit]]:
        """The units of each text; none if it has no tokens."""
        for text, units in zip(texts, self.units.of(texts), strict=True):
            if text and self.differs and _NONE in units:
                units = self._encoded([text])  # bytes are compared for the whole text
            yield [] if not text or (self.differs and _NONE in units) else units

    def written(self, a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        codes = np.empty(len(a) + len(b), np.int64)
        # a token stands after its own side's before it and the other side's of earlier groups
        at_a = np.arange(len(a)) + np.repeat(ends_b - sizes_b, sizes_a)
        at_b = np.arange(len(b)) + np.repeat(ends_a, sizes_b)
        codes[at_a], codes[at_b] = a, b
        codes[at_a[ends_a - 1]] += self.ends
        codes[at_b[ends_b - 1]] += 2 * self.ends
        return "".join(map(self.strings.__getitem__, codes.tolist()))[:-1]


_pairs: dict[tuple[str, str], Pair] = {}


def load(path_a: str, path_b: str) -> Pair:
    """Both tokenizers once a Python worker."""
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def cut(labels: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B in each group: the spans up to each 3, and the labels in them."""
    spans = _SPAN.findall(labels)
    cuts = _cuts(np.fromiter(map(len, spans), np.int64, len(spans)))
    marks = np.frombuffer(labels, np.uint8)
    return _sums(marks & 1, cuts), _sums((marks >> 1) & 1, cuts)


def links(marks: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A's id times 2**32 plus B's id of every link."""
    marks = marks[marks > 48] - 48
    of_a, of_b = np.cumsum(marks & 1) - (marks & 1), np.cumsum(marks >> 1) - (marks >> 1)
    return a[of_a].astype(np.int64) << 32 | b[of_b]


def _cuts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The sum of the values between each two cuts."""
    return np.diff(_cuts(values)[cuts])


_FIGURES = ["id", "n_units", "groups", "n_a", "n_b", "n_groups", "n_links"]
_BINARY = ["units", "unit_links", "unit_places", "pairs", "pair_counts"]
_BLOCKS = ", ".join(["block long", *(f"{c} array<{'string' if c == 'groups' else 'long'}>" for c in _FIGURES), *(f"{c} binary" for c in _BINARY)])


def _zip(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed by planes of bytes."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(len(numbers), 4).T)
    return zlib.compress(planes.tobytes(), 1)


def _unzip(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Block:
    def __init__(self, number: int):
        self.number, self.rows, self.units, self.n_units = number, [], [], 0

    def add(self, figures: tuple, units: list[Unit]) -> None:
        self.rows.append(figures)
        self.units.append(units)
        self.n_units += len(units)

    def batch(self) -> pa.RecordBatch:
        every = list(chain.from_iterable(self.units))  # equal stretches are one object while they are remembered
        _, first, sequence = np.unique(np.fromiter(map(id, every), np.int64, len(every)), return_index=True, return_inverse=True)
        own = [every[i] for i in first.tolist()]
        sizes = np.array([len(u.links) // 8 for u in own], np.int64)
        keys = np.frombuffer(b"".join([u.links for u in own]), np.int64)
        cuts = _cuts(np.array([r[1] for r in self.rows], np.int64))
        figures = [_sums(np.array(x, np.int64)[sequence], cuts).tolist() for x in ([u.a for u in own], [u.b for u in own], [u.n for u in own], sizes)]
        pairs, places = np.unique(keys, return_inverse=True)
        times = np.repeat(np.bincount(sequence, minlength=len(own)), sizes)
        counts = np.bincount(places, weights=times, minlength=len(pairs)).astype(np.int64)  # below 2**53
        lists = [pa.array([list(c)], pa.list_(pa.string() if name == "groups" else pa.int64())) for name, c in zip(_FIGURES, [*zip(*self.rows, strict=True), *figures], strict=True)]
        blobs = [_zip(sequence), _zip(sizes), _zip(places), pairs.astype("<i8").tobytes(), counts.astype("<i8").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([self.number], pa.int64()), *lists, *(pa.array([x], pa.binary()) for x in blobs)], ["block", *_FIGURES, *_BINARY])


def blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    """One row a block: its documents' figures and links, its pairs and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, number = load(path_a, path_b), TaskContext.get().partitionId() << 32
        block = _Block(number)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 500).columns)
                for doc_id, units in zip(ids, pair.of([t or "" for t in texts]), strict=True):
                    groups = ";".join([u.groups for u in units])
                    if digest and units:
                        groups = hashlib.sha256(groups.encode()).hexdigest()
                    block.add((doc_id, len(units), groups), units)
                    if block.n_units >= BLOCK_UNITS or len(block.rows) >= BLOCK_DOCS:
                        yield block.batch()
                        number += 1
                        block = _Block(number)
        if block.rows:
            yield block.batch()

    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return picked.mapInArrow(run, _BLOCKS)


def pair_totals(made: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, pair, n) of blocks; and pair, total, best: is the total its B id's highest."""

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                pairs = np.frombuffer(r["pairs"], "<i8")
                columns = [np.full(len(pairs), r["block"]), pairs, np.frombuffer(r["pair_counts"], "<i8")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "pair", "n"])

    each = made.select("block", "pairs", "pair_counts").mapInArrow(flat, "block long, pair long, n long")
    totals = each.groupBy("pair").agg(F.sum("n").alias("total"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))  # at most a row for each A id
    return each, totals.withColumn("best", F.col("total") == F.max("total").over(of_b))


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _scored(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of one block with the totals of its pairs, both in the order of pairs."""
    r = {c: blocks.column(c)[0].as_py() for c in blocks.column_names}
    order = np.argsort(answers.column("pair").to_numpy(), kind="stable")
    total = answers.column("total").to_numpy()[order]
    best = answers.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    places, unit_cuts = _unzip(r["unit_places"]), _cuts(_unzip(r["unit_links"]))
    units, cuts = _unzip(r["units"]), _cuts(np.array(r["n_units"]))
    n_best, count_sum = (_sums(_sums(x[places], unit_cuts)[units], cuts) for x in (best, total))
    columns = [r["id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], n_best, count_sum]
    return pa.table([*(pa.array(c, pa.int64()) for c in columns), pa.array(r["groups"], pa.string())], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """A row a document: tokens of A (of a blank and the text) and B, groups, links, links
    whose pair is its B id's most frequent in the corpus, the sum of the links' corpus
    counts, and the groups written out (with ``digest`` only their SHA-256).

    path_a: a byte-level vocabulary of the tokenizers library; path_b: a sentencepiece
    model that adds a blank; both on every machine.
    """
    require_integers(docs, id_col)
    made = stored(blocks(docs, path_a, path_b, id_col, text_col, digest))
    each, totals = pair_totals(made)
    answers = each.select("block", "pair").join(totals, "pair")
    own = made.drop("pairs", "pair_counts")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored, _RESULT)
