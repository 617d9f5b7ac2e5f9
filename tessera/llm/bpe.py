"""Byte-pair encoding by backtracking, and decoding by an offset table.

A word's tokens are found in linear time: an Aho-Corasick automaton of the
vocabulary gives the longest token at a place, a memoised pair-compatibility test
says whether two tokens may stand side by side after all merges, and a dead end
falls back to the next shorter token. A sequence whose neighbours are all
compatible is exactly what applying the merges in rank order gives.

Text is prepared as the tokenizer file asks: special tokens are split off, then
Unicode composition, lower case per code point, the file's split pattern, and the
byte alphabet; the last symbol of a word carries the end-of-word suffix. Words are
remembered per task in a table of bounded size.

Letters are those of the ``regex`` module's Unicode version; the tokenizers library's
is older, so a code point assigned in between may be split otherwise.

Defined cases: a null or empty text has no tokens and decodes to an empty text;
long texts are encoded whole; repeated rows are rows of their own; an empty table gives
an empty result; the extra
columns of the input are not looked at.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_END = ""  # stands for the end-of-word suffix; not in the byte alphabet
_DECODED_IDS = 1 << 18
_MEMO = 300_000
#: Fixed value: the white space of the split pattern's engine.
_WHITE = r"\t\n\v\f\r \u0085   -     　"


def byte_alphabet() -> list[str]:
    """The printable character of each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Memo(dict):
    """The ids of recent words: two generations of bounded size, the older goes first."""

    def __init__(self, encode_word):
        self.encode_word, self.older = encode_word, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = np.array(self.encode_word(word), "<u4").tobytes()
        if len(self) >= _MEMO:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Bpe:
    """A vocabulary read from a tokenizers JSON file with end-of-word suffixes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        own = {t: i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = token_strings(spec)
        mark = lambda t: t[: -len(suffix)] + _END if t.endswith(suffix) and t != suffix else t
        self.ids = {mark(t): i for t, i in own.items() if t not in self.special}
        self.names = {i: t for t, i in self.ids.items()}
        self.size = {i: len(t) for t, i in self.ids.items()}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, both = own[a], own[b], own[a + b]
            self.pairs.setdefault((left, right), (rank, both))
            self.halves.setdefault(both, (left, right))
        #: a token's place in the order of merging; symbols that no merge makes come first
        self.order = {i: -1 for i in self.ids.values()}
        for left_right, (rank, both) in self.pairs.items():
            if self.halves[both] == left_right:
                self.order[both] = rank
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet())}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(pattern.replace(r"[^\s", "[^" + _WHITE).replace(r"\s", f"[{_WHITE}]"), regex.V0).findall
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else lambda t: [t]
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo = Memo(self.encode_word)
        self.shorter: dict[int, int] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves a and b side by side: undone step by step, latest
        merge first, no pair on the border may have merged before."""
        known = self.fits.get((a, b))
        if known is not None:
            return known
        left, right, limit, good = a, b, 1 << 60, True
        while True:
            pair = self.pairs.get((left, right))
            if pair is not None and pair[0] < limit:
                good = False
                break
            x, y = self.order[left], self.order[right]
            if x < 0 and y < 0:
                break
            # on a tie of one token with itself, the left occurrence merges first
            if x > y:
                limit, left = x, self.halves[left][1]
            else:
                limit, right = y + 1, self.halves[right][0]
        if len(self.fits) > _MEMO:
            self.fits.clear()
        self.fits[a, b] = good
        return good

    def prefix(self, token: int) -> int:
        """The longest shorter token that this token begins with, or -1."""
        found = self.shorter.get(token)
        if found is None:
            name = self.names[token]
            found = next((self.ids[name[:n]] for n in range(len(name) - 1, 0, -1) if name[:n] in self.ids), -1)
            self.shorter[token] = found
        return found

    def longest(self, text: str) -> list[int]:
        """The longest token that starts at each place, from one run of the automaton."""
        best = [-1] * len(text)
        size, last = self.size, [0] * len(text)
        for end, token in self.automaton.iter(text):
            n = size[token]
            if n > last[end - n + 1]:
                best[end - n + 1], last[end - n + 1] = token, n
        return best

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word of the split pattern."""
        text = "".join(map(self.alphabet.__getitem__, word.encode())) + _END
        whole = self.ids.get(text)
        if whole is not None and self.reachable(whole):
            return [whole]
        n = len(text)
        best, size = self.longest(text), self.size
        open_at = [True] * (n + 1)
        open_at[n - 1] = False  # the suffix is never apart from its symbol
        out: list[int] = []
        at, token = 0, best[0]
        while at < n:
            while True:
                end = at + size[token]
                if open_at[end] and (not out or self.compatible(out[-1], token)):
                    out.append(token)
                    at = end
                    token = best[at] if at < n else -1
                    break
                token = self.prefix(token)
                if token < 0:
                    open_at[at] = False
                    token = out.pop()
                    at -= size[token]
                    break
        return out

    def reachable(self, token: int) -> bool:
        """Whether merging the token's own symbols gives the token."""
        halves = self.halves.get(token)
        return halves is None or (self.reachable(halves[0]) and self.reachable(halves[1]) and self.compatible_under(halves, self.order[token]))

    def compatible_under(self, halves: tuple[int, int], rank: int) -> bool:
        pair = self.pairs.get(halves)
        if pair is None or pair[0] != rank:
            return False
        left, right, limit = *halves, rank
        while True:
            x, y = self.order[left], self.order[right]
            if x < 0 and y < 0:
                return True
            if x > y:
                limit, left = x, self.halves[left][1]
            else:
                limit, right = y + 1, self.halves[right][0]
            pair = self.pairs.get((left, right))
            if pair is not None and pair[0] < limit:
                return False

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = []
        for piece in self.split_special(text) if "<|" in text or not self.special else (text,):
            if piece in self.special:
                parts.append(np.array([self.special[piece]], "<u4").tobytes())
                continue
            if not piece.isascii():
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            words = self.find(piece.lower())
            parts.append(b"".join(map(self.memo.__getitem__, words)))
        return b"".join(parts)


class Decoder:
    """Token strings in one buffer; a table of offsets says where each id's lies."""

    def __init__(self, strings: list[str], joiner: str = " "):
        pieces = [(s + joiner).encode() for s in strings]
        self.buffer = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum([len(p) for p in pieces], out=self.offsets[1:])
        self.joiner = len(joiner.encode())

    def decode(self, ids: np.ndarray, text_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of consecutive texts and their offsets; text_offsets counts ids."""
        start = self.offsets[ids]
        sizes = self.offsets[ids + 1] - start
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        out = self.buffer[np.arange(ends[-1]) + np.repeat(start - ends[:-1], sizes)]
        cut = ends[text_offsets]
        full = text_offsets[1:] > text_offsets[:-1]
        if self.joiner:  # nothing follows a text's last token
            keep = np.ones(len(out), bool)
            for k in range(self.joiner):
                keep[cut[1:][full] - 1 - k] = False
            out = out[keep]
            cut = cut - self.joiner * np.concatenate([[0], np.cumsum(full)])
        return out, cut


def load(path: str) -> Bpe:
    """One vocabulary a Python worker, kept between tasks."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


_loaded: dict[str, Bpe] = {}
_decoders: dict[str, Decoder] = {}


def load_decoder(path: str) -> Decoder:
    """One decoder a Python worker; of the file it needs the tokens alone."""
    if path not in _decoders:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _decoders[path] = Decoder(token_strings(spec))
    return _decoders[path]


def token_strings(spec: dict) -> list[str]:
    """The string of each id."""
    pairs = [*spec["model"]["vocab"].items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]
    strings = [""] * (1 + max(i for _, i in pairs))
    for t, i in pairs:
        strings[i] = t
    return strings


def encoded(bpe: Bpe, texts: pa.Array) -> pa.Array:
    return pa.array([bpe.encode(t.as_py() or "") for t in texts], pa.binary())


def decoded(decoder: Decoder, column: pa.Array) -> pa.Array:
    """The texts of a column of ids, some at a time."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out, row = [], 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + 4 * _DECODED_IDS, "right")) - 1)
        ids = np.ascontiguousarray(data[offsets[row] : offsets[to]]).view("<u4").astype(np.int64)
        text, cut = decoder.decode(ids, (offsets[row : to + 1] - offsets[row]) // 4)
        strings = pa.LargeStringArray.from_buffers(to - row, pa.py_buffer(np.ascontiguousarray(cut, np.int64)), pa.py_buffer(np.ascontiguousarray(text)))
        out.append(strings.cast(pa.string()))
        row = to
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "token_ids", keep: tuple[str, ...] = ("doc_id",), out_col: str | None = None) -> DataFrame:
    """keep and a binary column of little-endian unsigned 32-bit ids of each whole text;
    with ``out_col``, the text that the ids decode to as well, from the same pass.

    ``tokenizer`` is the path of the vocabulary file on every machine.
    """
    picked = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], F.col(text_col).alias("_text"))
    added = ["_ids binary", *(["_out string"] if out_col else [])]
    schema = ", ".join([*(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, decoder = load(tokenizer), load_decoder(tokenizer) if out_col else None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # bounds what one output batch holds
                part = batch.slice(at, 500)
                ids = encoded(bpe, part.column(part.num_columns - 1))
                more = [decoded(decoder, ids)] if decoder else []
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, *more], [*part.schema.names[:-1], *(a.split()[0] for a in added)])

    return picked.mapInArrow(run, schema).toDF(*keep, ids_col, *([out_col] if out_col else []))


def decode(tokens: DataFrame, tokenizer: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """tokens with the decoded text of ids_col; special tokens are kept."""
    names = tokens.columns
    schema = ", ".join([*(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(tokens.schema.fields)), "_out string"])
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = load_decoder(tokenizer)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                yield pa.RecordBatch.from_arrays([*part.columns, decoded(decoder, part.column(at))], [*part.schema.names, "_out"])

    out = tokens.toDF(*[f"_{i}" for i in range(len(names))]).mapInArrow(run, schema)
    return out.toDF(*names, out_col)
