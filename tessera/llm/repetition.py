"""Quality rules by repetition coverage.

Every whole text is measured in numpy: words, symbols, repeated lines, and for
each n-gram length the share of word characters inside later occurrences of
n-grams that the text has more than once. Rolling 64-bit hashes propose equal
n-grams and their words are compared, so the counts are exact; a longer n-gram can
only repeat where the shorter one does, so each length looks at the positions that
are left. One pass over the table, no shuffle.

Defined cases: a null or empty text has no words, so all counts are 0, all
shares 0.0 and it fails the word count; a text of one endless word is measured
like any other; repeated rows are rows of their own; an empty table gives an
empty result; extra columns of the input are passed through by ``filter_quality``
and ignored by ``measure``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Block, blocks, covered, mix, window_hash

#: Largest share of word characters in later copies of repeated n-grams, by n.
#: Twice the shares of published web-text filters: short clean texts with one
#: notice given twice pass these, looping texts are far beyond them.
MAX_NGRAM_SHARE = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
MAX_LINE_CHAR_SHARE = 0.30
MAX_LINE_SHARE = 0.50
MIN_WORDS = 50
MAX_REPEAT_WORDS_PERCENT = 50
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars")


def same_grams(keys: np.ndarray, at: np.ndarray, n: int, words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams at some places, equal where the n-grams of one document are
    equal, and which occur more than once. keys: hashes, of which equal ones are compared
    word by word; where two different n-grams share a hash, numbers take its place."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    a, b = order[:-1][same], order[1:][same]
    if not all((words[at[a] + k] == words[at[b] + k]).all() for k in range(n)) or not (doc[at[a]] == doc[at[b]]).all():
        grams = np.stack([doc[at], *(words[at + k] for k in range(n))], axis=1)
        keys = np.unique(grams, axis=0, return_inverse=True)[1].reshape(-1)
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return keys, flags


def _later(keys: np.ndarray) -> np.ndarray:
    """Which keys stand earlier in the array too."""
    flags = np.ones(len(keys), bool)
    flags[np.unique(keys, return_index=True)[1]] = False
    return flags


def measure_block(block: Block, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    data, offsets, word_offsets = block.data, block.offsets, block.word_offsets
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS.encode())] = True
    lead = ((data & 0xC0) != 0x80) & ~block.space
    out = {
        "n_words": block.n_words.astype(np.int64),
        "word_chars": block.per_doc(lead, offsets),
        "n_symbols": block.per_doc(is_symbol[data], offsets),
    }
    chars_to = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=chars_to[1:])

    # lines that hold a word
    breaks = np.unique(np.concatenate([block.doc_start, np.flatnonzero(data == 0x0A) + 1, block.doc_end]))
    line_start, line_end = breaks[:-1], breaks[1:]
    has_word = chars_to[line_end] > chars_to[line_start]
    line_start, line_end = line_start[has_word], line_end[has_word]
    text_end = np.where(data[line_end - 1] == 0x0A, line_end - 1, line_end)
    line_doc = np.searchsorted(offsets, line_start, "right") - 1
    raw = data.tobytes()
    lines = pa.array([raw[a:b] for a, b in zip(line_start.tolist(), text_end.tolist(), strict=True)], pa.large_binary()).dictionary_encode()
    dup_line = _later(line_doc << 32 | lines.indices.to_numpy())
    line_offsets = np.searchsorted(line_start, offsets)
    out["n_lines"] = np.diff(line_offsets)
    out["n_dup_lines"] = block.per_doc(dup_line, line_offsets)
    line_chars = np.where(dup_line, chars_to[line_end] - chars_to[line_start], 0)
    out["dup_line_chars"] = block.per_doc(line_chars, line_offsets)

    # n-grams, shorter first; ``at`` keeps the places where the last length repeats
    words, doc = block.word_hash(), block.word_doc
    codes = block.word_codes()[0]
    chars = chars_to[block.end] - chars_to[block.start]
    salt = mix(np.arange(1, block.n_docs + 1, dtype=np.uint64))
    at = np.arange(len(words))
    for n in (3, *lengths):
        grams = window_hash(words, n)
        at = at[at < len(grams)]
        at = at[doc[at] == doc[at + n - 1]]
        keys, flags = same_grams(grams[at] ^ salt[doc[at]], at, n, codes, doc)
        at, keys = at[flags], keys[flags]
        if n == 3:
            out["n_repeat_words"] = block.per_doc(covered(at, 3, len(words)), word_offsets)
        if n in lengths:
            inside = covered(at[_later(keys)], n, len(words))
            out[f"dup_chars_{n}"] = block.per_doc(np.where(inside, chars, 0), word_offsets)
    return out


def _schema(lengths: tuple[int, ...]) -> str:
    return ", ".join(f"{c} long" for c in (*COUNTS, *(f"dup_chars_{n}" for n in lengths)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = tuple(MAX_NGRAM_SHARE), keep_text: bool = False) -> DataFrame:
    """id, the counts of COUNTS and dup_chars_n for each length; with the text if asked."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = (*COUNTS, *(f"dup_chars_{n}" for n in lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measure_block(b, lengths) for b in blocks(batch.column(1))]
            if parts:
                cols = [batch.column(0)] + ([batch.column(1)] if keep_text else [])
                cols += [pa.array(np.concatenate([p[c] for p in parts]).astype(np.int64)) for c in names]
                yield pa.RecordBatch.from_arrays(cols, ["_id", *(["_text"] if keep_text else []), *names])

    text = ", _text string" if keep_text else ""
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {id_type}{text}, {_schema(lengths)}")
    return out.withColumnsRenamed({"_id": id_col, "_text": text_col})


def verdict(measured: DataFrame, max_ngram_share: dict[int, float] | None = None, max_line_char_share: float = MAX_LINE_CHAR_SHARE, max_line_share: float = MAX_LINE_SHARE, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_WORDS_PERCENT) -> DataFrame:
    """Adds base_failed, repetition_failed and kept to what ``measure`` returned."""
    shares = MAX_NGRAM_SHARE if max_ngram_share is None else max_ngram_share
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    bad = (F.col("dup_line_chars") > max_line_char_share * F.col("word_chars")) | (F.col("n_dup_lines") > max_line_share * F.col("n_lines"))
    for n, share in shares.items():
        bad |= F.col(f"dup_chars_{n}") > share * F.col("word_chars")
    return measured.withColumns({"base_failed": base, "repetition_failed": bad, "kept": ~(base | bad)})


def filter_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, all columns as they were; no shuffle."""
    lengths = tuple(MAX_NGRAM_SHARE)
    columns = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(text_col).alias("_text"))
    names = (*COUNTS, *(f"dup_chars_{n}" for n in lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measure_block(b, lengths) for b in blocks(batch.column(1))]
            if parts:
                cols = [pa.array(np.concatenate([p[c] for p in parts]).astype(np.int64)) for c in names]
                yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["_row", *names])

    row_type = whole.schema["_row"].dataType.simpleString()
    kept = verdict(whole.mapInArrow(run, f"_row {row_type}, {_schema(lengths)}")).filter("kept")
    return kept.select("_row.*")
