"""Words, repetition rules and their filter against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import TEXTS, documents

from tessera.llm import repetition
from tessera.llm.words import blocks, covered, window_hash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
small = st.text(alphabet="ab \n\tß\x0b$", max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(small | st.none(), max_size=8), st.integers(1, 30))
def test_words_of_blocks(texts, size):
    got = []
    for b in blocks(pa.array(texts, pa.string()), size):
        raw = b.data.tobytes()
        for d in range(b.n_docs):
            span = slice(b.word_offsets[d], b.word_offsets[d + 1])
            got.append([raw[i:j].decode() for i, j in zip(b.start[span], b.end[span], strict=True)])
    assert got == [WORD.findall(t or "") for t in texts]


def test_hashes_depend_on_content_alone():
    b = next(blocks(pa.array(["xx ab cd ab", "ab cd"])))
    h = b.word_hash()
    assert h[1] == h[3] == h[4] and h[2] == h[5] and len(set(h.tolist())) == 3
    grams = window_hash(h, 2)
    assert grams[1] == grams[4] and len(set(grams.tolist())) == 4


@given(st.lists(st.integers(0, 19), max_size=10), st.integers(1, 5))
def test_covered(starts, n):
    want = [any(s <= i < s + n for s in starts) for i in range(20)]
    assert covered(np.array(starts, np.int64), n, 20).tolist() == want


def counts(text: str | None) -> dict[str, int]:
    text = text or ""
    words = WORD.findall(text)

    def repeats(n):
        c = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        return {j for i in range(len(words) - n + 1) if c[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}

    def later(n):
        seen, out = set(), set()
        for i in range(len(words) - n + 1):
            g = tuple(words[i : i + n])
            if g in seen:
                out |= set(range(i, i + n))
            seen.add(g)
        return sum(len(words[i]) for i in out)
    lines, dup, chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in lines:
                dup, chars = dup + 1, chars + sum(map(len, WORD.findall(line)))
            lines.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup, "dup_line_chars": chars, "n_repeat_words": len(repeats(3)), **{f"dup_chars_{n}": later(n) for n in range(5, 11)}}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é", "$x", "\n", "a b\n"]), max_size=40).map(" ".join), min_size=1, max_size=4))
def test_counts_of_blocks(texts):
    parts = [repetition.measure_block(b, tuple(range(5, 11))) for b in blocks(pa.array(texts, pa.string()), 64)]
    for name in counts(""):
        assert np.concatenate([p[name] for p in parts]).tolist() == [counts(t)[name] for t in texts], name


def test_words_and_lines_that_sums_of_powers_confuse_are_told_apart():
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, other = ("".join(ab[b] for b in bits) for ab in ("ab", "ba"))
    for text in (f"{one}\n{other}", f"{one} x y {other} x y", f"{one} {one}\n{other}\n{one}"):
        got = repetition.measure_block(next(blocks(pa.array([text]))), (5, 6))
        assert {k: int(got[k][0]) for k in ("n_dup_lines", "n_repeat_words", "dup_chars_5")} == {k: counts(text)[k] for k in ("n_dup_lines", "n_repeat_words", "dup_chars_5")}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "\n"]), max_size=40).map(" ".join), min_size=1, max_size=4))
def test_counts_do_not_rest_on_hashes(texts):
    whole = repetition.window_hash
    try:
        repetition.window_hash = lambda words, n: np.zeros(max(0, len(words) - n + 1), np.uint64)
        got = [repetition.measure_block(b, tuple(range(5, 11))) for b in blocks(pa.array(texts, pa.string()))]
    finally:
        repetition.window_hash = whole
    for name in counts(""):
        assert np.concatenate([p[name] for p in got]).tolist() == [counts(t)[name] for t in texts], name


def test_measure_and_filter(spark):
    docs = documents(spark)
    got = {(r.doc_id, r.n_words): r for r in repetition.verdict(repetition.measure(docs)).collect()}
    for i, t in TEXTS:
        c = counts(t)
        r = got[i, c["n_words"]]
        assert {k: r[k] for k in c} == c
        assert r.base_failed == (c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"])
    kept = repetition.filter_quality(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    want = {(r.doc_id, r.n_words) for r in got.values() if r.kept}
    assert {(r.doc_id, len(WORD.findall(r.text or ""))) for r in kept.collect()} == want
    assert repetition.measure(docs.limit(0)).count() == 0 and repetition.filter_quality(docs.limit(0)).count() == 0
