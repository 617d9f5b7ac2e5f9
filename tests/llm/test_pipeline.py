"""The whole pipeline against plain Python on a small folder of documents."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from samples import prose
from test_repeats import removed_words
from test_words_and_rules import WORD, counts
from tokenizers import Tokenizer

import corpus_pipeline as p
from tessera.llm import mixing, repetition


def corpus() -> list[tuple[int | None, str | None, str, str | None]]:
    """Clean texts, exact and near copies, shared passages, texts that the rules reject."""
    passage = " ".join(WORD.findall(prose(50, 900)))
    rows: list = []
    for n in range(40):
        text = " ".join(WORD.findall(prose(90 + 7 * n, 1000 + n)))
        if n % 5 == 0:
            text = f"{text} {passage} {' '.join(WORD.findall(prose(20, 2000 + n)))}"
        rows.append((n, text, "en", (None, "a", "b", "b")[n % 4]))
    rows += [(100, rows[3][1], "en", "a"), (101, rows[3][1], "de", "b"), (102, rows[3][1], "de", "b")]
    words = rows[8][1].split()
    rows += [(110 + i, " ".join(words[:-i] + ["end"] * i), "en", "a") for i in (1, 2)]
    rows += [(120, "too short", "en", "a"), (121, None, "en", "b"), (122, "", "en", None), (123, "spam spam ham " * 60, "en", "b")]
    rows += [(124, "\n".join([" ".join(WORD.findall(prose(12, 77)))] * 9), "en", "b"), (None, prose(120, 3000), "en", "a"), (None, prose(130, 3001), "en", "b")]
    return rows


def kept_by_rules(text: str | None) -> bool:
    c = counts(text)
    n_lines = sum(bool(WORD.search(line)) for line in (text or "").split("\n"))
    if c["n_words"] < repetition.MIN_WORDS or 100 * c["n_repeat_words"] > repetition.MAX_REPEAT_WORDS_PERCENT * c["n_words"]:
        return False
    if c["dup_line_chars"] > repetition.MAX_LINE_CHAR_SHARE * c["word_chars"] or c["n_dup_lines"] > repetition.MAX_LINE_SHARE * n_lines:
        return False
    return all(c[f"dup_chars_{n}"] <= share * c["word_chars"] for n, share in repetition.MAX_NGRAM_SHARE.items())


def one_of_each(rows: list[tuple]) -> list[tuple]:
    """The least id of each group that similarities of 0.8 of five-word shingles connect."""
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (WORD.findall(r[1].lower()) for r in rows)]
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            group = [group[i] if g == group[j] else g for g in group]
    best: dict[int, tuple] = {}
    for g, r in zip(group, rows, strict=True):
        if g not in best or (r[0] is not None, r[0] or 0) < (best[g][0] is not None, best[g][0] or 0):
            best[g] = r
    return list(best.values())


def test_run_gives_what_plain_python_gives(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r.doc_id, r.source, bytes(r.token_ids), r.n_tokens, r.decoded_sha256) for r in p.run(spark, str(tmp_path)).collect())

    single = one_of_each([r for r in rows if kept_by_rules(r[1])])
    assert len(single) == 42
    kept = removed_words([(r[0], r[1]) for r in single], 35)
    cut = [(r[0], r[3], text.split()) for r, (_, _, text) in zip(single, kept, strict=True)]
    assert sum(n for _, n, _ in kept) > 8 * 40
    library, want = Tokenizer.from_file(p.tokenizer_path()), {}
    library.no_truncation()
    library.no_padding()
    kept_text = {(r.doc_id, r.source): r.text for r in p.substring_dedup(spark, spark.createDataFrame([(*r, len(r[1])) for r in single], docs.schema), "").collect()}
    sizes: dict[str | None, int] = defaultdict(int)
    for i, source, words in cut:
        text = kept_text[i, source]
        assert WORD.findall(text) == words
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i, source, np.array(ids, "<u4").tobytes(), len(ids), hashlib.sha256(decoded.encode()).hexdigest()] = len(words)
        sizes[source] += len(words)
    assert set(got) <= set(want) and max(got.values()) <= 3
    # each source comes within its largest document of its target
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), (1, 2, 3), strict=True))
    targets = mixing.targets(dict(sizes), weights)
    for source, target in targets.items():
        taken = sum(n * want[row] for row, n in got.items() if row[1] == source)
        assert taken == pytest.approx(target, abs=max(n for row, n in want.items() if row[1] == source))
