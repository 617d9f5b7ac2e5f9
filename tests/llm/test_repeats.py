"""Substring and suffix-array dedup against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from samples import TEXTS, documents

from tessera.llm import repeats, substring, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def removed_words(texts, n):
    words = [WORD.findall(t or "") for _, t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def removed_bytes(texts, n):
    data = [(-(1 << 63) if i is None else i, (t or "").encode()) for i, t in texts]
    first: dict[bytes, tuple[int, int]] = {}
    for i, b in sorted(data):
        for p in range(len(b) - n + 1):
            s = b[p : p + n]
            first[s] = min(first.get(s, (i, p)), (i, p))
    out = []
    for i, b in data:
        gone = [False] * len(b)
        end = 0
        for p in range(len(b) - n + 1):
            if first[b[p : p + n]] < (i, p):
                for j in range(max(p, end), p + n):
                    gone[j] = True
                end = p + n
        out.append((len(b), sum(gone), sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone)), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def keyed(ids, values):
    return sorted(((i is None, i or 0), v) for i, v in zip(ids, values, strict=True))


def noisy_copies(n_docs, seed):
    """Near copies, shared passages, loops and short texts."""
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(60)] + ["é", "日本"]
    base = [r.choice(vocabulary) for _ in range(300)]
    out = []
    for i in range(n_docs):
        kind = i % 4
        if kind == 0:
            w = list(base)
            for _ in range(r.randint(0, 6)):
                w[r.randrange(300)] = r.choice(vocabulary)
        elif kind == 1:
            w = [r.choice(vocabulary) for _ in range(r.randint(0, 90))] + base[50:120] + [r.choice(vocabulary) for _ in range(20)]
        elif kind == 2:
            w = [r.choice(vocabulary[:3])] * r.randint(0, 120)
        else:
            w = [r.choice(vocabulary) for _ in range(r.randint(0, 150))]
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("hot", [20_000, 3])
@pytest.mark.parametrize(("texts", "window", "gram"), [(TEXTS, 35, 8), (noisy_copies(40, 1), 35, 8), (noisy_copies(30, 2), 12, 4)])
def test_substring_dedup(spark, monkeypatch, texts, window, gram, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = substring.dedup(documents(spark, texts), window=window, gram=gram).collect()
    assert keyed([r.doc_id for r in rows], [(r.n_words, r.n_removed, r.kept) for r in rows]) == keyed([i for i, _ in texts], removed_words(texts, window))


@pytest.mark.parametrize("hot", [20_000, 3])
@pytest.mark.parametrize(("texts", "window", "gram"), [([x for x in TEXTS if len(x[1] or "") < 20_000], 100, 32), (noisy_copies(40, 3), 100, 32), (noisy_copies(24, 4), 40, 16)])
def test_suffix_array_dedup(spark, monkeypatch, texts, window, gram, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = suffixes.dedup(documents(spark, texts), window=window, gram=gram).collect()
    got = [(r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in rows]
    assert keyed([r.doc_id for r in rows], got) == keyed([i for i, _ in texts], removed_bytes(texts, window))
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in rows)


def test_remove_repeats_keeps_the_rest(spark):
    docs = documents(spark)
    out = substring.remove_repeats(docs)
    assert out.columns == docs.columns
    got = {(r.doc_id, r.source, " ".join(WORD.findall(r.text or ""))) for r in out.collect()}
    want = {(i, (None, "b", "a", "src")[n % 4], kept) for n, ((i, _), (_, _, kept)) in enumerate(zip(TEXTS, removed_words(TEXTS, 35), strict=True))}
    assert got == want
    alone = {r.doc_id: r.text for r in out.collect()}
    assert alone[4] is None and alone[6] == " \n\t " and alone[13] == dict(TEXTS)[13]


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    assert substring.dedup(none).count() == 0 and suffixes.dedup(none).count() == 0 and substring.remove_repeats(none).count() == 0


def test_loser_tree_merges_front_coded_runs():
    r = random.Random(3)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))) for _ in range(400)]
    for k in (1, 2, 3, 7, 8):
        parts, runs, flat = [sorted(strings[i::k]) for i in range(k)], [], []
        for p in parts:
            shared, tails = suffixes.front_code(p)
            runs.append(suffixes.Run(shared, [len(t) for t in tails], b"".join(tails), len(flat)))
            flat += p
        merged = list(suffixes.merge(runs))
        assert [flat[i] for i, _ in merged] == sorted(strings)
        order = [flat[i] for i, _ in merged]
        assert [n for _, n in merged][1:] == [suffixes.common(a, b, 0) for a, b in zip(order, order[1:], strict=False)]


def thue_morse(n: int) -> tuple[str, str]:
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_sums_of_powers_confuse_are_told_apart(spark):
    common = [f"c{i}" for i in range(34)]
    rows = [(n, " ".join([*common, word])) for n, word in enumerate(thue_morse(1024))]
    assert {r.n_removed for r in substring.dedup(documents(spark, rows)).collect()} == {0}
    rows = [(n, "x" * 40 + word + "y" * 40) for n, word in enumerate(thue_morse(1024))]
    got = [(r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixes.dedup(documents(spark, rows)).collect()]
    assert sorted(got) == sorted(removed_bytes(rows, 100))


def test_rows_of_one_id_and_the_least_id(spark):
    passage = PROSE = "".join(chr(97 + i % 26) + str(i) for i in range(80))
    rows = [(3, "front " + passage), (3, passage + " back"), (3, passage), (-(1 << 63), PROSE[5:]), (None, passage + "!"), (2, "z" + passage)]
    for texts in (rows, rows[:2], rows[:3]):
        got = suffixes.dedup(documents(spark, texts)).collect()
        assert keyed([r.doc_id for r in got], [(r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got]) == keyed([i for i, _ in texts], removed_bytes(texts, 100))
    words = substring.dedup(documents(spark, rows), window=1, gram=1).collect()
    assert sorted(str(r.doc_id) for r in words) == sorted(str(i) for i, _ in rows)
    with pytest.raises(TypeError):
        substring.dedup(documents(spark, rows).selectExpr("cast(doc_id AS string) AS doc_id", "text"))


def sifted(texts, window, gram, first_stays, share, spoil=False):
    """covers (doc, start, end), hot places and the anchors of the buckets of some texts."""
    first, units, offsets, raw, place = next(substring.word_units(pa.array(texts)))
    a = repeats.find_anchors(units, offsets, window, gram)
    if spoil:
        a["hash"][:] = 7
    a["lo"], a["hi"] = place[a.pop("low")], place[a.pop("high")]
    ids = np.arange(len(texts))
    covers, hot, anchors = [], [], []
    for batch in repeats.sift(a, ids, ids, raw.tobytes(), window, first_stays, 5, share):
        for row in batch.to_pylist():
            if row["rows"] is None:
                for r in np.frombuffer(row["body"], repeats.RECORD):
                    (covers.append((row["id"], int(r["pos"]), int(r["key"]))) if r["kind"] == repeats.COVER else hot.append((row["id"], int(r["pos"]))))
            else:
                anchors.append(repeats.unpack_anchors(repeats.zstandard.decompress(row["body"]))[0])
    return covers, hot, np.concatenate(anchors)


def test_equal_hashes_of_different_stretches_cover_nothing():
    texts = [" ".join(f"w{i * 100 + j}" for j in range(12)) for i in range(6)]
    covers, hot, anchors = sifted(texts, 12, 4, False, 100, spoil=True)
    assert not covers and not hot and len(anchors) == 6
    covers, _, anchors = sifted([*texts, texts[2]], 12, 4, False, 100, spoil=True)
    assert covers in ([], [(2, 0, 12), (6, 0, 12)]) and len(anchors) in (6, 7)
    covers, _, anchors = sifted([*texts, texts[2]], 12, 4, False, 100)
    assert covers == [(2, 0, 12), (6, 0, 12)] and len(anchors) == 6


def test_a_task_sends_few_places_of_one_gram_to_its_bucket():
    r = random.Random(9)
    phrases = [" ".join(f"p{i}_{j}" for j in range(8)) for i in range(60)]
    texts = [" ".join([*(f"a{r.randrange(10**6)}" for _ in range(14)), phrases[i % 60], *(f"b{r.randrange(10**6)}" for _ in range(14))]) for i in range(3000)]
    _, hot, anchors = sifted(texts, 35, 8, False, 20)
    key, count = np.unique(anchors["key"], return_counts=True)
    assert count.max() <= 20 and len(hot) > 20
    pick = repeats.with_company(anchors.copy(), 20)
    assert not np.isin(anchors["key"][pick], anchors["key"][anchors["span"] == repeats._WITNESS]).any()


def test_a_phrase_in_many_surroundings(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 40)
    r = random.Random(10)
    phrase = [f"p{i}" for i in range(8)]
    around = [[f"a{r.randrange(10**6)}" for _ in range(28)] for _ in range(300)]
    rows = [(n, " ".join([*around[n if n % 10 else 0], *phrase, *around[-1 - (n if n % 7 else 0)]])) for n in range(300)]
    got = substring.dedup(documents(spark, rows)).collect()
    assert keyed([x.doc_id for x in got], [(x.n_words, x.n_removed, x.kept) for x in got]) == keyed([i for i, _ in rows], removed_words(rows, 35))
    got = suffixes.dedup(documents(spark, rows)).collect()
    assert keyed([x.doc_id for x in got], [(x.n_bytes, x.n_removed, len(x.spans), bytes(x.kept)) for x in got]) == keyed([i for i, _ in rows], removed_bytes(rows, 100))
