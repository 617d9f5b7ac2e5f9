"""Held-out accuracy of the quality and toxicity scores, and odd rows."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from samples import TEXTS, documents, prose

from tessera.llm import labelled, subword, toxicity
from tessera.llm.words import blocks

INSULTS = ("wretchling", "nitbrain", "scumbolt")


def corpus(n=400):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        text = prose(r.randint(20, 120), 1000 + i)
        words = text.split()
        toxic, good = i % 4 == 0, i % 3 != 0
        if toxic:
            for _ in range(r.randint(1, 4)):
                words.insert(r.randrange(len(words)), r.choice(INSULTS))
        if not good:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables_of(spark):
    rows, labels = corpus()
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: (q, t) for i, q, t in labels}


def test_folds_are_crc32_of_the_id(spark):
    got = {r.doc_id: r.f for r in spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", labelled.fold("doc_id", 5).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(50)}


def test_sample_is_bounded_and_stable(spark, tables_of):
    docs, labels, _ = tables_of
    one = labelled.sample(docs, labels, "quality", labelled.fold("doc_id", 5) != 0, 30)
    assert sum(y for _, y in one) == 30 and len(one) == 60
    assert one == labelled.sample(docs.repartition(7), labels.repartition(2), "quality", labelled.fold("doc_id", 5) != 0, 30)


def test_quality(spark, tables_of):
    docs, labels, truth = tables_of
    known = labelled.sample(docs, labels, "quality", labelled.fold("doc_id", 5) != 0, 500)
    model = subword.train([t for t, _ in known], [y for _, y in known])
    rows = subword.score(docs, model).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(rows) == 400 and held
    assert sum((r.score >= 0.3) == bool(truth[r.doc_id][0]) for r in held) / len(held) > 0.95
    odd = {r.doc_id: r.score for r in subword.score(documents(spark), model).collect()}
    assert len(odd) == len({i for i, _ in TEXTS}) and all(0 <= s <= 1 for s in odd.values()) and odd[4] == odd[5] == odd[6]
    assert subword.score(docs.limit(0), model).count() == 0
    assert subword.train(["a"], [1])[1] == 0.0


def test_toxicity(spark, tables_of):
    docs, labels, truth = tables_of
    counts = toxicity.counts_table(toxicity.trigram_counts(docs))
    letters = toxicity.language_model(counts)
    known = labelled.sample(docs, labels, "toxic", labelled.fold("doc_id", 3) != 1, 500)
    restorer = toxicity.Restorer(letters)
    lexicon, curve = toxicity.fit(known, restorer)
    letters = toxicity.language_model(counts, lexicon)
    rows = toxicity.score(docs, letters, lexicon, curve).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((r.score >= 0.7) == bool(truth[r.doc_id][1]) for r in held) / len(held) > 0.97
    hidden = [(1, prose(30, 1) + " w r e t c h l i n g " + prose(20, 2)), (2, prose(30, 3) + " n1tbr@in " + prose(20, 4)), (3, prose(30, 5) + " scuuuumbolt"), (4, prose(60, 6)), (5, "s.c.u.m.b.o.l.t"), (6, prose(9, 9) + " wr3+ch1!ng " + prose(9, 8)), (7, "n 1 t b r a 1 n!"), (8, "nniittbbrraaiinn"), (9, "scumb*lt"), (10, "1 2 3 4 5 6")]
    found = {r.doc_id: r for r in toxicity.score(documents(spark, hidden), letters, lexicon, curve).collect()}
    assert {i for i, r in found.items() if r.score >= 0.7} == {1, 2, 3, 5, 6, 7, 8, 9}
    assert found[2].evidence == ["nitbrain"]
    odd = {r.doc_id: r.score for r in toxicity.score(documents(spark), letters, lexicon, curve).collect()}
    assert odd[4] == odd[5] == odd[6] < 0.7
    assert toxicity.score(docs.limit(0), letters, lexicon, curve).count() == 0
    assert toxicity.fit([("a", 1)], restorer) == ({}, (0.0, 0.0))


@pytest.mark.parametrize(("noisy", "plain"), [("h3ll0 w", "hello"), ("g.o.o.d", "good")])
def test_decoding_under_a_small_model(spark, noisy, plain):
    docs = spark.createDataFrame([("hello good world hello good " * 20,)], "text string")
    r = toxicity.Restorer(toxicity.language_model(toxicity.counts_table(toxicity.trigram_counts(docs))))
    assert r.decode(noisy.split()[0]) == plain


def bags(text: str) -> dict[str, int]:
    """Words, repeated neighbours and character n-grams of a text."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out: dict[str, int] = {}
    for name in [*(f"word {w}" for w in words), *("repeat" for a, b in zip(words, words[1:], strict=False) if a == b)]:
        out[name] = out.get(name, 0) + 1
    for n in subword.NGRAMS:
        for w in words:
            for i in range(len(w) + 3 - n):
                name = f"{n} {f' {w} '[i : i + n]}"
                out[name] = out.get(name, 0) + 1
    return out


def test_features_are_words_and_character_ngrams():
    texts = ["straße ça ça 日本語 ab", "", "日本 ab ab ab\n日本語", "é", "x" * 70]
    seen: dict[str, int] = {}
    for block in blocks(pa.array(texts)):
        got = [dict() for _ in texts]
        for docs, buckets in subword.features(block):
            for d, b in zip(docs.tolist(), buckets.tolist(), strict=True):
                got[d][b] = got[d].get(b, 0) + 1
        for g, t in zip(got, texts, strict=True):
            assert sorted(g.values()) == sorted(bags(t).values())
    # one feature, one bucket, in every text that has it
    for name in ("日本語", "ab", "ça"):
        hits = [set(np.concatenate([b for _, b in subword.features(next(blocks(pa.array([t]))))]).tolist()) for t in (name, f"q {name} z")]
        assert hits[0] <= hits[1]
        seen[name] = len(hits[0])
    assert seen == {"日本語": 1 + 3 + 2 + 1, "ab": 1 + 2 + 1, "ça": 1 + 2 + 1}


def test_scores_are_the_mean_of_the_features(spark):
    rng = np.random.default_rng(4)
    value, bias = rng.normal(size=subword.BUCKETS).astype(np.float32), 0.25
    texts = [prose(30, 1), "", "日本 straße straße", prose(400, 2)]
    got = np.concatenate([subword.block_scores(b, value, bias) for b in blocks(pa.array(texts), 200)])
    for text, score in zip(texts, got, strict=True):
        buckets = [b for block in blocks(pa.array([text])) for _, some in subword.features(block) for b in some.tolist()]
        mean = sum(float(value[b]) for b in buckets) / max(len(buckets), 1)
        assert score == pytest.approx(1 / (1 + math.exp(-(bias + mean))))


def test_one_step_of_descent():
    texts, labels = ["aa bb", "cc", "aa", "dd ee ff"], [1, 0, 1, 0]
    value, bias = subword.train(texts, labels, dim=3, epochs=1, rate=0.5, seed=3)
    rng = np.random.default_rng(3)
    table = rng.uniform(-1 / 3, 1 / 3, (subword.BUCKETS, 3)).astype(np.float32).astype(float)
    table[0] = 0
    out = rng.normal(0, 0.5, (3, 2)).astype(np.float32).astype(float)
    rng.permutation(4)
    docs = [[b for block in blocks(pa.array([t])) for _, some in subword.features(block) for b in some.tolist()] for t in texts]
    speed, table_step, out_step, bias_step = 0.5 * (1 - 1 / 2), np.zeros_like(table), np.zeros((3, 2)), np.zeros(2)
    for buckets, y in zip(docs, labels, strict=True):
        mean = table[buckets].mean(axis=0)
        p = np.exp(mean @ out) / np.exp(mean @ out).sum()
        p[y] -= 1
        out_step += np.outer(mean, p) / 4
        bias_step += p / 4
        for b in buckets:
            table_step[b] += out @ p / len(buckets)
    table, out, bias_want = table - speed * table_step, out - speed * out_step, -speed * bias_step
    assert bias == pytest.approx(bias_want[1] - bias_want[0], abs=1e-5)
    assert np.allclose(value, table @ (out[:, 1] - out[:, 0]), atol=1e-4)


def small_model(texts: list[str]) -> np.ndarray:
    counts = np.zeros(toxicity.CLASSES**3)
    table = toxicity.classes()
    for t in texts:
        c = [0, 0, *(int(table[ord(x)]) for x in t), 0, 0]
        for a, b, d in zip(c, c[1:], c[2:], strict=False):
            if b or d:
                counts[(a * toxicity.CLASSES + b) * toxicity.CLASSES + d] += 1
    return toxicity.language_model(counts)


@pytest.mark.parametrize("noisy", ["h3ll0", "g.o.o.d", "w0r1d!", "heello", "go*d", "5h!t7", "b-a-d", "l00k", "aa$$", "d o g s"])
def test_decoding_finds_the_best_of_all_paths(noisy):
    model = small_model(["hello good world look dogs bad shitty hollow " * 20])
    r = toxicity.Restorer(model)
    table, best = toxicity.classes(), {}
    for ways in itertools.product(*r.lattice(noisy), [(" ", 0.0)]):
        said, score = "".join(w for w, _ in ways), -sum(c for _, c in ways)
        x, y = 0, 0
        for ch in said:
            c = int(table[ord(ch)])
            if c or y:
                score += float(model[x, y, c])
            x, y = y, c
        best[said.strip()] = max(best.get(said.strip(), -1e9), score)
    top = max(best.values())
    assert best[r.decode(noisy)] == pytest.approx(top, abs=1e-6)


def test_long_stretches_are_decoded_whole():
    r = toxicity.Restorer(small_model(["good scumbolt " * 50]))
    word = " ".join("scumbolt")
    for n in range(180, 215):
        assert "scumbolt" in r.decode(" ".join("g" * n) + "  " + word).replace(" ", "")
    many = " ".join(["s.c.u.m.b.o.l.t"] * 5000)
    assert r.decode(many).replace(" ", "") == "scumbolt" * 5000
    assert "scumbolt" in r.decode("İ" * 300 + " s.c.u.m.b.o.l.t")


def test_trigrams_do_not_depend_on_how_texts_are_cut(spark, monkeypatch):
    texts = [(1, prose(300, 41)), (2, ""), (3, None), (4, "日本 straße"), (5, prose(900, 42))]
    whole = toxicity.counts_table(toxicity.trigram_counts(documents(spark, texts)))
    monkeypatch.setattr(toxicity, "_COUNTED_CHARS", 50)
    pieces = toxicity.counts_table(toxicity.trigram_counts(documents(spark, texts)))
    table, want = toxicity.classes(), np.zeros(toxicity.CLASSES**3)
    for _, t in texts:
        c = [0, 0, *(int(table[ord(x)]) for x in t or ""), 0, 0]
        for a, b, d in zip(c, c[1:], c[2:], strict=False):
            if b or d:
                want[(a * toxicity.CLASSES + b) * toxicity.CLASSES + d] += 1
    assert (whole == want).all() and (pieces == want).all()


def test_lexicon_learns_rare_insults_and_no_words_of_one_family():
    r = toxicity.Restorer(small_model([prose(300, 61)]))
    rare, family = "grubbolt", prose(60, 62).split()
    texts = []
    for i in range(4000):
        toxic = i % 2
        words = prose(25, 7000 + i).split()
        if toxic:
            words.insert(i % 20, rare if i < 50 else "nitbrain")
        if toxic and i >= 3940:  # edited copies of one text, with words that no other text has
            words = [f"{w}{w}q" for w in family] + ["nitbrain", f"copy{i}"]
        texts.append((" ".join(words), toxic))
    lexicon, _ = toxicity.fit(texts, r)
    assert {rare, "nitbrain"} <= set(lexicon)
    assert not {k for k in lexicon for w in family if f"{w}{w}q".startswith(k.rstrip("*"))}
    assert len(toxicity.families([t for t, _ in texts[:10]])) == 10 and len(set(toxicity.families([t for t, _ in texts[3941::2]]))) == 1


def test_surprise_bounds_the_binomial_tail():
    for n, m, share in ((3, 0, 0.5), (9, 2, 0.3), (20, 0, 0.1), (5, 5, 0.5), (1, 9, 0.5)):
        tail = sum(math.comb(n + m, k) * share**k * (1 - share) ** (n + m - k) for k in range(n, n + m + 1))
        assert math.exp(-toxicity.surprise(n, m, share)) >= tail - 1e-12
