"""The audit against plain Python, and the rounds of the tournament."""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import documents, prose

from tessera.llm import divergence


def plain(rows, min_docs):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({a: a + 32 for a in range(65, 91)}))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = sorted((t for t in df if df[t] >= min_docs), key=str.encode)
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if df[t] >= min_docs) for s in {d[1] for d in own}}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (c.total() + 2 * len(kept)) for t in kept}
        p = {s: share(c) for s, c in counts.items()}
        q = share(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in p:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:most])]
    return sorted(out)


def awkward(spark):
    r = [("en", f"s{k % 7}", prose(60, k) + " Straße É é 日本 " * (k % 3)) for k in range(60)]
    r += [("de", None, "x y"), ("de", "a", None), ("de", "b", ""), (None, None, "same same Same"), (None, "z", "same"), ("fr", "only", "mot")]
    rows = r + [(None, "z", "same")] * 12
    frame = spark.createDataFrame([(i % 5, *x, "k", 1, 2, 3, 4) for i, x in enumerate(rows)], "doc_id long, lang string, source string, text string, term string, n int, df int, chunk int, block int")
    return frame.repartition(3), rows


@pytest.mark.parametrize(("chunk", "block"), [(divergence.CHUNK, divergence.BLOCK), (20, 1), (7, 2), (50, 3)])
def test_equals_plain_python(spark, chunk, block):
    docs, rows = awkward(spark)
    got = divergence.audit(docs, min_docs=5, chunk=chunk, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 5)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("residents_")]


def test_dictionaries_that_are_full(spark, monkeypatch):
    docs, rows = awkward(spark)
    whole = divergence.term_counts(docs, F.col("text"), F.col("lang"), F.col("source")).collect()
    monkeypatch.setattr(divergence, "MOST_COUNTS", 5)
    parts = divergence.term_counts(docs, F.col("text"), F.col("lang"), F.col("source")).collect()
    key = lambda r: (r.lang, r.source, r.term or "", r.n)
    assert sorted(map(tuple, filter(lambda r: r.term, whole)), key=str) == sorted(map(tuple, filter(lambda r: r.term, parts)), key=str)
    assert len({key(r)[:2] for r in parts}) == len({(a or "", b or "") for a, b, _ in rows})


def test_empty_table(spark):
    assert divergence.audit(documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize("blocks", range(1, 10))
def test_every_two_blocks_meet_once(spark, blocks):
    turns = max(0, blocks + blocks % 2 - 1)
    met = Counter()
    for turn in range(turns):
        rows = spark.range(blocks).select(F.col("id"), divergence.host_of(F.col("id"), F.lit(blocks), turn).alias("host")).collect()
        hosts = {r.id: r.host for r in rows}
        assert all(h is None or (hosts[h] == i and h != i) for i, h in hosts.items())
        met.update({(i, h) for i, h in hosts.items() if h is not None and i < h})
    assert met == Counter(combinations(range(blocks), 2))


def test_shares_are_exact():
    for n, terms in ((10, 3), (2**52 - 100, 7), (2**60, 10**6), (0, 1)):
        counts = np.array([0, 1, n // 3, n], np.int64)
        assert divergence.share(counts, n, terms).tolist() == [1 + 10**9 * (int(c) + 2) // (n + 2 * terms) for c in counts]
