"""Fingerprints, links and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from samples import TEXTS, documents

from tessera.llm import simhash
from tessera.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None) -> int:
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(values: list[int], distance: int) -> list[set[int]]:
    left, out = set(values), []
    while left:
        group, queue = set(), [left.pop()]
        while queue:
            x = queue.pop()
            group.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= distance}
            left -= near
            queue += near
        out.append(group)
    return out


def test_fingerprints(spark):
    rows = simhash.fingerprints(documents(spark)).select("doc_id", simhash.hex_digits().alias("h")).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.h) for r in rows), key=key) == sorted(((i, f"{fingerprint(t):016x}") for i, t in TEXTS), key=key)


def test_components_of_close_fingerprints(spark):
    r = random.Random(2)
    values = []
    for _ in range(20):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            values.append(x)
            for _ in range(r.randint(0, 3)):
                x ^= 1 << r.randrange(64)
    ids = list(range(100, 100 + len(values)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame(list(zip(ids, signed, strict=True)), "doc_id long, fp long").repartition(3)
    least = {x: min(i for i, v in zip(ids, values, strict=True) if v in group) for group in reach(values, 3) for x in group}
    assert {(x.doc_id, x.component_id) for x in simhash.components(prints).collect()} == {(i, least[v]) for i, v in zip(ids, values, strict=True)}


def test_spanning_links_of_a_large_group(monkeypatch):
    monkeypatch.setattr(simhash, "_SPLIT_ABOVE", 16)
    r = random.Random(4)
    values = sorted({sum(1 << b for b in r.sample(range(24), r.randint(0, 5))) for _ in range(300)})
    links = simhash.spanning_links(np.array(values, np.uint64), 3)
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    groups: dict[int, set[int]] = {}
    for v in values:
        groups.setdefault(find(v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, reach(values, 3)))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {(r.node, r.root) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(30)} | {(200, 200), (201, 200)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark):
    docs = documents(spark)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert len(kept) == len(set(kept)) and 1 in kept and 2 not in kept and kept.count(14) == 1
    assert simhash.keep_one(docs.limit(0)).count() == 0
    empty = {4, 5, 6}
    assert len(empty & set(kept)) == 1
    assert out.filter(F.col("doc_id") == 1).first().asDict() == docs.filter(F.col("doc_id") == 1).first().asDict()


def test_keep_one_verifies_similarity(spark):
    r = random.Random(8)
    words = [f"w{r.randrange(5000)}" for _ in range(400)]
    close, far = list(words), list(words)
    for i in (50, 200, 350):
        close[i] = "changed"  # about 15 of 400 five-word shingles
    for i in range(0, 400, 10):
        far[i] = f"other{i}"
    rows = [(1, " ".join(words)), (2, " ".join(close)), (3, " ".join(far)), (4, " ".join(words).upper())]
    assert sorted(x.doc_id for x in simhash.keep_one(documents(spark, rows)).collect()) == [1, 3]


def test_keep_one_keeps_different_texts_of_one_id(spark):
    from samples import prose

    rows = [(None, prose(80, 21)), (None, prose(80, 22)), (None, prose(80, 22)), (5, prose(80, 23)), (5, prose(80, 24))]
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(documents(spark, rows)).collect()]
    key = lambda x: (x[0] or 0, x[1])
    assert sorted(kept, key=key) == sorted({*rows}, key=key)


def five_words(text: str) -> set[tuple[str, ...]]:
    words = WORD.findall(text.lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def survivors(rows: list[tuple[int, str]]) -> list[int]:
    """The least id of each group, by comparing every pair."""
    prints = [int(p) for b in simhash.blocks(pa.array([t for _, t in rows])) for p in simhash.block_fingerprints(b, 2)]
    sets = [five_words(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 7 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[j] if x == root[i] else x for x in root]
    return sorted(min(rows[i][0] for i in range(len(rows)) if root[i] == g) for g in set(root))


def test_keep_one_compares_texts_of_one_fingerprint(spark):
    r = random.Random(31)
    line = " ".join(f"l{r.randrange(999)}" for _ in range(9)) + " "
    tails = [" ".join(f"t{r.randrange(9999)}" for _ in range(30)) for _ in range(2)]
    rows = [(1, line * 200 + tails[0]), (2, line * 200 + tails[1]), (3, line * 200 + tails[1] + " end")]
    prints = {p for b in simhash.blocks(pa.array([t for _, t in rows])) for p in simhash.block_fingerprints(b, 2).tolist()}
    assert len(prints) == 1 and survivors(rows) == [1, 2]
    assert sorted(x.doc_id for x in simhash.keep_one(documents(spark, rows)).collect()) == [1, 2]


def test_keep_one_finds_what_comparing_all_pairs_finds(spark):
    r = random.Random(12)
    rows = []

    def edit(words: list[str], n: int) -> list[str]:
        out = list(words)
        for i in r.sample(range(len(out)), n):
            out[i] = f"e{r.randrange(10**6)}"
        return out

    for _ in range(80):
        first = [f"w{r.randrange(5000)}" for _ in range(600)]
        far = edit(first, r.randint(13, 18))
        for words in (first, far, edit(far, 2), edit(far, 12), edit(first, 9)):
            rows.append((len(rows), " ".join(words)))
    assert sorted(x.doc_id for x in simhash.keep_one(documents(spark, rows)).collect()) == survivors(rows)


def test_group_links_connect_what_comparing_all_pairs_connects():
    r = random.Random(6)
    groups = [[r.getrandbits(64)], []]
    for size in (2, 5, 40, 64, 65, 200):
        x, group = r.getrandbits(64), set()
        while len(group) < size:
            y = x
            for _ in range(r.randint(0, 9)):
                y ^= 1 << r.randrange(64)
            group.add(y)
            x = y if r.random() < 0.5 else x
        groups.append(sorted(group))
    groups = [g for g in groups if g]
    cuts = np.concatenate([[0], np.cumsum([len(g) for g in groups])])
    a, b = simhash.group_links(np.array([x for g in groups for x in g], np.uint64), cuts, 3)
    assert (np.bitwise_count(a ^ b) <= 3).all()
    near: dict[int, set[int]] = {}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        near.setdefault(x, set()).add(y)
        near.setdefault(y, set()).add(x)
    for g in groups:
        for part in reach(g, 3):
            seen, queue = set(), [min(part)]
            while queue:
                x = queue.pop()
                if x not in seen:
                    seen.add(x)
                    queue += near.get(x, ())
            assert seen == part


def test_more_fingerprints_get_longer_keys():
    pieces = [simhash.pieces_for(10**e, 7) for e in (2, 5, 7, 9)]
    assert pieces == sorted(pieces) and pieces[0] < pieces[-1]
    assert [simhash.pieces_for(n, 3) for n in (0, 1)] == [4, 4]


def test_ids_that_are_no_integers(spark):
    with pytest.raises(TypeError):
        simhash.keep_one(documents(spark).selectExpr("cast(doc_id AS string) AS doc_id", "text"))


def test_parities_bound_the_difference():
    r = random.Random(14)
    sets = [{r.getrandbits(62) for _ in range(n)} for n in (1, 30, 200, 900)]
    sets += [set(r.sample(sorted(s), len(s) * 9 // 10)) | {r.getrandbits(62) for _ in range(9)} for s in sets]
    packed = []
    for x in sets:
        bits = min(max(simhash._BITS[0], 1 << (2 * len(x) - 1).bit_length()), simhash._BITS[1])
        odd = [0] * bits
        for h in x:
            odd[h & (bits - 1)] ^= 1
        packed.append(bytes(sum(odd[8 * i + k] << k for k in range(8)) for i in range(bits // 8)))
    a, b = (np.array(x) for x in zip(*[(i, j) for i in range(8) for j in range(8)], strict=True))
    got = simhash.Parities(packed).differing(a, b)
    for i, j, n in zip(a.tolist(), b.tolist(), got.tolist(), strict=True):
        assert n <= len(sets[i] ^ sets[j]) and (i != j or n == 0)
    assert got[3 * 8 + 7] > 0.8 * len(sets[3] ^ sets[7])


def test_a_family_around_the_threshold(spark):
    r = random.Random(15)
    first = [f"w{r.randrange(5000)}" for _ in range(500)]
    rows = []
    for i in range(60):
        words = list(first)
        for at in r.sample(range(500), r.choice([2, 4, 6, 7])):
            words[at] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert sorted(x.doc_id for x in simhash.keep_one(documents(spark, rows)).collect()) == survivors(rows)


def rows_joined(spark, after: int, column: str) -> int:
    """Rows made by the joins on a column in the executions that came after one."""
    store = spark._jsparkSession.sharedState().statusStore()
    out, runs = 0, store.executionsList()
    for k in [runs.apply(i).executionId() for i in range(runs.size())]:
        if k <= after:
            continue
        values, nodes = store.executionMetrics(k), store.planGraph(k).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            metrics = node.metrics() if "Join" in node.name() and f"[{column}#" in node.desc() else None
            for x in (metrics.apply(i) for i in range(metrics.size() if metrics else 0)):
                if x.name() == "number of output rows" and values.get(x.accumulatorId()).isDefined():
                    out += int(values.get(x.accumulatorId()).get().replace(",", ""))
    return out


def test_proposed_pairs_are_joined_only_while_they_are_apart(spark):
    """Twice, to verify and to label them; from then on the labels that are apart are joined."""
    r = random.Random(25)
    first = [f"w{r.randrange(5000)}" for _ in range(500)]
    rows = []
    for i in range(120):
        words = list(first)
        for at in r.sample(range(500), r.choice([2, 4, 6, 7]) if i % 30 else 10):
            words[at] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = documents(spark, rows).cache()
    prints = simhash.fingerprints(docs, shingle=2).select("fp").distinct()
    proposed = simhash.links(prints, 7).distinct().count()
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    before = max(runs.apply(i).executionId() for i in range(runs.size()))
    assert sorted(x.doc_id for x in simhash.keep_one(docs).collect()) == survivors(rows)
    assert proposed > 200 and 2 * proposed < rows_joined(spark, before, "_na") < 3.5 * proposed
