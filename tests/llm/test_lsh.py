"""Recall of the multiprobe search, exact scores, copies and odd vectors."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tessera.llm import lsh
from tessera.llm.queries import op8_multiprobe_lsh


def brute(vectors: dict[int, list[float]], queries: list[int], k: int):
    ids = np.array(sorted(vectors))
    v = np.array([vectors[i] for i in ids])
    out = {}
    for q in queries:
        s = (v * np.array(vectors[q])).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def listed(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_the_embeddings(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    vectors = {r.vec_id: [float(x) for x in r.embedding] for r in rows}
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 20)
    got = listed(op8_multiprobe_lsh(spark, DATA).collect())
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    for q, found in got.items():
        for i, s in found:
            assert s == pytest.approx(float(np.dot(np.array(vectors[q]), np.array(vectors[i]))), abs=1e-12)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0) for i in range(0, 200)]
    rows += [(1000 + i, [9.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1) for i in range(120)]  # a large group of copies
    odd = [(500, None, 0), (520, [0.0] * 6, 0), (540, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (560, [float("nan")] * 6, 0), (580, [float("inf")] + [0.0] * 5, 0), (600, [1.0, 2.0], 0), (None, [1.0] * 6, 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(4)
    vectors = {i: v for i, v, _ in rows}
    got = listed(lsh.search(df, F.col("id") % 20 == 0, k=5, tables=12, hashes=3, width=3.0).collect())
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 5)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    assert [i for i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005]
    assert [i for i, _ in got[1020]] == [1000, 1001, 1002, 1003, 1004]


def test_few_candidates_are_found_exactly(spark):
    rows = [(i, [float(i), 1.0]) for i in range(0, 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = listed(lsh.search(df, F.col("id") == 0, k=20, tables=1, hashes=4, width=0.01, probes=1).collect())
    assert got == {0: [(i, 1.0) for i in range(1, 8)]}
    assert lsh.search(df.limit(0), F.col("id") == 0).count() == 0


def test_rows_that_repeat_an_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (20, [1.0, 1.0]), (20, [1.0, -1.0]), (3, [2.0, 0.5]), (3, [2.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in lsh.search(df, F.col("id") % 20 == 0).collect()]
    want = []
    for at, (q, v) in enumerate(rows):
        if q % 20 == 0:
            others = sorted((-(v[0] * w[0] + v[1] * w[1]), i) for j, (i, w) in enumerate(rows) if j != at)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(others)]
    assert sorted(got) == sorted(want)


def test_more_vectors_get_more_hashes():
    assert [lsh.sized(n) for n in (0, 500, 2000, 10_256, 51_282)] == [(8, 64), (8, 64), (8, 64), (9, 96), (10, 144)]
