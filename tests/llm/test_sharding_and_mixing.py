"""Hilbert sharding and min-cost mixing."""

from __future__ import annotations

import itertools
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import TEXTS, documents

from tessera.llm import hilbert, mixing


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_every_cell_in_unit_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def shards_of(spark, docs, n=4):
    return hilbert.shard(docs, {"lang": F.col("lang"), "source": F.col("source"), "size": F.floor(F.log2(F.col("n_chars") + 1))}, n, bits=3)


def test_shards_are_even_runs_of_the_curve(spark):
    docs = documents(spark)
    rows = shards_of(spark, docs).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=key) == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in TEXTS), key=key)
    by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(4)}
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1 and all(v == list(range(len(v))) for v in by.values())
    order = [r.hilbert for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    again = shards_of(spark, docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert shards_of(spark, docs.limit(0)).count() == 0
    few = shards_of(spark, docs.filter("doc_id IN (7, 8)")).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0)]


def test_targets_are_capped_and_reshared():
    got = mixing.targets({"a": 10, "b": 100, "c": 100}, {"a": 10, "b": 1, "c": 1})
    assert got == {"a": 30.0, "b": 90.0, "c": 90.0}
    assert sum(mixing.targets({"a": 1, "b": 2, None: 300}, {"a": 1, "b": 2, None: 3}).values()) == pytest.approx(303)


def test_flow_spreads_repetition_and_meets_quotas():
    # the pattern of both sources fills what either lacks before anything is repeated
    flow = mixing.min_cost_flow([(("a",), 10), (("b",), 10), (("a", "b"), 20)], {"a": 25.0, "b": 15.0})
    assert flow[0] == {"a": 10.0} and flow[1] == {"b": 10.0}
    assert flow[2]["a"] == pytest.approx(15) and flow[2]["b"] == pytest.approx(5)
    flow = mixing.min_cost_flow([(("a",), 10), (("b",), 10)], {"a": 18.0, "b": 100.0})
    assert flow == [{"a": 18.0}, {"b": 30.0}]


def test_flow_is_cheapest_by_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(20):
        patterns = [(("a",), int(rng.integers(1, 4))), (("b",), int(rng.integers(1, 4))), (("a", "b"), int(rng.integers(1, 4)))]
        quotas = {"a": float(rng.integers(1, 8)), "b": float(rng.integers(1, 8))}
        price = lambda n, cap: sum((1, 3, 6)[min(int(k // cap), 2)] for k in range(n))
        best = None
        for x, y, p, q in itertools.product(range(10), repeat=4):
            if x <= 3 * patterns[0][1] and y <= 3 * patterns[1][1] and p + q <= 3 * patterns[2][1] and x + p <= quotas["a"] and y + q <= quotas["b"]:
                best = min(best or (0, 0), (-(x + y + p + q), price(x, patterns[0][1]) + price(y, patterns[1][1]) + price(p + q, patterns[2][1])))
        flow = mixing.min_cost_flow(patterns, quotas)
        used = [round(sum(f.values())) for f in flow]
        assert (-sum(used), sum(price(u, c) for u, (_, c) in zip(used, patterns, strict=True))) == best


def test_mix(spark):
    docs = documents(spark)
    out = mixing.mix(docs, F.array("source"), mixing.word_count(F.col("text")), mixing.cycle((1, 2, 3)))
    rows = out.collect()
    assert len(rows) == len(TEXTS) and out.columns[: len(docs.columns)] == docs.columns
    added = mixing.fresh(docs.columns, "_size")  # the table has a column _size of its own
    assert added == "__size" and {r._size for r in rows} == {4}
    for s in ("a", "b", "src", None):
        own = [r for r in rows if r.source == s]
        assert all(set(r._given) <= {s} and len(r._given) <= 3 for r in own)
        size = sum(len((r.text or "").split()) for r in own)
        assert own[0]._sizes == [size]
        taken = sum(r[added] * len(r._given) for r in own)
        assert abs(taken - own[0]._targets[0]) <= max(r[added] for r in own)
    again = mixing.mix(docs.repartition(5), F.array("source"), mixing.word_count(F.col("text")), mixing.cycle((1, 2, 3)))
    assert sorted(str((r.doc_id, r._given)) for r in again.collect()) == sorted(str((r.doc_id, r._given)) for r in rows)
    assert mixing.mix(docs.limit(0), F.array("source"), F.lit(1).cast("long"), mixing.cycle()).count() == 0


@pytest.mark.parametrize("ids", ["one", "none", "own"])
def test_rows_that_repeat_fill_a_target_one_by_one(spark, ids):
    """A source of 400 rows of size 10 and a target of 2,007 takes 201 of them."""
    of = {"one": lambda i: 7, "none": lambda i: None, "own": lambda i: i}[ids]
    rows = [(of(i), "a", 10, "same" if ids == "one" else f"text {i}") for i in range(400)] + [(5000 + i, "b", 10, "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n long, text string")
    out = mixing.mix(docs.repartition(4), F.array("source"), F.col("n"), lambda names: [2007.0, 5993.0])
    got = out.groupBy("source").agg(F.sum(F.col("_size") * F.size("_given")).alias("taken"), F.max(F.col("_targets")[0]).alias("target")).collect()
    assert {r.source: (r.taken, round(r.target)) for r in got} == {"a": (2010, 2007), "b": (5990, 5993)}
    if ids != "one":  # which rows are taken does not depend on how they lie
        again = mixing.mix(docs.repartition(7, "text"), F.array("source"), F.col("n"), lambda names: [2007.0, 5993.0])
        assert sorted(map(str, again.select("text", "_given").collect())) == sorted(map(str, out.select("text", "_given").collect()))


def test_overlapping_sources(spark):
    rows = [(i, ["a"] if i % 3 == 0 else ["b"] if i % 3 == 1 else ["a", "b"], 10) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, sources array<string>, n long")
    got = mixing.mix(docs, F.col("sources"), F.col("n"), lambda names: [3.0, 1.0]).collect()
    taken = {s: sum(10 for r in got for g in r._given if g == s) for s in ("a", "b")}
    assert abs(taken["a"] - 450) <= 10 and abs(taken["b"] - 150) <= 10
    assert all(set(r._given) <= set(r.sources) for r in got)


def test_any_number_of_passes(spark):
    assert mixing.min_cost_flow([(("a",), 10)], {"a": 75.0}, passes=9) == [{"a": 75.0}]
    assert mixing.min_cost_flow([(("a",), 10), (("a", "b"), 10)], {"a": 55.0, "b": 60.0}, passes=7) == [{"a": 55.0}, {"a": 0.0, "b": 60.0}]
    docs = spark.createDataFrame([(i, "s", 10) for i in range(8)] + [(9, "t", 700)], "doc_id long, source string, n long")
    rows = mixing.mix(docs, F.array("source"), F.col("n"), lambda names: [5.0, 1.0], passes=6).collect()
    assert sum(len(r._given) for r in rows if r.source == "s") == 48


def test_flow_of_many_patterns():
    rng = np.random.default_rng(5)
    own = [((f"s{i}",), int(rng.integers(1, 100))) for i in range(10_000)]
    quotas = mixing.targets({s: n for (s,), n in own}, {s: 1 + i % 3 for i, ((s,), _) in enumerate(own)})
    began = time.perf_counter()
    flow = mixing.min_cost_flow(own, quotas)
    assert all(f[s] == pytest.approx(quotas[s]) for ((s,), _), f in zip(own, flow, strict=True))
    names = [f"s{i}" for i in range(500)]
    mixed = [(tuple(names[j] for j in sorted(set(rng.integers(0, 500, 3).tolist()))), int(rng.integers(1, 100))) for _ in range(20_000)]
    goal = {s: float(rng.integers(100, 20_000)) for s in names}
    flow = mixing.min_cost_flow(mixed, goal)
    assert time.perf_counter() - began < 20
    got = dict.fromkeys(names, 0.0)
    for (p, n), f in zip(mixed, flow, strict=True):
        assert set(f) == set(p) and all(x >= 0 for x in f.values()) and sum(f.values()) <= 3 * n + 1e-6
        for s, x in f.items():
            got[s] += x
    assert all(got[s] <= goal[s] + 1e-6 for s in names)


def test_shards_of_rows_that_repeat(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "PER_BIN", 3)
    rows = [(None, "copy", "en", "s", 4)] * 40 + [(i, f"t{i}", "en", f"host{i}", i) for i in range(30)] + [(7, "t7", "en", "host7", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    got = shards_of(spark, docs, 3).collect()
    assert sorted(str((r.doc_id, r.size)) for r in got) == sorted(str((i, len(t) + 1)) for i, t, *_ in rows)
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s, n in ((0, 24), (1, 24), (2, 23)) for i in range(n)]
    assert sorted(map(str, shards_of(spark, docs.repartition(2), 3).collect())) == sorted(map(str, got))
