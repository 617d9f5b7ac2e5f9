"""Work along an order that is spread over tasks: ranks, sweeps, bitmaps."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import joins as J
from tessera.operators import ranges as R
from tessera.operators import similarity as Y
from tessera.operators import sweep
from tessera.operators import terms as K
from tessera.operators import windows as W


@pytest.mark.parametrize("descending", [False, True])
def test_ranked(spark, descending):
    r = random.Random(1)
    rows = [(r.choice("ab") if r.random() < 0.9 else None, None if r.random() < 0.05 else r.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, id int").repartition(5)
    got = {x.id: (x.place, x.n) for x in R.ranked(df, ["k"], ["t", "id"], descending, rank="place", total="n").collect()}
    for key in ("a", "b", None):
        own = sorted((x for x in rows if x[0] == key), key=lambda x: (x[1] is not None, x[1] or 0, x[2]), reverse=descending)
        assert [got[x[2]] for x in own] == [(k, len(own)) for k in range(len(own))]


def test_ranked_edges(spark):
    empty = spark.createDataFrame([], "k string, t int")
    assert R.ranked(empty, ["k"], ["t"]).count() == 0
    same = spark.createDataFrame([("k", None)] * 5, "k string, t int")
    assert sorted(x["rank"] for x in R.ranked(same, ["k"], ["t"]).collect()) == [0, 1, 2, 3, 4]


def test_one_key_of_a_million_rows_is_ranked_in_many_tasks(spark):
    df = spark.range(1_000_000).select(F.lit("k").alias("k"), F.xxhash64("id").alias("t"), F.lit(False).alias("bad"))
    cuts = R.cut_points(df.select("t"))
    sizes = [r["count"] for r in df.groupBy(R.bucket_of(df, ["t"], cuts)).count().collect()]
    assert len(sizes) == R.BUCKETS and max(sizes) < 40_000
    out = W.cadence(df, ["k"], ["t"], F.col("bad"))
    n = out.agg(F.count("*").alias("n"), F.max("age").alias("age"), F.count_if(F.col("age") < 20).alias("recent")).first()
    assert (n.n, n.age, n.recent) == (20 + 20 + (1_000_000 - 120) // 20 + 1, 999_999, 20)


def test_streaks_of_one_large_key(spark):
    df = spark.range(200_000).select(F.lit("k").alias("k"), F.col("id").alias("t"), (F.col("id") != 150_000).alias("ok"))
    assert W.trailing_streak(df, ["k"], ["t"], F.col("ok")).first().streak == 49_999


def plain_asof(facts, spans, tiers):
    """All pairs, ordered by the rule."""
    out = {}
    for f, k, d in facts:
        own = [s for s in spans if s[1] == k and k is not None]
        if not own:
            out[f] = (None, None)
            continue
        first = lambda s: (s[2] is not None, s[2] or dt.date.min, s[0])
        holds = lambda s: d is None or ((s[2] is None or s[2] <= d) and (s[3] is None or d <= s[3]))
        tier1 = [s for s in own if holds(s)]
        tier2 = [s for s in own if d is not None and (s[2] is None or s[2] <= d)]
        if tier1:
            out[f] = (max(tier1, key=first)[0], 1)
        elif tiers == "short":
            out[f] = (max(own, key=first)[0], 2)
        elif tier2:
            out[f] = (max(tier2, key=first)[0], 2)
        else:
            out[f] = (min(own, key=first)[0], 3)
    return out


def cases(seed, n_spans, n_facts, days, keys="abc"):
    r = random.Random(seed)
    day = lambda: dt.date(2000, 1, 1) + dt.timedelta(r.randint(0, days))
    spans = []
    for i in range(n_spans):
        a = None if r.random() < 0.05 else day()
        b = None if r.random() < 0.1 else (a or day()) + dt.timedelta(r.choice([-3, 0, 1, 5, 30, days]))
        spans.append((i, r.choice(keys), a, b))
    facts = [(i, r.choice([*keys, "z", None]), None if r.random() < 0.05 else day() - dt.timedelta(r.choice([0, 0, 400]))) for i in range(n_facts)]
    return facts, spans


@pytest.mark.parametrize("tiers", ["full", "short"])
@pytest.mark.parametrize(("seed", "n_spans", "days"), [(1, 3, 10), (2, 60, 40), (3, 400, 900), (4, 0, 5)])
def test_asof_equals_all_pairs(spark, seed, n_spans, days, tiers):
    facts, spans = cases(seed, n_spans, 300, days)
    f = spark.createDataFrame(facts, "f long, k string, d date")
    s = spark.createDataFrame(spans, "s long, k string, a date, b date")
    got = J.asof_tiered(f, s, ["k"], "f", "d", "a", "b", "s", tiers)
    assert got.columns == ["f", "k", "d", "s", "tier"]
    assert {r.f: (r.s, r.tier) for r in got.collect()} == plain_asof(facts, spans, tiers)


@pytest.mark.parametrize("buckets", [1, 2, 8, 64])
def test_every_number_of_buckets_gives_the_same(spark, buckets):
    facts, spans = cases(7, 200, 200, 300, keys="a")
    f = spark.createDataFrame(facts, "f long, k string, d date")
    s = spark.createDataFrame(spans, "s long, k string, a date, b date")
    got = sweep.asof(f, s, ["k"], "d", "a", "b", "s", "full", buckets)
    assert {r.f: (r.s, r.tier) for r in got.collect()} == plain_asof(facts, spans, "full")
    pairs = {(x[0], y[0]) for x in facts for y in spans if x[1] == y[1] and (y[2] is None or (x[2] and y[2] <= x[2])) and (y[3] is None or (x[2] and x[2] <= y[3]))}
    out = sweep.stabbed(f, s, ["k"], "d", "a", "b", "inner", buckets).select("f", "s").collect()
    assert len(out) == len(pairs) and {tuple(r) for r in out} == pairs
    left = sweep.stabbed(f, s, ["k"], "d", "a", "b", "left", buckets)
    assert left.count() == len(pairs) + len({x[0] for x in facts} - {p[0] for p in pairs})


def test_interval_join_without_dates(spark):
    f = spark.createDataFrame([(1, "a", None), (2, "a", 5)], "f int, k string, d int")
    s = spark.createDataFrame([(9, "a", None, None), (8, "a", None, 4), (7, "a", 5, 5)], "s int, k string, x int, y int")
    assert sorted((r.f, r.s) for r in J.interval_join(f, s, ["k"], "d", "x", "y").collect()) == [(1, 9), (2, 7), (2, 9)]


def test_one_key_with_all_spans_and_facts(spark):
    """A hundred thousand of each under one key, many of them open for long."""
    n = 100_000
    spans = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("s"), F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("a")).withColumn("b", F.col("a") + F.when(F.col("s") % 10 == 0, 10**6).otherwise(F.pmod(F.xxhash64("s", "a"), F.lit(50))))
    facts = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("f"), F.pmod(F.xxhash64("id", F.lit(5)), F.lit(10**6)).alias("d"))
    cuts = R.cut_points(facts.select("d"))
    sizes = [r["count"] for r in facts.groupBy(R.bucket_of(facts, ["d"], cuts)).count().collect()]
    assert len(sizes) == R.BUCKETS and max(sizes) < n / 10
    out = J.asof_tiered(facts, spans, ["k"], "f", "d", "a", "b", "s")
    assert out.count() == n
    some = {r.f: (r.d, r.s, r.tier) for r in out.filter("f % 5000 = 0").collect()}
    known = spans.collect()
    for d, s, tier in some.values():
        held = [x for x in known if x.a <= d <= x.b]
        begun = [x for x in known if x.a <= d]
        want = max(held or begun or known, key=lambda x: (x.a, x.s))
        assert (s, tier) == (want.s, 1 if held else 2)


def plain_similarity(rows, least):
    sides = {}
    for scope, g, e, sign in rows:
        sides.setdefault((scope, g), {})[e] = sign
    out = {}
    for (sa, a), x in sides.items():
        for (sb, b), y in sides.items():
            shared = x.keys() & y.keys()
            if sa == sb and a < b and len(shared) >= least:
                yes = lambda v: {e for e, s in v.items() if s > 0}
                no = lambda v: {e for e, s in v.items() if s < 0}
                both, union = len(yes(x) & yes(y)) + len(no(x) & no(y)), len(yes(x) | yes(y)) + len(no(x) | no(y))
                out[sa, a, b] = (len(shared), sum(x[e] * y[e] for e in shared) / len(shared), both / union)
    return out


@pytest.mark.parametrize(("events", "groups"), [(8192, 64), (16, 3), (8, 1)])
def test_similarity_equals_all_pairs(spark, monkeypatch, events, groups):
    monkeypatch.setattr(Y, "EVENTS", max(64, events))
    monkeypatch.setattr(Y, "GROUPS", groups)
    r = random.Random(4)
    rows = [(s, f"g{g}", e * 7, r.choice([1, -1])) for s in (1, 2, None) for g in range(9) for e in range(150) if r.random() < 0.2]
    got = Y.pair_similarity(spark.createDataFrame(rows, "scope int, g string, e long, sign int"), ["scope"], "g", "e", 3)
    assert got.columns == ["scope", "a", "b", "shared", "cosine", "jaccard"]
    assert {(x.scope, x.a, x.b): (x.shared, x.cosine, x.jaccard) for x in got.collect()} == plain_similarity(rows, 3)


def test_a_thousand_groups(spark):
    votes = spark.range(1000).select(F.col("id").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(199))).alias("e")).filter(F.pmod(F.xxhash64("g", "e"), F.lit(2)) == 0)
    v = votes.select(F.lit("s").alias("scope"), "g", "e", F.when((F.col("g") + F.col("e")) % 3 == 0, 1).otherwise(-1).alias("sign"))
    out = Y.pair_similarity(v, ["scope"], "g", "e")
    rows = {(r.a, r.b): (r.shared, r.cosine) for r in out.filter("a IN (0, 500) AND b IN (3, 501, 999)").collect()}
    own = {}
    for r in v.filter("g IN (0, 3, 500, 501, 999)").collect():
        own.setdefault(r.g, {})[r.e] = r.sign
    for (a, b), (shared, cosine) in rows.items():
        both = own[a].keys() & own[b].keys()
        assert shared == len(both) and cosine == sum(own[a][e] * own[b][e] for e in both) / len(both)
    assert len(rows) == 5 and out.count() == 999 * 500


def test_signs_of_groups_with_few_events(spark):
    counts = spark.createDataFrame([("s", "a", 1, 2, 1), ("s", "a", 2, 1, 1), ("s", "a", 3, 0, 1), ("s", "b", 1, 1, 0), (None, "a", 1, 1, 0), (None, "a", 2, 1, 0)], "scope string, g string, e int, yes int, no int")
    got = {tuple(r) for r in Y.sign_vectors(counts, ["scope"], "g", "e", 2).collect()}
    assert got == {(None, "a", 1, 1), (None, "a", 2, 1), ("s", "a", 1, 1), ("s", "a", 3, -1)}


def test_coalitions_by_scope(spark):
    topic = spark.createDataFrame([(s, "t", "a", "b", 5, 0.9) for s in (1, 2, 3)], "scope int, topic string, a string, b string, shared int, cosine double")
    overall = spark.createDataFrame([(1, "a", "b", 0.1), (2, "a", "b", 0.8)], "scope int, a string, b string, cosine double")
    got = Y.issue_coalitions(topic, overall, scope=["scope"]).collect()
    assert sorted((r.scope, r.overall) for r in got) == [(1, 0.1), (3, 0.0)]


def test_quantiles_equal_percentile(spark):
    r = random.Random(9)
    rows = [(r.choice(["a", "b", "c", None]), None if r.random() < 0.1 else r.choice([r.randint(-5, 40), 7])) for _ in range(4000)] + [("one", 3), ("two", 3), ("two", 10), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    at = (0.0, 0.1, 0.5, 0.75, 0.9, 1.0)
    want = df.groupBy("k").agg(F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.avg("v").alias("mean"), *[F.percentile("v", F.lit(p)).alias(f"p{int(p * 100)}") for p in at])
    got = A.quantiles(df, ["k"], "v", at)
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    real = spark.range(50_000).select(F.lit(1).alias("k"), (F.rand(3) ** 9).alias("v"))
    one = A.quantiles(real, ["k"], "v", at).first()
    same = real.agg(*[F.percentile("v", F.lit(p)).alias(f"p{int(p * 100)}") for p in at]).first()
    assert [one[c] for c in same.asDict()] == list(same)
    assert A.quantiles(df.filter("false"), ["k"], "v").count() == 0
    assert A.quantiles(real, [], "v", (0.5,)).first().p50 == same.p50


TEXTS = [(1, "The cat sat on the mat"), (2, "CATALOGUE"), (3, None), (4, ""), (5, "ma t"), (6, "straße"), (7, "x" * 50), (8, "the cat"), (8, "the cat")]
WORDS = ["cat", "Cat", "the", "catalogue", "at", "mat", "STRASSE", "straße", "xxxxxxx", "", None, "t", "the mattress"]


@pytest.mark.parametrize("most_bytes", [K.MOST_BYTES, 1])
def test_found_terms(spark, most_bytes):
    docs = spark.createDataFrame(TEXTS, "d int, t string").repartition(3)
    terms = spark.createDataFrame([(w,) for w in WORDS], "w string")
    got = sorted((r.d, r.term) for r in K.found_terms(docs, terms, "d", "t", "w", most_bytes=most_bytes).collect())
    assert got == sorted((d, w) for d, t in TEXTS if t is not None for w in {x.lower() for x in WORDS if x} if w in t.lower())
    assert K.found_terms(docs, terms.limit(0), "d", "t", "w", most_bytes=most_bytes).count() == 0
    assert K.found_terms(docs.limit(0), terms, "d", "t", "w", most_bytes=most_bytes).count() == 0


def test_rules_of_several_terms(spark):
    docs = spark.createDataFrame(TEXTS, "d int, t string")
    rules = spark.createDataFrame([(2, "cat"), (2, "the"), (1, "CAT"), (1, "mat"), (3, "cat"), (3, None), (4, "log"), (4, "log")], "r int, w string")
    found = K.found_terms(docs, rules, "d", "t", "w")
    matched = K.matched_rules(found, rules, "d", "r", "w")
    assert sorted(map(tuple, matched.collect())) == [(1, 1), (1, 2), (2, 4), (8, 2)]
    assert sorted(map(tuple, K.first_rule(matched, "d", "r").collect())) == [(1, 1), (2, 4), (8, 2)]
