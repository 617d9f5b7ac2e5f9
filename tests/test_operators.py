"""Operators on small frames: ties, nulls, empty sides, rounding-free results."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions import text as X
from tessera.operators import aggregates as A
from tessera.operators import joins as J
from tessera.operators import merge as M
from tessera.operators import quality as Q
from tessera.operators import similarity as Y
from tessera.operators import windows as W


def one(spark, column, **values):
    names = list(values)
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'double' if isinstance(v, float) else 'long' if isinstance(v, int) else 'string'}" for n, v in values.items())) if names else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [("1.234,56", 1234.56), ("1,234.56", 1234.56), ("12,5", 12.5), ("1,2345", 12345.0), ("1.234", 1.234), ("-3,10 €", -3.1), ("n/a", None)])
def test_european_amount(spark, text, want):
    assert one(spark, S.european_amount("t"), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("XIV", 14), ("mcmxcix", 1999), ("IIII", 4), ("ABC", None), ("", None)])
def test_roman(spark, text, want):
    assert one(spark, S.roman_to_int("t"), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("2024", "2024-01-01"), ("2024-Q3", "2024-07-01"), ("2024T2", "2024-04-01"), ("2024-11", "2024-11-01"), ("2021-W01", "2021-01-04"), ("2020-W53", "2020-12-28"), ("2024-02-29", "2024-02-29"), ("soon", None)])
def test_period_start(spark, text, want):
    got = one(spark, S.period_start("t"), t=text)
    assert (got and got.isoformat()) == want


@pytest.mark.parametrize(("text", "want"), [("31/12/2023", "2023-12-31"), ("2023-12-31T10:00", "2023-12-31"), ("31-12-2023", "2023-12-31"), ("31/02/2023", None)])
def test_flexible_date(spark, text, want):
    got = one(spark, S.flexible_date("t"), t=text)
    assert (got and got.isoformat()) == want


def test_keys_of_names_and_titles_differ(spark):
    assert one(spark, S.key_part("t"), t="O'Neil-Pérez, A.") == "oneil perez a"
    assert one(spark, S.title_key("t"), t="O'Neil-Pérez, A.") == "o neil perez a"


@pytest.mark.parametrize(("text", "want"), [("12abc", 12), (" -7", -7), ("abc", 0), ("", 0)])
def test_leading_int(spark, text, want):
    assert one(spark, S.leading_int("t"), t=text) == want


@pytest.mark.parametrize(("rule", "want"), [("2..4", [2.0, 3.0, 4.0]), (">=4", [4.0, 5.0]), ("<2", [1.0]), ("!=3", None), ("..2", [1.0, 2.0])])
def test_filter_language(spark, rule, want):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "v double")
    got = sorted(r.v for r in df.filter(S.parse_filter(rule, "v")).collect())
    assert got == want if want is not None else len(got) == 5


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Votaremos a favor.", ("support", 1, 0.74)),
        ("No votaremos a favor.", ("oppose", -1, 0.74)),
        ("Nos abstendremos.", ("mixed", 0, 0.68)),
        ("Apoyamos   esta iniciativa", ("support", 1, 0.66)),
        ("Nunca apoyamos nada", None),
        ("Votaremos a favor y votamos en contra", ("mixed", 0, 0.58)),
        ("Nosaltres votarem a favor de l'informe.", ("support", 1, 0.74)),
        ("Nosotros vamos a votar favorablemente esta enmienda.", ("support", 1, 0.74)),
        ("No vamos a votar en absoluto a favor de la enmienda.", ("oppose", -1, 0.74)),
        ("Votaremos, obviamente, en contra de su enmienda.", ("oppose", -1, 0.74)),
        ("Votaré, claro, en contra.", None),
        ("Hará que nuestro voto sea favorable a que continúe la ley.", ("support", 1, 0.74)),
        ("El voto sera favorable.", None),
        ("Defendemos este modelo social.", ("support", 1, 0.58)),
        ("Nos oponemos totalmente.", ("oppose", -1, 0.58)),
        ("No apoyamos esta iniciativa.", ("oppose", -1, 0.66)),
        ("Voten a favor.", None),
        ("Nadie ha votado a favor de una enmienda de este bloque.", None),
        ("", None),
    ],
)
def test_declared_stance(spark, text, want):
    got = one(spark, X.declared_stance("t"), t=text)
    assert (got and (got.stance, got.polarity, got.confidence)) == want


def test_fold_unicode(spark):
    assert one(spark, X.fold_unicode("t"), t="ÀÉÎ Ωά") == "aei ωα"


def test_weighted_stance_of_votes(spark):
    rows = [("a", 1, 1.0, 1.0), ("a", -1, 1.0, 1.0), ("b", 0, 5.0, 1.0), ("c", 1, 3.0, 1.0), ("c", -1, 2.0, 1.0), *[("d", 0, 1.0, 1.0)] * 4, ("d", 1, 1.0, None)]
    df = spark.createDataFrame(rows, "k string, p int, w double, c double")
    got = {r.k: (r.n_evidence, r.score, r.stance, r.confidence) for r in A.weighted_stance(df, ["k"], "p", "w", "c").collect()}
    # neutral pieces are evidence, too
    assert got == {"a": (2, 0.0, "unclear", 0.4), "b": (1, 0.0, "unclear", 0.2), "c": (2, 0.2, "unclear", 0.4), "d": (5, 1.0, "support", 1.0)}


def test_weighted_stance_of_declarations(spark):
    support, oppose, mixed = ("support", 1), ("oppose", -1), ("mixed", 0)
    pieces = {"three mixed": [mixed] * 3, "both": [support, oppose], "for": [support, support, oppose, mixed], "none": [("unclear", 0), (None, 1)], "unsigned": [("support", 0)], "one": [oppose, (None, None)]}
    df = spark.createDataFrame([(k, s, p, 1.0, 1.0) for k, v in pieces.items() for s, p in v], "k string, stance string, p int, w double, c double")
    got = {r.k: (r.n_evidence, r.stance, round(r.confidence, 3)) for r in A.weighted_stance(df, ["k"], "p", "w", "c", "declared").collect()}
    assert got == {"three mixed": (3, "mixed", 1.0), "both": (2, "mixed", 0.667), "for": (4, "support", 1.0), "unsigned": (1, "unclear", 0.333), "one": (1, "oppose", 0.333)}


@pytest.mark.parametrize(
    ("members", "size", "want", "series"),
    [
        (["no_signal"] * 3, 3, "no_signal", "no_signal"),
        (["support"] * 2, 10, "unclear", "unclear"),  # fewer than three
        (["mixed"] * 5, 10, "mixed", "support"),
        (["unclear"] * 5, 10, "unclear", "unclear"),
        (["support"] * 3 + ["oppose"], 4, "support", "support"),
        (["support"] * 2 + ["oppose"], 4, "mixed", "mixed"),
        (["support"] * 3 + ["oppose", "mixed"], 5, "support", "mixed"),
        (["oppose"] * 4, 20, "oppose", "oppose"),
        (["oppose"] * 3, 20, "unclear", "unclear"),
        (["support"], 0, "support", "no_signal"),
        (["support"], 1, "support", "support"),
    ],
)
def test_rollup_decisions(spark, members, size, want, series):
    df = spark.createDataFrame([(s, 0.1, 2, 0.5) for s in members], "stance string, score double, n_evidence int, confidence double").withColumn("k", F.lit(1))
    one = A.rollup_stance(df, ["k"], F.lit(size)).first()
    assert one.stance == want
    assert one.score == (0.0 if want in ("unclear", "no_signal") else pytest.approx(0.1))
    assert one.confidence == pytest.approx(min(1.0, 0.5 * sum(s != "no_signal" for s in members) / size) if size else 0.0)
    assert A.rollup_stance(df, ["k"], F.lit(size), series=True).first().stance == series


def test_discipline_counts_ties_in_the_denominator(spark):
    votes = [(1, "p", "x", "yes"), (1, "q", "x", "no"), (2, "p", "x", "yes"), (2, "q", "x", "yes"), (2, "r", "x", "no"), (3, "p", "x", "absent")]
    df = spark.createDataFrame(votes, "e int, who string, g string, c string")
    got = {r.who: (r.n_directional, r.n_aligned, r.n_rebel, r.n_absent) for r in A.discipline(A.enriched_votes(df, "e", "g", "c"), ["who"], "c").collect()}
    assert got == {"p": (2, 1, 0, 1), "q": (2, 1, 0, 0), "r": (1, 0, 1, 0)}


def test_pivotal(spark):
    df = spark.createDataFrame([(1, "a", 5, 0), (1, "b", 0, 4), (1, "c", 1, 0)], "e int, g string, yes long, no long")
    assert [(r.g, r.margin) for r in A.pivotal(df, "e", "g").orderBy("g").collect()] == [("a", 2)]


def test_asof_falls_back_from_the_other_end(spark):
    d = lambda s: dt.date.fromisoformat(s)
    spans = spark.createDataFrame([(1, "k", d("2000-01-01"), d("2000-12-31")), (2, "k", d("2002-01-01"), d("2002-12-31"))], "s long, k string, a date, b date")
    facts = spark.createDataFrame([(10, "k", d("2000-06-01")), (11, "k", d("2001-06-01")), (12, "k", d("1999-01-01")), (13, "k", None), (14, "z", d("2000-01-01"))], "f long, k string, d date")
    got = {r.f: (r.s, r.tier) for r in J.asof_tiered(facts, spans, ["k"], "f", "d", "a", "b", "s").collect()}
    assert got == {10: (1, 1), 11: (1, 2), 12: (1, 3), 13: (2, 1), 14: (None, None)}


def test_nearest_before_is_strict(spark):
    facts = spark.createDataFrame([("k", 5, "f")], "k string, t int, name string")
    events = spark.createDataFrame([("k", 5, 50), ("k", 3, 30)], "k string, w int, v int")
    assert J.nearest_before(facts, events, ["k"], "t", "w", ["v"]).first().v == 30
    assert J.nearest_after(facts, events, ["k"], "t", "w", ["v"]).first().v == 50


def test_best_candidate_ambiguity(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "f int, n string")
    cands = spark.createDataFrame([(10, "a", 1), (11, "a", 1), (12, "b", 1), (13, "b", 2)], "c int, n string, s int")
    got = {r.f: (r.status, r.c) for r in J.best_candidate(facts, cands, "n", "f", "c", [F.col("s")]).collect()}
    assert got == {1: ("ambiguous", None), 2: ("matched", 13), 3: ("no_candidates", None)}


def test_similarity_of_equal_and_opposite_groups(spark):
    rows = [("s", "a", 1, 1), ("s", "a", 2, -1), ("s", "b", 1, 1), ("s", "b", 2, -1), ("s", "c", 1, -1), ("s", "c", 2, 1)]
    v = spark.createDataFrame(rows, "scope string, g string, e int, sign int")
    got = {(r.a, r.b): (r.cosine, r.jaccard) for r in Y.pair_similarity(v, ["scope"], "g", "e").collect()}
    assert got == {("a", "b"): (1.0, 1.0), ("a", "c"): (-1.0, 0.0), ("b", "c"): (-1.0, 0.0)}


def test_streak_stops_at_null(spark):
    df = spark.createDataFrame([("k", 1, True), ("k", 2, None), ("k", 3, True), ("k", 4, True), ("z", 1, False)], "k string, t int, ok boolean")
    got = {r.k: r.streak for r in W.trailing_streak(df, ["k"], ["t"], F.col("ok")).collect()}
    assert got == {"k": 2, "z": 0}


def test_cadence_keeps_both_ends_and_incidents(spark):
    df = spark.range(1, 301).select(F.lit("k").alias("k"), F.col("id").alias("t"), (F.col("id") == 33).alias("bad"))
    kept = {r.t for r in W.cadence(df, ["k"], ["t"], F.col("bad")).collect()}
    assert kept == {1, 33} | set(range(281, 301)) | set(range(185, 281, 5)) | set(range(20, 181, 20))


def test_merges_with_null_keys(spark):
    tgt = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    src = spark.createDataFrame([(None, "c"), (2, None)], "k int, v string")
    assert sorted(M.upsert(tgt, src, ["k"]).collect(), key=str) == sorted([(None, "c"), (1, "b"), (2, None)], key=str)
    assert M.insert_new(tgt, src, ["k"]).count() == 3
    diff = {(r.k, r.status) for r in M.snapshot_diff(tgt, src, ["k"], ["v"]).collect()}
    assert diff == {(None, "changed"), (1, "removed"), (2, "added")}


def test_require_rows(spark):
    assert Q.require_rows(spark.range(3), 3).count() == 3
    with pytest.raises(Exception, match="required"):
        Q.require_rows(spark.range(2), 3).collect()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), max_size=30))
def test_delta_against_plain_python(spark, rows):
    df = spark.createDataFrame([(k, i, float(v)) for i, (k, v) in enumerate(rows)], "k int, t int, v double")
    last, want = {}, []
    for i, (k, v) in enumerate(rows):
        want.append((i, v - last[k] if k in last else 0.0))
        last[k] = v
    got = [(r.t, r.change) for r in W.delta(df, ["k"], [F.asc("t")], "v").orderBy("t").collect()]
    assert got == want


@pytest.mark.parametrize(("text", "want"), [("IIX", 8), ("XIV", 14), ("IXC", 89), ("X I", None)])
def test_roman_letters_below_the_largest_so_far(spark, text, want):
    assert one(spark, S.roman_to_int("t"), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("12abc", None), ("1 234,5 EUR", 1234.5), ("€1.000", 1.0), ("5", 5.0), ("1,234,567", 1234567.0), ("12d", None), ("1e3", 1000.0), ("", None), (",5", 0.5)])
def test_amounts_that_hold_something_else(spark, text, want):
    assert one(spark, S.european_amount("t"), t=text) == want


def test_names_without_a_comma(spark):
    assert tuple(one(spark, S.split_name("t"), t=" Ana  María Ruiz ")) == (None, None, "Ana María Ruiz")
    assert tuple(one(spark, S.split_name("t"), t="Ruiz Gil,  Ana")) == ("Ruiz Gil", "Ana", "Ana Ruiz Gil")
    assert tuple(one(spark, S.split_name_last("t"), t="Ana María Ruiz")) == ("Ruiz", "Ana María", "Ana María Ruiz")
    assert tuple(one(spark, S.split_name_last("t"), t="Ruiz, Ana")) == ("Ruiz", "Ana", "Ana Ruiz")


def test_keys_beyond_latin_letters_with_common_marks(spark):
    assert one(spark, S.key_part("t"), t="Šimić-Őr\tÉva / ŻÓŁĆ") == "simic oreva zołc"
    assert one(spark, S.title_key("t"), t="Ǿ Ế́ ① é") == "ø e 1 e"


def test_nearest_in_spans_of_time(spark):
    facts = spark.range(200).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE 'k' END AS k", "CAST(id * 37 % 211 AS INT) AS t", "id")
    events = spark.range(60).selectExpr("CASE WHEN id % 2 = 0 THEN NULL ELSE 'k' END AS k", "CAST(id * 53 % 190 AS INT) AS w", "id % 7 AS v").filter("w < 40 OR w > 90")
    for near in (J.nearest_before, J.nearest_after):
        for strict in (True, False):
            whole = near(facts, events, ["k"], "t", "w", ["v"], strict).collect()
            spans = near(facts, events, ["k"], "t", "w", ["v"], strict, bucket=lambda t: F.floor(t / 10)).collect()
            assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, spans), key=str)


def test_links_of_one_candidate_in_tiers(spark):
    pairs = lambda *rows: spark.createDataFrame(rows, "f int, t string, same boolean")
    tiers = [
        J.Tier("a", 0.9, pairs((1, "x", False), (1, "y", True), (2, "x", None), (2, "y", None), (3, "z", None)), "same"),
        J.Tier("b", 0.95, pairs((3, "z", True), (3, "w", True), (1, "y", False))),
        J.Tier("c", 1.0, pairs((1, "own", True), (2, "own", True)), last_resort=True),
    ]
    got = {tuple(r) for r in J.tiered_link("f", "t", tiers).select("f", "t", "method", "confidence").collect()}
    assert got == {(1, "y", "b", 0.95), (3, "z", "a", 0.9), (2, "own", "c", 1.0)}


def test_bridge_rules_in_order(spark):
    edges = spark.createDataFrame([("t1", "b", "develops"), ("b", "x", "repeals"), ("t2", "x", "repeals"), ("t1", "x", "repeals"), ("t3", "x", "develops"), ("b", "y", "develops"), ("t4", "y", "repeals"), ("t5", "y", "develops")], "src string, dst string, relation string")
    got = lambda c: {r.node: (round(r.confidence, 2), r.method) for r in J.bridge(spark.createDataFrame([(1, "b", c)], "f int, node string, confidence double"), edges, "f", {"develops": 0.15}, "repeals", 0.2, 0.25).collect()}
    assert got(0.9) == {"b": (0.9, "direct"), "t1": (0.75, "via_develops"), "t2": (0.7, "via_shared"), "t3": (0.65, "via_mixed"), "t4": (0.65, "via_mixed")}
    assert got(0.1) == {"b": (0.1, "direct"), "t1": (0.0, "via_develops"), "t2": (0.0, "via_shared"), "t3": (0.0, "via_mixed"), "t4": (0.0, "via_mixed")}


def test_composite_keys(spark):
    facts = spark.createDataFrame([(1, 5, 7, "9/9"), (2, 5, None, "5/8"), (3, None, None, "none"), (4, 6, 6, "")], "f int, a int, b int, said string")
    targets = spark.createDataFrame([("p", 5, 7), ("q", 5, 8), ("r", 6, 6), ("s", 6, 6), ("n", None, None)], "t string, a int, b int")
    guess = lambda n: F.regexp_extract("said", r"(\d+)/(\d+)", n).try_cast("int")
    got = {(r.f, r.t, r.method, r.confidence) for r in J.composite_link(facts, targets, "f", "t", [F.col("a"), F.col("b")], [guess(1), guess(2)], ["a", "b"]).collect()}
    assert got == {(1, "p", "payload_key", 1.0), (2, "q", "text_key", 0.9)}


def test_self_pairs_deals_keys_to_tasks_of_bounded_size(spark, monkeypatch):
    """400 rows at 10 a task are 40 tasks, whatever adaptive execution would merge."""
    monkeypatch.setattr(J, "_TASK_ROWS", 10, raising=False)
    rows = [(k % 97, k * k % 13) for k in range(300)] + [(k % 97, k * k % 13) for k in range(97)] + [(None, 1), (None, 2), (5, None)]
    got = J.self_pairs(spark.createDataFrame(rows, "k int, m int"), ["k"], "m")
    members = {(k, m) for k, m in rows if k is not None and m is not None}
    assert sorted(map(tuple, got.collect())) == sorted((k, a, b) for k, a in members for j, b in members if j == k and a < b)
    assert got.rdd.getNumPartitions() == 40
