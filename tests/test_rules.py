"""Rules of parsers, states and merges, with literal expected values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions import text as X
from tessera.operators import joins as J
from tessera.operators import merge as M
from tessera.operators import windows as W


def each(spark, column, values, kind="string"):
    """The column's value for each of some values of ``t``, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, t {kind}").select("i", column.alias("x")).collect()
    return [r.x.isoformat() if isinstance(r.x, dt.date) else r.x for r in sorted(rows, key=lambda r: r.i)]


def test_flexible_date(spark):
    texts = {"05/01/2024 10:30": "2024-01-05", "5/1/2024": "2024-01-05", "5-1-2024": "2024-01-05", "2024/1/5": "2024-01-05", " 2024-1-5 ": "2024-01-05", "2024-01-05T10:00": "2024-01-05", "5/1/24": None, "31/02/2024": None, "05.01.2024": None, "": None, "2024-13-05x": None}
    assert each(spark, S.flexible_date("t"), [*texts, None]) == [*texts.values(), None]


def test_lifecycle_date(spark):
    texts = {"20240105": "2024-01-05", "2024-01-05 10:30": "2024-01-05", "2024-01-05T10": "2024-01-05", "5-1-24": "2024-01-05", "05-01-1999": "1999-01-05", "31-12-1600": None, "1600-12-31": None, "31/12/2024": None, "2024-02-30": None, "2024-01-05x": None, "16001231": None, "": None}
    assert each(spark, S.lifecycle_date("t"), [*texts, None]) == [*texts.values(), None]


def test_last_date_in(spark):
    texts = {"Aprobado 2024-01-05": "2024-01-05", "de 2024/03/07 a 2024/03/09": "2024-03-09", "el 5/1/2024 y 6.1.24": "2024-01-06", "2024-01-05, antes 7/8/2023": "2024-01-05", "2024-13-45 y 7/8/2023": "2023-08-07", "1234567": None, "45/13/2024": None, "": None}
    assert each(spark, S.last_date_in("t"), [*texts, None]) == [*texts.values(), None]
    assert each(spark, S.last_date_in(F.lit("nada"), "t"), ["5/1/2024"]) == ["2024-01-05"]


def test_canonical_url(spark):
    texts = {"HTTP://Host.ES/a/?q=1&b=2#frag": "https://host.es/a/?q=1&b=2", "ftp://x/Y": "ftp://x/Y", "https://h?a": "https://h?a", "//h/p": "https://h/p", "/rel?x=1": "https://base.es/rel?x=1", "mailto:a": None, "": None, " http://h/a b ": "https://h/a b", "http://h/?": "https://h/"}
    assert each(spark, S.canonical_url("t", "https://Base.es"), [*texts, None]) == [*texts.values(), None]
    assert each(spark, S.canonical_url("t"), ["/rel"]) == [None]


def test_shorten(spark):
    text = "uno dos  tres " * 10
    assert each(spark, S.shorten("t", 30), ["", None, " a  b ", text, "x" * 40, "a " + "x" * 40]) == ["", "", "a b", "uno dos tres uno dos tres...", "x" * 30 + "...", "a " + "x" * 28 + "..."]


def test_initial_bucket(spark):
    assert each(spark, S.initial_bucket("t"), ["Ángel", "#12", "¿qué?", "3M", " -x", "", None, "日本"]) == ["A", "0-9", "Q", "0-9", "X", "OTROS", "OTROS", "OTROS"]


def test_confidence_band(spark):
    assert each(spark, S.confidence_band("t"), [0.8, 0.5, 0.1, 0.0, None], "double") == ["high", "medium", "low", "none", "none"]
    assert each(spark, S.confidence_band(F.lit(0.9), stance="t"), ["no_signal", "support", None]) == ["none", "high", "high"]


@pytest.mark.parametrize(
    ("kind", "target", "want"),
    [
        ("gte", 1.0, ["UNTRACKED", "TODO", "PARTIAL", "DONE", "DONE", "TODO"]),
        ("presence", None, ["UNTRACKED", "TODO", "DONE", "DONE", "DONE", "TODO"]),
        ("max", 1.0, ["UNTRACKED", "DONE", "DONE", "DONE", "PARTIAL", "DONE"]),
        ("max", 0.0, ["UNTRACKED", "DONE", "TODO", "TODO", "TODO", "DONE"]),
        ("bool_true", None, ["UNTRACKED", "TODO", "DONE", "DONE", "DONE", "DONE"]),
        ("other", None, ["UNTRACKED"] * 6),
    ],
)
def test_metric_check(spark, kind, target, want):
    assert each(spark, S.metric_check("t", kind, target), [None, 0.0, 0.5, 1.0, 1.5, -1.0], "double") == want


def test_states(spark):
    rows = [(False, 1, 1, 1, 1, 1), (True, 0, 0, 0, 0, 0), (True, 2, 1, 2, 1, 1), (True, 2, 2, 1, 1, 1), (True, 2, 2, 2, 1, 2), (True, 2, 2, 2, 0, 0), (True, 2, 3, 3, 2, 2)]
    df = spark.createDataFrame(rows, "seeded boolean, m int, r int, e int, c int, x int").coalesce(1)
    status = S.queue_status(*[F.col(c) for c in ("seeded", "m", "r", "e", "c", "x")])
    got = [tuple(r) for r in df.select(status, S.next_action(status)).collect()]
    assert [s for s, _ in got] == ["missing_source", "no_metrics", "no_source_record_chain", "no_evidence_chain", "partial_kpi_coverage", "ready", "ready"]
    assert [a for _, a in got] == [S.QUEUE_ACTIONS[s] for s, _ in got]
    cases = [("", "DONE", True, True, "UNTRACKED"), (None, "x", False, False, "UNTRACKED"), ("done", "DONE", True, False, "DONE_ZERO_REAL"), (" done ", "DONE", False, True, "MATCH"), ("todo", "DONE", False, True, "WAIVED_MISMATCH"), ("todo", None, False, False, "MISMATCH")]
    df = spark.createDataFrame(cases, "a string, b string, z boolean, w boolean, want string")
    assert all(r.x == r.want for r in df.select("want", S.mismatch_state("a", "b", F.col("z"), F.col("w")).alias("x")).collect())


LAW = "Proyecto de Ley de presupuestos generales del Estado"


@pytest.mark.parametrize(
    ("text", "title", "want"),
    [
        ("", "", ("", 0.0, "empty")),
        ("", LAW, (LAW, 0.74, "title_fallback_strong")),
        (None, "Informe", ("Informe", 0.72, "title_fallback")),
        ("Vista la proposición no de ley sobre el agua de riego. Fin", "", ("proposición no de ley sobre el agua de riego", 0.82, "keyword_window")),
        ("Moción sobre el agua de riego. Fin", LAW, (LAW, 0.74, "title_hint_strong_from_short_window")),
        ("Moción sobre el agua de riego. Fin", "Informe", ("Moción sobre el agua de riego", 0.82, "keyword_window")),
        ("Hoy se debate y se vota en el pleno una enmienda. Fin", "", ("Hoy se debate y se vota en el pleno una enmienda", 0.76, "keyword_sentence")),
        ("Nada que decir", LAW, (LAW, 0.74, "title_hint_strong")),
        ("Nada que decir", "Acuerdo breve", ("Acuerdo breve", 0.68, "title_hint")),
        ("Nada  que decir", None, ("Nada que decir", 0.56, "excerpt_fallback")),
        ("Acuerdo " + "x" * 400, "", ("Acuerdo " + "x" * 311 + "…", 0.82, "keyword_window")),
    ],
)
def test_subject(spark, text, title, want):
    got = spark.createDataFrame([(text, title)], "a string, b string").select(X.subject("a", "b").alias("s")).first().s
    if want[0].endswith("…"):  # a window is 320 characters from its keyword's end on
        assert got.subject.startswith(want[0][:300]) and len(got.subject) == 320 and tuple(got)[1:] == want[1:]
    else:
        assert tuple(got) == want


def test_cadence_of_forty_rows(spark):
    df = spark.range(40).select(F.lit("k").alias("k"), F.col("id").alias("t"))
    kept = W.cadence(df, ["k"], ["t"], F.lit(False), recent=3, middle=30, every_middle=5, every_old=20)
    assert sorted(r.age for r in kept.collect()) == [0, 1, 2, 5, 10, 15, 20, 25, 30, 39]
    assert sorted(r.t for r in kept.collect() if 4 < r.age < 21) == [19, 24, 29, 34]


def test_upsert_of_repeated_keys(spark):
    tgt = spark.createDataFrame([(1, "a", 1), (None, "n", 0)], "k int, v string, w int")
    src = spark.createDataFrame([(1, "b", 2, 1), (1, None, 3, 2), (2, "x", 4, 2), (2, "y", 5, 1), (None, "m", 7, 1), (None, None, 8, 2)], "k int, v string, w int, seq int")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(M.upsert(tgt, src, ["k"], order=["seq"])) == sorted([(1, None, 3), (2, "x", 4), (None, None, 8)], key=str)
    assert rows(M.upsert(tgt, src, ["k"], keep_known=True, order=["seq"])) == sorted([(1, "b", 3), (2, "x", 4), (None, "m", 8)], key=str)
    # what is not updated keeps what was inserted first
    assert rows(M.upsert(tgt, src, ["k"], ["v"], order=["seq"])) == sorted([(1, None, 1), (2, "x", 5), (None, None, 0)], key=str)
    assert rows(M.insert_new(tgt, src, ["k"], order=["seq"])) == sorted([(1, "a", 1), (None, "n", 0), (2, "y", 5)], key=str)
    for merge in (M.upsert, M.insert_new):
        with pytest.raises(Exception, match="a key is repeated"):
            merge(tgt, src.drop("seq"), ["k"]).collect()
    once = src.filter("seq = 1").drop("seq")
    assert M.upsert(tgt, once, ["k"]).count() == 3 and M.insert_new(tgt, once, ["k"]).count() == 3


def test_close_missing_knows_null_keys(spark):
    tgt = spark.createDataFrame([(None, True, None), (1, True, None), (2, True, dt.date(2020, 1, 1))], "k int, is_active boolean, end_date date")
    batch = spark.createDataFrame([(None,), (None,)], "k int")
    got = {r.k: (r.is_active, r.end_date) for r in M.close_missing(tgt, batch, ["k"], F.lit("2024-01-01").cast("date")).collect()}
    assert got == {None: (True, None), 1: (False, dt.date(2024, 1, 1)), 2: (False, dt.date(2020, 1, 1))}


def test_nearest_within_a_gap(spark):
    facts = spark.createDataFrame([("k", 10), ("k", 30)], "k string, t int")
    events = spark.createDataFrame([("k", 8, "a"), ("k", 15, "b"), ("k", 33, "c")], "k string, w int, v string")
    near = lambda n: lambda fact, event: F.abs(fact - event) <= n
    for bucket in (None, lambda at: F.floor(at / 4)):
        before = {r.t: (r.w, r.v) for r in J.nearest_before(facts, events, ["k"], "t", "w", ["v"], bucket=bucket, within=near(5)).collect()}
        after = {r.t: (r.w, r.v) for r in J.nearest_after(facts, events, ["k"], "t", "w", ["v"], bucket=bucket, within=near(4)).collect()}
        assert before == {10: (8, "a"), 30: (None, None)} and after == {10: (None, None), 30: (33, "c")}
