"""Queries and operators on inputs that the small tables don't hold."""

from __future__ import annotations

import duckdb
from conftest import DATA, rows_of
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import joins as J
from tessera.plans import registry
from tessera.sources.readers import strip_html


def same_as_sql(spark, folder, name, **tables):
    """The rows of a query over the given pandas tables, which are those of its SQL."""
    con = duckdb.connect()
    for table, frame in tables.items():
        con.register("given", frame)
        con.sql(f"COPY given TO '{folder}/{table}.parquet' (FORMAT parquet)")
        con.unregister("given")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got, want = registry.queries()[name](spark, str(folder)).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    assert rows_of(got, sorted(want.columns)) == rows_of(want, sorted(want.columns))
    return got


def pages(rows):
    import pandas as pd

    return pd.DataFrame({"page_id": [i for i, _ in rows], "url": ["u"] * len(rows), "html": [h for _, h in rows]})


def test_dates_after_this_century(spark, tmp_path):
    ids = [0, 27_999, 28_000, 29_300, *range(30_000, 30_210), *range(180_000, 180_210), *range(3_000_000, 3_000_210)]
    got = same_as_sql(spark, tmp_path, "date_parsers", pages=pages([(i, "") for i in ids]))
    assert len(got) == len(ids) and got.lifecycle.notna().sum() > len(ids) / 2


def test_pages_with_cut_entities_and_other_blanks(spark, tmp_path):
    html = ["a &amp", "<p>R&ampD &quot &copy 2020 &nbsp;&#65;&lt;b&gt;</p>", "&amp;quot; &amp;amp;copy; &quot;x&quot;", "a  b\x0bc \t\n d\u0085e", "<SCRIPT a='b'>x</Script>y<style>z</style\n>w<!-- > -->v", "<script>1</style>2</script>3", ""]
    got = same_as_sql(spark, tmp_path, "html_strip", pages=pages([*enumerate(html), (99, None)]))
    assert len(got) == len(html) + 1
    assert spark.createDataFrame([("R&ampD&nbsp;&lt;b&gt;x",)], "h string").select(strip_html("h")).head()[0] == "R&D x"


def test_coalitions_of_groups_of_different_scopes(spark, duck):
    got = registry.queries()["issue_coalitions"](spark, DATA).toPandas()
    nation = duck.sql("SELECT n_nationkey, n_regionkey FROM nation").df().set_index("n_nationkey").n_regionkey
    apart = nation[got.a].to_numpy() != nation[got.b].to_numpy()
    assert apart.any() and (got.scope[apart] == -1).all()


def test_every_way_of_a_bridge_is_dealt_by_itself(spark):
    m = spark.createDataFrame([(1, 4, 0.9), (1, 4, 0.5), (2, 7, 0.1)], "fact long, node long, confidence double")
    e = spark.createDataFrame([(7, 4, "develops"), (4, 3, "repeals"), (8, 3, "repeals"), (9, 3, "develops")], "src long, dst long, relation string")
    out = J.bridge(m, e, "fact", {"develops": 0.15}, "repeals", 0.2, 0.25)
    assert {(r.fact, r.node, round(r.confidence, 6), r.method) for r in out.collect()} == {(1, 4, 0.9, "direct"), (1, 7, 0.75, "via_develops"), (1, 8, 0.7, "via_shared"), (1, 9, 0.65, "via_mixed"), (2, 7, 0.1, "direct")}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("RepartitionBy") + plan.count("REPARTITION_BY_COL") >= 5


def test_best_candidates_of_a_heavy_key_are_met_by_kind(spark):
    """Repeated ids and null scores too; equal rows are scored once, not pair by pair."""
    scored = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(a, b):
        scored.add(1)
        return None if b is None else -abs(a - b)

    facts = [(i, "k", i % 7) for i in range(600)] + [(5, "k", 6), (900, "none", 1), (901, None, 1)]
    cands = [(i, "k", i % 11) for i in range(20, 600)] + [(20, "k", 3), (20, "other", 3), (700, "k", 100), (None, "k", 4), (701, "k", None)]
    a, b = spark.createDataFrame(facts, "f int, n string, x int"), spark.createDataFrame(cands, "c int, n string, y int")
    got = {r.f: (r.status, r.c, r.n_best) for r in J.best_candidate(a, b, "n", "f", "c", [counted("x", "y")]).collect()}
    assert 0 < scored.value < 1000
    want = {}
    for f in {f for f, _, _ in facts}:
        best = {}
        for _, n, x in (row for row in facts if row[0] == f):
            for c, m, y in cands:
                if n is not None and n == m:
                    best[c] = max(best.get(c, -1000), -1000 if y is None else -abs(x - y))
        top = [c for c, s in best.items() if s == max(best.values()) and c is not None]
        want[f] = ("no_candidates", None, 0) if not top else ("matched", top[0], 1) if len(top) == 1 else ("ambiguous", None, len(top))
    assert got == want


def test_subjects_work_out_each_step_once(spark):
    rest = " sobre la regulación de los mercados y otras cosas."
    texts = ["PROPOSİCİÓN" + rest, "Real \n decreto-ley" + rest, "Propueſta" + rest, "uno. dos Interpelacıón" + rest, "ENMIENDA corta. La nueva MOCIÓN de todos los grupos es larga y firme", "nada" + rest]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.subject("t", F.lit("")).alias("s"))
    got = {r.i: (r.s.method, r.s.subject[:14]) for r in df.collect()}
    assert [got[i][0] for i in range(6)] == ["keyword_window", "keyword_window", "keyword_window", "keyword_window", "keyword_window", "excerpt_fallback"]
    assert got[1][1] == "Real decreto-l" and got[4][1] == "MOCIÓN de todo"
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
