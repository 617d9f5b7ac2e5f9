"""Readers and writers on small files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import readers as R
from tessera.sources import sinks as K


def test_json_documents_of_every_shape(spark, tmp_path):
    shapes = {"a": {"items": [{"x": 1}, {"x": 2}]}, "b": [{"x": 3}], "c": {"x": 4}}
    for name, doc in shapes.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    assert sorted(r.x for r in R.json_records(spark, f"{tmp_path}/*.json", "x long").collect()) == [1, 2, 3, 4]


def test_json_lines_keep_malformed(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"x": 1}\n\nnot json\n{"x": 2}\n')
    got = [(r.x, r.malformed) for r in R.json_lines(spark, f"{tmp_path}/l.jsonl", "x long").collect()]
    assert sorted(got, key=str) == [(1, False), (2, False), (None, True)]


@pytest.mark.parametrize("head", ["", "sep=;\n"])
def test_csv_separator(spark, tmp_path, head):
    (tmp_path / "t.csv").write_text(head + "name;n\nx, y;1\n;\nz;2\n")
    assert sorted((r.name, r.n) for r in R.csv_records(spark, f"{tmp_path}/t.csv").collect()) == [("x, y", "1"), ("z", "2")]


def test_xml_without_namespaces(spark, tmp_path):
    (tmp_path / "x.xml").write_text('<r xmlns:a="u"><a:row><a:n>1</a:n></a:row><a:row><a:n>2</a:n></a:row></r>')
    assert sorted(r.n for r in R.xml_records(spark, f"{tmp_path}/x.xml", "row", "n long").collect()) == [1, 2]


def test_cube(spark):
    cube = spark.createDataFrame([({"0": 1.0, "5": 2.0},)], "value map<string,double>")
    got = sorted((r.a, r.b, r.value) for r in R.cube_series(cube, ["a", "b"], [2, 3]).collect())
    assert got == [(0, 0, 1.0), (1, 2, 2.0)]


def test_html(spark):
    page = "<html><script>x<y</script><p>a&amp;b</p><!-- c --> d</html>"
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(R.strip_html("h")).first()[0] == "a&b d"
    with pytest.raises(Exception, match="web page"):
        R.refuse_html(df, "h").collect()


def test_conform(spark):
    df = spark.createDataFrame([("7", "x")], "old string, s string")
    assert R.conform(df, "n long, s long, gone date", {"n": ("old",)}).first() == (7, None, None)


def test_slices_snapshots_and_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string")
    K.write_slice(df, f"{tmp_path}/s", ["p"])
    K.write_slice(df.filter("p = 1").withColumn("v", F.lit("z")), f"{tmp_path}/s", ["p"])
    assert sorted((r.p, r.v) for r in spark.read.parquet(f"{tmp_path}/s").collect()) == [(1, "z"), (2, "b")]
    wrote, h = K.write_if_changed(df, f"{tmp_path}/j")
    assert wrote and K.write_if_changed(df.orderBy(F.desc("p")), f"{tmp_path}/j", known=h) == (False, h)
    manifest = K.export_parquet({"t": df, "none": df.limit(0)}, f"{tmp_path}/e", {"t": ["p"]})
    assert [m["rows"] for m in manifest] == [2, 0] and spark.read.parquet(f"{tmp_path}/e/none").columns == ["p", "v"]
    K.export_csv(df, f"{tmp_path}/c")
    K.publish(spark, f"{tmp_path}/c", f"{tmp_path}/final")
    assert spark.read.option("header", True).csv(f"{tmp_path}/final").count() == 2
    assert R.landed(df.union(df), "v", "src").count() == 2


def workbook(path, rows):
    import zipfile

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings, body = [], ""
    for n, row in enumerate(rows, 1):
        body += f'<row r="{n}">'
        for i, v in enumerate(row):
            if v is None:
                continue
            ref = f"{chr(65 + i)}{n}"
            if isinstance(v, str):
                strings.append(v)
                body += f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>'
            else:
                body += f'<c r="{ref}"><v>{v}</v></c>'
        body += "</row>"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [["Title"], ["name", None, "n"], ["x", None, 1], [None, None, None], ["y", "extra", 2.5]])
    got = sorted((r.row, r.record) for r in R.workbook_records(spark, f"{tmp_path}/*.xlsx").collect())
    assert got == [(2, {"name": "x", "n": "1"}), (4, {"name": "y", "n": "2.5"})]


def test_private_fields_are_dropped(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS _b, named_struct('c', 3, '_d', 4) AS s, array(named_struct('_e', 5, 'f', 6)) AS l")
    assert R.drop_private(df).first().asDict(recursive=True) == {"a": 1, "s": {"c": 3}, "l": [{"f": 6}]}


def test_html_entities_come_before_tags(spark):
    df = spark.createDataFrame([("Se&ntilde;or&nbsp; &lt;b&gt;x&lt;/b&gt; &#233; &amp;lt;",), (None,), ("<p>a</p>b",)], "h string")
    assert [r.x for r in df.select(R.strip_html("h").alias("x")).collect()] == ["Señor x é &lt;", None, "a b"]


def test_labelled_values_and_sections(spark):
    page = "<h1>Top</h1><p>one &amp; two</p><dl><dt>Date</dt><dd class='x'>1 <b>May</b></dd><dt>Who</dt> <dd>Ana</dd></dl><h2 id=a>Next</h2>three"
    df = spark.createDataFrame([(1, page), (2, "none"), (3, None)], "id long, h string")
    assert [(r.id, r.place, r.label, r.value) for r in R.labelled_values(df, "h").collect()] == [(1, 0, "Date", "1 May"), (1, 1, "Who", "Ana")]
    assert [(r.id, r.place, r.heading) for r in R.sections(df, "h").collect()] == [(1, 0, "Top"), (1, 1, "Next")]
    assert [r.body for r in R.sections(df, "h").collect()] == ["one & two Date 1 May Who Ana", "three"]


def test_slices_that_become_empty(spark, tmp_path):
    path = str(tmp_path / "slices")
    first = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "a b")], "n int, s string")
    K.write_slice(first, path, ["s"])
    again = spark.createDataFrame([(9, "c")], "n int, s string")
    K.write_slice(again, path, ["s"], spark.createDataFrame([("a b",), ("c",)], "s string"))
    assert [(r.n, r.s) for r in spark.read.parquet(path).collect()] == [(9, "c")]


def test_loads_are_published_whole_and_recorded(spark, tmp_path):
    ledger, staged, target = (str(tmp_path / x) for x in ("ledger", "staged", "target"))
    assert K.recorded(spark, ledger, "r1", "s", lambda: spark.range(3), staged, target) == "ok"
    assert K.recorded(spark, ledger, "r2", "s", lambda: spark.range(0), staged, target, least=1) == "failed"
    assert K.recorded(spark, ledger, "r3", "s", lambda: spark.range(2).selectExpr("assert_true(id > 5)"), staged, target) == "failed"
    assert spark.read.parquet(target).count() == 3
    assert K.recorded(spark, ledger, "r4", "s", lambda: spark.range(5), staged, target) == "ok"
    assert spark.read.parquet(target).count() == 5
    assert sorted((r.run_id, r.status, r.rows) for r in spark.read.parquet(ledger).collect()) == [("r1", "ok", 3), ("r2", "failed", 0), ("r3", "failed", None), ("r4", "ok", 5)]


def test_a_stream_without_rows(spark, tmp_path):
    from tessera.streaming import streams

    path = str(tmp_path / "none.parquet")
    spark.range(0).write.parquet(path)
    got = streams.run_available(streams.file_stream(spark, path))
    assert got.count() == 0 and got.columns == ["id"]
