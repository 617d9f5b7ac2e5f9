"""Payloads as they come: JSON of any form, CSV from bytes, numbered lines."""

from __future__ import annotations

import csv
import io
import json
import random
from contextlib import contextmanager

import pytest

from tessera.sources import readers as R


@contextmanager
def small_blocks(spark, size):
    """Files are read in blocks of some bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, str(size))
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


@pytest.mark.parametrize(
    ("doc", "want"),
    [
        ([{"x": 1}, 5, None, {"x": 2}], [1, 2]),
        ({"meta": {"n": 1}, "foo": [{"x": 1}, {"x": 2}]}, [1, 2]),
        ({"b": [1, 2], "z": [{"x": 1}], "a": [{"x": 9}]}, [1]),  # in the order of the document
        ({"items": [{"x": 3}], "results": [{"x": 1}]}, [1]),
        ({"diputados": [{"x": 4}, "no"]}, [4]),
        ({"results": [], "foo": [{"x": 1}]}, []),  # a known field decides, though it is empty
        ({"data": {"x": 1}, "x": 7}, [7]),  # no list: the document
        ({"data": "[{}]", "x": 8}, [8]),  # a text is no list
        ({"we'ird \"key\"": [{"x": 6}]}, [6]),
        (5, []),
        ("text", []),
        ([], []),
    ],
)
def test_json_records_of_any_form(spark, tmp_path, doc, want):
    (tmp_path / "a.json").write_text(json.dumps(doc))
    assert [r.x for r in R.json_records(spark, str(tmp_path), "x long").collect()] == want


def test_json_that_is_none(spark, tmp_path):
    (tmp_path / "a.json").write_text("{no")
    with pytest.raises(Exception, match="MALFORMED|parse"):
        R.json_records(spark, str(tmp_path), "x long").collect()


def test_lines_have_numbers(spark, tmp_path):
    lines = [json.dumps({"x": i}) if i % 7 else "{bad" if i else "" for i in range(500)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.jsonl").write_text("\r\n".join(lines[:5]))
    with small_blocks(spark, 500):
        got = R.json_lines(spark, str(tmp_path), "x long", line_no="n")
        assert spark.read.text(f"{tmp_path}/a.jsonl").rdd.getNumPartitions() > 5
        rows = sorted((r.n, r.raw, r.malformed, r.x) for r in got.collect())
    want = [(i + 1, v, v == "{bad", None if v == "{bad" else i) for part in (lines, lines[:5]) for i, v in enumerate(part) if v]
    assert rows == sorted(want, key=lambda r: (r[0], r[1]))


def written(rows, sep=";", encoding="utf-8", end="\n"):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator=end).writerows(rows)
    return out.getvalue().encode(encoding)


def read(spark, path):
    df = R.csv_records(spark, str(path))
    return df.columns, sorted(tuple("" if v is None else v for v in r) for r in df.collect())


@pytest.mark.parametrize(("encoding", "end"), [("utf-8", "\n"), ("utf-8-sig", "\r\n"), ("cp1252", "\r\n")])
@pytest.mark.parametrize("size", [60, 128 << 20])
def test_csv_equals_the_csv_module(spark, tmp_path, encoding, end, size):
    r = random.Random(2)
    pick = ["España", "a\nb", 'say "hi"', "x;y", "1,5", "“smart” €", "", "plain", 'two\nbreaks\n"and" quotes']
    rows = [["key", "nombre ", "nota"]] + [[str(i), r.choice(pick), r.choice(pick)] for i in range(120)]
    (tmp_path / "t.csv").write_bytes(written(rows, encoding=encoding, end=end))
    with small_blocks(spark, size):
        if size == 60:
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        columns, got = read(spark, tmp_path)
    assert columns == ["key", "nombre", "nota"]
    assert got == sorted(tuple(v.strip() for v in x) for x in rows[1:])


def test_csv_probes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'sep=|\nx|y\n1|"a\nb"\n\n|\n2|Espa\xf1a\x80\n3\n')
    columns, got = read(spark, tmp_path)
    assert (columns, got) == (["x", "y"], [("1", "a\nb"), ("2", "España€"), ("3", "")])
    (tmp_path / "a.csv").write_bytes(b"x,y\n")
    assert read(spark, tmp_path) == (["x", "y"], [])
    (tmp_path / "a.csv").write_bytes(b"")
    assert R.csv_records(spark, str(tmp_path)).count() == 0


def test_files_of_different_encodings(spark, tmp_path):
    for name, encoding in (("a", "cp1252"), ("b", "utf-8"), ("c", "utf-8-sig")):
        (tmp_path / f"{name}.csv").write_bytes(written([["k", "v"], [name, "ñandú"]], encoding=encoding))
    assert read(spark, tmp_path) == (["k", "v"], [(n, "ñandú") for n in "abc"])


def test_private_fields_at_any_depth(spark):
    df = spark.sql("""SELECT 1 AS a, 2 AS _b, map('x', named_struct('c', 1, '_d', 2), '_y', named_struct('c', 3, '_d', 4)) AS m,
      array(array(named_struct('e', 5, '_f', 6))) AS l, named_struct('g', map('h', array(named_struct('_i', 7, 'j', 8))), '_k', 9) AS s, CAST(null AS struct<c: int, _d: int>) AS n""")
    assert R.drop_private(df).first().asDict(recursive=True) == {"a": 1, "m": {"x": {"c": 1}}, "l": [[{"e": 5}]], "s": {"g": {"h": [{"j": 8}]}}, "n": None}
