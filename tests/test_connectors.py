"""Connectors behind spark.read and spark.readStream, and lookups by prefix."""

from __future__ import annotations

import json
import random

import pytest

from tessera.operators import joins as J
from tessera.sources import connectors as C
from tessera.streaming import streams as R


def load(spark, kind, path):
    C.register(spark)
    return spark.read.format(kind).option("source_id", "s").load(str(path))


def test_paged_json(spark, tmp_path):
    C.land(str(tmp_path), [("p1.json", json.dumps({"meta": {}, "foo": [{"x": 1}, 5, {"x": 2}]})), ("p2.json", '[{"x": 3}]'), ("p3.json", '{"x": "ñ"}'), ("p4.json", "7"), (".hidden.json", "["), ("other.txt", "")])
    got = load(spark, "paged_json", tmp_path)
    assert got.columns == ["source_id", "page", "place", "record"]
    rows = sorted(map(tuple, got.collect()))
    assert rows == [("s", "p1.json", 1, '{"x": 1}'), ("s", "p1.json", 2, '{"x": 2}'), ("s", "p2.json", 1, '{"x": 3}'), ("s", "p3.json", 1, '{"x": "ñ"}')]
    assert got.rdd.getNumPartitions() == 4  # one a page


def test_filters_reach_the_plan(spark, tmp_path):
    C.land(str(tmp_path), [(f"p{k}.json", json.dumps([{"x": 10 * k + i} for i in range(5)])) for k in range(6)])
    (tmp_path / "p9.json").write_text("no json")  # a page that is not read does no harm
    few = load(spark, "paged_json", tmp_path).filter("page IN ('p2.json', 'p4.json') AND place >= 4 AND record <> ''")
    assert few.rdd.getNumPartitions() == 2
    assert sorted((r.page, r.place) for r in few.collect()) == [("p2.json", 4), ("p2.json", 5), ("p4.json", 4), ("p4.json", 5)]
    assert load(spark, "paged_json", tmp_path).filter("page < 'p1.json'").count() == 5
    assert load(spark, "paged_json", tmp_path).filter("page = 'none'").count() == 0
    with pytest.raises(Exception, match="JSON|Expecting"):
        load(spark, "paged_json", tmp_path).collect()


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_lines_in_ranges(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(C, "RANGE", size)
    r = random.Random(size)
    lines = [r.choice(['{"x": %d}' % i, "", "{cut", '{"y": "%s"}' % ("ñ" * r.randint(0, 40)), "5"]) for i in range(60)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text("")
    # the planning runs in a process of its own, so the pieces are made here
    pieces = C.JsonLines.pieces(C.JsonLines.pages(str(tmp_path)))
    got = [row for p in pieces for row in C.JsonLines.rows({"path": str(tmp_path), "source_id": "s"}, p)]
    want, at = [], 0
    for line in lines:
        if line:
            try:
                record = json.loads(line)
            except ValueError:
                record = {"_malformed": line}
            want.append(("s", "a.jsonl", at + 1, json.dumps(record, ensure_ascii=False, sort_keys=True)))
        at += len(line.encode()) + 1
    assert got == want
    assert sorted(map(tuple, load(spark, "json_lines", tmp_path).collect())) == sorted(want)


def test_cubes(spark, tmp_path):
    cube = {"id": ["g", "y"], "size": [2, 3], "dimension": {"g": {"category": {"index": {"f": 1, "m": 0}}}, "y": {"category": {"index": ["20", "21", "22"]}}}}
    C.land(str(tmp_path), [("a.json", json.dumps(cube | {"value": {"0": 1.5, "5": 7, "3": None}})), ("b.json", json.dumps(cube | {"value": [1, None, 3, 4, 5, 6]}))])
    rows = [(r.page, *json.loads(r.record).values()) for r in load(spark, "stat_cube", tmp_path).collect()]
    assert sorted(rows) == [("a.json", "f", 7, "22"), ("a.json", "m", 1.5, "20"), ("b.json", "f", 4, "20"), ("b.json", "f", 5, "21"), ("b.json", "f", 6, "22"), ("b.json", "m", 1, "20"), ("b.json", "m", 3, "22")]


def test_pages_as_a_stream(spark, tmp_path):
    C.register(spark)
    pages, out = tmp_path / "pages", str(tmp_path / "out")
    stream = lambda: spark.readStream.format("paged_json").option("source_id", "s").load(str(pages))
    C.land(str(pages), [(f"p{k}.json", f'[{{"x": {k}}}]') for k in range(3)])
    read = lambda: sorted(r.record for r in R.run_into(stream(), out).collect())
    assert read() == ['{"x": 0}', '{"x": 1}', '{"x": 2}']
    C.land(str(pages), [("p3.json", '[{"x": 3}, {"x": 4}]')])
    assert read() == [f'{{"x": {k}}}' for k in range(5)] == read()


def test_longest_prefix(spark):
    r = random.Random(6)
    codes = ["".join(r.choice("ab") for _ in range(r.randint(0, 8))) for _ in range(300)] + [None]
    heads = [("".join(r.choice("ab") for _ in range(r.choice([1, 2, 4, 7]))), r.randint(0, 99)) for _ in range(25)] + [(None, 1), ("abab", None)]
    df = spark.createDataFrame(list(enumerate(codes)), "i int, code string")
    for table in (heads, [*heads, ("", 77)], [("", 5)], []):
        t = spark.createDataFrame(table, "p string, v int")
        got = {x.i: x.v for x in J.longest_prefix(df, "code", t, "p", "v").collect()}
        for i, code in enumerate(codes):
            fits = [p for p, _ in table if p is not None and code is not None and code.startswith(p)]
            best = [v for p, v in table if fits and p == max(fits, key=len) and v is not None]
            assert got[i] == (min(best) if best else None), (code, fits)
