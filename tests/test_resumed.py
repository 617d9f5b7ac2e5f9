"""Work that goes on where it stopped: streams and kept aggregates."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import incremental as I
from tessera.operators.joins import best_row
from tessera.operators.merge import upsert
from tessera.streaming import streams as R


def add_files(spark, path, first, n, rows=40):
    """n files of events, in order of time."""
    for k in range(first, first + n):
        r = random.Random(k)
        at = lambda i, k=k: dt.datetime(2024, 1, 1) + dt.timedelta(hours=k, seconds=i)
        data = [(1000 * k + i, r.choice("abcde"), at(i), float(r.randint(0, 99))) for i in range(rows)]
        spark.createDataFrame(data, "id long, key string, ts timestamp, value double").coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return R.file_stream(spark, path, files_per_batch=1)


def newest(before, batch):
    new = best_row(batch if before is None else before.unionByName(batch), ["key"], [F.desc("ts"), F.desc("id")])
    return new if before is None else upsert(before, new, ["key"])


def rows_of(df):
    return sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect())))


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    add_files(spark, path, 0, 2)
    R.run_into(stream(spark, path), out, merge=newest)
    assert R.Ledger(spark, out).batches() == [0, 1]
    add_files(spark, path, 2, 3)
    got = R.run_into(stream(spark, path), out, merge=newest)
    assert R.Ledger(spark, out).batches() == [0, 1, 2, 3, 4]
    assert rows_of(got) == rows_of(R.run_into(stream(spark, path), str(tmp_path / "once"), merge=newest))
    kept = sorted(os.path.basename(p) for p in glob.glob(f"{out}/v*"))
    assert kept == ["v3", "v4"]  # the last two versions


def test_a_batch_is_not_applied_twice(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    add_files(spark, path, 0, 3)
    count = lambda before, batch: (batch if before is None else before.unionByName(batch))  # noqa: E731  not idempotent by itself
    once = rows_of(R.run_into(stream(spark, path), out, merge=count))
    assert len(once) == 120
    for f in (f"{out}/progress/commits/2", f"{out}/progress/commits/.2.crc"):  # the batch ran, its progress was lost
        if os.path.exists(f):
            os.remove(f)
    assert rows_of(R.run_into(stream(spark, path), out, merge=count)) == once
    assert rows_of(R.run_into(stream(spark, path), out, merge=count)) == once  # nothing new


def test_a_failed_batch_is_run_again(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    add_files(spark, path, 0, 4)
    seen = []

    def fails(before, batch):
        seen.append(1)
        if len(seen) == 3:
            raise ValueError("lost")
        return newest(before, batch)

    with pytest.raises(Exception, match="lost"):
        R.run_into(stream(spark, path), out, merge=fails)
    assert R.Ledger(spark, out).batches() == [0, 1]
    got = R.run_into(stream(spark, path), out, merge=newest)
    assert rows_of(got) == rows_of(R.run_into(stream(spark, path), str(tmp_path / "once"), merge=newest))


def test_appends_and_late_rows(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    add_files(spark, path, 10, 2)
    unique = lambda: R.idempotent(stream(spark, path), "ts", "id", "1 hour")
    first = R.run_into(unique(), out)
    assert first.count() == 80
    add_files(spark, path, 11, 1)  # the same rows once more
    add_files(spark, path, 0, 1)  # rows from long before
    assert rows_of(R.run_into(unique(), out)) == rows_of(first)


def test_last_rows_in_list_state(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    keep = lambda before, batch: batch if before is None else upsert(before, batch, ["key"])
    last = lambda **more: R.last_n(stream(spark, path), "key", "ts", "value", 7, **more)
    add_files(spark, path, 0, 2)
    R.run_into(last(), out, "update", keep)
    add_files(spark, path, 2, 2)
    got = {r.key: (r.n, round(r.mean, 6)) for r in R.run_into(last(), out, "update", keep).collect()}
    rows = spark.read.parquet(path).orderBy(F.desc("ts"), F.desc("value")).collect()
    for key in "abcde":
        own = [r.value for r in rows if r.key == key][:7]
        assert got[key] == (len(own), round(sum(own) / len(own), 6))


def test_idle_keys_are_forgotten(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    last = lambda: R.last_n(stream(spark, path), "key", "ts", "value", 7, idle_seconds=3600, late="1 minute")
    keep = lambda before, batch: batch if before is None else upsert(before, batch, ["key"])
    for h, key in ((0, "a"), (5, "b"), (6, "b"), (7, "a"), (7.2, "b")):
        spark.createDataFrame([(1, key, at(h), 1.0)], "id long, key string, ts timestamp, value double").coalesce(1).write.mode("append").parquet(path)
        got = {r.key: r.n for r in R.run_into(last(), out, "update", keep).collect()}
    assert got == {"a": 1, "b": 2} or got == {"a": 1, "b": 3}  # a began anew; b within an hour of its last row went on


def evidence(spark, rows):
    return spark.createDataFrame(rows, "person int, topic int, polarity int, w decimal(12,2), c decimal(12,2), slice int")


def some(n, seed):
    r = random.Random(seed)
    return [(r.randint(0, 30), t, r.choice([-1, 0, 1]), Decimal(r.randint(1, 500)) / 100, Decimal(r.randint(1, 100)) / 100, t % 20) for t in (r.randint(0, 99) for _ in range(n))]


def test_changes_equal_a_full_run(spark, tmp_path):
    rows = some(5000, 1)
    later = [x for x in rows if x[5] in (3, 7) and x[0] % 5 == 0]  # a small part, in two slices
    back = [x for x in rows if x[5] == 7 and x[0] % 5 == 1] + [x for x in rows if x[1] == 3 and x[0] % 5 > 0]
    keys, slices, sums, results = ["person", "topic"], ["slice"], str(tmp_path / "sums"), str(tmp_path / "positions")
    of = lambda x, sign=None: A.stance_sums(evidence(spark, x), [*slices, *keys], "polarity", "w", "c", sign=sign)
    start = of([x for x in rows if x not in later])
    I.build(start, sums, slices)
    I.build(A.stances(spark.read.schema(start.schema).parquet(sums)), results, slices)
    stamps = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{sums}/slice=*/*.parquet")}
    changes = of(later).unionByName(of(back, F.lit(-1)))
    changes = changes.groupBy(*slices, *keys).agg(*[F.sum(c).cast(start.schema[c].dataType).alias(c) for c in start.columns if c not in (*slices, *keys)]).select(*start.columns)
    touched = I.apply_changes(sums, changes, slices, keys, "n_evidence", str(tmp_path / "staging"))
    assert touched == [(3,), (7,)]
    got = I.reevaluate(sums, start.schema, slices, touched, results, A.stances)
    final = list(rows)
    for x in back:
        final.remove(x)
    want = A.stances(of(final))
    assert rows_of(got) == rows_of(want)
    # other slices were neither read nor written
    now = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{sums}/slice=*/*.parquet")}
    assert {p: t for p, t in stamps.items() if "slice=3/" not in p and "slice=7/" not in p} == {p: t for p, t in now.items() if "slice=3/" not in p and "slice=7/" not in p}
    read = I._within(spark.read.schema(start.schema).parquet(sums), slices, touched).inputFiles()
    plan = I._within(spark.read.schema(start.schema).parquet(sums), slices, touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "slice" in plan.split("PartitionFilters: [")[1].split("]")[0] and read
    assert I.apply_changes(sums, changes.limit(0), slices, keys, "n_evidence", str(tmp_path / "none")) == []


def test_a_slice_that_loses_all_rows_goes(spark, tmp_path):
    sums, keys = str(tmp_path / "sums"), ["person", "topic"]
    rows = [(1, 1, 1, Decimal(1), Decimal(1), 1), (1, 2, 1, Decimal(1), Decimal(1), 2)]
    of = lambda x, sign=None: A.stance_sums(evidence(spark, x), ["slice", *keys], "polarity", "w", "c", sign=sign)
    start = of(rows)
    I.build(start, sums, ["slice"])
    back = of(rows[:1], F.lit(-1)).select(*[F.col(c).cast(start.schema[c].dataType).alias(c) for c in start.columns])
    assert I.apply_changes(sums, back, ["slice"], keys, "n_evidence", str(tmp_path / "staging")) == [(1,)]
    assert [r.slice for r in spark.read.schema(start.schema).parquet(sums).collect()] == [2]
