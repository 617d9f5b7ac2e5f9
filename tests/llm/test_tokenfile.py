"""Token files: Elias-Fano codes, and reading back what the library gives."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from conftest import DATA
from hypothesis import given
from hypothesis import strategies as st
from samples import documents

import __spark_entry__ as entry
from tessera.llm import eliasfano, tokenfile
from tessera.llm.queries import tokenizer_path
from tessera.llm.units import load_library


@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(1, 2**64 - 1))
def test_elias_fano_of_any_numbers(values, modulus):
    values = np.array(sorted(v % modulus for v in values), np.uint64)
    code = eliasfano.EliasFano(eliasfano.build(values))
    assert len(code) == len(values) and (code.select(0, len(values)) == values).all()
    for i, v in enumerate(values.tolist()):
        assert code.select(i) == v
        assert code.locate(v) == int(np.searchsorted(values, np.uint64(v), "right")) - 1


def test_elias_fano_of_many_numbers_is_small():
    r = np.random.default_rng(1)
    values = np.cumsum(r.integers(0, 400, 100_000)).astype(np.uint64)
    values[50_000:] += np.uint64(1 << 30)  # a long stretch without ones
    values[70_000:90_000] = values[70_000]
    values.sort()
    data = eliasfano.build(values)
    code = eliasfano.EliasFano(data)
    bits = 2 + np.log2(float(values[-1] - values[0]) / len(values)) + 32 / eliasfano.EVERY
    assert 8 * len(data) / len(values) <= bits + 0.1
    for lo, hi in ((0, 100_000), (255, 257), (49_999, 50_001), (69_990, 90_010), (99_999, 100_000), (5, 5)):
        assert (code.select(lo, hi) == values[lo:hi]).all()
    with pytest.raises(IndexError):
        code.select(100_000)


def encoded(texts):
    library = load_library(tokenizer_path())
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def awkward(spark):
    r = random.Random(3)
    odd = ["a  b c\x1cd\x0be", "'s 'S don't <|endoftext|>x <|startoftext|> y", "é ́e\ń", "﻿ q　w ΣΑΣ", "x" * 5000, "".join(chr(r.choice([32, 10, 9, 13, 0x301, 0x85, 0x1F600, 0xAC00, 65, 97, 39, 115])) for _ in range(3000))]
    return documents(spark).unionByName(documents(spark, [(2**63 - 1, odd[0]), (-(2**63), odd[1]), *((40 + k, t) for k, t in enumerate(odd))]))


@pytest.mark.parametrize("shard_ids", [1, 700, 1 << 25])
def test_files_hold_what_the_library_gives(spark, tmp_path, shard_ids):
    docs = awkward(spark)
    rows = docs.select("doc_id", "text").collect()
    path = str(tmp_path / "files")
    tokenfile.write(docs, path, tokenizer_path(), end_id=1, shard_ids=shard_ids)
    got = sorted(tokenfile.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    want = sorted((r.doc_id is not None, r.doc_id or 0, [*ids, 1]) for r, ids in zip(rows, encoded(r.text for r in rows), strict=True))
    have = sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in got)
    assert have == want
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    # any document by its place in a file
    files = sorted(f for f in os.listdir(path) if f.endswith(".tok"))
    at = 0
    for f in files:
        file = tokenfile.TokenFile(*tokenfile._open(f"{path}/{f}"))
        for k in range(file.docs):
            assert file.document(k).tolist() == np.frombuffer(got[at + k].ids, "<u4").tolist() and file.doc_ids(k, k + 1) == [got[at + k].doc_id]
        at += file.docs
    assert at == len(got)


def test_overwrite_and_empty_tables(spark, tmp_path):
    path, docs = str(tmp_path / "files"), documents(spark)
    tokenfile.write(docs.limit(0), path, tokenizer_path(), end_id=1)
    assert tokenfile.read(spark, path).count() == 0
    with pytest.raises(Exception, match="FileExistsError|exists"):
        tokenfile.write(docs, path, tokenizer_path())
    tokenfile.write(docs, path, tokenizer_path(), overwrite=True)
    assert tokenfile.read(spark, path).filter("n_tokens = 0").count() == 3  # null, empty, white space: no end id here
    with pytest.raises(Exception, match="integer column"):
        tokenfile.write(docs.withColumn("doc_id", docs.source), path, tokenizer_path(), overwrite=True)


def test_files_of_ids(spark, tmp_path):
    path = str(tmp_path / "files")
    ids = spark.createDataFrame([(2, bytes([1, 0, 0, 0, 255, 1, 0, 0])), (1, None)], "i int, ids binary")
    tokenfile.write(ids, path, id_col="i", text_col="ids", end_id=7, width=2)
    got = tokenfile.read(spark, path).collect()
    assert [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got] == [(1, 0, [7]), (2, 1, [1, 511, 7])]
    with pytest.raises(Exception, match="bytes"):
        tokenfile.write(ids, path, id_col="i", text_col="ids", end_id=7, width=1, overwrite=True)
    assert tokenfile.read(spark, path).count() == 2  # a failed write leaves the earlier one


def test_query_equals_the_library(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, start = [], 0
    for r, ids in zip(rows, encoded(r.text for r in rows), strict=True):
        ids = np.array([*ids, 1], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = entry.queries()["op11_elias_fano_tokens"](spark, DATA)
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == want
