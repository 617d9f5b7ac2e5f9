"""Registered queries and the pipeline over the smallest tables."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from conftest import DATA, rows_of

import __spark_entry__ as entry

COLUMNS = {
    "op1_": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op2_": ["doc_id", "fingerprint", "component_id"],
    "op3_": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4_": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op5_": ["doc_id", "held_out", "score", "predicted"],
    "op6_": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_": ["query_id", "rank", "vec_id", "score"],
    "op9_": ["doc_id", "held_out", "score", "predicted"],
    "op10_": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op11_": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op12_": ["lang", "source", "part", "item", "value", "rank"],
    "op13_": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}


@pytest.mark.parametrize("prefix", list(COLUMNS))
def test_query(spark, duck, prefix):
    name = next(q for q in entry.queries() if q.startswith(prefix))
    df = entry.queries()[name](spark, DATA)
    assert df.columns[: len(COLUMNS[prefix])] == COLUMNS[prefix]
    got = df.toPandas()
    assert len(got)
    if prefix not in ("op8_", "op12_"):
        docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").toPandas()
        assert sorted(got.doc_id) == sorted(docs.doc_id)
    sql = entry.oracle_sql().get(name)
    if sql:
        want = duck.sql(sql).df()
        assert rows_of(got, want.columns) == rows_of(want, want.columns)


def test_stages_take_effect(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = [docs.collect()]
    for name, stage in p.STAGES:
        out = stage(spark, spark.createDataFrame(seen[-1], docs.schema) if len(seen) > 1 else docs, DATA)
        if name != p.STAGES[-1][0]:
            assert out.columns == docs.columns
        seen.append(out.collect())
    start, ruled, single, cut, mixed, tokens = seen
    assert {r.doc_id for r in ruled} < {r.doc_id for r in start}
    texts = Counter(r.text for r in single)
    assert max(texts.values()) == 1 and len(single) < len(ruled)
    words = [re.findall(r"[^\x20\x09-\x0D]+", r.text) for r in cut]
    before = {r.doc_id: len(r.text.split()) for r in single}
    assert len(cut) == len(single) and sum(map(len, words)) <= sum(before.values())
    assert all(r.n_chars == len(r.text) for r in cut)
    copies = Counter(r.doc_id for r in mixed)
    assert max(copies.values()) <= 3 and len(tokens) == len(mixed)


def test_pipeline_runs(spark):
    import corpus_pipeline as p

    out = p.run(spark, DATA).select("doc_id", "n_tokens").collect()
    assert out and sorted(map(tuple, p.run(spark, DATA).select("doc_id", "n_tokens").collect())) == sorted(map(tuple, out))


def test_last_stage_decodes_what_it_encodes(spark):
    import hashlib

    import numpy as np
    from samples import documents

    import corpus_pipeline as p
    from tessera.llm import bpe

    strings = bpe.load(p.tokenizer_path()).strings
    rows = p.tokenize(spark, documents(spark), DATA).collect()
    assert len(rows) == documents(spark).count()
    for r in rows:
        text = " ".join(strings[i] for i in np.frombuffer(r.token_ids, "<u4"))
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
