"""The backtracking encoder against the tokenizers library, and the round trip."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import TEXTS, documents

from tessera.llm import bpe
from tessera.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


HARD = ["", "Hello <|endoftext|> world<|startoftext|>x", "ΑΣ ΣΑΣ İstanbul ﬁ it's we'll 'S x''re\x1c\x85y 12³½", "a" * 3000, "日本語テキスト 😀👨‍👩‍👧 aaaaabbbb", "​᠎﻿", " <|ENDOFTEXT|>", "naïve café — “quotes” … $%&*((", "é ö ﷺ"]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(library, text):
    assert np.frombuffer(bpe.load(tokenizer_path()).encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FF), max_size=60) | st.text(alphabet="aeinrst'<|> ", max_size=40))
def test_any_text(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    assert np.frombuffer(bpe.load(tokenizer_path()).encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_memo_of_two_generations(monkeypatch):
    monkeypatch.setattr(bpe, "_MEMO", 3)
    memo = bpe.Memo(lambda w: [len(w)])
    words = ["a" * i for i in range(1, 9)] * 2
    assert [np.frombuffer(memo[w], "<u4")[0] for w in words] == [len(w) for w in words]
    assert len(memo) <= 3


def test_encode_and_decode_tables(spark, library):
    docs = documents(spark)
    path = tokenizer_path()
    rows = bpe.decode(bpe.encode(docs, path), path).collect()
    want = []
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, bytes(r.token_ids), r.decoded) for r in rows), key=key) == sorted(want, key=key)
    assert bpe.decode(bpe.encode(docs.limit(0), path), path).count() == 0
    sha = bpe.encode(docs.filter("doc_id = 4"), path).select(F.sha2("token_ids", 256)).first()[0]
    assert sha == hashlib.sha256(b"").hexdigest()
