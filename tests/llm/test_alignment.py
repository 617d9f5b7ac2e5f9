"""Token groups and links against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from conftest import DATA
from samples import documents

import __spark_entry__ as entry
from tessera.llm import alignment, units
from tessera.llm.queries import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def spans(pieces):
    at, out = 0, []
    for i, b in pieces:
        out.append((at, at + len(b), i))
        at += len(b)
    return out


def plain(rows):
    """Every pair of tokens is compared by its byte ranges."""
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(tokenizer_path(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    of, names = alignment.byte_table(), {i: t for t, i in a.get_vocab().items()}
    docs = []
    for doc_id, text in rows:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        pieces_a = spans([(i, bytes(of[c] for c in names[i])) for i in ids_a])
        pieces_b = spans([(i, bytes([b.id_to_piece(i)[1:5] and int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids_b])
        joined = [b"".join(bytes(of[c] for c in names[i]) for i in ids_a), b"".join(bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b)]
        if not text or any(j != b" " + text.encode() for j in joined):
            docs.append((doc_id, [], [], []))
            continue
        docs.append((doc_id, pieces_a, pieces_b, [(x[2], y[2]) for x in pieces_a for y in pieces_b if x[0] < y[1] and y[0] < x[1]]))
    counts = Counter(k for d in docs for k in d[3])
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, pieces_a, pieces_b, linked in docs:
        ends = sorted({x[1] for x in pieces_a} & {y[1] for y in pieces_b})
        groups, lo = [], 0
        for hi in ends:
            groups.append("|".join(",".join(str(x[2]) for x in side if lo < x[1] <= hi) for side in (pieces_a, pieces_b)))
            lo = hi
        out.append((doc_id, len(pieces_a), len(pieces_b), len(groups), len(linked), sum(counts[k] == best[k[1]] for k in linked), sum(counts[k] for k in linked), ";".join(groups)))
    return out


def odd_texts():
    r = random.Random(8)
    texts = ["a▁b", "tail ▁ x", "<|endoftext|> <s></s> x", " lead", "trail ", "two  blanks", "   x\x1c y", "<0x41> A", "né 日本 \U0001f600‍ x", "q" * 3000]
    texts += ["".join(chr(r.choice([32, 32, 10, 9, 0x301, 0x85, 0x1F600, 0xAC00, 65, 97, 101, 39, 115, 0x3000])) for _ in range(400)) for _ in range(6)]
    return [(100 + k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("size", [alignment.BLOCK_UNITS, 40])
def test_equals_plain_python(spark, monkeypatch, size):
    monkeypatch.setattr(alignment, "BLOCK_UNITS", size)
    docs = documents(spark).filter("doc_id IS NULL OR doc_id <> 13").unionByName(documents(spark, odd_texts()))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = alignment.align(docs, tokenizer_path(A), tokenizer_path(B))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(rows)))


def test_empty_table(spark):
    assert alignment.align(documents(spark).limit(0), tokenizer_path(A), tokenizer_path(B)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    short = docs.filter("length(text) < 1500").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in entry.queries()["op13_label_alignment"](spark, DATA).collect()}
    assert sorted(got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    for doc_id, n_a, n_b, n_groups, n_links, _, _, groups in plain([tuple(r) for r in short]):
        r = got[doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, n_groups, n_links)
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        assert n_links <= r.count_sum and 0 <= r.n_best <= n_links


def test_memory_of_any_size_gives_the_same():
    texts = [t for _, t in odd_texts()] + ["one two", "two one two. one, (one) One"]
    for cut, encode in ((units.spaced, lambda new: [u + "|" for u in new]), (units.words, lambda new: [u.upper() for u in new])):
        small, large = units.Units(encode, cut, 2), units.Units(encode, cut)
        for _ in range(3):
            for t in texts:
                assert small.of([t, t]) == large.of([t, t]) == [encode(cut(t))] * 2
        assert not [u for u in large.young if len(u) > units.LONGEST_UNIT]


def test_labels():
    assert alignment.byte_table()["Ġ"] == 32 and len(alignment.byte_table()) == 256
    a, b = alignment.cut(b"0130230033")
    assert (a.tolist(), b.tolist()) == ([2, 1, 1, 1], [1, 2, 1, 1])
