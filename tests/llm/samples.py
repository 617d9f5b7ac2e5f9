"""A small table with the awkward rows: nulls, empty and very long texts, ties, repeated
rows, and columns named like those that the operators use inside."""

from __future__ import annotations

import random

_r = random.Random(5)
_VOCABULARY = ["".join(_r.choice("abcdefghij") for _ in range(_r.randint(1, 6))) for _ in range(300)] + ["straße", "ça", "日本", "x$y"]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return "".join(r.choice(_VOCABULARY) + r.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(n))


PASSAGE = prose(60, 99)
_BASE = prose(200, 1)
TEXTS: list[tuple[int | None, str | None]] = [
    (1, _BASE),
    (2, _BASE),  # an exact copy
    (3, _BASE[:600] + " changed " + _BASE[606:]),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "one"),
    (8, "one two"),
    (9, prose(120, 2) + PASSAGE + prose(30, 3)),
    (10, prose(40, 4) + PASSAGE),
    (11, PASSAGE + " " + PASSAGE),
    (12, "spam spam " * 100),
    (13, prose(20_000, 6)),
    (14, prose(70, 7)),
    (14, prose(70, 7)),  # a repeated row
    (15, "\n".join([prose(12, 8).replace("\n", " ")] * 6 + [prose(60, 9)])),
    (None, prose(90, 10)),
    (17, "ÀÉÎ straße 日本 x$y " * 3 + prose(60, 11)),
]

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, th int, bodies string, fp int, _id string, key string, _text string, bucket int, _size int, _null int, _copy int, _row int, nil int, rest int, node int"


def documents(spark, texts=None):
    rows = []
    for n, (i, t) in enumerate(TEXTS if texts is None else texts):
        source = (None, "b", "a", "src")[n % 4]
        rows.append((i, t, "en" if n % 3 else None, source, len(t or ""), "x", 1, "y", 2, "z", "k", "t", 3, 4, 5, 6, 7, 8, 9, 10))
    return spark.createDataFrame(rows, COLUMNS).repartition(3)
