"""Toxicity by noisy-channel deobfuscation.

Obfuscated stretches of a text (look-alike symbols inside words, letters spelled out
with separators, stretched letters) become lattices of what each character may stand
for. Viterbi decoding finds the likeliest original under a trigram model of characters
and the costs of the channel; the restored text is scored by words and word beginnings
that labelled toxic texts have far more often than others.

The character model counts the plain words of every document: a table of at most
``CLASSES**3`` numbers, whatever the corpus. The lexicon is fitted on a bounded sample of
labelled whole texts. Both go out with the code of the scoring pass, which reads each
whole text once and shuffles nothing.

Defined cases: null and empty texts get the score of no evidence; long texts are
scored whole; repeated rows get equal scores; an empty table gives an empty result;
without labelled rows of both kinds the lexicon is empty and all scores are equal.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .simhash import block_fingerprints, spanning_links
from .words import Block, blocks

CLASSES = 64
PREFIX = 5
PER_CLASS = 2000
MIN_DOCS = 3
MIN_LOG_ODDS = 3.0
#: How many words and beginnings may enter the lexicon by chance alone, at most.
CHANCE = 0.05
_MEMO = 300_000
_MEMO_CHARS = 200
_COUNTED_CHARS = 1 << 20
#: The letters that a symbol may stand for.
LOOK_ALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
#: Costs, in nats, of what the channel does to a character.
COST = {"same": 0.0, "look_alike": 1.0, "drop": 9.0, "stretch": 0.7, "double": 2.0, "hidden": 2.5, "gap": 0.1, "break": 6.0, "mark": 1.0}
#: What a star may hide, and what may stand between spelled-out letters.
HIDDEN = "aeiou"
MARKS = "!(|"
GAPS = " ._*-"

_WORD = regex.compile(r"\p{L}+")
_SIGNS, _GAPS = (regex.escape(x, special_only=False) for x in ("".join(LOOK_ALIKE), GAPS))
_DOUBLES = 3
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BETWEEN = np.zeros(256, bool)
_BETWEEN[list(GAPS.strip().encode())] = True
_LEADS = np.zeros(256, bool)
_LEADS[list("".join(LOOK_ALIKE).encode())] = True
_ENDS = _LEADS.copy()
_ENDS[list(MARKS.encode())] = False
_SPELLED = 4


def noisy_stretches(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of the stretches of a block that may hide a word: words with a
    look-alike or separator beside a letter or with a stretched letter, and letters
    spelled out one by one."""
    b, letter = block.data, _LETTER[block.data]
    spot = np.zeros(len(b) + 1, bool)
    if len(b) > 2:
        spot[1:-2] |= letter[:-2] & _BETWEEN[b[1:-1]] & letter[2:]
        spot[:-3] |= letter[:-2] & (b[:-2] == b[1:-1]) & (b[1:-1] == b[2:])
    if len(b) > 5:  # letters of two bytes
        spot[:-6] |= (b[:-5] >= 0xC0) & (b[:-5] == b[2:-3]) & (b[2:-3] == b[4:-1]) & (b[1:-4] == b[3:-2]) & (b[3:-2] == b[5:])
    start, end = block.start, block.end
    size = end - start
    found = np.add.reduceat(spot[:-1], start) > 0 if len(start) else np.zeros(0, bool)
    if len(start):  # many doubled letters are a stretched word too
        double = np.zeros(len(b), np.int32)
        double[:-1] = letter[:-1] & (b[:-1] == b[1:])
        found |= np.add.reduceat(double, start) >= _DOUBLES
    if len(start):
        # a look-alike before the last letter, or at the end and no mere row of one sign
        last = np.maximum.reduceat(np.where(letter, np.arange(len(b)), -1), start)
        alike = np.concatenate([[0], np.cumsum(_LEADS[b])])
        found |= (last > start) & (alike[np.maximum(last, 0)] - alike[start] > 0)
        row = (size > 2) & (b[end - 1] == b[np.maximum(end - 2, 0)]) & (b[end - 1] == b[np.maximum(end - 3, 0)])
        found |= _ENDS[b[end - 1]] & (last > start) & ~row
    single = ((size == 1) & (letter | _LEADS[b])[start]) | ((size == 2) & (b[start] >= 0xC0)) if len(start) else found
    doc = block.word_doc
    edge = np.flatnonzero(np.concatenate([[True], (single[1:] != single[:-1]) | (doc[1:] != doc[:-1])])) if len(start) else np.zeros(0, np.int64)
    last = np.append(edge[1:], len(start)) - 1
    run = (last - edge + 1 >= _SPELLED) & single[edge] if len(edge) else np.zeros(0, bool)
    if len(edge):  # at least half letters, or it is a row of figures
        letters = np.concatenate([[0], np.cumsum(letter[start])])
        run &= 2 * (letters[last + 1] - letters[edge]) >= last - edge + 1
    first, stop = np.concatenate([start[found], start[edge[run]]]), np.concatenate([end[found], end[last[run]]])
    order = np.argsort(first, kind="stable")
    return first[order], stop[order]


def char_class() -> np.ndarray:
    """Code point -> class: 0 ends a word, 1-26 are a-z, other letters share the rest."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0xC0, 0x3000):
        ch = chr(c)
        if ch.isalpha():
            table[c] = 27 + ord(ch.lower()[0]) % (CLASSES - 27)
    table[0x3000:0xD800] = 27 + np.arange(0x3000, 0xD800) % (CLASSES - 27)
    for i in range(26):
        table[0x41 + i] = table[0x61 + i] = i + 1
    return table


_class: np.ndarray | None = None


def classes() -> np.ndarray:
    global _class
    if _class is None:
        _class = char_class()
    return _class


def some_texts(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column, some at a time: about _COUNTED_CHARS, one at least."""
    held, size = [], 0
    for value in column:
        text = value.as_py()
        if text:
            held.append(text)
            size += len(text)
            if size > _COUNTED_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def trigram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """trigram (three classes as one number) and n over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = classes(), np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for text in ("  ".join(["", *texts, ""]) for texts in some_texts(batch.column(0))):
                for at in range(0, len(text) - 2, _COUNTED_CHARS):  # pieces share the last two
                    c = table[np.frombuffer(text[at : at + _COUNTED_CHARS + 2].encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
                    key = (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]
                    total += np.bincount(key[(c[1:-1] > 0) | (c[2:] > 0)], minlength=CLASSES**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["trigram", "n"])

    counts = docs.select(F.col(text_col).alias("_text")).mapInArrow(run, "trigram long, n long")
    return counts.groupBy("trigram").agg(F.sum("n").alias("n"))


def counts_table(counts: DataFrame) -> np.ndarray:
    """The trigram counts as an array; their number of rows is fixed."""
    n = np.zeros(CLASSES**3)
    for r in counts.collect():
        n[r.trigram] = r.n
    return n


def language_model(n: np.ndarray, lexicon: dict[str, float] | None = None, prior: float = 0.3) -> np.ndarray:
    """log P(c | a, b), smoothed with the bigram. The words of a lexicon are expected in
    noisy stretches: each of their trigrams gets a share of its context's count more."""
    n = n.reshape(CLASSES, CLASSES, CLASSES).copy()
    table, context = classes(), n.sum(axis=2)
    for a, b, c in {t for key in lexicon or () for t in _trigrams(key, table)}:
        n[a, b, c] += prior * max(context[a, b], 10.0)
    pair = n.sum(axis=0) + 0.1
    pair = pair / pair.sum(axis=1, keepdims=True)
    seen = n.sum(axis=2, keepdims=True)
    return np.log((n + 2 * pair[None]) / (seen + 2)).astype(np.float32)


def _trigrams(key: str, table: np.ndarray) -> list[tuple[int, int, int]]:
    word = key.rstrip("*")
    c = [0, 0, *(int(table[ord(ch)]) for ch in word), *([] if key.endswith("*") else [0])]
    return list(zip(c, c[1:], c[2:], strict=False))


class Restorer:
    """Viterbi decoding of noisy stretches; recent ones are remembered."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.memo: dict[str, str] = {}

    def lattice(self, text: str) -> list[list[tuple[str, float]]]:
        """For each character or run of equal ones, what it may stand for, and the cost."""
        out, at = [], 0
        spelled = regex.fullmatch(rf"(?:\p{{L}}|[{_SIGNS}])(?:[{_GAPS}]+(?:\p{{L}}|[{_SIGNS}]))+[^\p{{L}}]*", text) is not None
        end = max((i for i, c in enumerate(text) if c.isalpha()), default=-1)
        while at < len(text):
            c, to = text[at], at + 1
            while to < len(text) and text[to] == c:
                to += 1
            n = to - at
            if c.isalpha():
                ways = [(c, COST["same"])] if n == 1 else [(c * 2, COST["same"]), (c, COST["double"])] if n == 2 else [(c, COST["stretch"]), (c * 2, COST["stretch"] + 0.5)]
            elif c in GAPS and spelled:
                ways = [("", COST["gap"]), (" ", COST["break"])]
            elif c in LOOK_ALIKE:
                ways = [(x * m, COST["look_alike"] * n) for x in LOOK_ALIKE[c] for m in {1, min(n, 2)}]
                # at the end of a word it may be a mark
                ways.append((" ", COST["drop"] if at < end else COST["mark"] if c in MARKS else 5 * COST["mark"]))
            elif c in GAPS:
                ways = [(" ", COST["mark"]), ("", COST["hidden"])]
                if c == "*" and n == 1 and 0 < at < end:
                    ways += [(v, COST["hidden"]) for v in HIDDEN]
            else:
                ways = [(" ", 0.0)]
            out.append(ways)
            at = to
        return out

    def decode(self, text: str) -> str:
        """The likeliest original of one noisy stretch, its words set apart by spaces."""
        known = self.memo.get(text)
        if known is not None:
            return known
        table, model = classes(), self.model
        # a state's text is a chain of its parts, last first, so that long stretches are linear
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for ways in [*self.lattice(text.lower()), [(" ", 0.0)]]:
            nxt: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, said) in states.items():
                for add, cost in ways:
                    x, y, s = a, b, score - cost
                    for ch in add:
                        c = int(table[ord(ch)])
                        if c or y:
                            s += model[x][y][c]
                        x, y = y, c
                    if (x, y) not in nxt or s > nxt[x, y][0]:
                        nxt[x, y] = (s, (said, add) if add else said)
            states = nxt
        chain, parts = max(states.values(), key=lambda v: v[0])[1], []
        while chain:
            chain, add = chain
            parts.append(add)
        best = "".join(reversed(parts)).strip()
        if len(text) <= _MEMO_CHARS:
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            self.memo[text] = best
        return best

    def words(self, block: Block) -> Iterator[list[str]]:
        """Words of each text of a block, and of its noisy stretches as they are restored."""
        first, stop = noisy_stretches(block)
        cuts = np.searchsorted(first, block.offsets)
        raw = block.data.tobytes()
        for d in range(block.n_docs):
            words = _WORD.findall(raw[block.offsets[d] : block.offsets[d + 1]].decode().lower())
            for i in range(cuts[d], cuts[d + 1]):
                words += _WORD.findall(self.decode(raw[first[i] : stop[i]].decode()))
            yield words


def fold_marks(word: str) -> str:
    """The word without accents and other marks."""
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def keys_of(word: str) -> tuple[str, ...]:
    word = fold_marks(word)
    return (word, word[:PREFIX] + "*") if len(word) >= PREFIX else (word,)


def surprise(n: int, m: int, share: float) -> float:
    """A bound of how unlikely it is that of n + m texts n or more are toxic where a ``share``
    of all texts is (Chernoff's), as its negative logarithm; 0 if n is no more than expected."""
    part = n / (n + m)
    if part <= share:
        return 0.0
    return n * math.log(part / share) + (m * math.log((1 - part) / (1 - share)) if m else 0.0)


def families(texts: list[str]) -> list[int]:
    """A number for each text, the same for texts that near copies connect: fingerprints of
    two-word shingles within 7 bits."""
    prints = np.concatenate([block_fingerprints(b, 2) for b in blocks(pa.array(texts, pa.large_string()))])
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    for a, b in spanning_links(np.unique(prints), 7):
        a, b = sorted((top(a), top(b)))
        if a != b:
            up[b] = a
    return [top(x) for x in prints.tolist()]


def fit(texts: list[tuple[str, int]], restorer: Restorer) -> tuple[dict[str, float], tuple[float, float]]:
    """Weights of toxic words and word beginnings, and the logistic curve of their sum.

    A word of the lexicon is in MIN_DOCS toxic texts or more, has a log odds ratio above
    MIN_LOG_ODDS, and more toxic texts than chance explains, as many words as there are
    being tried: how many texts that takes grows with the logarithm of the number of
    words, not with the sample. Near copies count as one text, as chance made one of them.
    """
    texts = sorted(set(texts))
    words = (w for block in blocks(pa.array([t for t, _ in texts], pa.large_string())) for w in restorer.words(block))
    bags = [({k for w in set(ws) for k in keys_of(w)}, y) for ws, (_, y) in zip(words, texts, strict=True)]
    if len({y for _, y in bags}) < 2:
        return {}, (0.0, 0.0)
    told: dict[tuple[int, int], set[str]] = {}
    for family, (bag, y) in zip(families([t for t, _ in texts]), bags, strict=True):
        told.setdefault((y, family), set()).update(bag)
    size, seen = Counter(y for y, _ in told), {0: Counter(), 1: Counter()}
    for (y, _), bag in told.items():
        seen[y].update(bag)
    weights, least, share = {}, math.log(max(len(seen[1]), 1) / CHANCE), size[1] / len(told)
    for key, n in seen[1].items():
        odds = math.log((n + 0.5) / (size[1] + 1)) - math.log((seen[0][key] + 0.5) / (size[0] + 1))
        if n >= MIN_DOCS and odds > MIN_LOG_ODDS and surprise(n, seen[0][key], share) > least:
            weights[key] = odds
    evidence = np.array([sum(sorted((weights.get(k, 0.0) for k in bag), reverse=True)[:3]) for bag, _ in bags])
    y = np.array([y for _, y in bags], float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    slope, base = 1.0, -1.0
    for _ in range(2000):  # logistic regression on one number, by gradient descent
        p = 1 / (1 + np.exp(-(slope * evidence + base)))
        slope -= 0.5 * (weight * (p - y) * evidence).sum()
        base -= 0.5 * (weight * (p - y)).sum()
    return weights, (float(slope), float(base))


class Weights(dict):
    """The weight of a word, remembered for recent words."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        found = max((self.weights.get(k, 0.0) for k in keys_of(word)), default=0.0)
        if len(self) >= _MEMO:
            self.clear()
        self[word] = found
        return found


def score(docs: DataFrame, model: np.ndarray, lexicon: dict[str, float], curve: tuple[float, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score and evidence (the toxic words that were found, restored)."""
    slope, base = curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, weights = Restorer(model), Weights(lexicon)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                scores, said = [], []
                for words in (w for block in blocks(part.column(1)) for w in restorer.words(block)):
                    values = list(map(weights.__getitem__, words))
                    hits = {w: v for w, v in zip(words, values, strict=True) if v} if any(values) else {}
                    z = slope * sum(sorted(hits.values(), reverse=True)[:3]) + base
                    scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
                    said.append(sorted(hits))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), pa.array(said, pa.list_(pa.string()))], ["_id", "score", "evidence"])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {id_type}, score double, evidence array<string>")
    return out.withColumnRenamed("_id", id_col)
