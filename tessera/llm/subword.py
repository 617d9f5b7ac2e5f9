"""Quality classifier by supervised subword embeddings.

A document is the mean of learned vectors of its words and of their character n-grams,
hashed into a table of ``BUCKETS`` rows; a repeated neighbour (the same word twice in
a row) is one more feature, a word bigram that all words share. A softmax over the
mean gives the classes. Table and softmax are fitted by stochastic gradient descent in
numpy on a bounded sample of labelled whole texts (``per_class`` of either label).

The score is linear in the mean, so scoring needs one number for each bucket: half a
megabyte, whatever the corpus. It is one pass over whole texts in numpy, no shuffle.

Defined cases: null and empty texts have no features and get the score of the bias;
long texts are scored whole; repeated rows get equal scores; an empty table gives an
empty result; without labelled rows of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import _BYTE, _INVERSE, Block, blocks, mix, powers

BITS = 17
BUCKETS = 1 << BITS
NGRAMS = (3, 4, 5)
DIM = 8
PER_CLASS = 1500
EPOCHS = 6
RATE = 2.0
_REPEAT = 0


def features(block: Block, ngrams: tuple[int, ...] = NGRAMS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every feature of a block, kind by kind."""
    size = block.end - block.start
    place = np.ones(len(size) + 1, np.int64)
    np.cumsum(size + 1, out=place[1:])
    place[1:] += 1
    joined = np.full(place[-1], 0x20, np.uint8)  # " word word "
    at = np.flatnonzero(~block.space)
    joined[at + np.repeat(place[:-1] - block.start, size)] = block.data[at]
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTE[joined] * powers(len(joined)), out=sums[1:])
    back = powers(len(joined) + 1, _INVERSE)
    doc = block.word_doc
    top = np.uint64(64 - BITS)

    def hashed(start: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
        return (mix((sums[end] - sums[start]) * back[start] + np.uint64(kind)) >> top).astype(np.int64)

    yield doc, hashed(place[:-1], place[1:] - 1, 1)
    words = block.word_hash()
    same = np.flatnonzero((words[1:] == words[:-1]) & (doc[1:] == doc[:-1]))
    yield doc[same], np.full(len(same), _REPEAT)
    # n-grams of characters: all bytes that start one, and the first of each word among them
    lead = np.append(np.flatnonzero((joined & 0xC0) != 0x80), len(joined))
    char = np.searchsorted(lead, place)
    length = np.diff(char) - 1
    for n in ngrams:
        # a word of c characters with a space on either side has c + 3 - n n-grams
        count = np.maximum(length + 3 - n, 0)
        first = np.arange(count.sum()) + np.repeat(char[:-1] - 1 - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        yield np.repeat(doc, count), hashed(lead[first], lead[first + n], n)


def train(texts: list[str], labels: list[int], dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 3) -> tuple[np.ndarray, float]:
    """A number for each bucket and a bias: the logit of label 1 is bias + their mean."""
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return np.zeros(BUCKETS, np.float32), 0.0
    bags = []
    for block in blocks(pa.array(texts, pa.large_string())):
        docs, buckets = (np.concatenate(x) for x in zip(*features(block), strict=True))
        key, count = np.unique(docs * BUCKETS + buckets, return_counts=True)
        doc, bucket = key // BUCKETS, key % BUCKETS
        total = np.bincount(doc, count, block.n_docs)
        cuts = np.searchsorted(doc, np.arange(1, block.n_docs))
        weight = (count / total[doc]).astype(np.float32)
        bags += list(zip(np.split(bucket, cuts), np.split(weight, cuts), strict=True))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    table[_REPEAT] = 0
    out = rng.normal(0, 0.5, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    balance = len(y) / (2 * np.bincount(y, minlength=2))
    batch, step, steps = 16, 0, epochs * -(-len(y) // 16)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            some = [i for i in order[lo : lo + batch] if len(bags[i][0])]
            step += 1
            if not some:
                continue
            speed = rate * (1 - step / (steps + 1))
            index = np.concatenate([bags[i][0] for i in some])
            weight = np.concatenate([bags[i][1] for i in some])
            sizes = np.array([len(bags[i][0]) for i in some])
            mean = np.add.reduceat(table[index] * weight[:, None], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
            logits = mean @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            p *= balance[y[some]][:, None].astype(np.float32)
            inner = p @ out.T
            out -= speed * mean.T @ p / len(some)
            bias -= speed * p.mean(axis=0)
            np.add.at(table, index, -speed * weight[:, None] * np.repeat(inner, sizes, axis=0))
    return (table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def block_scores(block: Block, value: np.ndarray, bias: float) -> np.ndarray:
    total, count = np.zeros(block.n_docs), np.zeros(block.n_docs)
    for doc, bucket in features(block):
        total += np.bincount(doc, value[bucket], block.n_docs)
        count += np.bincount(doc, minlength=block.n_docs)
    return 1 / (1 + np.exp(-(bias + total / np.maximum(count, 1))))


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score, the probability of label 1, of every whole text."""
    value, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [block_scores(b, value, bias) for b in blocks(batch.column(1), 1 << 18)]
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts))], ["_id", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {id_type}, score double")
    return out.withColumnRenamed("_id", id_col)
