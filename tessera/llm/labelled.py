"""Bounded samples of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 11) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` documents of either label, by a hash of the
    id, from the rows of labels for which ``train`` holds. Whole texts; the result is
    the same for every order and partitioning of the tables."""
    known = labels.filter(train & F.col(label).isin(0, 1)).select(F.col(id_col).alias("_l"), F.col(label).cast("int").alias("_y")).groupBy("_l").agg(F.max("_y").alias("_y"))
    # a top by hash for either label: every task keeps per_class rows at most
    top = [known.filter(F.col("_y") == y).orderBy(F.xxhash64("_l", F.lit(seed)), "_l").limit(per_class) for y in (0, 1)]
    chosen = top[0].union(top[1])
    rows = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t")).join(F.broadcast(chosen), F.col("_d") == F.col("_l"))
    return [(r._t or "", r._y) for r in sorted(rows.select("_d", "_t", "_y").distinct().collect(), key=lambda r: (r._d, r._t or ""))]
