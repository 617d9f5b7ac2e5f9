"""Ordered work inside a key, spread over many tasks.

Rows are cut into buckets along their order. The cuts come from a sample of bounded size
and decide only how the work is spread: a key that holds all rows still has some rows in
every bucket. What a bucket needs from those before it is a sum or a greatest value, one
row for each key and bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets along the order, a power of two, and the rows from which their cuts are taken.
BUCKETS = 64
SAMPLE = 6400


def cut_points(rows: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> list[tuple]:
    """At most buckets - 1 different rows that split a sample of the rows evenly, in
    ascending order, nulls first. The rows are drawn at random; only they reach the driver."""
    some = rows.orderBy(F.rand(11)).limit(sample).orderBy(*[F.col(c).asc_nulls_first() for c in rows.columns]).collect()
    at = [some[k * len(some) // buckets] for k in range(1, buckets)] if some else []
    return list(dict.fromkeys(tuple(r) for r in at))


def bucket_of(rows: DataFrame, columns: list[str], cuts: list[tuple]) -> Column:
    """How many cuts are not above the row's columns: a tree of comparisons."""
    types = [rows.schema[c].dataType for c in columns]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    edge = lambda cut: F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(cut, types, strict=True))])

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(row >= edge(cuts[middle]), tree(middle + 1, hi)).otherwise(tree(lo, middle))

    return tree(0, len(cuts))


def null_safe(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def ranked(df: DataFrame, keys: list[str], by: list[str], descending: bool = False, buckets: int = BUCKETS, rank: str = "rank", total: str | None = None) -> DataFrame:
    """df with each row's place in its key from 0, in the order of the ``by`` columns
    (which should tell the rows of a key apart); with ``total``, also the key's rows.

    A row's place is the number of rows in the buckets before its own, plus that in its
    bucket, so no task sorts more than a bucket of a key.
    """
    cut = df.withColumn("_bucket", bucket_of(df, by, cut_points(df.select(*by), buckets)))
    sizes = cut.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    whole, side = Window.partitionBy(*keys), F.desc("_bucket") if descending else F.asc("_bucket")
    before = F.coalesce(F.sum("_size").over(whole.orderBy(side).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"), before.alias("_before"), F.sum("_size").over(whole).alias("_total"))
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in by]
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    on = null_safe([*keys, "_bucket"], [*(f"_k{i}" for i in range(len(keys))), "_b"])
    out = cut.join(sizes, on).withColumn(rank, F.col("_before") + inside - 1)
    return out.select(*df.columns, rank, *([F.col("_total").alias(total)] if total else []))
