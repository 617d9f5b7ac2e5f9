"""Aggregates that are kept as tables and take changes in.

A table of sums lies in slices (folders). Changes are rows with a sign, 1 for a new row and
-1 for one that is taken back; they are summed up first, then added to the sums of the
slices they touch, and only those are read, written and evaluated again. Sums of counts and
decimals take rows back exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import write_slice


def touched_slices(changes: DataFrame, slices: list[str]) -> list[tuple]:
    """The slices that some rows are in; at most as many as there are folders."""
    return sorted((tuple(r) for r in changes.select(*slices).distinct().collect()), key=str)


def _within(df: DataFrame, slices: list[str], touched: list[tuple]) -> DataFrame:
    """Rows of some slices, by a filter that prunes folders."""
    if not touched:
        return df.limit(0)
    return df.filter(reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(slices, t, strict=True)]) for t in touched]))


def build(sums: DataFrame, path: str, slices: list[str]) -> None:
    """A new table of sums."""
    sums.write.partitionBy(*slices).parquet(path)


def apply_changes(path: str, changes: DataFrame, slices: list[str], keys: list[str], count: str, staging: str) -> list[tuple]:
    """Adds the sums of changes (same columns as the table) to those of a table and returns
    the slices that changed. Keys whose ``count`` comes to 0 go. A run that fails before the
    end leaves the table as it was or with whole new slices, and staging tells which."""
    spark = changes.sparkSession
    touched = touched_slices(changes, slices)
    if not touched:
        return []
    old = _within(spark.read.schema(changes.schema).parquet(path), slices, touched)
    every = [*slices, *keys]
    rest = [c for c in changes.columns if c not in every]
    both = old.select(*changes.columns).unionByName(changes)
    merged = both.groupBy(*every).agg(*[F.sum(c).cast(changes.schema[c].dataType).alias(c) for c in rest]).filter(F.col(count) != 0)
    merged.select(*changes.columns).write.parquet(staging)  # what is read is not what is written
    new = spark.read.schema(changes.schema).parquet(staging)
    write_slice(new, path, slices, changes.select(*slices).distinct())
    return touched


def reevaluate(path: str, schema, slices: list[str], touched: list[tuple], results: str, evaluate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Evaluates the touched slices of a table of sums, replaces them in ``results`` and
    returns all results. ``evaluate`` keeps the slice columns."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    new = evaluate(_within(spark.read.schema(schema).parquet(path), slices, touched))
    if touched:
        gone = spark.createDataFrame(touched, new.select(*slices).schema)
        write_slice(new, results, slices, gone)
    return spark.read.schema(new.schema).parquet(results)
