"""Windows over ordered rows of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import micros
from .ranges import null_safe, ranked


def delta(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """previous, change (0 on the first row) and change_pct (null if there is no previous
    value or it is 0)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("previous", F.lag(value).over(w))
    change = F.col(value) - F.col("previous")
    return out.withColumns({"change": F.coalesce(change, F.lit(0.0)), "change_pct": F.try_divide(change * 100.0, F.nullif(F.col("previous"), F.lit(0.0)))})


def previous_known(df: DataFrame, keys: list[str], order: list[Column], value: str, out: str = "previous_known") -> DataFrame:
    """The last value before a row that is not null."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def tail(df: DataFrame, keys: list[str], newest: list[Column], n: int) -> DataFrame:
    """The newest n rows of each key, with their age from 1."""
    return df.withColumn("age", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))).filter(F.col("age") <= n)


def trailing_streak(df: DataFrame, keys: list[str], newest: list[str], good: Column) -> DataFrame:
    """keys and streak: how many of the newest rows (greatest in the ``newest`` columns) are
    good before the first that is not; a null counts as not good. Two grouped aggregations:
    the newest bad row of each key, then the rows after it."""
    at = F.struct(*newest)
    rows = df.select(*keys, at.alias("_at"), F.coalesce(good, F.lit(False)).alias("_good"))
    last = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(F.when(~F.col("_good"), F.col("_at"))).alias("_bad"))
    seen = rows.join(last, null_safe(keys, [f"_k{i}" for i in range(len(keys))]))
    return seen.groupBy(*keys).agg(F.count_if(F.col("_bad").isNull() | (F.col("_at") > F.col("_bad"))).alias("streak"))


def cadence(df: DataFrame, keys: list[str], newest: list[str], always: Column, recent: int = 20, middle: int = 100, every_middle: int = 5, every_old: int = 20) -> DataFrame:
    """A log thinned by age, which the newest row (greatest in the ``newest`` columns) counts
    from 0: all ``recent`` rows, then every few of the next ``middle``, then fewer; the
    first and the last row and those for which ``always`` holds (or is null) stay. A key is
    ranked over many tasks."""
    rows = ranked(df, keys, newest, descending=True, rank="age", total="_n")
    age = F.col("age")
    every = F.when(age < recent, 1).when(age < recent + middle, every_middle).otherwise(every_old)
    anchor = (age == 0) | (age == F.col("_n") - 1)
    return rows.filter((F.pmod(age, every) == 0) | anchor | F.coalesce(always, F.lit(True))).drop("_n")


def sessions(df: DataFrame, keys: list[str], at: str, gap_seconds: int) -> DataFrame:
    """A number for each run of rows without a gap longer than ``gap_seconds``."""
    w = Window.partitionBy(*keys).orderBy(at)
    new = F.when(micros(at) - micros(F.lag(at).over(w)) > gap_seconds * 1_000_000, 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")
