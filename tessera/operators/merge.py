"""Merges of a batch into a table, as joins: the result is written as a new version."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _matched(target: DataFrame, source: DataFrame, keys: list[str], how: str) -> DataFrame:
    t = target.select(F.struct(*[F.col(c) for c in target.columns]).alias("t"), *[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)])
    s = source.select(F.struct(*[F.col(c) for c in source.columns]).alias("s"), *[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)])
    on = reduce(lambda a, b: a & b, [F.col(f"_t{i}").eqNullSafe(F.col(f"_s{i}")) for i in range(len(keys))])
    return t.join(s, on, how)


def _single(source: DataFrame, keys: list[str], order: list[str] | None, value, first: bool = False) -> DataFrame:
    """One row a key: rows of a repeated key are applied in the order of ``order``; a
    column's value comes from the last row (or the first), as ``value`` says. Without an
    order a repeated key is an error."""
    at = F.struct(*order) if order else F.lit(0)
    pick = F.min_by if first else F.max_by
    rest = [c for c in source.columns if c not in keys]
    out = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[(value(c, at) if value else pick(F.struct(c), at)[c]).alias(c) for c in rest])
    if not order:
        out = out.filter(F.when(F.col("_n") > 1, F.raise_error(F.lit("a key is repeated: give an order")).cast("boolean")).otherwise(True))
    return out.select(*source.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None, keep_known: bool = False, order: list[str] | None = None) -> DataFrame:
    """Rows of both; where keys meet (nulls meet nulls) the ``update`` columns come from
    source, with keep_known only if they are not null there. Rows of source that share a
    key are applied in the order of the ``order`` columns, as one statement for each would:
    the first inserts, later ones update."""
    update = [c for c in target.columns if c not in keys] if update is None else update

    def applied(c: str, at: Column) -> Column:
        if c not in update:
            return F.min_by(F.struct(c), at)[c]
        return F.max_by(c, F.when(F.col(c).isNotNull(), at)) if keep_known else F.max_by(F.struct(c), at)[c]

    both = _matched(target, _single(source, keys, order, applied), keys, "full")
    new, old = F.col("t").isNull(), F.col("s").isNull()

    def value(c: str) -> Column:
        mine, theirs = F.col(f"t.{c}"), F.col(f"s.{c}") if c in source.columns else F.lit(None)
        if c in keys:
            return F.when(new, theirs).otherwise(mine)
        if c not in update:
            return F.when(new, theirs).otherwise(mine)
        return F.when(old, mine).otherwise(F.coalesce(theirs, mine) if keep_known else theirs)

    return both.select(*[value(c).alias(c) for c in target.columns])


def insert_new(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """target and the rows of source with keys that it lacks, of a repeated key the first
    in the order of the ``order`` columns."""
    one = _single(source, keys, order, None, first=True)
    fresh = one.alias("s").join(target.select(*[F.col(k).alias(f"_k{k}") for k in keys]), reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"_k{k}")) for k in keys]), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def close_missing(target: DataFrame, batch: DataFrame, keys: list[str], as_of: Column, active: str = "is_active", end: str = "end_date") -> DataFrame:
    """target after a full snapshot: rows that the batch lacks become inactive and end at
    the snapshot, unless they had ended. A null key meets a null key."""
    seen = batch.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]).distinct().withColumn("_seen", F.lit(True))
    gone = F.col("_seen").isNull() & F.col(active)
    out = target.join(seen, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s{i}")) for i, k in enumerate(keys)]), "left")
    return out.withColumns({end: F.when(gone & F.col(end).isNull(), as_of).otherwise(F.col(end)), active: F.when(gone, False).otherwise(F.col(active))}).select(*target.columns)


def reconcile(queue: DataFrame, detected: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """A work queue after a new detection: pending rows that were not found again are
    resolved, resolved rows that were are pending again, ignored ones stay; new rows are
    pending."""
    both = _matched(queue, detected.select(*keys).distinct(), keys, "full")
    old = F.col(f"t.{status}")
    now = (
        F.when(F.col("t").isNull(), "pending")
        .when(old == "ignored", "ignored")
        .when(F.col("s").isNull(), F.when(old == "pending", "resolved").otherwise(old))
        .otherwise("pending")
    )
    return both.select(*[now.alias(c) if c == status else F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c) if c in keys else F.col(f"t.{c}").alias(c) for c in queue.columns])


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys and status (added, removed, changed, same) by keys and values."""
    both = _matched(before.select(*keys, *values), after.select(*keys, *values), keys, "full")
    same = reduce(lambda a, b: a & b, [F.col(f"t.{v}").eqNullSafe(F.col(f"s.{v}")) for v in values])
    status = F.when(F.col("t").isNull(), "added").when(F.col("s").isNull(), "removed").when(same, "same").otherwise("changed")
    return both.select(*[F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in keys], status.alias("status"))


def apply_decisions(queue: DataFrame, decisions: DataFrame, key: str, at: str) -> DataFrame:
    """queue with the newest decision of each key: its status, and its stance where one is
    given. Decisions on unknown keys change nothing."""
    from .joins import best_row

    last = best_row(decisions, [key], [F.col(at).desc(), F.col("status")]).select(F.col(key).alias("_k"), F.col("status").alias("_s"), F.col("stance").alias("_v"))
    out = queue.join(last, F.col(key) == F.col("_k"), "left")
    return out.withColumns({"status": F.coalesce("_s", "status"), "stance": F.coalesce("_v", "stance")}).select(*queue.columns)
