"""Joins of facts with spans of time, by a sweep over buckets.

Time is cut into buckets (see ranges.py), so a key with all rows is swept in many tasks. In
its bucket a span is seen exactly where it begins or ends; over the buckets that it covers
whole it holds for every fact, so only the greatest of such spans matters: a span names at
most 2 log2(buckets) nodes of a binary tree over the buckets, each node keeps the greatest,
and a bucket looks at the nodes above it. No structure that crosses a bucket grows with the
open spans, and no pair of a fact and a span is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranges import BUCKETS, bucket_of, cut_points, null_safe


def _number(df: DataFrame, column: str) -> Column:
    """A date, timestamp or integer as a long of the same order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    raise TypeError(f"{column} must be a date, timestamp or integer, it is {kind.simpleString()}")


def _nodes(lo: Column, hi: Column, levels: int) -> Column:
    """The nodes of a binary tree (1 is the root, leaf x is 2**levels + x) that cover the
    leaves from lo to hi, as an array; none if hi < lo."""
    start = F.struct((lo + (1 << levels)).alias("l"), (hi + (1 << levels) + 1).alias("r"), F.array().cast("array<long>").alias("n"))

    def climb(at: Column, _: Column) -> Column:
        left, right, open_ = at["l"], at["r"], at["l"] < at["r"]
        own = F.array_compact(F.array(F.when(open_ & (left % 2 == 1), left), F.when(open_ & (right % 2 == 1), right - 1)))
        up = lambda x: F.floor(x / 2)
        return F.struct(F.when(open_, up(left + 1)).otherwise(left).alias("l"), F.when(open_, up(right)).otherwise(right).alias("r"), F.concat(at["n"], own).alias("n"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, climb, lambda at: at["n"])


def _stab(n_keys: int):
    """The sweep inside buckets. Rows come in the order of keys, bucket, time, spans before
    facts at one time, spans by start and id. Open spans lie on a stack: one that begins
    later goes before those below it, so those that do not outlast it are dropped, and what
    has ended by a fact's time has ended for all facts after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, stack, last = None, [], None
        for batch in batches:
            keys = batch.columns[: n_keys + 1]
            groups = list(zip(*(c.to_pylist() for c in keys), strict=True))
            time, start, end, span, is_fact = (batch.column(n_keys + 1 + i).to_pylist() for i in range(5))
            rows, found = [], []
            for k, group in enumerate(groups):
                if group != here:
                    here, stack, last = group, [], None
                if is_fact[k]:
                    at = time[k]
                    while stack and stack[-1][0] is not None and stack[-1][0] < at:
                        stack.pop()
                    rows.append(k)
                    found.append((stack[-1][1:] if stack else (None, None)) + (last or (None, None)) + (bool(stack), last is not None))
                else:
                    if end[k] is None or start[k] is None or end[k] >= start[k]:
                        while stack and (end[k] is None or (stack[-1][0] is not None and stack[-1][0] <= end[k])):
                            stack.pop()
                        stack.append((end[k], start[k], span[k]))
                    last = (start[k], span[k])
            if rows:
                part, columns = batch.take(pa.array(rows)), list(zip(*found, strict=True))
                kinds = [pa.int64(), batch.schema.types[n_keys + 4]] * 2 + [pa.bool_()] * 2
                arrays = [*part.columns[: n_keys + 2], *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[: n_keys + 2], "hs", "hi", "ls", "li", "held", "begun"])

    return run


def asof(facts: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, span_id: str, tiers: str, buckets: int = BUCKETS) -> DataFrame:
    """facts with the id of one span of their key and its tier (see joins.asof_tiered). Keys
    join on equality, so a null key has no span."""
    names = [f"_k{i}" for i in range(len(keys))]
    picked = lambda df, **more: df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *[c.alias(n) for n, c in more.items()])
    s = picked(spans, _s=_number(spans, start), _e=_number(spans, end), _id=F.col(span_id)).dropna(subset=names)
    # spans of equal times differ by id alone, and the greatest goes before the others
    s = s.groupBy(*names, "_s", "_e").agg(F.max("_id").alias("_id"), F.min("_id").alias("_least"))
    d = picked(facts, _t=_number(facts, at)).dropna(subset=[*names, "_t"]).distinct()
    levels = max(1, (buckets - 1).bit_length())
    cuts = cut_points(d.select("_t").unionByName(s.filter("_s IS NOT NULL").select(F.col("_s").alias("_t"))), 1 << levels)
    last = (1 << levels) - 1

    of = lambda df, column: bucket_of(df, [column], cuts).cast("long")
    s = s.withColumns({"_bs": F.when(F.col("_s").isNotNull(), of(s, "_s")), "_be": F.when(F.col("_e").isNotNull(), of(s, "_e"))})
    d = d.withColumn("_b", of(d, "_t"))
    whole = F.struct(F.col("_s").alias("s"), F.col("_id").alias("i"))
    valid = s.filter("_s IS NULL OR _e IS NULL OR _s <= _e")

    # spans over whole buckets: the greatest of each node, then of all nodes above a bucket
    inner = _nodes(F.coalesce(F.col("_bs") + 1, F.lit(0)), F.coalesce(F.col("_be") - 1, F.lit(last)), levels)
    nodes = valid.select(*names, F.explode(inner).alias("_node"), whole.alias("_best")).groupBy(*names, "_node").agg(F.max("_best").alias("_best"))
    leaves = d.select(*names, "_b").distinct()
    above = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.floor((F.col("_b") + (1 << levels)) / F.pow(F.lit(2), k)))
    carried = leaves.withColumn("_node", F.explode(above)).join(nodes, [*names, "_node"]).groupBy(*names, "_b").agg(F.max("_best").alias("_over"))

    # the last span begun in the buckets before, and the ends of each key
    begun = s.groupBy(*names, F.coalesce("_bs", F.lit(-1)).alias("_b")).agg(F.max(whole).alias("_last"))
    line = Window.partitionBy(*names).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    both = begun.unionByName(leaves.withColumn("_last", F.lit(None).cast(begun.schema["_last"].dataType))).groupBy(*names, "_b").agg(F.max("_last").alias("_last"))
    before = both.withColumn("_before", F.max("_last").over(line)).drop("_last")
    ends = s.groupBy(*names).agg(F.max(whole).alias("_max"), F.min(F.struct(F.col("_s").alias("s"), F.col("_least").alias("i"))).alias("_min"))

    # inside the buckets
    span = [F.col("_s"), F.col("_e"), F.col("_id"), F.lit(False).alias("_fact")]
    starts = s.filter("_s IS NOT NULL").select(*names, F.col("_bs").alias("_b"), F.col("_s").alias("_t"), *span)
    stops = valid.filter("_be IS NOT NULL AND (_bs IS NULL OR _bs < _be)").select(*names, F.col("_be").alias("_b"), F.lit(None).cast("long").alias("_t"), *span)
    none = lambda c: F.lit(None).cast(s.schema[c].dataType).alias(c)
    stabs = d.select(*names, "_b", "_t", none("_s"), none("_e"), none("_id"), F.lit(True).alias("_fact"))
    rows = starts.unionByName(stops).unionByName(stabs).repartition(*names, "_b")
    rows = rows.sortWithinPartitions(*names, "_b", F.col("_t").asc_nulls_first(), "_fact", F.col("_s").asc_nulls_first(), "_id")
    kind = s.schema["_id"].dataType.simpleString()
    schema = ", ".join([*(f"{n} {s.schema[n].dataType.simpleString()}" for n in names), "_b long", "_t long", *(f"{c} {k}" for c, k in zip(("hs", "hi", "ls", "li"), ("long", kind) * 2, strict=True)), "held boolean", "begun boolean"])
    swept = rows.mapInArrow(_stab(len(names)), schema)

    found = swept.join(carried, [*names, "_b"], "left").join(before, [*names, "_b"], "left")
    pair = lambda flag, a, b: F.when(F.col(flag), F.struct(F.col(a).alias("s"), F.col(b).alias("i")))
    held, first = F.greatest(pair("held", "hs", "hi"), F.col("_over")), F.greatest(pair("begun", "ls", "li"), F.col("_before"))
    found = found.select(*[F.col(n).alias(f"{n}_f") for n in names], F.col("_t").alias("_tf"), held.alias("_held"), first.alias("_first"))

    mine = facts.withColumns({n: F.col(k) for n, k in zip(names, keys, strict=True)}).withColumn("_t", _number(facts, at))
    out = mine.join(ends.select(*[F.col(n).alias(f"{n}_e") for n in names], "_max", "_min"), _equal(names, "_e"), "left")
    out = out.join(found, _equal(names, "_f") & (F.col("_t") == F.col("_tf")), "left")
    holds = F.col("_held").isNotNull()
    if tiers == "full":
        begins = F.col("_first").isNotNull()
        chosen = F.when(F.col("_t").isNull(), F.col("_max")).when(holds, F.col("_held")).when(begins, F.col("_first")).otherwise(F.col("_min"))
        tier = F.when(F.col("_t").isNull() | holds, 1).when(begins, 2).otherwise(3)
    else:
        chosen = F.when(F.col("_t").isNull(), F.col("_max")).when(holds, F.col("_held")).otherwise(F.col("_max"))
        tier = F.when(F.col("_t").isNull() | holds, 1).otherwise(2)
    return out.select(*facts.columns, chosen["i"].alias(span_id), F.when(F.col("_max").isNotNull(), tier).alias("tier"))


def _equal(names: list[str], suffix: str) -> Column:
    out = F.lit(True)
    for n in names:
        out &= F.col(n) == F.col(f"{n}{suffix}")
    return out


def stabbed(facts: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, how: str, buckets: int = BUCKETS) -> DataFrame:
    """Facts with all spans of equal keys that hold their time: a span goes to the buckets
    that it touches and meets only the facts there. Every fact is in one bucket."""
    d, s = _number(facts, at), _number(spans, start)
    times = facts.select(d.alias("t")).unionByName(spans.select(s.alias("t"))).filter("t IS NOT NULL")
    cuts = cut_points(times, buckets)
    fact_rows = facts.withColumn("_t", d)
    fact_rows = fact_rows.withColumn("_b", F.when(F.col("_t").isNull(), -1).otherwise(bucket_of(fact_rows, ["_t"], cuts)))
    span_rows = spans.withColumns({"_s": s, "_e": _number(spans, end), **{f"_k{i}": F.col(k) for i, k in enumerate(keys)}})
    lo, hi = (F.when(F.col(c).isNull(), other).otherwise(bucket_of(span_rows, [c], cuts)) for c, other in (("_s", 0), ("_e", len(cuts))))
    touched = F.when((F.col("_s") <= F.col("_e")) | F.col("_s").isNull() | F.col("_e").isNull(), F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    always = F.when(F.col("_s").isNull() & F.col("_e").isNull(), F.array(F.lit(-1))).otherwise(F.array().cast("array<int>"))  # also for facts without a time
    span_rows = span_rows.withColumn("_sb", F.explode(F.concat(touched, always))).drop(*keys)
    holds = (F.col("_s").isNull() | (F.col("_t") >= F.col("_s"))) & (F.col("_e").isNull() | (F.col("_t") <= F.col("_e")))
    on = (F.col("_b") == F.col("_sb")) & holds
    for i, k in enumerate(keys):
        on &= F.col(k) == F.col(f"_k{i}")
    return fact_rows.join(span_rows, on, how).drop("_t", "_b", "_s", "_e", "_sb", *[f"_k{i}" for i in range(len(keys))])
