"""Joins that one call of ``DataFrame.join`` does not say.

All work on equal keys with further conditions, so they shuffle by key and adaptive
execution may split what is skewed. None needs a cross join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import sweep

_TASK_ROWS = 500_000


def best_row(df: DataFrame, keys: list[str], order: list[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows of each key; ``order`` should be total."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= k)
    return out if rank else out.drop(name)


def latest_lookup(df: DataFrame, other: DataFrame, keys: list[str], order: list[Column], how: str = "left") -> DataFrame:
    """df with the latest row of other by key: a correlated LIMIT 1 as a join."""
    return df.join(best_row(other, keys, order), keys, how)


def interval_join(facts: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Facts with the spans of equal keys that hold their time; a null end or start is open.
    Both are cut along time, so a key with many rows is joined in many tasks."""
    return sweep.stabbed(facts, spans, keys, at, start, end, how)


def asof_tiered(facts: DataFrame, spans: DataFrame, keys: list[str], fact_id: str, at: str, start: str, end: str, span_id: str, tiers: str = "full") -> DataFrame:
    """Every fact with one span of its key.

    Spans are looked at latest start first (null starts last), then greatest id. Tier 1
    holds the date; an unknown date takes the first span. In the full form tier 2 is the
    first span that started by the date or has no start, tier 3 the last of all; in the
    short form tier 2 is the first span. Facts without a span keep nulls, rows that repeat
    a fact id stay rows of their own. Times are swept, no pairs are made (sweep.py).
    """
    return sweep.asof(facts, spans, keys, at, start, end, span_id, tiers)


def _classes(df: DataFrame, row_id: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The different rows of df without their ids, each with its class ``name`` and with _n
    and _id, the number and one of the ids that have it; and the class of each id. Ids of one
    row each share the class of that row, an id of several rows has its own."""
    values = [c for c in df.columns if c != row_id]
    different = df.distinct()
    several = different.groupBy(F.col(row_id).alias("_several")).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    own = F.col("_rows").isNotNull()
    key = F.struct(own.alias("own"), F.when(own, F.col(row_id)).alias("id"), *[F.when(~own, F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(values)])
    marked = different.join(several, F.col(row_id).eqNullSafe(F.col("_several")), "left").withColumn(name, key)
    kind = marked.groupBy(name, *[F.col(f"`{c}`") for c in values]).agg(F.count(row_id).alias("_n"), F.max(row_id).alias("_id"))
    return kind, marked.select(row_id, name).distinct()


def best_candidate(facts: DataFrame, candidates: DataFrame, on: str, fact_id: str, candidate_id: str, score: list[Column]) -> DataFrame:
    """fact_id, status (matched, ambiguous, no_candidates), candidate_id, n_best.

    Candidates share the key ``on``. The greatest score of each candidate counts; equal
    best scores of different candidates are ambiguous. ``score`` may use all columns but
    the ids.

    Facts that are equal but for their ids meet candidates that are equal but for theirs
    once, so pairs grow with the different ones, not with the rows of a key. An id with
    several different rows is a class by itself, as the best of its rows counts.
    """
    (kind, members), (other, _) = _classes(facts, fact_id, "_fact"), _classes(candidates, candidate_id, "_candidate")
    scored = F.struct(*[s.alias(f"s{i}") for i, s in enumerate(score)])
    # _fact: the group of facts that the pair is for; _candidate: that of candidates
    pairs = kind.drop("_n", "_id").join(other, on, "left").select("_fact", "_candidate", "_n", "_id", scored.alias("_score"))
    each = pairs.groupBy("_fact", "_candidate").agg(F.max("_n").alias("_n"), F.max("_id").alias("_id"), F.max("_score").alias("_score"))
    by_score = each.groupBy("_fact", "_score").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_best"), F.max("_id").alias("_one"))
    best = by_score.groupBy("_fact").agg(F.max(F.struct("_score", "n_best", "_one")).alias("_best")).select(F.col("_fact").alias("_of"), "_best.n_best", "_best._one")
    status = F.when(F.col("n_best") == 0, "no_candidates").when(F.col("n_best") == 1, "matched").otherwise("ambiguous")
    out = members.join(best, F.col("_fact") == F.col("_of"))
    return out.select(fact_id, status.alias("status"), F.when(F.col("n_best") == 1, F.col("_one")).alias(candidate_id), "n_best")


@dataclass(frozen=True)
class Tier:
    """One way to link: pairs holds fact and target. ``same`` names a boolean column of it:
    a fact's pairs where it is true go before the others, which count only where it has
    none. A tier that is ``last_resort`` is for facts that no tier before it links."""

    method: str
    confidence: float
    pairs: DataFrame
    same: str | None = None
    last_resort: bool = False


def tiered_link(fact_id: str, target_id: str, tiers: list[Tier]) -> DataFrame:
    """fact_id, target_id, method, confidence: in each tier a fact links to a target only
    if it is the one candidate; of several ways to a target the most certain counts."""
    linked = None
    for tier in tiers:
        same = F.coalesce(F.col(tier.same), F.lit(False)) if tier.same else F.lit(True)
        inside, target = F.when(same, F.col(target_id)), F.col(target_id)
        ends = tier.pairs.groupBy(fact_id).agg(F.coalesce(F.min(inside), F.min(target)).alias(target_id), F.coalesce(F.max(inside), F.max(target)).alias("_other"))
        one = ends.filter(F.col(target_id) == F.col("_other")).drop("_other")
        if tier.last_resort and linked is not None:
            one = one.join(linked.select(fact_id), fact_id, "left_anti")
        one = one.withColumns({"method": F.lit(tier.method), "confidence": F.lit(tier.confidence)})
        linked = one if linked is None else linked.unionByName(one)
    return best_row(linked, [fact_id, target_id], [F.col("confidence").desc(), F.col("method")])


def composite_link(facts: DataFrame, targets: DataFrame, fact_id: str, target_id: str, sure: list[Column], guessed: list[Column], keys: list[str]) -> DataFrame:
    """fact_id, target_id, method, confidence by a key of several parts: the parts that a
    fact carries (1.0), or those read out of its text where it does not carry all (0.9).
    Targets that share a key link nothing."""
    carried = reduce(lambda a, b: a & b, [c.isNotNull() for c in sure])
    asked = facts.select(fact_id, carried.alias("_sure"), *[F.when(carried, c).otherwise(g).alias(k) for c, g, k in zip(sure, guessed, keys, strict=True)])
    one = targets.groupBy(*keys).agg(F.min(target_id).alias(target_id), F.max(target_id).alias("_other")).filter(F.col(target_id) == F.col("_other"))
    return asked.join(one, keys).select(fact_id, target_id, F.when(F.col("_sure"), "payload_key").otherwise("text_key").alias("method"), F.when(F.col("_sure"), 1.0).otherwise(0.9).alias("confidence"))


Bucket = Callable[[Column], Column]
Gap = Callable[[Column, Column], Column]


def nearest_before(facts: DataFrame, events: DataFrame, keys: list[str], fact_at: str, event_at: str, event_cols: list[str], strict: bool = True, bucket: Bucket | None = None, within: Gap | None = None) -> DataFrame:
    """Facts with the last event of their keys before their time.

    Facts and events become one timeline; the last event seen so far is carried along,
    so no pair of rows is made. ``bucket`` maps a time to a span of time in order (such as
    its day): a key is then sorted span by span in many tasks, and only the last event of
    each span goes on to the next ones. ``within`` tells from the times of a fact and its
    event whether they are near enough; a farther event does not count.
    """
    return _near(_nearest(facts, events, keys, fact_at, event_at, event_cols, True, strict, bucket), fact_at, event_at, event_cols, within)


def nearest_after(facts: DataFrame, events: DataFrame, keys: list[str], fact_at: str, event_at: str, event_cols: list[str], strict: bool = False, bucket: Bucket | None = None, within: Gap | None = None) -> DataFrame:
    """Facts with the first event of their keys at or after their time."""
    return _near(_nearest(facts, events, keys, fact_at, event_at, event_cols, False, strict, bucket), fact_at, event_at, event_cols, within)


def _near(found: DataFrame, fact_at: str, event_at: str, event_cols: list[str], within: Gap | None) -> DataFrame:
    if within is None:
        return found
    near = within(F.col(fact_at), F.col(event_at))
    return found.withColumns({c: F.when(near, F.col(c)) for c in dict.fromkeys([*event_cols, event_at])})


def _nearest(facts: DataFrame, events: DataFrame, keys: list[str], fact_at: str, event_at: str, event_cols: list[str], back: bool, strict: bool, bucket: Bucket | None) -> DataFrame:
    kept = [c for c in facts.columns if c not in keys]
    payload = F.struct(F.col(event_at).alias(event_at), *[F.col(c) for c in event_cols if c != event_at])
    left = facts.select(*keys, F.col(fact_at).alias("_t"), F.struct(*kept).alias("_fact"), F.lit(None).cast(events.select(payload.alias("x")).schema["x"].dataType).alias("_event"))
    right = events.select(*keys, F.col(event_at).alias("_t"), F.lit(None).cast(left.schema["_fact"].dataType).alias("_fact"), payload.alias("_event"))
    # at equal times an event comes first where it counts
    is_event = F.col("_event").isNotNull()
    tie = F.when(is_event, 1 if strict else -1).otherwise(0)
    time = F.col("_t").asc() if back else F.col("_t").desc()
    others = [F.col(f"_event.{c}") for c in event_cols if c != event_at]
    part = [F.col(k) for k in keys] + ([bucket(F.col("_t"))] if bucket else [])
    seen = Window.partitionBy(*part).orderBy(time, tie, *[c.asc_nulls_first() for c in others]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = left.unionByName(right).withColumn("_event", F.last("_event", ignorenulls=True).over(seen)).filter(F.col("_fact").isNotNull())
    if bucket:
        span = bucket(F.col("_t")).alias("_span")
        reverse = F.col("_t").desc() if back else F.col("_t").asc()
        ends = best_row(right.select(*keys, span, "_t", "_event"), [*keys, "_span"], [reverse, *[c.desc_nulls_last() for c in others]]).drop("_t")
        # of each span of facts or events, the last event of all spans before it
        spans = left.select(*keys, span).distinct().withColumn("_event", F.lit(None).cast(right.schema["_event"].dataType)).unionByName(ends)
        spans = spans.groupBy(*keys, "_span").agg(F.first("_event", ignorenulls=True).alias("_event"))
        earlier = Window.partitionBy(*keys).orderBy(F.col("_span").asc() if back else F.col("_span").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carry = spans.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_span", F.last("_event", ignorenulls=True).over(earlier).alias("_carried"))
        on = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)] + [bucket(F.col("_t")).eqNullSafe(F.col("_span"))]
        both = both.join(carry, reduce(lambda a, b: a & b, on), "left").withColumn("_event", F.coalesce("_event", "_carried"))
    return both.select(*keys, "_fact.*", *[F.col(f"_event.{c}").alias(c) for c in dict.fromkeys([event_at, *event_cols])])


def full_grid(rows: DataFrame, columns: DataFrame, stats: DataFrame, on: list[str], defaults: dict[str, object]) -> DataFrame:
    """Every row key with every column key, and the stats or defaults of the cell. Both
    key sets are dimensions; the product is the wanted output."""
    return rows.join(columns, F.lit(True)).join(stats, on, "left").fillna(defaults)


def longest_prefix(df: DataFrame, code: str, table: DataFrame, prefix: str, value: str, out: str | None = None) -> DataFrame:
    """df with the value of the longest prefix in a table that its code begins with; null if
    there is none. Of a prefix with several values the least counts.

    Different codes alone are looked up, once for each length that prefixes have, by equality;
    the empty prefix is one row for all and joined as such.
    """
    known = table.filter(F.col(prefix).isNotNull()).groupBy(F.col(prefix).alias("_p")).agg(F.min(value).alias("_v"))
    rest = known.agg(F.min(F.when(F.col("_p") == "", F.col("_v"))).alias("_rest"))  # one row
    known = known.filter("_p <> ''")
    lengths = [r[0] for r in known.select(F.length("_p")).distinct().collect()]  # as many as the longest prefix has characters
    codes = df.select(F.col(code).alias("_code")).filter(F.col("_code").isNotNull()).distinct()
    heads = F.filter(F.array(*[F.when(F.length("_code") >= n, F.left("_code", F.lit(n))) for n in sorted(lengths)]).cast("array<string>"), lambda h: h.isNotNull())
    found = codes.withColumn("_p", F.explode(heads)).join(known, "_p").groupBy("_code").agg(F.max_by("_v", F.length("_p")).alias("_found"))
    both = df.join(found, F.col(code) == F.col("_code"), "left").join(F.broadcast(rest), F.lit(True))
    return both.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_found", F.when(F.col(code).isNotNull(), F.col("_rest"))).alias(out or value))


def self_pairs(df: DataFrame, on: list[str], member: str) -> DataFrame:
    """member_a < member_b for the members that share a key; for few members a key. Keys are
    dealt to as many tasks as hold _TASK_ROWS rows each, so a task's memory does not grow
    with the table; df is read twice."""
    rows = df.select(*on, member)
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // _TASK_ROWS))
    rows = rows.repartition(tasks, *on)
    a = rows.withColumnRenamed(member, f"{member}_a").distinct()
    b = rows.withColumnRenamed(member, f"{member}_b").distinct()
    return a.join(b, on).filter(F.col(f"{member}_a") < F.col(f"{member}_b"))


def bridge(matches: DataFrame, edges: DataFrame, fact: str, direct: dict[str, float], ends: str, shared: float, mixed: float) -> DataFrame:
    """fact, node, confidence, method: matches (fact, node, confidence) carried one hop.

    An edge (src, dst, relation) says what src does to dst. A match goes from dst to every
    src of a ``direct`` relation, at that cost; where both nodes have an ``ends`` edge to a
    third one, at the cost ``shared``; where one has an ``ends`` and the other a direct
    edge to it, at the cost ``mixed``. Confidence is never below 0; of several ways to a
    node the best counts, then the first rule, so a match may come several times. Before nodes meet at a third one, matches
    are summed up by it; a node left and entered again can't beat its own match.
    """
    e = edges.distinct()
    cost = F.create_map(*[F.lit(x) for kv in direct.items() for x in kv])
    ended, going = e.filter(F.col("relation") == ends), e.filter(F.col("relation").isin(*direct))

    def hop(into: DataFrame, rest: DataFrame, penalty: Column | float, rule: int, method: Column) -> DataFrame:
        """From a match along ``into`` to the nodes of ``rest`` that meet it there."""
        at = matches.join(into.select(F.col("src").alias("node"), F.col("dst").alias("_third")), "node").groupBy(fact, "_third").agg(F.max("confidence").alias("confidence"))
        return step(at.withColumnRenamed("_third", "dst").join(rest, "dst"), penalty, rule, method)

    def step(found: DataFrame, penalty: Column | float, rule: int, method: Column) -> DataFrame:
        return found.select(fact, F.col("src").alias("node"), F.greatest(F.col("confidence") - penalty, F.lit(0.0)).alias("confidence"), F.lit(rule).alias("_rule"), method.alias("method")).repartition(fact, "node")

    # each way is dealt by itself, so that no task holds the joins of several
    ways = matches.select(fact, "node", "confidence", F.lit(0).alias("_rule"), F.lit("direct").alias("method")).repartition(fact, "node")
    ways = ways.unionByName(step(matches.withColumnRenamed("node", "dst").join(going, "dst").filter("src <> dst"), cost[F.col("relation")], 1, F.concat(F.lit("via_"), F.col("relation"))))
    ways = ways.unionByName(hop(ended, ended, shared, 2, F.lit("via_shared")))
    ways = ways.unionByName(hop(ended, going, mixed, 3, F.lit("via_mixed"))).unionByName(hop(going, ended, mixed, 3, F.lit("via_mixed")))
    return best_row(ways, [fact, "node"], [F.col("confidence").desc(), F.col("_rule"), F.col("method")]).drop("_rule")
