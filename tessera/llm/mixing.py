"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern: the set of sources that they count
for. Tokens flow from patterns to the quotas of their sources; a pattern's first pass
is free, every further pass costs more than the one before, so repetition is spread where
it is cheapest; the flow is the same for all costs that grow. The network has one node for each pattern and source, whatever the number
of documents. A path of least cost never comes back to the start, so its cost is that
of the pass it opens: passes are opened one after the other, and all paths of a cost
are filled at once by blocking flows.

A pattern's flow is then laid out along its documents in seeded order, pass after
pass: every source has one stretch of that line, and a pass of a document goes to the
source whose stretch holds its middle. The last pass, where it is a part only, takes the
documents that end within it and then the one whose size is nearest to what is left. So
whole documents are taken, no one more than ``passes`` times, and sources come near their
flow even where they have few documents. Places on the line are prefix sums: over hash bins first, then inside a bin, so a
pattern of a third of all rows is not ordered in one task.

Defined cases: a null source is one of its own, last; null and empty texts have size
0 and are taken 0 words; rows of one id (or of none) are told apart by size, then by a hash
of their columns, and where all are equal each has its own place on the line; an empty table gives an empty result; other columns pass through,
and where one has the name of an added column, that one gets an underscore more.
"""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

BINS = 4096
PASSES = 3
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], most: int = PASSES, total: float | None = None) -> dict[str | None, float]:
    """Shares of the total (else of all sizes) by weight, none above ``most`` times its
    source's size; what is above is shared again by weight among the others."""
    total, out, free = float(sum(sizes.values()) if total is None else total), {}, set(sizes)
    while free:
        rest = total - sum(out.values())
        weight = sum(weights[s] for s in free)
        full = {s for s in free if rest * weights[s] / weight > most * sizes[s]}
        if not full:
            return out | {s: rest * weights[s] / weight for s in free}
        out |= {s: float(most * sizes[s]) for s in full}
        free -= full
    return out


def min_cost_flow(patterns: list[tuple[tuple[str | None, ...], int]], quotas: dict[str | None, float], passes: int = PASSES) -> list[dict[str | None, float]]:
    """Tokens that each pattern gives to each of its sources: as much of the quotas as
    can be met, at least cost."""
    names = list(quotas)
    index = {s: i for i, s in enumerate(names)}
    members = [[index[s] for s in p] for p, _ in patterns]
    givers: list[list[int]] = [[] for _ in names]
    for i, own in enumerate(members):
        for s in own:
            givers[s].append(i)
    need = [float(quotas[s]) for s in names]
    supply = [0.0] * len(patterns)
    give = [dict.fromkeys(own, 0.0) for own in members]
    least = max(1e-6, 1e-12 * sum(need))
    for _ in range(passes):
        supply = [x + size for x, (_, size) in zip(supply, patterns, strict=True)]
        while (levels := _levels(members, givers, give, supply, need, least)) is not None:
            _blocking_flow(members, givers, give, supply, need, least, *levels)
    return [{names[s]: x for s, x in g.items()} for g in give]


def _levels(members: list, givers: list, give: list, supply: list, need: list, least: float) -> tuple[list[int], list[int]] | None:
    """The fewest steps from a pattern with supply to each pattern and source; None if no
    source that needs more can be reached."""
    of_pattern, of_source = [-1] * len(members), [-1] * len(givers)
    queue = deque(i for i, x in enumerate(supply) if x > least)
    for i in queue:
        of_pattern[i] = 0
    found = False
    while queue:
        i = queue.popleft()
        for s in members[i]:
            if of_source[s] < 0:
                of_source[s] = of_pattern[i] + 1
                if need[s] > least:
                    found = True
                elif not found:
                    for j in givers[s]:
                        if of_pattern[j] < 0 and give[j][s] > least:
                            of_pattern[j] = of_source[s] + 1
                            queue.append(j)
    return (of_pattern, of_source) if found else None


def _blocking_flow(members: list, givers: list, give: list, supply: list, need: list, least: float, of_pattern: list[int], of_source: list[int]) -> None:
    """Fills paths of the levels until none is left."""
    tried_p, tried_s = [0] * len(members), [0] * len(givers)
    for root in range(len(members)):
        path = [root]  # pattern, source, pattern, ...
        while path and supply[root] > least:
            if len(path) % 2 == 0 and need[path[-1]] > least:
                push = min(supply[root], need[path[-1]])
                for k in range(2, len(path), 2):
                    push = min(push, give[path[k]][path[k - 1]])
                for k in range(0, len(path), 2):
                    if k:
                        give[path[k]][path[k - 1]] -= push
                    give[path[k]][path[k + 1]] += push
                supply[root] -= push
                need[path[-1]] -= push
                path = [root]
                continue
            here, nxt = path[-1], None
            if len(path) % 2:
                level, ways = of_pattern[here], members[here]
                while tried_p[here] < len(ways) and of_source[ways[tried_p[here]]] != level + 1:
                    tried_p[here] += 1
                if tried_p[here] < len(ways):
                    nxt = ways[tried_p[here]]
            else:
                level, ways = of_source[here], givers[here]
                while tried_s[here] < len(ways) and (of_pattern[ways[tried_s[here]]] != level + 1 or give[ways[tried_s[here]]][here] <= least):
                    tried_s[here] += 1
                if tried_s[here] < len(ways):
                    nxt = ways[tried_s[here]]
            if nxt is not None:
                path.append(nxt)
                continue
            path.pop()
            if path:
                (tried_p if len(path) % 2 else tried_s)[path[-1]] += 1


def fresh(columns: list[str], name: str) -> str:
    """The name, with underscores before it until no column has it."""
    return fresh(columns, "_" + name) if name in columns else name


def mix(docs: DataFrame, members: Column, size: Column, weight_of, id_col: str = "doc_id", passes: int = PASSES, seed: int = 17) -> DataFrame:
    """docs with _size, _given (the source of each pass that is taken), and the sizes
    and targets of their sources as maps, ``_sizes`` and ``_targets``.

    members: array of the sources a row counts for. weight_of: a function from the
    sources in code point order, null last, to their weights.
    """
    spark = docs.sparkSession
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        size.alias("_size"),
        F.to_json(F.struct(F.array_distinct(members).alias("s")), {"ignoreNullFields": "false"}).alias("_pattern"),
        F.xxhash64(F.col(id_col), F.lit(seed)).alias("_h"),
        F.xxhash64(*hashed).alias("_t"),
    ).withColumn("_bin", F.pmod(F.xxhash64("_h", "_t"), F.lit(BINS)))
    # sizes are counted once for all that is decided, and once more as the rows go by
    light = cut(rows.drop("_row"))
    sizes = light.groupBy("_pattern", "_bin").agg(F.sum("_size").alias("_n"))
    found = sizes.groupBy("_pattern").agg(F.sum("_n").alias("n"), F.first("_pattern").alias("p")).collect()
    patterns = sorted(((tuple(json.loads(r.p)["s"]), int(r.n)) for r in found), key=lambda x: [(s is None, s or "") for s in x[0]])
    key_of = {tuple(json.loads(r.p)["s"]): r.p for r in found}
    names = sorted({s for p, _ in patterns for s in p}, key=lambda s: (s is None, s or ""))
    own = {s: sum(n for p, n in patterns if s in p) for s in names}
    total = sum(n for _, n in patterns)
    weights = dict(zip(names, weight_of(names), strict=True))
    goal = targets(own, weights, passes, total) if total else {s: 0.0 for s in names}
    flow = min_cost_flow(patterns, goal, passes)

    plan = []
    for (p, n), give in zip(patterns, flow, strict=True):
        at, stretches = 0.0, []
        for s in p:
            stretches.append((s, at, at + give[s]))
            at += give[s]
        plan.append((key_of[p], n, at, stretches, [own[s] for s in p], [float(goal[s]) for s in p]))
    schema = "_p string, _cap long, _flow double, _stretches array<struct<source: string, lo: double, hi: double>>, _sizes array<long>, _targets array<double>"
    planned = spark.createDataFrame(plan, schema)

    # one row a pattern and bin: all that rows are joined with is joined here first, so that
    # a pattern of most rows meets it bin by bin
    before = Window.partitionBy("_pattern").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(planned, F.col("_pattern") == F.col("_p"))
    last = F.floor(F.try_divide("_flow", "_cap"))
    bins = bins.select(F.col("_pattern").alias("_bp"), F.col("_bin").alias("_bb"), "_before", "_cap", "_flow", "_stretches", "_sizes", "_targets", last.alias("_last"), (F.col("_flow") - last * F.col("_cap")).alias("_rest"))
    inside = Window.partitionBy("_pattern", "_bin").orderBy("_h", "_size", "_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = (F.col("_pattern") == F.col("_bp")) & (F.col("_bin") == F.col("_bb"))

    def place(df: DataFrame, known: DataFrame) -> DataFrame:
        out = df.join(known, here)
        return out.withColumn("_stop", F.col("_before") + F.sum("_size").over(inside)).withColumn("_middle", F.col("_stop") - F.col("_size") / 2)

    # what the last pass leaves open, and the one row that fits it best: rows of some size
    # end at places of their own
    whole = F.col("_stop") <= F.col("_rest")
    thin = place(light, bins.select("_bp", "_bb", "_before", "_rest"))
    left = thin.groupBy("_pattern").agg((F.max("_rest") - F.coalesce(F.max(F.when(whole, F.col("_stop"))), F.lit(0))).alias("_open")).withColumnRenamed("_pattern", "_lp")
    opened = bins.join(left, F.col("_bp") == F.col("_lp")).select("_bp", "_bb", "_before", "_rest", "_open")
    miss = F.abs(F.col("_open") - F.col("_size"))
    fits = place(light, opened).filter(~whole & (F.col("_size") > 0)).filter(miss < F.col("_open"))
    best = fits.groupBy("_pattern").agg(F.min(F.struct(miss.alias("m"), F.col("_h").alias("h"), F.col("_bin").alias("b"), F.col("_stop").alias("s"))).alias("_best")).withColumnRenamed("_pattern", "_xp")
    placed = place(rows, bins.join(best, F.col("_bp") == F.col("_xp"), "left"))
    extra = F.col("_best").isNotNull() & (F.col("_bin") == F.col("_best.b")) & (F.col("_stop") == F.col("_best.s")) & (F.col("_size") > 0)

    def taker(k: int) -> Column:
        at = F.when(F.col("_last") == k, F.least(F.col("_middle") + k * F.col("_cap"), F.col("_flow") - 1e-6)).otherwise(F.col("_middle") + k * F.col("_cap"))
        goes = (F.col("_last") > k) | ((F.col("_last") == k) & (whole | extra))
        return F.filter("_stretches", lambda s: goes & (at >= s["lo"]) & (at < s["hi"]))

    given = F.flatten(F.array(*[taker(k) for k in range(passes)]))
    given = F.transform(given, lambda s: s["source"])
    return placed.withColumn("_given", F.when(F.col("_size") > 0, given).otherwise(F.array().cast("array<string>"))).select("_row.*", *[F.col(c).alias(fresh(docs.columns, c)) for c in ("_size", "_given", "_sizes", "_targets")])


def cycle(weights: tuple[float, ...] = (1, 2, 3)):
    """Weights that repeat along the sources."""
    return lambda names: [weights[i % len(weights)] for i in range(len(names))]
