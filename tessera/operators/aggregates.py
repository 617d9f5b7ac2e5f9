"""Aggregations of signed, weighted evidence and of votes.

Each is one or two grouped aggregations with map-side combine; decisions are
expressions over their results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clamp01, ratio
from .ranges import bucket_of, cut_points, null_safe

STANCE_EDGE = 0.2


def stance(score: Column, edge: float = STANCE_EDGE) -> Column:
    """support above the edge, oppose below its negative, else unclear; both strict."""
    return F.when(score > edge, "support").when(score < -edge, "oppose").otherwise("unclear")


#: The stances of declared evidence that are a signal.
SIGNALS = ("support", "oppose", "mixed")


def weighted_stance(evidence: DataFrame, keys: list[str], polarity: str, weight: str, confidence: str, variant: str = "votes", stance_col: str = "stance") -> DataFrame:
    """keys, n_evidence, score, stance, confidence of signed, weighted evidence.

    score is the weighted mean of the polarity over the evidence that has one; 0 if none
    has. ``votes``: every row is evidence, full confidence at 5. ``declared``: rows whose
    ``stance_col`` is support, oppose or mixed are, full confidence at 3; without any
    polarity a mixed row makes the stance mixed, as do both signs without a clear mean.
    A key without evidence has no row.
    """
    return stances(stance_sums(evidence, keys, polarity, weight, confidence, variant, stance_col), variant)


def stance_sums(evidence: DataFrame, keys: list[str], polarity: str, weight: str, confidence: str, variant: str = "votes", stance_col: str = "stance", sign: Column | None = None) -> DataFrame:
    """keys and what weighted_stance needs of their evidence: counts, and sums of decimals
    where weights are. Sums of two sets of evidence add up to those of both; with a ``sign``
    of 1 or -1 rows are added or taken back."""
    one = F.lit(1) if sign is None else sign
    w = F.coalesce(F.col(weight), F.lit(1)) * F.coalesce(F.col(confidence), F.lit(1))
    declared = variant == "declared"
    rows = evidence.filter(F.col(stance_col).isin(*SIGNALS)) if declared else evidence
    p = F.col(polarity)
    counted = lambda test: F.sum(F.when(test, one).otherwise(0)).cast("long")
    return rows.groupBy(*keys).agg(
        F.sum(one).cast("long").alias("n_evidence"),
        counted(p > 0).alias("n_for"),
        counted(p < 0).alias("n_against"),
        (counted(F.col(stance_col) == "mixed") if declared else F.lit(0).cast("long")).alias("n_mixed"),
        F.coalesce(F.sum(F.when(p != 0, p * w * one)), F.lit(0)).alias("numer"),
        F.coalesce(F.sum(F.when(p != 0, w * one)), F.lit(0)).alias("denom"),
    )


def stances(sums: DataFrame, variant: str = "votes") -> DataFrame:
    """The positions of stance_sums."""
    numer, denom = F.col("numer").cast("double"), F.col("denom").cast("double")
    out = sums.withColumn("score", ratio(numer, denom))
    plain = stance(F.col("score"))
    if variant == "declared":
        both = (F.col("n_for") > 0) & (F.col("n_against") > 0)
        plain = F.when(denom <= 0, F.when(F.col("n_mixed") > 0, "mixed").otherwise("unclear")).when(both & (plain == "unclear"), "mixed").otherwise(plain)
    full = 3.0 if variant == "declared" else 5.0
    return out.withColumns({"stance": plain, "confidence": F.least(F.lit(1.0), F.col("n_evidence") / full)}).drop("numer", "denom", "n_mixed")


def rollup_stance(positions: DataFrame, keys: list[str], members: Column, majority: float = 0.75, series: bool = False) -> DataFrame:
    """Positions of members as one position of their group, weighted by evidence.

    members: size of the group. Members with any other stance than no_signal are a signal:
    none is no_signal, fewer than a fifth of the members (and than 3) is unclear. Without
    a clear member the group is mixed if one is, else unclear; both clear stances without a
    clear majority are mixed; support wins ties. The score of unclear groups is 0. In the
    form for ``series`` mixed members count among the clear ones, and a group without
    members is no_signal.
    """
    sums = positions.groupBy(*keys).agg(
        F.sum(F.col("score") * F.col("n_evidence")).alias("_numer"),
        F.sum("n_evidence").alias("n_evidence"),
        *[F.count_if(F.col("stance") == s).alias(f"n_{s}") for s in ("support", "oppose", "mixed", "unclear")],
        F.count_if(F.col("stance") != "no_signal").alias("n_signal"),
        F.sum(F.col("confidence") * F.col("n_evidence")).alias("_conf"),
        F.max(members).alias("n_members"),
    )
    support, oppose, mixed, signal, size = (F.col(f"n_{s}") for s in ("support", "oppose", "mixed", "signal", "members"))
    clear = support + oppose + mixed if series else support + oppose
    need = F.greatest(F.lit(1), F.least(F.lit(3), size), F.ceil(0.2 * size))
    least = F.when(F.col("n_unclear") > 0, "unclear").otherwise("no_signal") if series else F.when(mixed > 0, "mixed").otherwise("unclear")
    decided = (
        F.when((signal <= 0) | ((size <= 0) if series else F.lit(False)), "no_signal")
        .when((size > 0) & (signal < need), "unclear")
        .when(clear == 0, least)
        .when((support > 0) & (oppose > 0) & (F.greatest(support, oppose) / clear < majority), "mixed")
        .when(support >= oppose, "support")
        .otherwise("oppose")
    )
    return sums.withColumns({
        "stance": decided,
        "score": F.when(decided.isin("no_signal", "unclear"), 0.0).otherwise(ratio("_numer", "n_evidence")),
        "confidence": clamp01(ratio("_conf", "n_evidence") * ratio(signal, size)),
    }).drop("_numer", "_conf")


def vote_counts(votes: DataFrame, keys: list[str], choice: str) -> DataFrame:
    """keys, yes, no, abstain, absent: counts by normalised choice."""
    return votes.groupBy(*keys).agg(*[F.count_if(F.col(choice) == c).alias(c) for c in ("yes", "no", "abstain", "absent")])


def outcome(yes: Column, no: Column) -> Column:
    return F.when(yes + no == 0, "no_signal").when(yes > no, "passed").when(no > yes, "failed").otherwise("tied")


def majority(yes: Column, no: Column) -> Column:
    """yes, no or tie; null if nobody voted either way."""
    return F.when(yes + no == 0, None).when(yes > no, "yes").when(no > yes, "no").otherwise("tie")


def enriched_votes(votes: DataFrame, event: str, group: str, choice: str) -> DataFrame:
    """Votes with the majority of their group at their event."""
    sides = vote_counts(votes, [event, group], choice)
    sides = sides.select(F.col(event).alias("_e"), F.col(group).alias("_g"), majority(F.col("yes"), F.col("no")).alias("group_majority"))
    return votes.join(sides, (F.col(event) == F.col("_e")) & (F.col(group) == F.col("_g"))).drop("_e", "_g")


def discipline(enriched: DataFrame, keys: list[str], choice: str) -> DataFrame:
    """Aligned, rebel and absence rates. Yes and no votes are the denominator, also those
    at which the group was tied, so both rates may fall short of 1 together."""
    c, m = F.col(choice), F.col("group_majority")
    directional = c.isin("yes", "no")
    out = enriched.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_votes"),
        F.count_if(directional).alias("n_directional"),
        F.count_if(directional & (c == m)).alias("n_aligned"),
        F.count_if(directional & m.isin("yes", "no") & (c != m)).alias("n_rebel"),
        F.count_if(c == "absent").alias("n_absent"),
    )
    return out.withColumns({"aligned_rate": ratio("n_aligned", "n_directional"), "rebel_rate": ratio("n_rebel", "n_directional"), "absence_rate": ratio("n_absent", "n_votes")})


def pivotal(counts: DataFrame, event: str, group: str, keep: int = 6) -> DataFrame:
    """Groups without whose votes an event would have gone the other way or been tied;
    the ``keep`` with the least margin of their own."""
    total = Window.partitionBy(event)
    diff = F.col("yes") - F.col("no")
    out = counts.withColumns({"diff": diff, "margin": F.sum(diff).over(total)})
    flips = F.when(F.col("margin") > 0, (F.col("margin") - F.col("diff")) <= 0).when(F.col("margin") < 0, (F.col("margin") - F.col("diff")) >= 0).otherwise(False)
    order = Window.partitionBy(event).orderBy(F.abs("diff"), group)
    return out.filter(flips).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep).select(event, group, "diff", "margin", "place")


def stakes(events: DataFrame, keys: list[str], present: str, yes: str, no: str) -> DataFrame:
    """Sum of attendance times closeness over the events of a key."""
    y, n = F.col(yes).cast("double"), F.col(no).cast("double")
    close = F.when(y + n > 0, F.col(present) * (1 - F.abs(y - n) / (y + n))).otherwise(0.0)
    return events.groupBy(*keys).agg(F.sum(close).alias("stakes"), F.count(F.lit(1)).alias("n_events"))


def quantiles(df: DataFrame, keys: list[str], value: str, at: tuple[float, ...] = (0.5, 0.75, 0.9)) -> DataFrame:
    """keys, n, least, most, mean and exact percentiles with linear interpolation; null
    values drop out.

    For a few keys of many rows: values are counted, cut into buckets of values and the
    buckets counted; only the buckets that hold a wanted place are ordered. No task holds
    the values of a key.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(value).alias("_v"))
    known = rows.filter(F.col("_v").isNotNull())
    counts = known.groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_b", bucket_of(counts, ["_v"], cut_points(known.select("_v"))))

    # the buckets of the places that are wanted, and those places
    whole = Window.partitionBy(*names)
    sizes = counts.groupBy(*names, "_b").agg(F.sum("_c").alias("_n")).withColumns({"_stop": F.sum("_n").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)), "_all": F.sum("_n").over(whole)})
    place = lambda p: (F.col("_all") - 1) * F.lit(float(p))
    wanted = F.array_distinct(F.array(*[end(place(p)) for p in at for end in (F.floor, F.ceil)]))
    sizes = sizes.withColumn("_want", F.filter(wanted, lambda r: (r < F.col("_stop")) & (r >= F.col("_stop") - F.col("_n")))).filter(F.size("_want") > 0)
    sizes = sizes.select(*[F.col(n).alias(f"{n}_x") for n in names], F.col("_b").alias("_bx"), (F.col("_stop") - F.col("_n")).alias("_before"), "_want")
    there = counts.join(sizes, null_safe([*names, "_b"], [*(f"{n}_x" for n in names), "_bx"]))
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*names, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = there.withColumn("_upto", upto).select(*names, F.col("_v").cast("double").alias("_v"), F.explode(F.filter("_want", lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_c")))).alias("_r"))
    found = found.groupBy(*[F.col(n).alias(f"{n}_x") for n in names]).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at"))  # two places each

    plain = rows.groupBy(*names).agg(F.count("_v").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most"), F.avg("_v").alias("mean"))
    out = plain.join(found, null_safe(names, [f"{n}_x" for n in names]), "left") if names else plain.join(found, F.lit(True), "left")

    def percentile(p: float) -> Column:
        at = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.floor(at), F.ceil(at)
        low, high = F.try_element_at("_at", lo), F.try_element_at("_at", hi)
        return F.when(low == high, low).otherwise((hi - at) * low + (at - lo) * high)

    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "n", "least", "most", "mean", *[percentile(p).alias(f"p{int(p * 100)}") for p in at])


def mode_label(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The most frequent label of each key, ties to the least."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), label)
    return counts.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def facets(df: DataFrame, column: str, k: int = 8) -> DataFrame:
    """The k most frequent values of a column; none if there is nothing to choose."""
    counts = df.filter(F.col(column).isNotNull() & (F.trim(F.col(column).cast("string")) != "")).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    return counts.orderBy(F.desc("n"), "value").limit(k).withColumns({"_sum": F.sum("n").over(whole), "_top": F.max("n").over(whole)}).filter((F.col("_sum") >= max(8, k)) & (F.col("_top") > 1)).select("value", "n")


def percent_of_max(df: DataFrame, value: str, out: str) -> DataFrame:
    """value as a share of the greatest, times 100; the maximum is one small aggregate."""
    top = df.agg(F.max(value).alias("_top"))
    return df.join(F.broadcast(top), F.lit(True)).withColumn(out, ratio(F.col(value) * 100.0, "_top")).drop("_top")
