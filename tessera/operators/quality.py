"""Checks of data: orphans, rules, thresholds, gaps and leaks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, edge: str) -> DataFrame:
    """edge, n_rows, n_orphans of one foreign key; null keys are no orphans."""
    known = parent.select(F.col(parent_key).alias("_p")).distinct()
    lost = child.select(F.col(child_key).alias("_c")).join(known, F.col("_c") == F.col("_p"), "left")
    return lost.agg(F.lit(edge).alias("edge"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_c").isNotNull() & F.col("_p").isNull()).alias("n_orphans"))


def orphan_report(edges: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [orphans(c, p, ck, pk, name) for name, c, ck, p, pk in edges])


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, n_rows, n_failed: one pass for all rules; null counts as failed."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(~F.coalesce(r, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col("n").alias("n_rows"), F.col(f"r{i}").alias("n_failed")) for i, name in enumerate(rules)])
    return counts.select(F.explode(rows).alias("x")).select("x.*")


def reasons(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks, in order."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(name)) for name, r in rules.items()]))


def threshold_gate(kpis: DataFrame, floors: dict[str, float]) -> DataFrame:
    """metric, value, floor, passed of a one-row frame of KPIs."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(float(f)).alias("floor")) for m, f in sorted(floors.items())])
    return kpis.select(F.explode(rows).alias("x")).select("x.*").withColumn("passed", F.coalesce(F.col("value") >= F.col("floor"), F.lit(False)))


def require_rows(df: DataFrame, least: int) -> DataFrame:
    """df, or a failing job if it has fewer rows; the count is a part of the same job."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    checked = n.select(F.assert_true(F.col("_n") >= least, F.format_string(f"%d rows, {least} required", "_n")).alias("_ok"))
    # the filter keeps the assertion from being pruned with its column
    return df.join(F.broadcast(checked), F.lit(True)).filter(F.col("_ok").isNull()).drop("_ok")


def worst_status(*statuses: Column) -> Column:
    """failed before degraded before ok."""
    any_is = lambda s: reduce(lambda a, b: a | b, [c == s for c in statuses])
    return F.when(any_is("failed"), "failed").when(any_is("degraded"), "degraded").otherwise("ok")


#: Patterns of things that an export must not hold.
LEAKS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "secret": r"(?i)(?:password|token|secret|api[_-]?key)\s*[=:]\s*\S+",
    "local_path": r"/(?:home|Users)/[A-Za-z0-9._-]+",
}


def leak_scan(df: DataFrame, id_col: str, text_col: str, patterns: dict[str, str] = LEAKS) -> DataFrame:
    """id, kind, n_hits of the rows that a pattern is found in."""
    hits = F.array(*[F.struct(F.lit(k).alias("kind"), F.regexp_count(F.col(text_col), F.lit(p)).cast("long").alias("n_hits")) for k, p in patterns.items()])
    return df.select(id_col, F.explode(hits).alias("x")).select(id_col, "x.*").filter("n_hits > 0")


def manifest_problems(df: DataFrame, key: str, required: list[str], enums: dict[str, tuple[str, ...]], refs: dict[str, DataFrame]) -> DataFrame:
    """key and problem of a seed table: missing values, values outside an enumeration,
    references without a target (frames of one column), repeated keys."""
    checks = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(f"missing:{c}")) for c in required]
    checks += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*allowed), F.lit(f"enum:{c}")) for c, allowed in enums.items()]
    found = df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*checks))).alias("problem"))
    again = df.groupBy(F.col(key).cast("string").alias("key")).count().filter("count > 1").select("key", F.lit("duplicate").alias("problem"))
    out = found.unionByName(again)
    for c, target in refs.items():
        lost = df.filter(F.col(c).isNotNull()).join(target.toDF("_t"), F.col(c) == F.col("_t"), "left_anti")
        out = out.unionByName(lost.select(F.col(key).cast("string").alias("key"), F.lit(f"reference:{c}").alias("problem")))
    return out


def schema_problems(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Fields that a snapshot lacks, has with another type, or has too many."""
    have = dict(df.dtypes)
    out = [f"missing:{c}" for c in expected if c not in have]
    out += [f"type:{c}" for c, kind in expected.items() if c in have and have[c] != kind]
    return out + [f"extra:{c}" for c in have if c not in expected]
