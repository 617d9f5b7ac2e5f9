"""Windows over ordered rows, sorted tops and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins as J
from ..operators import windows as W
from .registry import Tables, plan


@plan("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1")
def best_row(t: Tables) -> DataFrame:
    """The best row of each key with a total order."""
    return J.best_row(t.events, ["user_id"], [F.desc("value"), F.asc("event_id")]).select("user_id", "event_id", "value")


@plan("""
SELECT event_type, user_id, n, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS place FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL) QUALIFY place <= 3
""")
def window_over_agg(t: Tables) -> DataFrame:
    """A rank by the size of groups."""
    c = t.events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return J.best_row(c, ["event_type"], [F.desc("n"), F.asc("user_id")], k=3, rank="place").withColumn("place", F.col("place").cast("long"))


@plan("SELECT place, c_custkey, c_acctbal, place <= 10 AS is_top FROM (SELECT *, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) WHERE place <= 25")
def global_rank(t: Tables) -> DataFrame:
    """A global rank: the top is limited first, so only its rows meet in one task."""
    top = t.customer.orderBy(F.desc("c_acctbal"), "c_custkey").limit(25)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("c_acctbal"), "c_custkey")).cast("long")).select("place", "c_custkey", "c_acctbal", (F.col("place") <= 10).alias("is_top"))


_MONTHS = "m AS (SELECT o_orderpriority AS p, strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS v FROM orders GROUP BY ALL)"


def _months(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("p"), F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.sum(F.col("o_totalprice").cast("decimal(15,2)")).cast("double").alias("v"))


@plan(f"""
WITH {_MONTHS}, l AS (SELECT *, lag(v) OVER (PARTITION BY p ORDER BY month) AS previous FROM m)
SELECT p, month, v, previous, coalesce(v - previous, 0.0) AS change, (v - previous) * 100.0 / nullif(previous, 0) AS change_pct FROM l
""")
def lag_delta(t: Tables) -> DataFrame:
    """Change against the previous period, absolute and relative."""
    return W.delta(_months(t), ["p"], [F.asc("month")], "v")


@plan("""
SELECT event_id, last_value(CASE WHEN value > 40 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_known FROM events
""")
def prev_non_null(t: Tables) -> DataFrame:
    """The last known value before each row."""
    e = t.events.withColumn("v", F.when(F.col("value") > 40, F.col("value")))
    return W.previous_known(e, ["user_id"], [F.asc("ts"), F.asc("event_id")], "v").select("event_id", "previous_known")


@plan("SELECT user_id, event_id, age FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS age FROM events) WHERE age <= 4")
def tail_n(t: Tables) -> DataFrame:
    """The newest rows of each key."""
    return W.tail(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 4).select("user_id", "event_id", F.col("age").cast("long").alias("age"))


@plan("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS age FROM events QUALIFY age <= 20)
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 20) / count(*) AS big_rate, min(event_id) AS first_id, max(event_id) AS last_id,
  CASE WHEN count(*) FILTER (WHERE value > 20) / count(*) > 0.5 THEN 'failed' WHEN count(*) FILTER (WHERE value > 20) / count(*) > 0.3 THEN 'degraded' ELSE 'ok' END AS status FROM l GROUP BY event_type
""")
def last_n_window(t: Tables) -> DataFrame:
    """Rates over the last rows against service levels."""
    last = W.tail(t.events, ["event_type"], [F.desc("ts"), F.desc("event_id")], 20)
    g = last.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), S.ratio(F.count_if(F.col("value") > 20), F.count(F.lit(1))).alias("big_rate"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
    return g.withColumn("status", F.when(F.col("big_rate") > 0.5, "failed").when(F.col("big_rate") > 0.3, "degraded").otherwise("ok"))


@plan("""
WITH b AS (SELECT user_id, sum(CASE WHEN event_type <> 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS broken FROM events)
SELECT user_id, count(*) FILTER (WHERE broken = 0) AS streak FROM b GROUP BY user_id
""")
def trailing_streak(t: Tables) -> DataFrame:
    """How many of the newest rows are good."""
    return W.trailing_streak(t.events, ["user_id"], ["ts", "event_id"], F.col("event_type") != "error")


@plan("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1 AS age, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, event_id, age FROM r WHERE age < 20 OR (age < 120 AND age % 5 = 0) OR (age >= 120 AND age % 20 = 0) OR age = n - 1 OR value > 60
""")
def cadence_compact(t: Tables) -> DataFrame:
    """A log thinned by age, incidents and both ends kept."""
    out = W.cadence(t.events, ["event_type"], ["ts", "event_id"], F.col("value") > 60)
    return out.select("event_type", "event_id", "age")


@plan("""
WITH k AS (SELECT event_id, value > 60 AS bad FROM events),
c AS (SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1 AS age, count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE age % 20 = 0 OR age = n - 1 OR value > 60)
SELECT count(*) FILTER (WHERE bad) AS n_incidents, count(*) FILTER (WHERE bad AND c.event_id IS NULL) AS n_lost, count(c.event_id) AS n_kept FROM k LEFT JOIN c USING (event_id)
""")
def compaction_parity(t: Tables) -> DataFrame:
    """Incidents of the whole log that the thinned log lacks, and the rows it has."""
    thin = W.cadence(t.events, ["event_type"], ["ts", "event_id"], F.col("value") > 60, 0, 0).select(F.col("event_id").alias("_e"))
    both = t.events.join(thin, F.col("event_id") == F.col("_e"), "left")
    bad = F.col("value") > 60
    return both.agg(F.count_if(bad).alias("n_incidents"), F.count_if(bad & F.col("_e").isNull()).alias("n_lost"), F.count("_e").alias("n_kept"))


@plan("""
WITH y AS (SELECT c_mktsegment AS party, year(o_orderdate) AS y, count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) AS cohesion FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT party, CAST(y AS INTEGER) AS y, cohesion, CAST(lag(y) OVER (PARTITION BY party ORDER BY y) AS INTEGER) AS previous_y, cohesion - lag(cohesion) OVER (PARTITION BY party ORDER BY y) AS shift FROM y
""")
def pre_post_shift(t: Tables) -> DataFrame:
    """Cohesion at each anchor against the anchor before."""
    y = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("party"), F.year("o_orderdate").alias("y")).agg(S.ratio(F.count_if(F.col("o_orderstatus") == "F"), F.count(F.lit(1))).alias("cohesion"))
    before = F.lag(F.struct("y", "cohesion")).over(Window.partitionBy("party").orderBy("y"))
    return y.withColumn("b", before).select("party", "y", "cohesion", F.col("b.y").alias("previous_y"), (F.col("cohesion") - F.col("b.cohesion")).alias("shift"))


@plan("""
WITH f AS (SELECT l_suppkey AS person, s_nationkey AS party, l_partkey % 20 AS topic, row_number() OVER (PARTITION BY l_suppkey, l_partkey % 20 ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS r, CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'R' THEN -1.0 ELSE 0.0 END AS score FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT party, topic, count(*) AS n_people, CAST(sum(greatest(score, 0.0)) AS DOUBLE) / count(*) AS score FROM f WHERE r = 1 GROUP BY ALL
""")
def series_first_point_rollup(t: Tables) -> DataFrame:
    """Each person counts once, at the first point; negative scores count as none."""
    score = F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "R", -1.0).otherwise(0.0)
    f = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).withColumns({"topic": F.col("l_partkey") % 20, "score": score})
    one = J.best_row(f, ["l_suppkey", "topic"], [F.asc("l_shipdate"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_extendedprice")])
    return one.groupBy(F.col("s_nationkey").alias("party"), "topic").agg(F.count(F.lit(1)).alias("n_people"), (F.sum(F.greatest("score", F.lit(0.0))) / F.count(F.lit(1))).alias("score"))


@plan("""
SELECT o_orderkey, o_orderpriority FROM orders ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey LIMIT 40
""")
def priority_topk(t: Tables) -> DataFrame:
    """A top by a priority of cases, with a total order."""
    case = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return t.orders.orderBy(case, F.desc("o_totalprice"), "o_orderkey").limit(40).select("o_orderkey", "o_orderpriority")


@plan("""
SELECT c_custkey AS who, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, 'order' AS kind, o_totalprice AS amount FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR), event_type, value FROM events
""")
def union_timeline(t: Tables) -> DataFrame:
    """Facts of several kinds in one timeline."""
    a = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_custkey").alias("who"), F.to_date("o_orderdate").cast("string").alias("day"), F.lit("order").alias("kind"), F.col("o_totalprice").alias("amount"))
    b = t.events.select(F.col("user_id").alias("who"), F.to_date("ts").cast("string").alias("day"), F.col("event_type").alias("kind"), F.col("value").alias("amount"))
    return a.unionByName(b)


@plan("SELECT c_nationkey AS code FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT 99")
def union_distinct_codes(t: Tables) -> DataFrame:
    """All codes in use, and one that is pinned."""
    pinned = t.spark.createDataFrame([(99,)], "code int")
    return t.customer.select(F.col("c_nationkey").alias("code")).union(t.supplier.select("s_nationkey")).union(pinned).distinct()


@plan("""
WITH s AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1), top AS (SELECT * FROM s WHERE k NOT IN (3, 5, 8) ORDER BY n DESC, k LIMIT 10)
SELECT * FROM top UNION SELECT * FROM s WHERE k IN (5, 77)
""")
def exclude_pin(t: Tables) -> DataFrame:
    """A top without excluded keys, with pinned ones whatever their score."""
    s = t.lineitem.groupBy(F.col("l_partkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return s.filter(~F.col("k").isin(3, 5, 8)).orderBy(F.desc("n"), "k").limit(10).union(s.filter(F.col("k").isin(5, 77))).distinct()


@plan("""
SELECT doc_id, kept FROM (SELECT doc_id, md5(text) AS h, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1 AS kept FROM documents)
""")
def ordered_dedupe(t: Tables) -> DataFrame:
    """The first of equal rows in order."""
    w = Window.partitionBy(F.md5(F.col("text").cast("binary"))).orderBy("doc_id")
    return t.documents.select("doc_id", (F.row_number().over(w) == 1).alias("kept"))
