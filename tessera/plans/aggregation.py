"""Grouped counts, pivots, percentiles, scores and funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as W
from .registry import Tables, plan


@plan("""
SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (WHERE l_quantity > 25) AS n_big, count(*) FILTER (WHERE l_discount = 0) AS n_full, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS price,
  CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean_quantity, min(l_extendedprice) AS least, max(l_extendedprice) AS most
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def pricing_conditional_counts(t: Tables) -> DataFrame:
    """Counts, conditional counts and sums of one pass."""
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("l_quantity") > 25).alias("n_big"),
        F.count_if(F.col("l_discount") == 0).alias("n_full"),
        F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast("double").alias("price"),
        (F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double") / F.count(F.lit(1))).alias("mean_quantity"),
        F.min("l_extendedprice").alias("least"),
        F.max("l_extendedprice").alias("most"),
    )


@plan("SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS n_priorities FROM orders GROUP BY o_custkey HAVING count(*) >= 12 AND count(DISTINCT o_orderpriority) >= 4")
def having_groups(t: Tables) -> DataFrame:
    """Groups by conditions on their aggregates."""
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderpriority").alias("n_priorities")).filter("n >= 12 AND n_priorities >= 4")


@plan("""
SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN value > 20 THEN user_id END) AS big_users, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY event_type
""")
def distinct_counts(t: Tables) -> DataFrame:
    """Distinct counts, conditional ones too."""
    return t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct(F.when(F.col("value") > 20, F.col("user_id"))).alias("big_users"), F.countDistinct(F.to_date("ts")).alias("days"))


@plan("SELECT n_orders, count(*) AS n_customers FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) GROUP BY n_orders")
def group_of_groups(t: Tables) -> DataFrame:
    """How many groups have which size."""
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")).groupBy("n_orders").agg(F.count(F.lit(1)).alias("n_customers"))


@plan("""
SELECT (SELECT count(*) FROM customer) AS n_customers, (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS n_open,
  (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS n_suppliers, (SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders) AS last_day
""")
def totals_row(t: Tables) -> DataFrame:
    """Independent totals in one row: one aggregate for each table."""
    o = t.orders.agg(F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"), F.max(F.to_date("o_orderdate")).cast("string").alias("last_day"))
    c = t.customer.agg(F.count(F.lit(1)).alias("n_customers"))
    line = t.lineitem.agg(F.countDistinct("l_suppkey").alias("n_suppliers"))
    return c.join(o, F.lit(True)).join(line, F.lit(True)).select("n_customers", "n_orders", "n_open", "n_suppliers", "last_day")


@plan("""
SELECT coalesce(r_name, 'ALL') AS region, coalesce(n_name, 'ALL') AS nation, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)
""")
def geo_rollup(t: Tables) -> DataFrame:
    """A hierarchy of sums up to the whole: rolled up from one sum for each nation."""
    by_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(12,2)")).alias("b"))
    named = by_nation.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    out = named.rollup("r_name", "n_name").agg(F.sum("n").alias("n"), F.sum("b").cast("double").alias("balance"))
    return out.select(F.coalesce("r_name", F.lit("ALL")).alias("region"), F.coalesce("n_name", F.lit("ALL")).alias("nation"), "n", "balance")


@plan("""
WITH x AS (SELECT o_orderpriority AS p, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT p, count(d) AS n, min(d) AS least, max(d) AS most, CAST(sum(d) AS DOUBLE) / count(d) AS mean, quantile_cont(d, 0.5) AS p50, quantile_cont(d, 0.75) AS p75, quantile_cont(d, 0.9) AS p90
FROM (SELECT p, CAST(CASE WHEN d >= 0 THEN d END AS BIGINT) AS d FROM x) GROUP BY p
""")
def duration_percentiles(t: Tables) -> DataFrame:
    """Exact percentiles of durations; negative ones are unknown and drop out."""
    days = F.datediff("l_shipdate", "o_orderdate").cast("long")
    x = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderpriority").alias("p"), F.when(days >= 0, days).alias("d"))
    return A.quantiles(x, ["p"], "d")


@plan("""
WITH x AS (SELECT s_nationkey AS k, CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) >= 0 THEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) END AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT n_name, n, p50, row_number() OVER (ORDER BY p50 DESC, n_name) AS place FROM (SELECT k, count(d) AS n, quantile_cont(d, 0.5) AS p50 FROM x GROUP BY k HAVING count(d) >= 500) JOIN nation ON k = n_nationkey
""")
def stage_bottleneck(t: Tables) -> DataFrame:
    """The slowest owners by median duration, with a least sample."""
    days = F.datediff("l_shipdate", "o_orderdate").cast("long")
    x = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    q = A.quantiles(x.select(F.col("s_nationkey").alias("k"), F.when(days >= 0, days).alias("d")), ["k"], "d", (0.5,)).filter("n >= 500")
    out = q.join(t.nation, F.col("k") == F.col("n_nationkey"))
    return out.select("n_name", "n", "p50", F.row_number().over(Window.orderBy(F.desc("p50"), "n_name")).cast("long").alias("place"))


@plan("""
SELECT l_partkey, max(l_discount) - min(l_discount) AS spread, (max(l_discount) - min(l_discount)) > 0.08 AS is_wide, count(*) AS n FROM lineitem GROUP BY l_partkey HAVING count(*) >= 20
""")
def spread_flags(t: Tables) -> DataFrame:
    """Spread of a value per key and its threshold flag."""
    spread = F.max("l_discount") - F.min("l_discount")
    return t.lineitem.groupBy("l_partkey").agg(spread.alias("spread"), (spread > 0.08).alias("is_wide"), F.count(F.lit(1)).alias("n")).filter("n >= 20")


@plan("""
WITH s AS (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(12,2)) * CASE l_returnflag WHEN 'A' THEN 3 WHEN 'R' THEN 2 ELSE 1 END) AS DOUBLE) AS raw FROM lineitem GROUP BY 1)
SELECT l_suppkey, raw, raw * 100.0 / (SELECT max(raw) FROM s) AS score FROM s
""")
def pct_of_max_score(t: Tables) -> DataFrame:
    """Role-weighted sums as a percentage of the greatest."""
    role = F.when(F.col("l_returnflag") == "A", 3).when(F.col("l_returnflag") == "R", 2).otherwise(1)
    s = t.lineitem.groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("decimal(12,2)") * role).cast("double").alias("raw"))
    return A.percent_of_max(s, "raw", "score")


@plan("""
WITH d AS (SELECT o_custkey AS k, 'direct' AS lane, CAST(2.0 AS DECIMAL(4,2)) * CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.5 END AS w FROM orders WHERE o_totalprice > 300000),
i AS (SELECT o_custkey AS k, 'indirect' AS lane, CAST(1.0 AS DECIMAL(4,2)) * CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.5 END AS w FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate WHERE l_quantity > 45),
s AS (SELECT k, CAST(sum(w) AS DOUBLE) AS raw, string_agg(DISTINCT lane, ',' ORDER BY lane) AS lanes FROM (SELECT * FROM d UNION ALL SELECT * FROM i) GROUP BY k)
SELECT k, raw, lanes, raw * 100.0 / max(raw) OVER () AS score FROM s
""")
def personal_score(t: Tables) -> DataFrame:
    """Direct and valid indirect lanes of responsibility in one normalised score."""
    sure = F.when(F.col("o_orderstatus") == "F", F.lit("1.0").cast("decimal(4,2)")).otherwise(F.lit("0.5").cast("decimal(4,2)"))
    direct = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("k"), F.lit("direct").alias("lane"), (sure * 2).alias("w"))
    lines = t.orders.join(t.lineitem.filter("l_quantity > 45"), (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("l_shipdate") >= F.col("o_orderdate")))
    indirect = lines.select(F.col("o_custkey").alias("k"), F.lit("indirect").alias("lane"), (sure * 1).alias("w"))
    s = direct.unionByName(indirect).groupBy("k").agg(F.sum("w").cast("double").alias("raw"), F.array_join(F.array_sort(F.collect_set("lane")), ",").alias("lanes"))
    return A.percent_of_max(s, "raw", "score")


@plan("""
WITH k AS (SELECT count(*) AS n, count_if(o_orderstatus = 'F') AS done, count_if(o_totalprice > 100000) AS big, count_if(o_orderpriority <> '5-LOW') AS rated FROM orders)
SELECT metric, value, floor, value >= floor AS passed FROM (
  SELECT unnest(['big_share', 'done_share', 'rated_share']) AS metric, unnest([big / n, done / n, rated / n]) AS value, unnest([0.5::DOUBLE, 0.6::DOUBLE, 0.75::DOUBLE]) AS floor FROM k)
""")
def coverage_kpis_gate(t: Tables) -> DataFrame:
    """Coverage ratios held against floors."""
    from ..operators.quality import threshold_gate

    k = t.orders.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_totalprice") > 100000).alias("big"), F.count_if(F.col("o_orderpriority") != "5-LOW").alias("rated"))
    kpis = k.select(S.ratio("big", "n").alias("big_share"), S.ratio("done", "n").alias("done_share"), S.ratio("rated", "n").alias("rated_share"))
    return threshold_gate(kpis, {"big_share": 0.5, "done_share": 0.6, "rated_share": 0.75})


@plan("""
WITH m AS (SELECT o_orderpriority, max(year(o_orderdate)) AS y FROM orders GROUP BY 1)
SELECT orders.o_orderpriority, CAST(y AS INTEGER) AS y, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total FROM orders JOIN m ON orders.o_orderpriority = m.o_orderpriority AND year(o_orderdate) = y GROUP BY ALL
""")
def latest_partition(t: Tables) -> DataFrame:
    """Only the latest partition of each source."""
    o = t.orders.withColumn("y", F.year("o_orderdate"))
    last = o.groupBy("o_orderpriority").agg(F.max("y").alias("y"))
    return o.join(last, ["o_orderpriority", "y"]).groupBy("o_orderpriority", "y").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).cast("double").alias("total"))


@plan("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) AS n FROM events WHERE value > 30 GROUP BY user_id")
def distinct_list(t: Tables) -> DataFrame:
    """A sorted list of the distinct labels of a key."""
    return t.events.filter("value > 30").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"), F.count(F.lit(1)).alias("n"))


@plan("""
SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)) WHERE r = 1
""")
def mode_label(t: Tables) -> DataFrame:
    """The most frequent label of each key, ties to the least."""
    return A.mode_label(t.events, ["user_id"], "event_type")


@plan("""
WITH a AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) > 21600000000 THEN 1 ELSE 0 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM a),
g AS (SELECT user_id, session, count(*) AS n, min(CASE WHEN event_type = 'click' THEN epoch_us(ts) END) - min(epoch_us(ts)) AS first_click, count_if(event_type = 'purchase') > 0 AS bought FROM s GROUP BY 1, 2)
SELECT count(*) AS n_sessions, quantile_cont(first_click, 0.5) / 1000000 AS median_seconds, CAST(count_if(bought) AS DOUBLE) / count(*) AS bought_rate, max(n) AS longest FROM g
""")
def session_kpis(t: Tables) -> DataFrame:
    """Sessions by gaps: time to the first answer, rates."""
    s = W.sessions(t.events, ["user_id"], "ts", 6 * 3600)
    micros = S.micros("ts")
    g = s.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), (F.min(F.when(F.col("event_type") == "click", micros)) - F.min(micros)).alias("first"), F.bool_or(F.col("event_type") == "purchase").alias("bought"))
    return g.agg(F.count(F.lit(1)).alias("n_sessions"), (F.percentile("first", F.lit(0.5)) / 1000000).alias("median_seconds"), S.ratio(F.count_if("bought"), F.count(F.lit(1))).alias("bought_rate"), F.max("n").alias("longest"))


@plan("""
WITH f AS (SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL AND trim(event_type) <> '' GROUP BY 1 ORDER BY n DESC, value LIMIT 3)
SELECT value, n FROM f WHERE (SELECT sum(n) FROM f) >= 8 AND (SELECT max(n) FROM f) > 1
""")
def facets_topk(t: Tables) -> DataFrame:
    """The most frequent values of a column for navigation."""
    return A.facets(t.events, "event_type", 3)


@plan("""
WITH e AS (SELECT user_id, event_type, value FROM events)
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS attempts, count(*) FILTER (WHERE event_type = 'purchase') AS done, count(*) FILTER (WHERE event_type = 'error') AS errors,
  CASE WHEN count_if(event_type = 'click') > 0 THEN CAST(count_if(event_type = 'purchase') AS DOUBLE) / count_if(event_type = 'click') END AS rate,
  CASE WHEN count_if(event_type = 'click') < 3 THEN 'degraded' WHEN CAST(count_if(event_type = 'purchase') AS DOUBLE) / count_if(event_type = 'click') < 0.5 THEN 'failed' ELSE 'ok' END AS status
FROM e GROUP BY user_id
""")
def event_funnel(t: Tables) -> DataFrame:
    """A funnel whose rate is unknown without attempts, with a least volume."""
    g = t.events.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == k).alias(n) for k, n in (("click", "attempts"), ("purchase", "done"), ("error", "errors"))])
    g = g.withColumn("rate", S.rate("done", "attempts"))
    return g.withColumn("status", F.when(F.col("attempts") < 3, "degraded").when(F.col("rate") < 0.5, "failed").otherwise("ok"))


@plan("""
SELECT md5(text) AS h, count(*) AS n_refs, arg_max(doc_id, n_chars * 1000000 - doc_id) AS representative, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents GROUP BY 1 HAVING count(*) > 1
""")
def dedupe_representative(t: Tables) -> DataFrame:
    """Groups of equal content with a representative and their references."""
    g = t.documents.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.count(F.lit(1)).alias("n_refs"), F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("representative"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    return g.filter("n_refs > 1")


@plan("""
SELECT CAST(coalesce((SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'X'), (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_quantity > 1000), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'P'), DATE '1970-01-01') AS VARCHAR) AS as_of
""")
def asof_cascade(t: Tables) -> DataFrame:
    """The as-of date from the first source that has one."""
    o = t.orders.agg(F.max(F.when(F.col("o_orderstatus") == "X", F.to_date("o_orderdate"))).alias("a"), F.max(F.when(F.col("o_orderstatus") == "P", F.to_date("o_orderdate"))).alias("c"))
    line = t.lineitem.agg(F.max(F.when(F.col("l_quantity") > 1000, F.to_date("l_shipdate"))).alias("b"))
    return o.join(line, F.lit(True)).select(F.coalesce("a", "b", "c", F.lit("1970-01-01").cast("date")).cast("string").alias("as_of"))


@plan("""
SELECT c_mktsegment, count(DISTINCT c_custkey) AS n_customers, count(DISTINCT o_orderkey) AS n_orders, count(l_linenumber) AS n_lines, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN c_custkey END) AS n_returning
FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
""")
def fanout_safe_counts(t: Tables) -> DataFrame:
    """Counts of parents and children, each branch aggregated before it joins."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("l_returnflag") == "R").alias("r"))
    orders = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("o"), F.sum("n").alias("n"), F.bool_or("r").alias("r"))
    out = t.customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_mktsegment")
    zero = F.lit(0).cast("long")
    return out.agg(F.count(F.lit(1)).alias("n_customers"), F.coalesce(F.sum("o"), zero).alias("n_orders"), F.coalesce(F.sum("n"), zero).alias("n_lines"), F.count_if(F.coalesce("r", F.lit(False))).alias("n_returning"))


@plan("""
WITH r AS (SELECT event_type, value, epoch_us(ts) AS b, epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts)) AS a FROM events)
SELECT event_type, CAST(sum(b - a) AS DOUBLE) / count(a) / 1000000 AS mean_seconds, count(a) AS n_runs, arg_max(value, b) AS last_value FROM r GROUP BY event_type
""")
def run_metrics(t: Tables) -> DataFrame:
    """Mean run time, number of runs and the last run's value of each source."""
    w = Window.partitionBy("event_type").orderBy("ts")
    r = t.events.withColumn("a", S.micros(F.lag("ts").over(w))).withColumn("b", S.micros("ts"))
    return r.groupBy("event_type").agg((F.sum(F.col("b") - F.col("a")).cast("double") / F.count("a") / 1000000).alias("mean_seconds"), F.count("a").alias("n_runs"), F.max_by("value", "b").alias("last_value"))


@plan("""
WITH c AS (SELECT s_nationkey AS k, l_returnflag AS f, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT k, string_agg(f || '=' || n, ',' ORDER BY r) AS top FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, f) AS r FROM c) WHERE r <= 2 GROUP BY k
""")
def top_breakdown(t: Tables) -> DataFrame:
    """The largest parts of each entity as a list."""
    c = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("k"), F.col("l_returnflag").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    top = J.best_row(c, ["k"], [F.desc("n"), F.asc("f")], k=2, rank="r")
    parts = F.array_sort(F.collect_list(F.struct("r", F.concat("f", F.lit("="), F.col("n").cast("string")).alias("x"))))
    return top.groupBy("k").agg(F.array_join(F.transform(parts, lambda p: p["x"]), ",").alias("top"))


@plan("""
WITH x AS (SELECT o_orderpriority AS p, count_if(o_orderstatus = 'F') AS f, count(*) AS n, avg(CASE WHEN o_totalprice > 250000 THEN 1.0 ELSE 0.0 END) AS share FROM orders GROUP BY 1)
SELECT p, share, 0.4 * f / n + 0.3 * (1 - share) + 0.3 * CASE WHEN n > 3000 THEN 1 ELSE 0 END AS score FROM x
""")
def composite_score(t: Tables) -> DataFrame:
    """Sub-scores, weighted; a mean of flags is a share."""
    x = t.orders.groupBy(F.col("o_orderpriority").alias("p")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("o_totalprice") > 250000, 1.0).otherwise(0.0)).alias("share"))
    return x.select("p", "share", (0.4 * F.col("f") / F.col("n") + 0.3 * (1 - F.col("share")) + 0.3 * F.when(F.col("n") > 3000, 1).otherwise(0)).alias("score"))


@plan("""
SELECT l_orderkey, count(*) AS n, min(1 - l_discount) AS least, max(1 - l_discount) AS most, quantile_cont(1 - l_discount, 0.5) AS mid, CAST(count_if(1 - l_discount < 0.93) AS DOUBLE) / count(*) AS low_share FROM lineitem GROUP BY 1
""")
def confidence_summary(t: Tables) -> DataFrame:
    """Spread, median and share of low confidences of each parent."""
    c = t.lineitem.withColumn("c", 1 - F.col("l_discount"))
    return c.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"), F.max("c").alias("most"), F.percentile("c", F.lit(0.5)).alias("mid"), S.ratio(F.count_if(F.col("c") < 0.93), F.count(F.lit(1))).alias("low_share"))
