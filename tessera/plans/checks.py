"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import quality as Q
from .registry import Tables, plan


@plan("""
SELECT 'lines_orders' AS edge, count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS n_orphans FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 100 <> 7) ON l_orderkey = o_orderkey
UNION ALL SELECT 'orders_customer', count(*), count(*) FILTER (WHERE c_custkey IS NULL) FROM orders LEFT JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'customer_nation', count(*), count(*) FILTER (WHERE n_nationkey IS NULL) FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'events_customer', count(*), count(*) FILTER (WHERE c_custkey IS NULL) FROM events LEFT JOIN (SELECT * FROM customer WHERE c_custkey > 20) ON user_id = c_custkey
""")
def fk_orphans(t: Tables) -> DataFrame:
    """Rows without their parent on every edge."""
    return Q.orphan_report([
        ("lines_orders", t.lineitem, "l_orderkey", t.orders.filter("o_orderkey % 100 <> 7"), "o_orderkey"),
        ("orders_customer", t.orders, "o_custkey", t.customer, "c_custkey"),
        ("customer_nation", t.customer, "c_nationkey", t.nation, "n_nationkey"),
        ("events_customer", t.events, "user_id", t.customer.filter("c_custkey > 20"), "c_custkey"),
    ])


@plan("""
SELECT rule, n_rows, n_failed FROM (SELECT unnest(['discount_range', 'flag_enum', 'line_prefix', 'quantity_positive', 'ship_year']) AS rule, count(*) AS n_rows,
  unnest([count(*) FILTER (WHERE NOT (l_discount BETWEEN 0 AND 0.09)), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')), count(*) FILTER (WHERE NOT starts_with(l_linestatus, 'O')), count(*) FILTER (WHERE NOT l_quantity > 0), count(*) FILTER (WHERE NOT year(l_shipdate) < 2000)]) AS n_failed FROM lineitem)
""")
def check_rules(t: Tables) -> DataFrame:
    """Enumerations, ranges and prefixes, all in one pass."""
    return Q.violations(t.lineitem, {
        "discount_range": F.col("l_discount").between(0, 0.09),
        "flag_enum": F.col("l_returnflag").isin("A", "N"),
        "line_prefix": F.startswith(F.col("l_linestatus"), F.lit("O")),
        "quantity_positive": F.col("l_quantity") > 0,
        "ship_year": F.year("l_shipdate") < 2000,
    })


@plan("""
SELECT c_custkey AS k, 'low_balance' AS gap, 1 AS priority FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'no_orders', 2 FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 350000)
UNION ALL SELECT c_custkey, 'segment', 3 FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def gap_queue(t: Tables) -> DataFrame:
    """Gaps of several kinds as one prioritised queue."""
    big = t.orders.filter("o_totalprice > 350000")
    c = t.customer
    gap = lambda df, name, p: df.select(F.col("c_custkey").alias("k"), F.lit(name).alias("gap"), F.lit(p).alias("priority"))
    return gap(c.filter("c_acctbal < 0"), "low_balance", 1).union(gap(c.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti"), "no_orders", 2)).union(gap(c.filter("c_mktsegment = 'MACHINERY'"), "segment", 3))


@plan("""
SELECT l_orderkey, l_linenumber, l_partkey, list_aggregate(list_filter([CASE WHEN l_quantity <= 45 THEN NULL ELSE 'bulk' END, CASE WHEN l_discount < 0.09 THEN NULL ELSE 'cheap' END, CASE WHEN l_tax < 0.08 THEN NULL ELSE 'taxed' END], lambda x: x IS NOT NULL), 'string_agg', ',') AS reasons
FROM lineitem WHERE l_quantity > 45 OR l_discount >= 0.09 OR l_tax >= 0.08
""")
def row_reasons(t: Tables) -> DataFrame:
    """All rules that a row breaks, as a list."""
    why = Q.reasons({"bulk": F.col("l_quantity") <= 45, "cheap": F.col("l_discount") < 0.09, "taxed": F.col("l_tax") < 0.08})
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(why, ",").alias("reasons")).filter("reasons <> ''")


@plan("""
SELECT doc_id, kind, n_hits FROM (SELECT doc_id, unnest(['email', 'secret', 'local_path']) AS kind,
  unnest([CAST(len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) AS BIGINT), CAST(len(regexp_extract_all(text, '(?i)(?:password|token|secret|api[_-]?key)\\s*[=:]\\s*\\S+')) AS BIGINT), CAST(len(regexp_extract_all(text, '/(?:home|Users)/[A-Za-z0-9._-]+')) AS BIGINT)]) AS n_hits FROM documents) WHERE n_hits > 0
""")
def leak_scan(t: Tables) -> DataFrame:
    """Texts that hold addresses, secrets or local paths."""
    return Q.leak_scan(t.documents, "doc_id", "text")


@plan("""
WITH g AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') / count(*) AS e, max(value) AS m FROM events GROUP BY 1)
SELECT user_id, CASE WHEN e > 0.3 OR n < 40 THEN 'failed' WHEN e > 0.25 OR m < 50 THEN 'degraded' ELSE 'ok' END AS status FROM g
""")
def status_rollup(t: Tables) -> DataFrame:
    """The worst of several statuses."""
    g = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), S.ratio(F.count_if(F.col("event_type") == "error"), F.count(F.lit(1))).alias("e"), F.max("value").alias("m"))
    errors = F.when(F.col("e") > 0.3, "failed").when(F.col("e") > 0.25, "degraded").otherwise("ok")
    volume = F.when(F.col("n") < 40, "failed").otherwise("ok")
    size = F.when(F.col("m") < 50, "degraded").otherwise("ok")
    return g.select("user_id", Q.worst_status(errors, volume, size).alias("status"))


@plan("""
WITH g AS (SELECT n_nationkey, p_type FROM nation CROSS JOIN (SELECT DISTINCT p_type FROM part)),
c AS (SELECT DISTINCT s_nationkey, p_type FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE l_quantity > 49 AND l_discount > 0.08)
SELECT n_nationkey, p_type FROM g WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.s_nationkey = n_nationkey AND c.p_type = g.p_type)
""")
def grid_contract(t: Tables) -> DataFrame:
    """Cells of a full grid that a snapshot lacks."""
    cells = t.lineitem.filter("l_quantity > 49 AND l_discount > 0.08").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("s_nationkey").alias("n_nationkey"), "p_type").distinct()
    grid = t.nation.select("n_nationkey").join(t.part.select("p_type").distinct(), F.lit(True))
    return grid.join(cells, ["n_nationkey", "p_type"], "left_anti")


@plan("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'UNTRACKED' WHEN o_totalprice < 2000 THEN 'DONE_ZERO_REAL' WHEN o_orderstatus = CASE WHEN o_custkey % 2 = 0 THEN 'O' ELSE 'F' END THEN 'MATCH' WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'WAIVED_MISMATCH' ELSE 'MISMATCH' END AS tracked FROM orders
""")
def tracker_state(t: Tables) -> DataFrame:
    """What a tracker says against the status of the data, with waivers."""
    tracker = F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise(F.when(F.col("o_custkey") % 2 == 0, "o").otherwise("f"))
    return t.orders.select("o_orderkey", S.mismatch_state(tracker, "o_orderstatus", F.col("o_totalprice") < 2000, F.col("o_orderdate") >= "1997-01-01").alias("tracked"))
