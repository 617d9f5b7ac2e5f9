"""Merges, queues and differences between versions of a table.

Orders play both versions: the target lacks some, the batch brings some anew and some
changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge as M
from .registry import Tables, plan

_PAIR = """
tgt AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0),
src AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'N' END AS status, o_totalprice + 1 AS price FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)
"""


def _pair(t: Tables) -> tuple[DataFrame, DataFrame]:
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    src = o.filter("k % 2 = 0 OR k % 3 = 0").select("k", F.when(F.col("k") % 4 != 0, "N").alias("status"), (F.col("price") + 1).alias("price"))
    return o.filter("k % 3 != 0"), src


@plan(f"WITH {_PAIR} SELECT coalesce(src.k, tgt.k) AS k, CASE WHEN src.k IS NULL THEN tgt.status ELSE src.status END AS status, coalesce(src.price, tgt.price) AS price FROM tgt FULL JOIN src ON src.k = tgt.k")
def upsert_merge(t: Tables) -> DataFrame:
    """Insert or update by key."""
    return M.upsert(*_pair(t), ["k"])


@plan(f"WITH {_PAIR} SELECT coalesce(tgt.k, src.k) AS k, coalesce(src.status, tgt.status) AS status, CASE WHEN tgt.k IS NULL THEN src.price ELSE tgt.price END AS price FROM tgt FULL JOIN src ON src.k = tgt.k")
def upsert_keep_known(t: Tables) -> DataFrame:
    """Insert or update some columns, never with null."""
    return M.upsert(*_pair(t), ["k"], ["status"], keep_known=True)


@plan(f"WITH {_PAIR} SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.k = src.k)")
def insert_new(t: Tables) -> DataFrame:
    """Insert only what is not there."""
    return M.insert_new(*_pair(t), ["k"])


#: Keys that repeat and null keys, in order of seq and price; the target has a null key, too.
_REPEATED = """
tgt AS (SELECT CASE WHEN o_orderkey <> (SELECT min(o_orderkey) FROM orders) THEN o_orderkey END AS k, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0),
src AS (SELECT CASE WHEN l_suppkey > 1 THEN l_orderkey END AS k, l_partkey * 100000000000 + l_orderkey * 10 + l_linenumber AS seq, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END AS status, l_extendedprice AS price FROM lineitem)
"""


def _repeated(t: Tables) -> tuple[DataFrame, DataFrame]:
    first = t.orders.agg(F.min("o_orderkey").alias("least"))
    o = t.orders.join(F.broadcast(first), F.lit(True)).filter("o_orderkey % 3 != 0").select(F.when(F.col("o_orderkey") != F.col("least"), F.col("o_orderkey")).alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    seq = F.col("l_partkey") * 100000000000 + F.col("l_orderkey") * 10 + F.col("l_linenumber")
    src = t.lineitem.select(F.when(F.col("l_suppkey") > 1, F.col("l_orderkey")).alias("k"), seq.alias("seq"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linestatus")).alias("status"), F.col("l_extendedprice").alias("price"))
    return o, src


@plan(f"""
WITH {_REPEATED}, one AS (SELECT k, last(status ORDER BY seq, price) AS status, last(price ORDER BY seq, price) AS price FROM src GROUP BY k)
SELECT CASE WHEN one.price IS NULL THEN tgt.k ELSE one.k END AS k, CASE WHEN one.price IS NULL THEN tgt.status ELSE one.status END AS status, coalesce(one.price, tgt.price) AS price FROM tgt FULL JOIN one ON one.k IS NOT DISTINCT FROM tgt.k
""")
def upsert_repeated(t: Tables) -> DataFrame:
    """Rows that share a key, or have none, leave one row: the last one."""
    return M.upsert(*_repeated(t), ["k"], order=["seq", "price"])


@plan(f"""
WITH {_REPEATED}, one AS (SELECT k, last(status ORDER BY seq, price) FILTER (WHERE status IS NOT NULL) AS status, first(price ORDER BY seq, price) AS price FROM src GROUP BY k)
SELECT CASE WHEN tgt.price IS NULL THEN one.k ELSE tgt.k END AS k, coalesce(one.status, tgt.status) AS status, coalesce(tgt.price, one.price) AS price FROM tgt FULL JOIN one ON one.k IS NOT DISTINCT FROM tgt.k
""")
def upsert_repeated_keep_known(t: Tables) -> DataFrame:
    """The same with one updated column that nulls leave alone; the first row inserts."""
    return M.upsert(*_repeated(t), ["k"], ["status"], keep_known=True, order=["seq", "price"])


@plan(f"""
WITH {_REPEATED}, one AS (SELECT k, first(status ORDER BY seq, price) AS status, first(price ORDER BY seq, price) AS price FROM src GROUP BY k)
SELECT * FROM tgt UNION ALL SELECT * FROM one WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.k IS NOT DISTINCT FROM one.k)
""")
def insert_repeated(t: Tables) -> DataFrame:
    """Of rows with a new repeated key the first comes in."""
    return M.insert_new(*_repeated(t), ["k"], order=["seq", "price"])


_QUEUE = """
q AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'P' THEN 'ignored' ELSE 'pending' END AS status FROM orders WHERE o_orderkey % 3 <> 0),
det AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 40)
"""


def _queue(t: Tables) -> tuple[DataFrame, DataFrame]:
    s = F.col("o_orderstatus")
    q = t.orders.filter("o_orderkey % 3 != 0").select(F.col("o_orderkey").alias("k"), F.when(s == "F", "resolved").when(s == "P", "ignored").otherwise("pending").alias("status"))
    return q, t.lineitem.filter("l_quantity > 40").select(F.col("l_orderkey").alias("k"))


@plan(f"""
WITH {_QUEUE} SELECT coalesce(q.k, det.k) AS k, CASE WHEN q.k IS NULL THEN 'pending' WHEN status = 'ignored' THEN 'ignored' WHEN det.k IS NULL THEN CASE WHEN status = 'pending' THEN 'resolved' ELSE status END ELSE 'pending' END AS status
FROM q FULL JOIN det ON q.k = det.k
""")
def reconcile_queue(t: Tables) -> DataFrame:
    """A work queue after a new detection; ignored rows stay ignored."""
    return M.reconcile(*_queue(t), ["k"])


@plan(f"""
WITH {_QUEUE} SELECT k, CASE WHEN k IN (SELECT k FROM det) AND status = 'resolved' THEN 'pending' ELSE status END AS status FROM q
""")
def upsert_state(t: Tables) -> DataFrame:
    """A state transition on conflict: resolved rows that are found again are pending."""
    q, det = _queue(t)
    found = det.distinct().withColumn("status", F.lit("pending"))
    seen = q.join(found.select("k", F.lit(True).alias("_f")), "k", "left")
    return seen.select("k", F.when(F.col("_f") & (F.col("status") == "resolved"), "pending").otherwise(F.col("status")).alias("status"))


@plan("""
WITH tgt AS (SELECT CASE WHEN o_orderkey % 64 <> 1 THEN o_orderkey END AS k, o_orderstatus <> 'F' AS is_active, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) END AS end_date FROM orders)
SELECT k, CASE WHEN k % 2 = 1 AND is_active THEN false ELSE is_active END AS is_active, CAST(CASE WHEN k % 2 = 1 AND is_active AND end_date IS NULL THEN DATE '1999-01-01' ELSE end_date END AS VARCHAR) AS end_date FROM tgt
""")
def close_missing(t: Tables) -> DataFrame:
    """Rows that a full snapshot lacks are closed at its date; it has the null key."""
    key = F.when(F.col("o_orderkey") % 64 != 1, F.col("o_orderkey"))
    o = t.orders.select(key.alias("k"), (F.col("o_orderstatus") != "F").alias("is_active"), F.when(F.col("o_orderkey") % 5 == 0, F.to_date("o_orderdate")).alias("end_date"))
    out = M.close_missing(o, t.orders.filter("o_orderkey % 2 = 0 OR o_orderkey % 64 = 1").select(key.alias("k")), ["k"], F.lit("1999-01-01").cast("date"))
    return out.withColumn("end_date", F.col("end_date").cast("string"))


@plan(f"""
WITH {_PAIR} SELECT coalesce(tgt.k, src.k) AS k, CASE WHEN tgt.k IS NULL THEN 'added' WHEN src.k IS NULL THEN 'removed' WHEN tgt.status IS NOT DISTINCT FROM src.status AND tgt.price = src.price THEN 'same' ELSE 'changed' END AS status
FROM tgt FULL JOIN src ON tgt.k = src.k
""")
def snapshot_diff(t: Tables) -> DataFrame:
    """Added, removed, changed and equal rows of two versions."""
    return M.snapshot_diff(*_pair(t), ["k"], ["status", "price"])


@plan("""
WITH d AS (SELECT DISTINCT p_brand, p_type FROM part), k AS (SELECT sha256(p_brand || '|' || p_type) AS id, p_brand, p_type FROM d)
SELECT p_partkey, id FROM part JOIN k USING (p_brand, p_type)
""")
def dimension_keys(t: Tables) -> DataFrame:
    """Keys of a dimension that need no lookup: a hash of the natural key."""
    return t.part.select("p_partkey", F.sha2(F.concat_ws("|", "p_brand", "p_type"), 256).alias("id"))


@plan("""
WITH x AS (SELECT o_orderkey AS k, o_totalprice AS v, CASE WHEN o_orderkey % 10 = 0 THEN 'missing' WHEN o_totalprice < 1000 THEN 'too_small' WHEN o_custkey % 3 = 0 THEN 'no_customer' END AS skip FROM orders)
SELECT coalesce(skip, 'applied') AS reason, count(*) AS n FROM x GROUP BY 1
""")
def apply_with_reasons(t: Tables) -> DataFrame:
    """Row-wise apply with the first reason that skips a row, counted."""
    skip = F.when(F.col("o_orderkey") % 10 == 0, "missing").when(F.col("o_totalprice") < 1000, "too_small").when(F.col("o_custkey") % 3 == 0, "no_customer")
    return t.orders.select(F.coalesce(skip, F.lit("applied")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
