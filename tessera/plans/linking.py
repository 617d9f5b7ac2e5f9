"""Joins: stars, existence, intervals, as-of, record linkage, nearest events, graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import terms as K
from .registry import Tables, plan


@plan("""
SELECT r_name, n_name, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name
""")
def inner_star(t: Tables) -> DataFrame:
    """Facts with their dimensions, aggregated before the wide dimensions join."""
    by_supplier = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("q"))
    star = by_supplier.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return star.groupBy("r_name", "n_name").agg(F.sum("n").alias("n_lines"), F.sum("q").cast("double").alias("quantity"))


@plan("""
SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def left_star(t: Tables) -> DataFrame:
    """Left joins of dimensions, the first with a predicate of its own side."""
    rich = t.customer.filter("c_acctbal > 5000")
    out = t.orders.join(rich, F.col("o_custkey") == F.col("c_custkey"), "left")
    out = out.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select("o_orderkey", "c_name", "n_name", "r_name")


@plan("""
SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS n_urgent FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY c_custkey
""")
def left_on_predicate(t: Tables) -> DataFrame:
    """A left join whose right side is filtered first, counted per key before the join."""
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t.customer.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0).cast("long")).alias("n_urgent"))


@plan("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti_missing(t: Tables) -> DataFrame:
    """Keys without a fact of a kind."""
    pending = t.orders.filter("o_orderstatus = 'P'")
    return t.customer.join(pending, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@plan("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48)")
def semi_exists(t: Tables) -> DataFrame:
    """Facts with a child of a kind."""
    return t.orders.join(t.lineitem.filter("l_quantity > 48"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@plan("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.08) AND p_brand IN (SELECT p_brand FROM part WHERE p_size > 45)")
def not_in_keys(t: Tables) -> DataFrame:
    """Membership in key sets without nulls."""
    cheap = t.lineitem.filter("l_discount > 0.08").select("l_partkey")
    brands = t.part.filter("p_size > 45").select(F.col("p_brand").alias("_b"))
    return t.part.join(cheap, F.col("p_partkey") == F.col("l_partkey"), "left_anti").join(brands, F.col("p_brand") == F.col("_b"), "left_semi").select("p_partkey")


@plan("""
SELECT a.o_orderkey FROM orders a WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderstatus IS NOT DISTINCT FROM a.o_orderstatus
  AND b.o_orderpriority IS NOT DISTINCT FROM nullif(a.o_orderpriority, '5-LOW') AND b.o_orderkey % 2 = 1) AND a.o_orderkey % 2 = 0
""")
def anti_null_safe(t: Tables) -> DataFrame:
    """An anti join on several keys where nulls are equal."""
    a = t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    b = t.orders.filter("o_orderkey % 2 = 1").select(F.col("o_custkey").alias("_c"), F.col("o_orderstatus").alias("_s"), F.col("o_orderpriority").alias("_p"))
    on = (F.col("o_custkey") == F.col("_c")) & F.col("o_orderstatus").eqNullSafe(F.col("_s")) & F.col("p").eqNullSafe(F.col("_p"))
    return a.join(b, on, "left_anti").select("o_orderkey")


@plan("""
WITH l AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned, bool_or(l_linestatus = 'O') AS is_open FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, CASE WHEN l.l_orderkey IS NULL THEN 0 WHEN NOT is_open THEN 1 WHEN NOT returned THEN 2 ELSE 3 END AS priority
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey
""")
def priority_existence(t: Tables) -> DataFrame:
    """A work order from what is missing: nested existence as flags of one aggregate."""
    flags = t.lineitem.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.bool_or(F.col("l_linestatus") == "O").alias("is_open"))
    out = t.orders.join(flags, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return out.select("o_orderkey", F.when(F.col("l_orderkey").isNull(), 0).when(~F.col("is_open"), 1).when(~F.col("returned"), 2).otherwise(3).alias("priority"))


@plan("""
SELECT c_custkey, o_orderkey AS last_order, o_orderstatus AS last_status FROM customer LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1) ON o_custkey = c_custkey
""")
def latest_lookup(t: Tables) -> DataFrame:
    """The latest fact of each key as columns."""
    last = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_orderdate")
    out = J.latest_lookup(t.customer.select("c_custkey"), last, ["c_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return out.select("c_custkey", F.col("o_orderkey").alias("last_order"), F.col("o_orderstatus").alias("last_status"))


@plan("""
SELECT o_orderkey, o_totalprice / nullif((SELECT avg(b.o_totalprice) FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderkey = a.o_orderkey), 0) AS of_mean,
  (SELECT count(*) FROM orders b WHERE b.o_custkey = a.o_custkey) AS n_orders FROM orders a
""")
def correlated_scalar(t: Tables) -> DataFrame:
    """Correlated aggregates as grouped frames joined by key."""
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    own = t.orders.groupBy("o_custkey", "o_orderkey").agg(F.avg("o_totalprice").alias("m"))
    a = t.orders.join(n, "o_custkey").join(own, ["o_custkey", "o_orderkey"])
    return a.select("o_orderkey", F.try_divide("o_totalprice", "m").alias("of_mean"), "n_orders")


_SPANS = """
spans AS (SELECT o_orderkey AS span_id, o_custkey AS cust, CASE WHEN o_orderkey % 15 <> 0 THEN CAST(o_orderdate AS DATE) END AS s,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) + 300 END AS e FROM orders WHERE o_orderkey % 3 = 0),
facts AS (SELECT o_orderkey AS fact_id, o_custkey AS cust, CASE WHEN o_orderkey % 50 <> 1 THEN CAST(o_orderdate AS DATE) END AS d FROM orders WHERE o_orderkey % 3 <> 0)
"""


def _spans(t: Tables) -> tuple[DataFrame, DataFrame]:
    d = F.col("o_orderdate").cast("date")
    spans = t.orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("span_id"), F.col("o_custkey").alias("cust"), F.when(F.col("o_orderkey") % 15 != 0, d).alias("s"), F.when(F.col("o_orderkey") % 9 != 0, F.date_add(d, 300)).alias("e"))
    facts = t.orders.filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("fact_id"), F.col("o_custkey").alias("cust"), F.when(F.col("o_orderkey") % 50 != 1, d).alias("d"))
    return facts, spans


@plan(f"WITH {_SPANS} SELECT fact_id, span_id FROM facts JOIN spans ON facts.cust = spans.cust AND (s IS NULL OR d >= s) AND (e IS NULL OR d <= e)")
def interval_join(t: Tables) -> DataFrame:
    """Facts with all spans of their key that hold their date; open ends count."""
    facts, spans = _spans(t)
    return J.interval_join(facts, spans, ["cust"], "d", "s", "e").select("fact_id", "span_id")


@plan(f"""
WITH {_SPANS},
c AS (SELECT fact_id, span_id, s, CASE WHEN span_id IS NULL THEN NULL WHEN d IS NULL OR ((s IS NULL OR d >= s) AND (e IS NULL OR d <= e)) THEN 1 WHEN s IS NULL OR s <= d THEN 2 ELSE 3 END AS tier
  FROM facts LEFT JOIN spans ON facts.cust = spans.cust),
r AS (SELECT *, row_number() OVER (PARTITION BY fact_id ORDER BY tier NULLS LAST, CASE WHEN tier < 3 THEN s END DESC NULLS LAST, CASE WHEN tier < 3 THEN span_id END DESC NULLS LAST, s ASC NULLS FIRST, span_id ASC) AS rn FROM c)
SELECT fact_id, span_id, CAST(tier AS INTEGER) AS tier FROM r WHERE rn = 1
""")
def asof_tiered(t: Tables) -> DataFrame:
    """As-of join with fallbacks, the last of which looks from the other end."""
    facts, spans = _spans(t)
    return J.asof_tiered(facts, spans, ["cust"], "fact_id", "d", "s", "e", "span_id").select("fact_id", "span_id", "tier")


@plan(f"""
WITH {_SPANS},
c AS (SELECT fact_id, span_id, s, CASE WHEN span_id IS NULL THEN NULL WHEN d IS NULL OR ((s IS NULL OR d >= s) AND (e IS NULL OR d <= e)) THEN 1 ELSE 2 END AS tier FROM facts LEFT JOIN spans ON facts.cust = spans.cust),
r AS (SELECT *, row_number() OVER (PARTITION BY fact_id ORDER BY tier NULLS LAST, s DESC NULLS LAST, span_id DESC) AS rn FROM c)
SELECT fact_id, span_id, CAST(tier AS INTEGER) AS tier FROM r WHERE rn = 1
""")
def asof_window_or_first(t: Tables) -> DataFrame:
    """As-of join with one fallback: the holding span, else the first."""
    facts, spans = _spans(t)
    return J.asof_tiered(facts, spans, ["cust"], "fact_id", "d", "s", "e", "span_id", tiers="short").select("fact_id", "span_id", "tier")


@plan("""
WITH f AS (SELECT s_suppkey AS fact_id, CAST(s_suppkey % 40 AS VARCHAR) AS name, s_nationkey AS nation FROM supplier),
c AS (SELECT c_custkey AS cand_id, CAST(c_custkey % 47 AS VARCHAR) AS name, c_nationkey AS nation, c_mktsegment AS seg, CAST(round(c_acctbal / 1000) AS INTEGER) AS bal FROM customer),
p AS (SELECT fact_id, cand_id, CASE WHEN c.nation = f.nation THEN 1 ELSE 0 END AS s0, CASE WHEN seg = 'BUILDING' THEN 1 ELSE 0 END AS s1, bal AS s2 FROM f LEFT JOIN c USING (name)),
e AS (SELECT fact_id, cand_id, max({'a': s0, 'b': s1, 'c': s2}) AS s FROM p GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY fact_id ORDER BY s DESC NULLS LAST) AS k FROM e)
SELECT fact_id, CASE WHEN count(cand_id) = 0 THEN 'no_candidates' WHEN count(cand_id) = 1 THEN 'matched' ELSE 'ambiguous' END AS status,
  CASE WHEN count(cand_id) = 1 THEN max(cand_id) END AS cand_id, count(cand_id) AS n_best FROM r WHERE k = 1 GROUP BY fact_id
""")
def best_candidate_link(t: Tables) -> DataFrame:
    """Record linkage: the best candidate by a tuple of criteria, ties are ambiguous."""
    f = t.supplier.select(F.col("s_suppkey").alias("fact_id"), (F.col("s_suppkey") % 40).cast("string").alias("name"), F.col("s_nationkey").alias("nation"))
    c = t.customer.select(F.col("c_custkey").alias("cand_id"), (F.col("c_custkey") % 47).cast("string").alias("name"), F.col("c_nationkey").alias("c_nation"), "c_mktsegment", F.round(F.col("c_acctbal") / 1000).cast("int").alias("bal"))
    score = [F.when(F.col("nation") == F.col("c_nation"), 1).otherwise(0), F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0), F.col("bal")]
    return J.best_candidate(f, c, "name", "fact_id", "cand_id", score)


_LINK = """
b AS (SELECT item_id, lower(trim(text)) AS k, item_id % 4 AS part FROM benchmark),
d AS (SELECT doc_id, lower(trim(text)) AS k, doc_id % 4 AS part FROM documents),
l AS (SELECT DISTINCT doc_id, part, k FROM (SELECT doc_id, part, trim(unnest(string_split_regex(k, '[.\\n]+'))) AS k FROM d) WHERE length(k) >= 24),
h AS (SELECT item_id, part, trim(string_split_regex(k, '[.\\n]+')[2]) AS k FROM b),
c2 AS (SELECT item_id, doc_id, h.part = l.part AS same FROM h JOIN l USING (k)),
c3 AS (SELECT item_id, doc_id, h.part = l.part AS same FROM h JOIN l ON left(h.k, 24) = left(l.k, 24) AND length(h.k) >= 40 AND h.k[1:40] = l.k[1:40] WHERE item_id NOT IN (SELECT item_id FROM c2)),
u AS (SELECT 'exact' AS method, 1.0 AS confidence, item_id, doc_id, true AS same FROM b JOIN d USING (k) UNION ALL SELECT 'sentence', 0.85, * FROM c2 UNION ALL SELECT 'prefix', 0.75, * FROM c3),
p AS (SELECT * FROM u AS a WHERE same OR NOT EXISTS (SELECT 1 FROM u AS o WHERE o.method = a.method AND o.item_id = a.item_id AND o.same)),
o AS (SELECT item_id, method, confidence, CAST(min(doc_id) AS VARCHAR) AS target FROM p GROUP BY ALL HAVING count(DISTINCT doc_id) = 1),
w AS (SELECT * FROM o UNION ALL SELECT item_id, 'derived', 1.0, left(sha256(k), 24) FROM h WHERE k <> '' AND item_id NOT IN (SELECT item_id FROM o)),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, target ORDER BY confidence DESC, method) AS rn FROM w)
"""


@plan(f"WITH {_LINK} SELECT item_id, target, method, CAST(confidence AS DOUBLE) AS confidence FROM r WHERE rn = 1")
def tiered_link(t: Tables) -> DataFrame:
    """Cascading links that must be unique: exact text, a whole sentence, its first 40
    characters where no sentence is equal, each within the same part first; a key of its
    own for what stays without a link."""
    text = F.lower(F.trim("text"))
    b = t.benchmark.select("item_id", text.alias("k"), (F.col("item_id") % 4).alias("part"))
    d = t.documents.select(F.col("doc_id").cast("string").alias("target"), text.alias("k"), (F.col("doc_id") % 4).alias("d_part"))
    lines = d.select("target", "d_part", F.explode(F.split("k", "[.\n]+")).alias("k")).withColumn("k", F.trim("k")).filter(F.length("k") >= 24).distinct()
    second = b.select("item_id", "part", F.trim(F.get(F.split("k", "[.\n]+"), F.lit(1))).alias("k"))
    same = (F.col("part") == F.col("d_part")).alias("same")
    equal = second.join(lines, "k").select("item_id", "target", same)
    start = lambda df: df.filter(F.length("k") >= 40).withColumn("k", F.left("k", F.lit(40)))
    near = start(second.join(equal.select("item_id"), "item_id", "left_anti")).join(start(lines), "k").select("item_id", "target", same)
    tiers = [
        J.Tier("exact", 1.0, b.join(d, "k").select("item_id", "target")),
        J.Tier("sentence", 0.85, equal, "same"),
        J.Tier("prefix", 0.75, near, "same"),
        J.Tier("derived", 1.0, second.filter("k <> ''").select("item_id", F.left(F.sha2("k", 256), F.lit(24)).alias("target")), last_resort=True),
    ]
    return J.tiered_link("item_id", "target", tiers)


@plan("""
WITH f AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id % 25 END AS a, CASE WHEN event_id % 6 <> 3 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS b, 'see ' || (user_id % 20) || '/' || lpad(CAST(json_extract(props, '$.k') AS VARCHAR), 6, '0') AS said FROM events),
k AS (SELECT event_id, a IS NOT NULL AND b IS NOT NULL AS sure, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a ELSE CAST(split_part(substr(said, 5), '/', 1) AS BIGINT) END AS a, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN b ELSE CAST(split_part(said, '/', 2) AS INTEGER) END AS b FROM f),
c AS (SELECT c_nationkey AS a, c_custkey % 100 AS b, min(c_custkey) AS cust FROM customer GROUP BY ALL HAVING count(*) = 1)
SELECT event_id, cust, CASE WHEN sure THEN 'payload_key' ELSE 'text_key' END AS method, CASE WHEN sure THEN 1.0 ELSE 0.9 END::DOUBLE AS confidence FROM k JOIN c ON k.a = c.a AND k.b = c.b
""")
def composite_link(t: Tables) -> DataFrame:
    """Links by a key of two parts that the fact carries, or else names in its text."""
    number = F.get_json_object("props", "$.k").cast("int")
    said = F.concat(F.lit("see "), (F.col("user_id") % 20).cast("string"), F.lit("/"), F.lpad(number.cast("string"), 6, "0"))
    facts = t.events.select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("user_id") % 25).alias("a"), F.when(F.col("event_id") % 6 != 3, number).alias("b"), said.alias("said"))
    guess = lambda n: F.regexp_extract("said", r"(\d+)/(\d+)", n).try_cast("int")
    targets = t.customer.select(F.col("c_custkey").alias("cust"), F.col("c_nationkey").alias("a"), (F.col("c_custkey") % 100).alias("b"))
    return J.composite_link(facts, targets, "event_id", "cust", [F.col("a"), F.col("b")], [guess(1), guess(2)], ["a", "b"])


@plan("""
WITH v AS (SELECT doc_id, unnest([title, regexp_replace(title, '^(the|der|la|le) ', ''), regexp_replace(title, '[.,]+$', '')]) AS k
  FROM (SELECT doc_id, lower(split_part(text, chr(10), 1)) AS title FROM documents))
SELECT k, count(DISTINCT doc_id) AS n_docs FROM v WHERE length(k) > 5 GROUP BY k HAVING count(DISTINCT doc_id) > 1
""")
def title_variants(t: Tables) -> DataFrame:
    """Titles with and without prefixes and suffixes as join keys."""
    title = t.documents.select("doc_id", F.lower(F.split_part("text", F.lit("\n"), F.lit(1))).alias("title"))
    forms = F.array_distinct(F.array("title", F.regexp_replace("title", "^(the|der|la|le) ", ""), F.regexp_replace("title", "[.,]+$", "")))
    v = title.select("doc_id", F.explode(forms).alias("k")).filter(F.length("k") > 5)
    return v.groupBy("k").agg(F.countDistinct("doc_id").alias("n_docs")).filter("n_docs > 1")


@plan("""
SELECT a.l_suppkey AS supp_a, b.l_suppkey AS supp_b, count(*) AS n_orders FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) a
JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY ALL
""")
def self_pairs(t: Tables) -> DataFrame:
    """Pairs of members that meet at a key."""
    pairs = J.self_pairs(t.lineitem.select("l_orderkey", F.col("l_suppkey").alias("supp")), ["l_orderkey"], "supp")
    return pairs.groupBy("supp_a", "supp_b").agg(F.count(F.lit(1)).alias("n_orders"))


@plan("""
WITH m AS (SELECT event_type AS k, event_id, ts FROM events WHERE event_id % 2 = 0), e AS (SELECT event_type AS k, ts AS w, value FROM events WHERE event_id % 2 = 1),
b AS (SELECT m.*, e.value AS before FROM m ASOF LEFT JOIN e ON m.k = e.k AND m.ts > e.w)
SELECT event_id, before, e.value AS after FROM b ASOF LEFT JOIN e ON b.k = e.k AND b.ts <= e.w
""")
def nearest_event_delta(t: Tables) -> DataFrame:
    """The last event before and the first at or after each fact, without making pairs."""
    m = t.events.filter("event_id % 2 = 0").select(F.col("event_type").alias("k"), "event_id", "ts")
    e = t.events.filter("event_id % 2 = 1").select(F.col("event_type").alias("k"), F.col("ts").alias("at"), "value")
    day = lambda at: F.date_trunc("day", at)
    before = J.nearest_before(m, e, ["k"], "ts", "at", ["value"], bucket=day).select("k", "event_id", "ts", F.col("value").alias("before"))
    return J.nearest_after(before, e, ["k"], "ts", "at", ["value"], bucket=day).select("event_id", "before", F.col("value").alias("after"))


@plan("""
WITH e AS (SELECT event_id, CASE WHEN user_id % 70 <> 0 THEN user_id END AS domain FROM events WHERE event_type = 'error'),
p AS (SELECT event_id AS policy_id, CASE WHEN user_id % 50 <> 0 THEN user_id END AS domain FROM events WHERE event_type = 'purchase')
SELECT e.event_id, count(policy_id) AS n_policies, min(policy_id) AS first_policy FROM e LEFT JOIN p ON e.domain = p.domain OR p.domain IS NULL OR e.domain IS NULL GROUP BY 1
""")
def theta_pairs(t: Tables) -> DataFrame:
    """What pairs with each fact where domains are equal or either is unknown: summed up by
    domain first, so that the unknown ones are single rows and no pairs are made."""
    known = lambda n: F.when(F.col("user_id") % n != 0, F.col("user_id"))
    e = t.events.filter("event_type = 'error'").select("event_id", known(70).alias("own"))
    p = t.events.filter("event_type = 'purchase'").groupBy(known(50).alias("domain")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("least"))
    n, least, wild = F.col("n"), F.col("least"), F.col("domain").isNull()
    sums = p.agg(F.coalesce(F.sum(n), F.lit(0)).alias("every"), F.min(least).alias("every_least"), F.coalesce(F.sum(F.when(wild, n)), F.lit(0)).alias("wild"), F.min(F.when(wild, least)).alias("wild_least"))
    both = e.join(p, F.col("own") == F.col("domain"), "left").join(F.broadcast(sums), F.lit(True))
    free = F.col("own").isNull()
    return both.select("event_id", F.when(free, F.col("every")).otherwise(F.coalesce(n, F.lit(0)) + F.col("wild")).alias("n_policies"), F.when(free, F.col("every_least")).otherwise(F.least(least, "wild_least")).alias("first_policy"))


@plan("""
SELECT kw, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents, (SELECT unnest(['license', 'example.com', 'password', 'rights', 'zzz']) AS kw) WHERE contains(lower(text), kw) GROUP BY kw
""")
def keyword_containment(t: Tables) -> DataFrame:
    """Keywords contained in texts: one scan with an array of hits, no join."""
    words = ["license", "example.com", "password", "rights", "zzz"]
    text = F.lower("text")
    hits = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in words]))
    return t.documents.select("doc_id", F.explode(hits).alias("kw")).groupBy("kw").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


@plan("""
WITH st AS (SELECT s_nationkey AS k, p_type, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS a FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE l_quantity > 45 GROUP BY ALL),
g AS (SELECT n_nationkey AS k, n_name, p_type FROM nation CROSS JOIN (SELECT DISTINCT p_type FROM part))
SELECT n_name, g.p_type, coalesce(n, 0) AS n_lines, coalesce(a, 0.0) AS avg_price FROM g LEFT JOIN st ON st.k = g.k AND st.p_type = g.p_type
""")
def full_grid(t: Tables) -> DataFrame:
    """Every cell of two dimensions, with defaults where there are no facts."""
    facts = t.lineitem.filter("l_quantity > 45").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    stats = facts.groupBy(F.col("s_nationkey").alias("k"), "p_type").agg(F.count(F.lit(1)).alias("n_lines"), (F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast("double") / F.count(F.lit(1))).alias("avg_price"))
    rows = t.nation.select(F.col("n_nationkey").alias("k"), "n_name")
    return J.full_grid(rows, t.part.select("p_type").distinct(), stats, ["k", "p_type"], {"n_lines": 0, "avg_price": 0.0}).select("n_name", "p_type", "n_lines", "avg_price")


@plan("""
SELECT o_orderkey, count(l_linenumber) AS n_lines, coalesce(string_agg(l_linenumber || ':' || CAST(l_quantity AS INTEGER), ',' ORDER BY l_linenumber, l_quantity), '') AS lines
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def nested_children(t: Tables) -> DataFrame:
    """Children stitched to their parents in order; a parent's children are bounded."""
    kids = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("int").alias("q")))).alias("kids"))
    out = t.orders.join(kids, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("kids", F.coalesce("kids", F.array().cast(kids.schema["kids"].dataType)))
    text = F.array_join(F.transform("kids", lambda k: F.concat(k["l_linenumber"].cast("string"), F.lit(":"), k["q"].cast("string"))), ",")
    return out.select("o_orderkey", F.size("kids").cast("long").alias("n_lines"), text.alias("lines"))


@plan("""
WITH codes AS (SELECT c_custkey, CASE WHEN c_custkey % 17 <> 0 THEN reverse(lpad(CAST(c_custkey * 37 % 100003 AS VARCHAR), 6, '0')) END AS code FROM customer),
heads AS (SELECT left(code, 1 + c_custkey // 7 % 5) AS prefix, min(c_custkey) AS head FROM codes WHERE c_custkey % 7 = 0 AND code IS NOT NULL GROUP BY 1),
r AS (SELECT c_custkey, prefix, head, row_number() OVER (PARTITION BY c_custkey ORDER BY length(prefix) DESC) AS n FROM codes LEFT JOIN heads ON starts_with(code, prefix))
SELECT c_custkey, length(prefix) AS length, head FROM r WHERE n = 1
""")
def prefix_lookup(t: Tables) -> DataFrame:
    """Codes looked up in a table of prefixes of several lengths: the longest one counts."""
    number = F.lpad((F.col("c_custkey") * 37 % 100003).cast("string"), 6, "0")
    codes = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 17 != 0, F.reverse(number)).alias("code"))
    length = (1 + F.floor(F.col("c_custkey") / 7) % 5).cast("int")
    heads = codes.filter("c_custkey % 7 = 0").withColumn("prefix", F.left("code", length))
    found = J.longest_prefix(codes, "code", heads.select("prefix", F.struct(F.col("c_custkey").alias("head"), F.length("prefix").cast("long").alias("length")).alias("v")), "prefix", "v")
    return found.select("c_custkey", "v.length", "v.head")


@plan("""
SELECT c_custkey FROM customer WHERE (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) OR EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey AND s_acctbal > 5000))
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def exists_or(t: Tables) -> DataFrame:
    """Either of two existences and not a third: one aggregate of flags and a key set."""
    flags = t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_totalprice") > 400000).alias("big"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    rich = t.supplier.filter("s_acctbal > 5000").select("s_suppkey").distinct()
    out = t.customer.join(flags, F.col("c_custkey") == F.col("o_custkey"), "left").join(rich, F.col("c_custkey") == F.col("s_suppkey"), "left")
    no = F.lit(False)
    return out.filter((F.coalesce("big", no) | F.col("s_suppkey").isNotNull()) & ~F.coalesce("urgent", no)).select("c_custkey")


@plan("""
WITH rules AS (SELECT * FROM (VALUES (1, ['small', 'ring']), (2, ['red']), (3, ['widget'])) v(rule, terms)),
ids AS (SELECT p_partkey, regexp_extract(p_brand, '#(\\d+)$', 1) AS n, p_name FROM part),
hits AS (SELECT p_partkey, 0 AS rule, 1.0 AS confidence FROM ids WHERE CAST(n AS INTEGER) <= 3
  UNION ALL SELECT p_partkey, rule, 0.9 FROM ids, rules WHERE len(list_filter(terms, lambda x: contains(lower(p_name), x))) = len(terms)),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY rule) AS rn FROM hits)
SELECT p_partkey, CAST(rule AS INTEGER) AS rule, CAST(confidence AS DOUBLE) AS confidence FROM r WHERE rn = 1
""")
def rule_match(t: Tables) -> DataFrame:
    """Rules in order: an id pattern, then terms that must all be contained."""
    name = F.lower("p_name")
    terms = [(1, ("small", "ring")), (2, ("red",)), (3, ("widget",))]
    rule = F.when(F.regexp_extract("p_brand", r"#(\d+)$", 1).try_cast("int") <= 3, 0)
    for n, words in terms:
        hit = F.lit(True)
        for w in words:
            hit &= F.contains(name, F.lit(w))
        rule = rule.when(hit, n)
    return t.part.select("p_partkey", rule.cast("int").alias("rule")).filter("rule is not null").withColumn("confidence", F.when(F.col("rule") == 0, 1.0).otherwise(0.9))


@plan("""
WITH m AS (SELECT o_orderkey AS fact, l_partkey AS node, CAST(max(1 - CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) AS c FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
e AS (SELECT p_partkey AS src, p_partkey // 3 * 2 AS dst, CASE p_size % 3 WHEN 0 THEN 'develops' WHEN 1 THEN 'repeals' ELSE 'amends' END AS rel FROM part),
pair AS (SELECT dst AS base, src AS target, 1 AS rule, 0.15 AS cost, 'via_' || rel AS method FROM e WHERE rel <> 'repeals' AND src <> dst
  UNION ALL SELECT a.src, b.src, CASE WHEN a.rel = b.rel THEN 2 ELSE 3 END, CASE WHEN a.rel = b.rel THEN 0.2 ELSE 0.25 END, CASE WHEN a.rel = b.rel THEN 'via_shared' ELSE 'via_mixed' END
    FROM e a JOIN e b ON a.dst = b.dst AND a.src <> b.src WHERE a.rel = 'repeals' OR b.rel = 'repeals'),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY base, target ORDER BY rule, method) AS rn FROM pair) WHERE rn = 1),
h AS (SELECT fact, node, c AS confidence, 0 AS rule, 'direct' AS method FROM m
  UNION ALL SELECT fact, target, greatest(c - cost::DOUBLE, 0.0), rule, method FROM m JOIN first ON node = base),
r AS (SELECT *, row_number() OVER (PARTITION BY fact, node ORDER BY confidence DESC, rule, method) AS rn FROM h)
SELECT fact, node, confidence, method FROM r WHERE rn = 1
""")
def graph_bridge(t: Tables) -> DataFrame:
    """Matches carried one hop along typed edges or over a shared node, at a penalty; the
    best way counts."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("fact"), F.col("l_partkey").alias("node"), (1 - F.col("l_discount").cast("decimal(12,2)")).cast("double").alias("confidence"))
    m = lines.join(t.orders, F.col("fact") == F.col("o_orderkey"), "left_semi")
    rel = F.when(F.col("p_size") % 3 == 0, "develops").when(F.col("p_size") % 3 == 1, "repeals").otherwise("amends")
    e = t.part.select(F.col("p_partkey").alias("src"), (F.floor(F.col("p_partkey") / 3) * 2).alias("dst"), rel.alias("relation"))
    return J.bridge(m, e, "fact", {"develops": 0.15, "amends": 0.15}, "repeals", 0.2, 0.25).select("fact", "node", "confidence", "method")


_TERMS = """
words AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM benchmark),
terms AS (SELECT DISTINCT term FROM words WHERE length(term) >= 7 UNION SELECT lower(p_name) FROM part)
"""


def _words(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("term"))


def _term_table(t: Tables) -> DataFrame:
    return _words(t).filter(F.length("term") >= 7).select("term").union(t.part.select("p_name"))


@plan(f"WITH {_TERMS} SELECT term, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents, terms WHERE contains(lower(text), term) GROUP BY term")
def term_table(t: Tables) -> DataFrame:
    """Which texts contain which terms of a table of thousands, in one scan."""
    found = K.found_terms(t.documents, _term_table(t), "doc_id", "text", "term")
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


@plan("""
WITH words AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM benchmark),
asked AS (SELECT DISTINCT item_id, term FROM words WHERE length(term) >= 9),
met AS (SELECT doc_id, item_id, count(*) AS n FROM documents, asked WHERE contains(lower(text), term) GROUP BY ALL),
whole AS (SELECT doc_id, met.item_id FROM met JOIN (SELECT item_id, count(*) AS n FROM asked GROUP BY 1) s ON s.item_id = met.item_id AND s.n = met.n)
SELECT doc_id, count(*) AS n_rules, min(item_id) AS first_rule FROM whole GROUP BY doc_id
""")
def rule_table(t: Tables) -> DataFrame:
    """Rules of a table, each a set of terms that a text must contain all of; the first one
    of each text and how many there are."""
    rules = _words(t).filter(F.length("term") >= 9)
    found = K.found_terms(t.documents, rules, "doc_id", "text", "term")
    matched = K.matched_rules(found, rules, "doc_id", "item_id", "term")
    return matched.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rules")).join(K.first_rule(matched, "doc_id", "item_id").withColumnRenamed("item_id", "first_rule"), "doc_id")
