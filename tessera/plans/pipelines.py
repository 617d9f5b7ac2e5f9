"""End-to-end snapshots composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import merge as M
from ..operators import windows as W
from .positions import _EVIDENCE, _POSITIONS, _VOTES, evidence, votes
from .registry import Tables, plan


@plan(f"""
WITH {_VOTES}, ev AS (SELECT scope, topic, event, count(*) FILTER (WHERE choice = 'yes') AS y, count(*) FILTER (WHERE choice = 'no') AS n, count(*) FILTER (WHERE choice <> 'absent') AS p FROM votes GROUP BY ALL),
s AS (SELECT scope, topic, count(*) AS n_events, CAST(sum(CASE WHEN y + n > 0 THEN CAST(p * (1 - abs(y - n) / (y + n)) AS DECIMAL(18,8)) ELSE 0 END) AS DOUBLE) AS stakes FROM ev GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY stakes DESC, topic) AS place FROM s)
SELECT r_name AS scope, topic, n_events, stakes, CAST(place AS INTEGER) AS place, place <= 2 AS is_high FROM r JOIN region ON r_regionkey = scope WHERE place <= 5
""")
def topic_set_by_scope(t: Tables) -> DataFrame:
    """The topics of each scope by what was at stake, the first flagged."""
    ev = votes(t).groupBy("scope", "topic", "event").agg(F.count_if(F.col("choice") == "yes").alias("y"), F.count_if(F.col("choice") == "no").alias("n"), F.count_if(F.col("choice") != "absent").alias("p"))
    both = F.col("y") + F.col("n")
    close = F.when(both > 0, (F.col("p") * (1 - F.abs(F.col("y") - F.col("n")) / both)).cast("decimal(18,8)")).otherwise(F.lit(0).cast("decimal(18,8)"))
    s = ev.groupBy("scope", "topic").agg(F.count(F.lit(1)).alias("n_events"), F.sum(close).cast("double").alias("stakes"))
    top = J.best_row(s, ["scope"], [F.desc("stakes"), F.asc("topic")], k=5, rank="place")
    return top.join(t.region, F.col("scope") == F.col("r_regionkey")).select(F.col("r_name").alias("scope"), "topic", "n_events", "stakes", "place", (F.col("place") <= 2).alias("is_high"))


@plan(f"""
WITH {_VOTES}, ev AS (SELECT event, count(*) FILTER (WHERE choice = 'yes') AS y, count(*) FILTER (WHERE choice = 'no') AS n FROM votes GROUP BY event),
side AS (SELECT event, party, count(*) FILTER (WHERE choice = 'yes') AS y, count(*) FILTER (WHERE choice = 'no') AS n FROM votes GROUP BY ALL),
en AS (SELECT votes.*, CASE WHEN y + n = 0 THEN NULL WHEN y > n THEN 'yes' WHEN n > y THEN 'no' ELSE 'tie' END AS m FROM votes JOIN side ON votes.event = side.event AND votes.party = side.party)
SELECT 'outcome' AS kind, CASE WHEN y + n = 0 THEN 'no_signal' WHEN y > n THEN 'passed' WHEN n > y THEN 'failed' ELSE 'tied' END AS key, count(*)::DOUBLE AS value FROM ev GROUP BY ALL
UNION ALL SELECT 'rebel_rate', n_name, CASE WHEN count(*) FILTER (WHERE choice IN ('yes', 'no')) > 0 THEN count(*) FILTER (WHERE choice IN ('yes', 'no') AND m IN ('yes', 'no') AND choice <> m) / count(*) FILTER (WHERE choice IN ('yes', 'no')) ELSE 0.0 END FROM en JOIN nation ON n_nationkey = party GROUP BY n_name
""")
def accountability_snapshot(t: Tables) -> DataFrame:
    """Outcomes and rebellion as one long table of facts."""
    v = votes(t)
    out = A.vote_counts(v, ["event"], "choice").groupBy(A.outcome(F.col("yes"), F.col("no")).alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    d = A.discipline(A.enriched_votes(v, "event", "party", "choice"), ["party"], "choice").join(t.nation, F.col("party") == F.col("n_nationkey"))
    return out.select(F.lit("outcome").alias("kind"), "key", "value").unionByName(d.select(F.lit("rebel_rate").alias("kind"), F.col("n_name").alias("key"), F.col("rebel_rate").alias("value")))


@plan("""
WITH m AS (SELECT o_orderpriority AS p, CAST(date_trunc('month', o_orderdate) AS DATE) AS at, count(*) AS v FROM orders WHERE (year(o_orderdate) * 12 + month(o_orderdate)) % 5 <> 0 GROUP BY ALL),
e AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d, o_orderkey FROM orders WHERE o_totalprice > 300000),
j AS (SELECT e.o_orderkey, max(a.at) AS pre, max_by(a.v, a.at) AS before FROM e JOIN m a ON a.p = e.p AND a.at < e.d GROUP BY ALL),
k AS (SELECT e.o_orderkey, min(b.at) AS post, min_by(b.v, b.at) AS after FROM e JOIN m b ON b.p = e.p AND b.at >= e.d GROUP BY ALL)
SELECT e.o_orderkey, e.p, before, after, CAST(e.d - pre AS INTEGER) AS pre_gap, CAST(post - e.d AS INTEGER) AS post_gap, after - before AS shift FROM e JOIN j USING (o_orderkey) JOIN k USING (o_orderkey) WHERE e.d - pre <= 45 AND post - e.d <= 25
""")
def policy_outcomes(t: Tables) -> DataFrame:
    """Events with the nearest points of their series at most so many days before and after
    them, and the shift; a fifth of the months have no point."""
    d = F.to_date("o_orderdate")
    points = t.orders.filter((F.year(d) * 12 + F.month(d)) % 5 != 0)
    m = points.groupBy(F.col("o_orderpriority").alias("p"), F.trunc(d, "month").alias("at")).agg(F.count(F.lit(1)).alias("v"))
    e = t.orders.filter("o_totalprice > 300000").select("o_orderkey", F.col("o_orderpriority").alias("p"), d.alias("d"))
    gap = lambda days: lambda fact, event: F.abs(F.datediff(event, fact)) <= days
    before = J.nearest_before(e, m, ["p"], "d", "at", ["v"], within=gap(45)).select("o_orderkey", "p", "d", F.col("v").alias("before"), F.col("at").alias("pre"))
    after = J.nearest_after(before, m, ["p"], "d", "at", ["v"], within=gap(25)).filter("pre IS NOT NULL AND at IS NOT NULL")
    return after.select("o_orderkey", "p", "before", F.col("v").alias("after"), F.datediff("d", "pre").alias("pre_gap"), F.datediff("at", "d").alias("post_gap"), (F.col("v") - F.col("before")).alias("shift"))


@plan("""
WITH l AS (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS b FROM lineitem GROUP BY 1),
s AS (SELECT o_orderpriority AS p, date_diff('day', CAST(o_orderdate AS DATE), a) AS first_days, date_diff('day', a, b) AS open_days FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
SELECT p, count(*) AS n, count(CASE WHEN first_days >= 0 THEN first_days END) AS n_known, quantile_cont(CASE WHEN first_days >= 0 THEN first_days END, 0.5) AS first_p50, quantile_cont(open_days, 0.9) AS open_p90,
  CASE WHEN quantile_cont(open_days, 0.9) > 600 THEN 'slow' ELSE 'normal' END AS verdict FROM s GROUP BY p
""")
def initiative_lifecycle(t: Tables) -> DataFrame:
    """Durations of stages; impossible ones are unknown; the slow groups are flagged."""
    line = t.lineitem.groupBy("l_orderkey").agg(F.min(F.to_date("l_shipdate")).alias("a"), F.max(F.to_date("l_shipdate")).alias("b"))
    s = t.orders.join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderpriority").alias("p"), F.datediff("a", F.to_date("o_orderdate")).alias("d"), F.datediff("b", "a").alias("open"))
    first = F.when(F.col("d") >= 0, F.col("d"))
    s = s.select("p", first.alias("first"), "open")
    known = A.quantiles(s, ["p"], "first", (0.5,)).select("p", F.col("n").alias("n_known"), F.col("p50").alias("first_p50"))
    g = s.groupBy("p").agg(F.count(F.lit(1)).alias("n")).join(known, "p").join(A.quantiles(s, ["p"], "open", (0.9,)).select("p", F.col("p90").alias("open_p90")), "p")
    return g.withColumn("verdict", F.when(F.col("open_p90") > 600, "slow").otherwise("normal"))


@plan("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = 1996 GROUP BY 1), b AS (SELECT c_nationkey AS k, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = 1997 AND c_nationkey <> 3 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.n = b.n THEN 'same' ELSE 'changed' END AS status, b.n - a.n AS change FROM a FULL JOIN b ON a.k = b.k
""")
def index_changelog(t: Tables) -> DataFrame:
    """An index of two periods, compared, with the change of each entry."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.year("o_orderdate").alias("y"), F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    a, b = o.filter("y = 1996").select("k", "n"), o.filter("y = 1997 AND k <> 3").select("k", "n")
    both = a.withColumnRenamed("n", "before").join(b.withColumnRenamed("n", "after"), "k", "full")
    return M.snapshot_diff(a, b, ["k"], ["n"]).join(both, "k").select("k", "status", (F.col("after") - F.col("before")).alias("change"))


@plan(f"""
WITH {_EVIDENCE}, {_POSITIONS}, p AS (SELECT s_nationkey AS party, topic, avg(score) AS m, count(*) AS n FROM scored JOIN supplier ON person = s_suppkey GROUP BY ALL),
g AS (SELECT n_nationkey AS party, tp.topic FROM nation CROSS JOIN (SELECT DISTINCT topic FROM p) tp)
SELECT CASE WHEN n IS NULL THEN 'no_signal' WHEN m > 0.2 THEN 'support' WHEN m < -0.2 THEN 'oppose' ELSE 'unclear' END AS stance, count(*) AS cells, CAST(coalesce(sum(n), 0) AS BIGINT) AS people FROM g LEFT JOIN p ON p.party = g.party AND p.topic = g.topic GROUP BY 1
""")
def citizen_grid(t: Tables) -> DataFrame:
    """The grid of groups and topics with a stance in every cell, summed up."""
    pos = A.weighted_stance(evidence(t), ["person", "topic"], "polarity", "w", "c").join(t.supplier, F.col("person") == F.col("s_suppkey"))
    p = pos.groupBy(F.col("s_nationkey").alias("party"), "topic").agg(F.avg("score").alias("m"), F.count(F.lit(1)).alias("n"))
    stats = p.select("party", "topic", A.stance(F.col("m")).alias("stance"), "n")
    grid = J.full_grid(t.nation.select(F.col("n_nationkey").alias("party")), p.select("topic").distinct(), stats, ["party", "topic"], {"stance": "no_signal", "n": 0})
    return grid.groupBy("stance").agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("people"))


@plan("""
WITH o AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS kinds FROM orders GROUP BY 1),
l AS (SELECT * FROM (SELECT o_custkey AS k, o_orderkey AS last_order, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1)
SELECT c_custkey, c_name, n_name, coalesce(n, 0) AS n_orders, coalesce(f, 0) AS n_done, coalesce(total, 0.0) AS total, coalesce(kinds, '') AS kinds, last_order, CASE WHEN coalesce(n, 0) = 0 THEN 1 WHEN c_acctbal < 0 THEN 2 ELSE 3 END AS priority
FROM customer LEFT JOIN o ON o.k = c_custkey LEFT JOIN l ON l.k = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def people_profiles(t: Tables) -> DataFrame:
    """A profile of each person: counts, kinds, latest fact, priority for review."""
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.sum(F.col("o_totalprice").cast("decimal(15,2)")).cast("double").alias("t"),
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("kinds"),
        F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"),
    )
    p = t.customer.join(o, "c_custkey", "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    zero = F.lit(0).cast("long")
    return p.select("c_custkey", "c_name", "n_name", F.coalesce("n", zero).alias("n_orders"), F.coalesce("f", zero).alias("n_done"), F.coalesce("t", F.lit(0.0)).alias("total"), F.coalesce("kinds", F.lit("")).alias("kinds"), "last_order", F.when(F.coalesce("n", zero) == 0, 1).when(F.col("c_acctbal") < 0, 2).otherwise(3).alias("priority"))


@plan("""
WITH raw AS (SELECT o_orderkey, 'contract ' || o_orderkey || ' for roads' AS title, CAST(CAST(o_totalprice AS INTEGER) AS VARCHAR) || ',50 EUR' AS amount, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL SELECT o_orderkey, 'grant ' || o_orderkey || ' for health', CAST(CAST(o_totalprice AS INTEGER) AS VARCHAR) || '.25', CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 2 = 1)
SELECT CASE WHEN contains(title, 'road') THEN 'transport' WHEN contains(title, 'health') THEN 'health' ELSE 'other' END AS domain, year(d) AS y, count(*) AS n,
  CAST(sum(CAST(CASE WHEN contains(amount, ',') THEN replace(replace(amount, ' EUR', ''), ',', '.') ELSE amount END AS DECIMAL(15,2))) AS DOUBLE) AS total FROM raw GROUP BY ALL
""".replace("year(d) AS y", "CAST(year(d) AS INTEGER) AS y"))
def money_events(t: Tables) -> DataFrame:
    """Contracts and grants with amounts in two notations, by inferred domain and year."""
    n = F.rint("o_totalprice").cast("int").cast("string")
    key = F.col("o_orderkey").cast("string")
    a = t.orders.filter("o_orderkey % 2 = 0").select(F.concat(F.lit("contract "), key, F.lit(" for roads")).alias("title"), F.concat(n, F.lit(",50 EUR")).alias("amount"), "o_orderdate")
    b = t.orders.filter("o_orderkey % 2 = 1").select(F.concat(F.lit("grant "), key, F.lit(" for health")).alias("title"), F.concat(n, F.lit(".25")).alias("amount"), "o_orderdate")
    domain = S.first_keyword("title", [("transport", ("road",)), ("health", ("health",))])
    return a.unionByName(b).groupBy(domain.alias("domain"), F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.sum(S.european_amount("amount").cast("decimal(15,2)")).cast("double").alias("total"))


@plan("""
WITH old AS (SELECT o_orderpriority AS series, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS d, count(*) AS v FROM orders WHERE year(o_orderdate) <= 1996 GROUP BY ALL),
new AS (SELECT o_orderpriority AS series, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS d, count(*) * 10 AS v FROM orders WHERE year(o_orderdate) >= 1996 GROUP BY ALL)
SELECT coalesce(new.series, old.series) AS series, CAST(coalesce(new.d, old.d) AS VARCHAR) AS d, coalesce(new.v, old.v) AS v FROM old FULL JOIN new ON old.series = new.series AND old.d = new.d
""")
def indicator_series(t: Tables) -> DataFrame:
    """Points of series under harmonised dates, newer ones replacing older."""
    quarter = F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate"))
    p = lambda df, factor: df.groupBy(F.col("o_orderpriority").alias("series"), quarter.alias("q")).agg((F.count(F.lit(1)) * factor).alias("v")).select("series", S.period_start("q").alias("d"), "v")
    out = M.upsert(p(t.orders.filter(F.year("o_orderdate") <= 1996), 1), p(t.orders.filter(F.year("o_orderdate") >= 1996), 10), ["series", "d"])
    return out.withColumn("d", F.col("d").cast("string"))


@plan("""
WITH r AS (SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 30) AS n_big, epoch_us(max(ts)) AS last_us, arg_max(value, epoch_us(ts)) AS last_value FROM events GROUP BY 1)
SELECT *, CASE WHEN n_big = 0 THEN 'failed' WHEN n_big * 4 < n THEN 'degraded' ELSE 'ok' END AS status FROM r
UNION ALL SELECT 'ALL', CAST(sum(n) AS BIGINT), CAST(sum(n_big) AS BIGINT), max(last_us), NULL, 'total' FROM r
""")
def source_status(t: Tables) -> DataFrame:
    """A dashboard row for each source and one for all."""
    g = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 30).alias("n_big"), S.micros(F.max("ts")).alias("last_us"), F.max_by("value", "ts").alias("last_value"))
    g = g.withColumn("status", F.when(F.col("n_big") == 0, "failed").when(F.col("n_big") * 4 < F.col("n"), "degraded").otherwise("ok"))
    total = g.agg(F.lit("ALL").alias("event_type"), F.sum("n").alias("n"), F.sum("n_big").alias("n_big"), F.max("last_us").alias("last_us"), F.lit(None).cast("double").alias("last_value"), F.lit("total").alias("status"))
    return g.unionByName(total)


@plan("""
SELECT DISTINCT 'node' AS kind, 'nation:' || n_nationkey AS a, n_name AS b, 0::BIGINT AS weight FROM nation JOIN supplier ON s_nationkey = n_nationkey
UNION ALL SELECT 'edge', 'nation:' || s_nationkey, 'nation:' || c_nationkey, count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN customer ON c_custkey = o_custkey WHERE l_quantity > 40 GROUP BY ALL
""")
def mandate_graph(t: Tables) -> DataFrame:
    """Nodes and weighted edges of a graph in one table."""
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("f"))
    c = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("l_orderkey"), F.col("c_nationkey").alias("g"))
    e = t.lineitem.filter("l_quantity > 40").join(s, "l_suppkey").join(c, "l_orderkey").groupBy("f", "g").agg(F.count(F.lit(1)).alias("weight"))
    name = lambda k: F.concat(F.lit("nation:"), F.col(k).cast("string"))
    nodes = t.nation.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select(F.lit("node").alias("kind"), name("n_nationkey").alias("a"), F.col("n_name").alias("b"), F.lit(0).cast("long").alias("weight"))
    return nodes.unionByName(e.select(F.lit("edge").alias("kind"), name("f").alias("a"), name("g").alias("b"), "weight"))


@plan(f"""
WITH {_VOTES}, page AS (SELECT DISTINCT event FROM votes ORDER BY event DESC LIMIT 20 OFFSET 10), g AS (SELECT event, party, count(*) FILTER (WHERE choice = 'yes') AS y, count(*) FILTER (WHERE choice = 'no') AS n FROM votes JOIN page USING (event) GROUP BY ALL)
SELECT event, (SELECT count(DISTINCT event) FROM votes) AS n_all, string_agg(party || '=' || y || '/' || n, ',' ORDER BY party) AS parties FROM g GROUP BY event
""")
def vote_summary_page(t: Tables) -> DataFrame:
    """A page of events with the counts of each group and the number of all events."""
    v = votes(t)
    events = v.select("event").distinct()
    page = events.orderBy(F.desc("event")).offset(10).limit(20)
    total = events.agg(F.count(F.lit(1)).alias("n_all"))
    g = A.vote_counts(v.join(F.broadcast(page), "event", "left_semi"), ["event", "party"], "choice")
    cell = F.concat(F.col("party").cast("string"), F.lit("="), F.col("yes").cast("string"), F.lit("/"), F.col("no").cast("string"))
    parts = F.array_sort(F.collect_list(F.struct("party", cell.alias("x"))))
    return g.groupBy("event").agg(F.array_join(F.transform(parts, lambda p: p["x"]), ",").alias("parties")).join(total, F.lit(True)).select("event", "n_all", "parties")


@plan("""
WITH d AS (SELECT page_id, url, length(html) AS size, page_id % 7 = 0 AS missing FROM pages), b AS (SELECT item_id FROM benchmark)
SELECT page_id, CAST(row_number() OVER (ORDER BY CASE WHEN missing THEN 0 WHEN item_id IS NOT NULL THEN 1 ELSE 2 END, size, page_id) AS INTEGER) AS place FROM d LEFT JOIN b ON item_id = page_id QUALIFY place <= 60
""")
def fetch_queue(t: Tables) -> DataFrame:
    """What to fetch next: missing first, then referenced, smallest first."""
    known = t.benchmark.select(F.col("item_id").alias("_b")).distinct()
    d = t.pages.select("page_id", F.length("html").alias("size"), (F.col("page_id") % 7 == 0).alias("missing")).join(known, F.col("page_id") == F.col("_b"), "left")
    order = [F.when(F.col("missing"), 0).when(F.col("_b").isNotNull(), 1).otherwise(2), F.col("size"), F.col("page_id")]
    top = d.orderBy(*order).limit(60)
    return top.select("page_id", F.row_number().over(Window.orderBy(*order)).alias("place"))


@plan("""
WITH k AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') / count(*) AS errors FROM events GROUP BY 1),
s AS (SELECT day, n, errors, CASE WHEN errors > 0.22 THEN 'failed' WHEN errors > 0.2 THEN 'degraded' ELSE 'ok' END AS status FROM k)
SELECT day, n, errors, status, CAST(count(*) FILTER (WHERE status = 'failed') OVER (ORDER BY day ROWS 6 PRECEDING) AS BIGINT) AS failed_week, errors - lag(errors) OVER (ORDER BY day) AS drift FROM s
""")
def heartbeat(t: Tables) -> DataFrame:
    """Daily figures, their status, a sliding count of failures and the drift."""
    g = t.events.groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), S.ratio(F.count_if(F.col("event_type") == "error"), F.count(F.lit(1))).alias("errors"))
    g = g.withColumn("status", F.when(F.col("errors") > 0.22, "failed").when(F.col("errors") > 0.2, "degraded").otherwise("ok"))
    day = Window.orderBy("day")  # one row a day
    return g.withColumns({"failed_week": F.count_if(F.col("status") == "failed").over(day.rowsBetween(-6, 0)), "drift": F.col("errors") - F.lag("errors").over(day)})


@plan("""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders), t AS (SELECT c_nationkey AS territory, count(*) AS seats FROM p JOIN customer ON c_custkey = o_custkey WHERE r = 1 GROUP BY 1),
k AS (SELECT territory, seats, seats * 100.0 / sum(seats) OVER () AS share FROM t)
SELECT r_name, n_name, seats, share FROM k JOIN nation ON n_nationkey = territory JOIN region ON r_regionkey = n_regionkey
""")
def territory_seats(t: Tables) -> DataFrame:
    """Seats of each territory with its share and its place in the hierarchy."""
    one = J.best_row(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    s = one.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("territory")).agg(F.count(F.lit(1)).alias("seats"))
    total = s.agg(F.sum("seats").alias("_all"))
    k = s.join(F.broadcast(total), F.lit(True)).withColumn("share", F.col("seats") * 100.0 / F.col("_all"))
    return k.join(t.nation, F.col("territory") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name", "seats", "share")


@plan("""
WITH m AS (SELECT o_orderpriority AS p, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, count(*) AS v FROM orders GROUP BY ALL), x AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY d DESC) AS age, lag(v) OVER (PARTITION BY p ORDER BY d) AS before FROM m)
SELECT p, CAST(d AS VARCHAR) AS d, v, before, coalesce((v - before) * 100.0 / nullif(before, 0), 0.0) AS pct FROM x WHERE age <= 6
""")
def kpi_drift(t: Tables) -> DataFrame:
    """The newest points of each indicator with their change."""
    m = t.orders.groupBy(F.col("o_orderpriority").alias("p"), F.trunc("o_orderdate", "month").alias("d")).agg(F.count(F.lit(1)).alias("v"))
    x = W.delta(m, ["p"], [F.asc("d")], "v")
    return W.tail(x, ["p"], [F.desc("d")], 6).select("p", F.col("d").cast("string").alias("d"), "v", F.col("previous").alias("before"), F.coalesce("change_pct", F.lit(0.0)).alias("pct"))
