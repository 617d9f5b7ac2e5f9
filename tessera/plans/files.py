"""Readers and writers over files made from the tables, in a new shared folder each time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import quality as Q
from ..sources import connectors as C
from ..sources import readers as R
from ..sources import sinks as K
from ..streaming.streams import folder
from .registry import Tables, plan


@plan("""
SELECT event_id % 50 = 7 AS malformed, CASE WHEN event_id % 50 <> 7 THEN event_id END AS event_id, CASE WHEN event_id % 50 <> 7 THEN event_type END AS event_type, CASE WHEN event_id % 50 <> 7 THEN value END AS value,
  CASE WHEN event_id % 50 = 7 THEN '{"event_id":' || event_id END AS kept_raw FROM events
""")
def jsonl_scan(t: Tables) -> DataFrame:
    """JSON lines, of which every fiftieth is cut off: it stays as a flagged row."""
    path = folder(t.spark)
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))
    t.events.select(F.when(F.col("event_id") % 50 == 7, cut).otherwise(whole)).write.text(path)
    rows = R.json_lines(t.spark, path, "event_id long, event_type string, value double")
    good = lambda c: F.when(~F.col("malformed"), F.col(c)).alias(c)
    return rows.select("malformed", good("event_id"), good("event_type"), good("value"), F.when(F.col("malformed"), F.col("raw")).alias("kept_raw"))


@plan("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def json_scan(t: Tables) -> DataFrame:
    """One JSON document for each region, its records under a field of another name."""
    path = folder(t.spark)
    record = F.to_json(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey")))
    docs = t.nation.groupBy("n_regionkey").agg(record.alias("a"))
    fields = F.array(*[F.lit(f) for f in ("results", "items", "data", "rows")])
    named = F.concat(F.lit('{"'), F.get(fields, F.col("n_regionkey").cast("int")), F.lit('":'), F.col("a"), F.lit("}"))
    docs.select(F.col("n_regionkey").alias("file"), F.coalesce(named, "a").alias("value")).write.partitionBy("file").text(path)
    return R.json_records(t.spark, f"{path}/file=*", "n_nationkey long, n_name string, n_regionkey long").select("n_nationkey", "n_name", "n_regionkey")


@plan("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def csv_scan(t: Tables) -> DataFrame:
    """A CSV export read back: separator found, columns conformed to their types."""
    path = folder(t.spark)
    K.export_csv(t.customer.select(F.col("c_custkey").alias("key"), "c_name", "c_nationkey", "c_acctbal"), path)
    return R.conform(R.csv_records(t.spark, path), "c_custkey long, c_name string, c_nationkey long, c_acctbal double", {"c_custkey": ("key",)})


@plan("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def xml_scan(t: Tables) -> DataFrame:
    """Elements of XML files, read by their local names."""
    path = folder(t.spark)
    t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").write.format("xml").option("rowTag", "supplier").option("rootTag", "suppliers").save(path)
    return R.xml_records(t.spark, path, "supplier", "s_suppkey long, s_name string, s_nationkey long, s_acctbal double").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@plan("""
SELECT 'pages' AS source_id, content_sha256, count(*) AS n_pages, min(page_id) AS first_page FROM (SELECT page_id, sha256(html) AS content_sha256 FROM pages) GROUP BY 2
""")
def raw_landing(t: Tables) -> DataFrame:
    """Payloads landed once for each content hash, with the ledger of what was fetched."""
    landed = R.landed(t.pages.select("html"), "html", "pages").select("source_id", "content_sha256")
    fetched = t.pages.groupBy(F.sha2("html", 256).alias("content_sha256")).agg(F.count(F.lit(1)).alias("n_pages"), F.min("page_id").alias("first_page"))
    return landed.join(fetched, "content_sha256").select("source_id", "content_sha256", "n_pages", "first_page")


@plan("""
SELECT o_orderpriority, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderpriority <> '2-HIGH'
""")
def slice_recompute(t: Tables) -> DataFrame:
    """Two slices computed anew, one of which comes out empty; the others stay."""
    path = folder(t.spark)
    rows = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    K.write_slice(rows, path, ["o_orderpriority"])
    again = rows.filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    K.write_slice(again, path, ["o_orderpriority"], t.spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "o_orderpriority string"))
    return t.spark.read.schema(rows.schema).parquet(path)


@plan("""
SELECT 'first' AS step, true AS written, (SELECT count(*) FROM part) AS n_rows UNION ALL SELECT 'other order', false, (SELECT count(*) FROM part) UNION ALL SELECT 'one less', true, (SELECT count(*) - 1 FROM part)
""")
def snapshot_if_changed(t: Tables) -> DataFrame:
    """A JSON snapshot is written only if its rows differ from the ones known."""
    path, parts = folder(t.spark), t.part.select("p_partkey", "p_name", "p_retailprice")
    least = t.part.agg(F.min("p_partkey")).first()[0]
    steps, known = [], None
    for step, rows in (("first", parts), ("other order", parts.orderBy(F.desc("p_name"))), ("one less", parts.filter(F.col("p_partkey") != least))):
        written, known = K.write_if_changed(rows, path, known=known)
        steps.append((step, written, t.spark.read.schema(parts.schema).json(path).count()))
    return t.spark.createDataFrame(steps, "step string, written boolean, n_rows long")


@plan("""
SELECT 'region' AS table_name, count(*) AS n_rows, 3 AS n_columns, sum(r_regionkey)::BIGINT AS key_sum FROM (SELECT r_regionkey FROM region)
UNION ALL SELECT 'supplier', count(*), 3, sum(s_suppkey)::BIGINT FROM supplier UNION ALL SELECT 'none', 0, 3, NULL
""")
def export_manifest(t: Tables) -> DataFrame:
    """Tables exported with a manifest, empty ones with their schema, and read back."""
    path = folder(t.spark)
    tables = {"region": t.region.select("r_regionkey", "r_name", F.lit(1).alias("v")), "supplier": t.supplier.select("s_suppkey", "s_name", "s_nationkey")}
    tables["none"] = tables["supplier"].limit(0)
    manifest = t.spark.createDataFrame([(m["table"], m["rows"], len(m["schema"]["fields"])) for m in K.export_parquet(tables, path, {"supplier": ["s_suppkey"]})], "table_name string, n_rows long, n_columns int")
    sums = None
    for name in tables:
        back = t.spark.read.parquet(f"{path}/{name}")
        one = back.agg(F.lit(name).alias("table_name"), F.sum(back.columns[0]).cast("long").alias("key_sum"))
        sums = one if sums is None else sums.unionByName(one)
    return manifest.join(sums, "table_name")


@plan("""
SELECT 'r1' AS run_id, 'ok' AS status, count(*) AS n_rows, count(*) AS n_published FROM orders UNION ALL SELECT 'r2', 'failed', 0, count(*) FROM orders
UNION ALL SELECT 'r3', 'failed', NULL, count(*) FROM orders UNION ALL SELECT 'r4', 'ok', count(*), count(*) FROM customer
""")
def run_ledger(t: Tables) -> DataFrame:
    """Loads that go in whole or not at all, with a ledger: one has too few rows, one fails."""
    base = folder(t.spark)
    loads = [
        ("r1", lambda: t.orders.select("o_orderkey")),
        ("r2", lambda: t.orders.select("o_orderkey").limit(0)),
        ("r3", lambda: t.spark.read.parquet(f"{base}/missing")),
        ("r4", lambda: t.customer.select(F.col("c_custkey").alias("o_orderkey"))),
    ]
    published = []
    for run_id, load in loads:
        K.recorded(t.spark, f"{base}/ledger", run_id, "orders", load, f"{base}/staged", f"{base}/target", least=1)
        published.append((run_id, t.spark.read.parquet(f"{base}/target").count()))
    counts = t.spark.createDataFrame(published, "run_id string, n_published long")
    return t.spark.read.parquet(f"{base}/ledger").select("run_id", "status", F.col("rows").alias("n_rows")).join(counts, "run_id")


@plan("""
SELECT c_custkey, CASE WHEN upper(left(trim(c_mktsegment), 1)) BETWEEN 'A' AND 'Z' THEN upper(left(trim(c_mktsegment), 1)) ELSE 'OTROS' END AS initial,
  CASE c_custkey % 3 WHEN 0 THEN '0-9' WHEN 1 THEN 'E' ELSE 'OTROS' END AS code_initial,
  CASE WHEN c_custkey % 7 = 0 OR c_acctbal <= 0 THEN 'none' WHEN c_acctbal / 10000 >= 0.8 THEN 'high' WHEN c_acctbal / 10000 >= 0.5 THEN 'medium' ELSE 'low' END AS band,
  CASE WHEN c_acctbal < 0 THEN 0.0 WHEN c_acctbal > 10000 THEN 1.0 ELSE c_acctbal / 10000 END AS share FROM customer
""")
def initials_and_bands(t: Tables) -> DataFrame:
    """Index letters of names, bands of confidence, and shares kept between 0 and 1."""
    share = F.col("c_acctbal") / 10000
    key = F.col("c_custkey") % 3
    code = F.when(key == 0, F.concat(F.lit("#"), F.col("c_custkey").cast("string"))).when(key == 1, "¿É1").otherwise("- ?")
    stance = F.when(F.col("c_custkey") % 7 == 0, "no_signal").otherwise("support")
    return t.customer.select("c_custkey", S.initial_bucket("c_mktsegment").alias("initial"), S.initial_bucket(code).alias("code_initial"), S.confidence_band(share, stance=stance).alias("band"), S.clamp01(share).alias("share"))


@plan("SELECT n_nationkey, n_name FROM nation")
def required_rows(t: Tables) -> DataFrame:
    """A table that has the rows it must have and no web pages among its payloads."""
    return Q.require_rows(R.refuse_html(t.nation.select("n_nationkey", "n_name"), "n_name"), 25)


@plan("""
SELECT 'regions' AS source_id, CAST(n_regionkey AS VARCHAR) AS part, count(*) AS n, CAST(sum(n_nationkey) AS DOUBLE) AS total FROM nation GROUP BY n_regionkey
UNION ALL SELECT 'events', event_type, count(*), CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) FROM events WHERE event_id % 100 <> 7 GROUP BY event_type
UNION ALL SELECT 'events', 'malformed', count(*), NULL FROM events WHERE event_id % 100 = 7
UNION ALL SELECT 'cube', o_orderstatus || o_orderpriority, 1, count(*) FROM orders GROUP BY o_orderstatus, o_orderpriority
""")
def connector_scan(t: Tables) -> DataFrame:
    """Paged documents, lines and cubes made from the tables, read by their connectors."""
    base = folder(t.spark)
    C.register(t.spark)

    def pages(df: DataFrame, name: str, ending: str) -> DataFrame:
        """One file for each row of page and doc, read back by a connector."""
        df.coalesce(1).foreachPartition(lambda rows, path=f"{base}/{name}": C.land(path, ((f"{r.page}{ending}", r.doc) for r in rows)))
        kind = {"regions": "paged_json", "events": "json_lines", "cube": "stat_cube"}[name]
        return t.spark.read.format(kind).option("source_id", name).load(f"{base}/{name}")

    nations = F.to_json(F.struct(F.lit(0).alias("count"), F.collect_list(F.struct("n_nationkey", "n_regionkey")).alias("nations")))
    regions = pages(t.nation.groupBy(F.col("n_regionkey").cast("string").alias("page")).agg(nations.alias("doc")), "regions", ".json")
    r = regions.select("source_id", F.from_json("record", "n_nationkey long, n_regionkey string").alias("r")).groupBy("source_id", F.col("r.n_regionkey").alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("r.n_nationkey").cast("double").alias("total"))

    line = F.when(F.col("event_id") % 100 == 7, F.lit("{cut off")).otherwise(F.to_json(F.struct("event_type", "value")))
    lines = t.events.groupBy((F.col("event_id") % 50).cast("string").alias("page")).agg(F.array_join(F.collect_list(line), "\n").alias("doc"))
    e = pages(lines, "events", ".jsonl").select("source_id", F.from_json("record", "event_type string, value double, _malformed string").alias("r"))
    e = e.groupBy("source_id", F.coalesce("r.event_type", F.lit("malformed")).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("r.value").cast("decimal(18,2)")).cast("double").alias("total"))

    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("v"))
    axis = lambda c: counts.agg(F.array_sort(F.collect_set(c)).alias(c))
    cells = counts.join(axis("o_orderstatus").withColumnRenamed("o_orderstatus", "a"), F.lit(True)).join(axis("o_orderpriority").withColumnRenamed("o_orderpriority", "b"), F.lit(True))
    flat = ((F.array_position("a", F.col("o_orderstatus")) - 1) * F.size("b") + F.array_position("b", F.col("o_orderpriority")) - 1).cast("string")
    index = lambda c: F.struct(F.struct(F.col(c).alias("index")).alias("category"))
    doc = F.to_json(F.struct(F.array(F.lit("a"), F.lit("b")).alias("id"), F.array(F.size("a"), F.size("b")).alias("size"), F.struct(index("a").alias("a"), index("b").alias("b")).alias("dimension"), F.col("value")))
    cube = cells.groupBy("a", "b").agg(F.map_from_entries(F.collect_list(F.struct(flat, "v"))).alias("value")).select(F.lit("cube").alias("page"), doc.alias("doc"))
    c = pages(cube, "cube", ".json").select("source_id", F.from_json("record", "a string, b string, value double").alias("r")).select("source_id", F.concat("r.a", "r.b").alias("part"), F.lit(1).cast("long").alias("n"), F.col("r.value").alias("total"))
    return r.unionByName(e).unionByName(c)
