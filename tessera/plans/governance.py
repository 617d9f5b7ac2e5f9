"""Normalised codes, review decisions, redaction and validation of seeds and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import merge as M
from ..operators import quality as Q
from .registry import Tables, plan

_CHOICES = ("Sí", " a  favor ", "En contra", "Abstención", "no vota", "Ausente", "favorable", "", "quizás")
_SNAPSHOT = ("yes", "yes", "no", "abstain", "no_vote", "no_vote", "other", "other", "other")
_PAGE = ("yes", "yes", "no", "abstain", "no_vote", "ausente", "yes", "other", "quizas")


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@plan(f"SELECT l_orderkey, l_linenumber, l_partkey, {_list(_SNAPSHOT)}[l_partkey % 9 + 1] AS choice, {_list(_PAGE)}[l_partkey % 9 + 1] AS page_choice FROM lineitem")
def vote_choice_normalize(t: Tables) -> DataFrame:
    """Spellings of vote choices under both sets of rules."""
    raw = F.get(F.array(*[F.lit(c) for c in _CHOICES]), (F.col("l_partkey") % 9).cast("int"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", S.vote_choice(raw).alias("choice"), S.vote_choice(raw, "page").alias("page_choice"))


@plan("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Customer' END AS given, CASE WHEN c_custkey % 2 = 0 THEN split_part(c_name, '#', 2) END AS family,
  CASE WHEN c_custkey % 2 = 0 THEN 'Customer ' || split_part(c_name, '#', 2) ELSE replace(c_name, '#', ' ') END AS full, CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'U' END AS gender FROM customer
""")
def name_and_codes(t: Tables) -> DataFrame:
    """Names taken apart, and codes of spellings."""
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit(",  Customer"))).otherwise(F.replace("c_name", F.lit("#"), F.lit(" ")))
    spelled = F.get(F.array(F.lit("Mujér"), F.lit("hombre "), F.lit("?")), (F.col("c_custkey") % 3).cast("int"))
    code = S.mapped(spelled, {"mujer": "F", "hombre": "M"}, F.lit("U"))
    return t.customer.select("c_custkey", S.split_name(name).alias("n"), code.alias("gender")).select("c_custkey", "n.given", "n.family", "n.full", "gender")


@plan("""
WITH m AS (SELECT o_orderkey, o_custkey % 11 <> 0 AS seeded, count(l_orderkey) AS metrics, count(*) FILTER (WHERE l_quantity > 3) AS records, count(*) FILTER (WHERE l_quantity > 3 AND l_discount > 0.0) AS evidence, count(DISTINCT l_returnflag) AS covered
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_tax > 0.02 GROUP BY o_orderkey, o_custkey),
s AS (SELECT *, CASE WHEN NOT seeded THEN 'missing_source' WHEN metrics <= 0 THEN 'no_metrics' WHEN records < metrics THEN 'no_source_record_chain' WHEN evidence < metrics THEN 'no_evidence_chain' WHEN covered < 2 AND o_orderkey % 4 > 0 THEN 'partial_kpi_coverage' ELSE 'ready' END AS status FROM m)
SELECT o_orderkey, status, CASE status WHEN 'missing_source' THEN 'add_source_to_sanction_data_catalog_seed' WHEN 'no_metrics' THEN 'ingest_official_review_procedural_metrics' WHEN 'no_source_record_chain' THEN 'backfill_source_record_pk_for_official_review_metrics'
  WHEN 'no_evidence_chain' THEN 'backfill_evidence_date_quote_for_official_review_metrics' WHEN 'partial_kpi_coverage' THEN 'ingest_missing_kpis_for_source_scope' ELSE 'monitor_refresh' END AS action FROM s
""")
def queue_next_action(t: Tables) -> DataFrame:
    """State and next action of queue entries; a fourth of them expects no KPIs."""
    known = F.col("l_quantity") > 3
    m = t.lineitem.filter("l_tax > 0.02").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("metrics"), F.count_if(known).alias("records"), F.count_if(known & (F.col("l_discount") > 0)).alias("evidence"), F.countDistinct("l_returnflag").alias("covered"))
    rows = t.orders.select("o_orderkey", "o_custkey").join(m, "o_orderkey", "left").fillna(0, ["metrics", "records", "evidence", "covered"])
    expected = F.when(F.col("o_orderkey") % 4 > 0, 2).otherwise(0)
    status = S.queue_status(F.col("o_custkey") % 11 != 0, F.col("metrics"), F.col("records"), F.col("evidence"), F.col("covered"), expected)
    return rows.select("o_orderkey", status.alias("status"), S.next_action(status).alias("action"))


@plan("""
WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS v FROM customer)
SELECT c_custkey, CASE WHEN v IS NULL THEN 'UNTRACKED' WHEN v > 5000 THEN 'DONE' ELSE 'TODO' END AS is_true, CASE WHEN v IS NULL THEN 'UNTRACKED' WHEN v > 0 THEN 'DONE' ELSE 'TODO' END AS has_balance,
  CASE WHEN v IS NULL THEN 'UNTRACKED' WHEN v >= 5000 THEN 'DONE' WHEN v > 0 THEN 'PARTIAL' ELSE 'TODO' END AS is_rich, CASE WHEN v IS NULL THEN 'UNTRACKED' WHEN v <= 4000 THEN 'DONE' WHEN v <= 6000 THEN 'PARTIAL' ELSE 'TODO' END AS is_small,
  CASE WHEN v IS NULL THEN 'UNTRACKED' WHEN v <= 0 THEN 'DONE' ELSE 'TODO' END AS is_none FROM x
""")
def metric_checks(t: Tables) -> DataFrame:
    """Truth, presence, least and greatest values; a ninth of the values is missing."""
    v = F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal"))
    checks = {"is_true": S.metric_check(v > 5000, "bool_true"), "has_balance": S.metric_check(v, "presence"), "is_rich": S.metric_check(v, "gte", 5000.0), "is_small": S.metric_check(v, "max", 4000.0), "is_none": S.metric_check(v, "max", 0.0)}
    return t.customer.select("c_custkey", *[c.alias(n) for n, c in checks.items()])


@plan("""
SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '(?i)((?:password|token|secret|api[_-]?key)\\s*[=:]\\s*)\\S+', '\\1[redacted]', 'g'), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[email]', 'g'), '(https?://[^\\s?#]+)[?#]\\S*', '\\1', 'g')) AS h FROM documents
""")
def redact_payload(t: Tables) -> DataFrame:
    """Texts without secrets, addresses and link queries."""
    return t.documents.select("doc_id", F.md5(S.redacted("text").cast("binary")).alias("h"))


@plan("""
WITH q AS (SELECT o_orderkey AS k, 'pending' AS status, CASE WHEN o_totalprice > 250000 THEN 'support' ELSE 'unclear' END AS stance FROM orders),
d AS (SELECT l_orderkey AS k, CASE l_returnflag WHEN 'A' THEN 'resolved' WHEN 'R' THEN 'ignored' ELSE 'pending' END AS status, CASE WHEN l_returnflag = 'A' THEN 'oppose' END AS stance, CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey AS w FROM lineitem WHERE l_orderkey % 4 <> 0),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY w DESC, status) AS r FROM d) WHERE r = 1)
SELECT q.k, coalesce(n.status, q.status) AS status, coalesce(n.stance, q.stance) AS stance FROM q LEFT JOIN n ON n.k = q.k
""")
def review_decisions(t: Tables) -> DataFrame:
    """A review queue with the newest decision of each entry applied."""
    q = t.orders.select(F.col("o_orderkey").alias("k"), F.lit("pending").alias("status"), F.when(F.col("o_totalprice") > 250000, "support").otherwise("unclear").alias("stance"))
    flag = F.col("l_returnflag")
    d = t.lineitem.filter("l_orderkey % 4 != 0").select(F.col("l_orderkey").alias("k"), F.when(flag == "A", "resolved").when(flag == "R", "ignored").otherwise("pending").alias("status"), F.when(flag == "A", "oppose").alias("stance"), (F.col("l_linenumber").cast("long") * 1000000 + F.col("l_partkey")).alias("w"))
    return M.apply_decisions(q, d, "k", "w")


@plan("""
WITH s AS (SELECT s_suppkey % 90 AS k, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS name, s_nationkey % 30 AS nation, CASE WHEN s_suppkey % 7 = 0 THEN 'odd' ELSE 'new' END AS state FROM supplier)
SELECT CAST(k AS VARCHAR) AS key, 'missing:name' AS problem FROM s WHERE name IS NULL UNION ALL SELECT CAST(k AS VARCHAR), 'enum:state' FROM s WHERE state NOT IN ('new', 'old')
UNION ALL SELECT CAST(k AS VARCHAR), 'duplicate' FROM s GROUP BY k HAVING count(*) > 1 UNION ALL SELECT CAST(k AS VARCHAR), 'reference:nation' FROM s WHERE nation NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 20)
""")
def manifest_validation(t: Tables) -> DataFrame:
    """Missing values, unknown codes, lost references and repeated keys of a seed table."""
    s = t.supplier.select((F.col("s_suppkey") % 90).alias("k"), F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("name"), (F.col("s_nationkey") % 30).alias("nation"), F.when(F.col("s_suppkey") % 7 == 0, "odd").otherwise("new").alias("state"))
    return Q.manifest_problems(s, "k", ["name"], {"state": ("new", "old")}, {"nation": t.nation.filter("n_nationkey < 20").select("n_nationkey")})


@plan("""
SELECT unnest(['missing:o_comment', 'type:o_orderkey', 'extra:o_orderpriority']) AS problem
""")
def snapshot_contract(t: Tables) -> DataFrame:
    """A snapshot's fields against a contract; only the schema is read."""
    expected = {"o_orderkey": "int", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": dict(t.orders.dtypes)["o_orderdate"], "o_comment": "string"}
    return t.spark.createDataFrame([(p,) for p in Q.schema_problems(t.orders, expected)], "problem string")


@plan("""
WITH e AS (SELECT event_type AS topic, 'type' AS k, count(*) AS n FROM events GROUP BY 1), f AS (SELECT CASE WHEN json_extract_string(props, '$.k') >= '5' THEN 'late' ELSE 'early' END AS topic, 'context' AS k, count(*) AS n FROM events GROUP BY 1)
SELECT * FROM e UNION ALL SELECT * FROM f
""")
def event_labels(t: Tables) -> DataFrame:
    """Events by the first label that is not blank, and by a context found in the payload."""
    e = t.events.groupBy(S.first_nonblank("event_type", default=F.lit("none")).alias("topic")).agg(F.count(F.lit(1)).alias("n")).select("topic", F.lit("type").alias("k"), "n")
    context = F.when(F.get_json_object("props", "$.k") >= "5", "late").otherwise("early")
    f = t.events.groupBy(context.alias("topic")).agg(F.count(F.lit(1)).alias("n")).select("topic", F.lit("context").alias("k"), "n")
    return e.unionByName(f)
