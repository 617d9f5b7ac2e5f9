"""Stances, positions, votes, discipline, similarity and coalitions.

Line items stand for evidence and for member votes: the supplier is the person, the
part the topic, the order the event; the nation is the group and the region the scope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import incremental as I
from ..operators import joins as J
from ..operators import similarity as M
from ..streaming.streams import folder
from .registry import Tables, plan

_EVIDENCE = """
evidence AS (SELECT l_suppkey AS person, l_partkey % 50 AS topic, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN -1 ELSE 0 END AS polarity,
  CAST(l_quantity AS DECIMAL(12,2)) AS w, CAST(1 - l_discount AS DECIMAL(12,2)) AS c,
  CASE l_returnflag WHEN 'A' THEN 'support' WHEN 'R' THEN 'oppose' ELSE CASE WHEN l_linenumber % 2 = 1 THEN 'mixed' END END AS stance FROM lineitem)
"""

_POSITIONS = """
sums AS (SELECT person, topic, count(*) AS n_evidence, count(*) FILTER (WHERE polarity > 0) AS n_for, count(*) FILTER (WHERE polarity < 0) AS n_against,
  CAST(sum(CASE WHEN polarity <> 0 THEN polarity * w * c END) AS DOUBLE) AS numer, CAST(sum(CASE WHEN polarity <> 0 THEN w * c END) AS DOUBLE) AS denom FROM evidence GROUP BY person, topic),
scored AS (SELECT *, CASE WHEN denom > 0 THEN coalesce(numer / denom, 0.0) ELSE 0.0 END AS score FROM sums)
"""

#: Positions of declared evidence: rows with a signal count; the first rule that holds decides.
_DECLARED = """
dsums AS (SELECT person, topic, count(*) AS signal_count, count(*) FILTER (WHERE stance = 'mixed') AS mixed_count, count(*) FILTER (WHERE polarity = 1) AS support_count, count(*) FILTER (WHERE polarity = -1) AS oppose_count,
  CAST(sum(polarity * w * c) AS DOUBLE) AS numer, CAST(sum(CASE WHEN polarity = 0 THEN 0 ELSE w * c END) AS DOUBLE) AS denom
  FROM evidence WHERE stance IN ('support', 'oppose', 'mixed') GROUP BY person, topic),
declared AS (SELECT person, topic, signal_count AS n_evidence, support_count AS n_for, oppose_count AS n_against,
  CASE WHEN denom <= 0 AND mixed_count > 0 THEN 'mixed' WHEN denom <= 0 THEN 'unclear' WHEN numer / denom > 0.2 THEN 'support' WHEN numer / denom < -0.2 THEN 'oppose' WHEN support_count > 0 AND oppose_count > 0 THEN 'mixed' ELSE 'unclear' END AS stance,
  CASE WHEN denom <= 0 THEN 0.0 ELSE numer / denom END AS score,
  CASE WHEN signal_count >= 3 THEN 1.0 ELSE signal_count / 3.0 END AS confidence FROM dsums)
"""


def evidence(t: Tables, topics: int = 50) -> DataFrame:
    return _evidence(t.lineitem, topics)


def _evidence(lines: DataFrame, topics: int = 50) -> DataFrame:
    flag = F.col("l_returnflag")
    return lines.select(
        F.col("l_suppkey").alias("person"),
        (F.col("l_partkey") % topics).alias("topic"),
        F.when(flag == "A", 1).when(flag == "R", -1).otherwise(0).alias("polarity"),
        F.col("l_quantity").cast("decimal(12,2)").alias("w"),
        (1 - F.col("l_discount")).cast("decimal(12,2)").alias("c"),
        F.when(flag == "A", "support").when(flag == "R", "oppose").when(F.col("l_linenumber") % 2 == 1, "mixed").alias("stance"),
    )


@plan(f"""
WITH {_EVIDENCE}, {_POSITIONS}
SELECT person, topic, n_evidence, n_for, n_against, score, CASE WHEN score > 0.2 THEN 'support' WHEN score < -0.2 THEN 'oppose' ELSE 'unclear' END AS stance, least(1.0, n_evidence / 5.0) AS confidence FROM scored
""".replace("least(1.0, n_evidence / 5.0)", "CAST(least(1.0, n_evidence / 5.0) AS DOUBLE)"))
def weighted_stance(t: Tables) -> DataFrame:
    """Positions from signed, weighted evidence."""
    return A.weighted_stance(evidence(t), ["person", "topic"], "polarity", "w", "c")


@plan(f"""
WITH {_EVIDENCE.replace("% 50", "% 400")}, {_DECLARED}
SELECT person, topic, n_evidence, n_for, n_against, score, stance, CAST(confidence AS DOUBLE) AS confidence FROM declared
""")
def weighted_stance_declared(t: Tables) -> DataFrame:
    """The variant for declared evidence, where mixed evidence is a signal."""
    e = evidence(t, topics=400)
    return A.weighted_stance(e, ["person", "topic"], "polarity", "w", "c", "declared")


def _with_members(t: Tables, positions: DataFrame) -> DataFrame:
    size = t.supplier.groupBy(F.col("s_nationkey").alias("party")).agg(F.count(F.lit(1)).alias("n"))
    members = t.supplier.select(F.col("s_suppkey").alias("person"), F.col("s_nationkey").alias("party")).join(size, "party")
    return positions.join(members, "person")


@plan(f"""
WITH {_EVIDENCE.replace("FROM lineitem)", "FROM lineitem WHERE l_orderkey % 100 <> 1)")}, {_POSITIONS}
SELECT person, topic, n_evidence, n_for, n_against, score, CASE WHEN score > 0.2 THEN 'support' WHEN score < -0.2 THEN 'oppose' ELSE 'unclear' END AS stance, CAST(CASE WHEN n_evidence >= 5 THEN 1.0 ELSE n_evidence / 5.0 END AS DOUBLE) AS confidence FROM scored
""")
def incremental_stance(t: Tables) -> DataFrame:
    """Positions kept up to date: one hundredth of the evidence comes later, another is
    taken back, and only the slices that these touch are summed and evaluated again."""
    base, keys, slices = folder(t.spark), ["person", "topic"], ["slice"]
    every = t.lineitem.select("*", (F.col("l_orderkey") % 100).alias("part"))
    sums = lambda rows, sign=None: A.stance_sums(_evidence(rows).withColumn("slice", F.col("topic") % 10), [*slices, *keys], "polarity", "w", "c", sign=sign)
    first = sums(every.filter("part <> 2"))
    I.build(first, f"{base}/sums", slices)
    I.build(A.stances(t.spark.read.schema(first.schema).parquet(f"{base}/sums")), f"{base}/positions", slices)
    changes = sums(every.filter("part = 2")).unionByName(sums(every.filter("part = 1"), F.lit(-1)))
    changes = changes.groupBy(*slices, *keys).agg(*[F.sum(c).cast(first.schema[c].dataType).alias(c) for c in first.columns if c not in (*slices, *keys)]).select(*first.columns)
    touched = I.apply_changes(f"{base}/sums", changes, slices, keys, "n_evidence", f"{base}/staging")
    return I.reevaluate(f"{base}/sums", first.schema, slices, touched, f"{base}/positions", A.stances).drop("slice")


_SIZE = "size AS (SELECT s_nationkey AS party, count(*) AS n_members FROM supplier GROUP BY 1)"


@plan(f"""
WITH {_EVIDENCE}, {_POSITIONS},
pos AS (SELECT *, CASE WHEN score > 0.2 THEN 'support' WHEN score < -0.2 THEN 'oppose' ELSE 'unclear' END AS stance FROM scored),
{_SIZE},
roll AS (SELECT s_nationkey AS party, topic, CAST(sum(n_evidence) AS BIGINT) AS n_evidence, count(*) AS n_signal, count(*) FILTER (WHERE stance = 'support') AS s, count(*) FILTER (WHERE stance = 'oppose') AS o, count(*) FILTER (WHERE stance = 'unclear') AS u FROM pos JOIN supplier ON person = s_suppkey GROUP BY ALL)
SELECT roll.party, topic, n_evidence, s AS n_support, o AS n_oppose, u AS n_unclear, n_members,
  CASE WHEN n_signal < greatest(1, least(3, n_members), ceil(0.2 * n_members)) THEN 'unclear' WHEN s + o = 0 THEN 'unclear' WHEN s > 0 AND o > 0 AND greatest(s, o) / (s + o) < 0.75 THEN 'mixed' WHEN s >= o THEN 'support' ELSE 'oppose' END AS stance
FROM roll JOIN size ON size.party = roll.party
""")
def party_rollup_stance(t: Tables) -> DataFrame:
    """Positions of members as the position of their group."""
    pos = _with_members(t, A.weighted_stance(evidence(t), ["person", "topic"], "polarity", "w", "c"))
    out = A.rollup_stance(pos, ["party", "topic"], F.col("n"))
    return out.select("party", "topic", "n_evidence", "n_support", "n_oppose", "n_unclear", "n_members", "stance")


@plan(f"""
WITH {_EVIDENCE.replace("% 50", "% 400")}, {_DECLARED}, {_SIZE},
roll AS (SELECT s_nationkey AS party, topic, CAST(sum(n_evidence) AS BIGINT) AS n_evidence, count(*) FILTER (WHERE stance <> 'no_signal') AS n_signal,
  count(*) FILTER (WHERE stance = 'support') AS n_support, count(*) FILTER (WHERE stance = 'oppose') AS n_oppose, count(*) FILTER (WHERE stance = 'mixed') AS n_mixed, count(*) FILTER (WHERE stance = 'unclear') AS n_unclear,
  sum(score * n_evidence) / sum(n_evidence) AS score_weighted, sum(confidence * n_evidence) / sum(n_evidence) AS confidence_weighted
  FROM declared JOIN supplier ON person = s_suppkey GROUP BY ALL),
met AS (SELECT roll.*, n_members, greatest(1, least(3, n_members), CAST(ceil(n_members * 0.20) AS BIGINT)) AS min_needed FROM roll JOIN size ON size.party = roll.party),
decided AS (SELECT *,
  CASE WHEN n_signal < min_needed THEN 'unclear' WHEN n_support + n_oppose = 0 AND n_mixed > 0 THEN 'mixed' WHEN n_support + n_oppose = 0 THEN 'unclear'
    WHEN n_support > 0 AND n_oppose > 0 AND greatest(n_support, n_oppose) / (n_support + n_oppose) < 0.75 THEN 'mixed' WHEN n_support >= n_oppose THEN 'support' ELSE 'oppose' END AS stance,
  CASE WHEN n_signal < min_needed THEN 'unclear' WHEN n_support + n_oppose + n_mixed = 0 THEN 'unclear'
    WHEN n_support > 0 AND n_oppose > 0 AND greatest(n_support, n_oppose) / (n_support + n_oppose + n_mixed) < 0.75 THEN 'mixed' WHEN n_support >= n_oppose THEN 'support' ELSE 'oppose' END AS series_stance
  FROM met)
SELECT party, topic, n_evidence, n_signal, n_support, n_oppose, n_mixed, n_unclear, n_members, stance, series_stance,
  round(CASE WHEN stance = 'unclear' THEN 0.0 ELSE score_weighted END, 6) AS score, round(least(1.0, confidence_weighted * n_signal / n_members), 6) AS confidence FROM decided
""")
def party_rollup_declared(t: Tables) -> DataFrame:
    """Declared positions of members as the position of their group, in both forms."""
    pos = _with_members(t, A.weighted_stance(evidence(t, topics=400), ["person", "topic"], "polarity", "w", "c", "declared"))
    out = A.rollup_stance(pos, ["party", "topic"], F.col("n"))
    series = A.rollup_stance(pos, ["party", "topic"], F.col("n"), series=True).select("party", "topic", F.col("stance").alias("series_stance"))
    out = out.join(series, ["party", "topic"]).withColumns({"score": F.round("score", 6), "confidence": F.round("confidence", 6)})
    return out.select("party", "topic", "n_evidence", "n_signal", "n_support", "n_oppose", "n_mixed", "n_unclear", "n_members", "stance", "series_stance", "score", "confidence")


_VOTES = """
votes AS (SELECT l_orderkey AS event, l_suppkey AS person, s_nationkey AS party, n_regionkey AS scope, l_partkey % 10 AS topic,
  CASE l_returnflag WHEN 'A' THEN 'yes' WHEN 'R' THEN 'no' ELSE CASE WHEN l_linestatus = 'O' THEN 'abstain' ELSE 'absent' END END AS choice
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
"""


def votes(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    choice = F.when(flag == "A", "yes").when(flag == "R", "no").otherwise(F.when(F.col("l_linestatus") == "O", "abstain").otherwise("absent"))
    members = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("person"), F.col("s_nationkey").alias("party"), F.col("n_regionkey").alias("scope"))
    v = t.lineitem.select(F.col("l_orderkey").alias("event"), F.col("l_suppkey").alias("person"), (F.col("l_partkey") % 10).alias("topic"), choice.alias("choice"))
    return v.join(members, "person")


_EVENT = "ev AS (SELECT event, count(*) FILTER (WHERE choice = 'yes') AS yes, count(*) FILTER (WHERE choice = 'no') AS no, count(*) FILTER (WHERE choice IN ('yes', 'no', 'abstain')) AS present FROM votes GROUP BY event)"


@plan(f"""
WITH {_VOTES}, {_EVENT}
SELECT event, yes, no, CASE WHEN yes + no = 0 THEN 'no_signal' WHEN yes > no THEN 'passed' WHEN no > yes THEN 'failed' ELSE 'tied' END AS outcome, yes - no AS margin FROM ev
""")
def event_outcome(t: Tables) -> DataFrame:
    """Outcome and margin of every event."""
    c = A.vote_counts(votes(t), ["event"], "choice")
    return c.select("event", "yes", "no", A.outcome(F.col("yes"), F.col("no")).alias("outcome"), (F.col("yes") - F.col("no")).alias("margin"))


@plan(f"""
WITH {_VOTES}
SELECT event, party, count(*) FILTER (WHERE choice = 'yes') AS yes, count(*) FILTER (WHERE choice = 'no') AS no,
  CASE WHEN count(*) FILTER (WHERE choice = 'yes') > count(*) FILTER (WHERE choice = 'no') THEN 'yes' WHEN count(*) FILTER (WHERE choice = 'yes') < count(*) FILTER (WHERE choice = 'no') THEN 'no' ELSE 'tie' END AS side
FROM votes GROUP BY event, party HAVING count(*) FILTER (WHERE choice IN ('yes', 'no')) > 0
""")
def majority_position(t: Tables) -> DataFrame:
    """The side of each group at each event; absent where nobody took one."""
    c = A.vote_counts(votes(t), ["event", "party"], "choice")
    return c.select("event", "party", "yes", "no", A.majority(F.col("yes"), F.col("no")).alias("side")).filter("side is not null")


_ENRICHED = """
side AS (SELECT event, party, count(*) FILTER (WHERE choice = 'yes') AS y, count(*) FILTER (WHERE choice = 'no') AS n FROM votes GROUP BY ALL),
en AS (SELECT votes.*, CASE WHEN y + n = 0 THEN NULL WHEN y > n THEN 'yes' WHEN n > y THEN 'no' ELSE 'tie' END AS m FROM votes JOIN side ON votes.event = side.event AND votes.party = side.party)
"""
_RATES = """count(*) AS n_votes, count(*) FILTER (WHERE choice IN ('yes', 'no')) AS n_directional, count(*) FILTER (WHERE choice IN ('yes', 'no') AND choice = m) AS n_aligned,
  count(*) FILTER (WHERE choice IN ('yes', 'no') AND m IN ('yes', 'no') AND choice <> m) AS n_rebel, count(*) FILTER (WHERE choice = 'absent') AS n_absent"""


def _rates_sql(keys: str) -> str:
    return f"""
WITH {_VOTES}, {_ENRICHED}, r AS (SELECT {keys}, {_RATES} FROM en GROUP BY {keys})
SELECT *, CASE WHEN n_directional > 0 THEN n_aligned / n_directional ELSE 0.0 END AS aligned_rate, CASE WHEN n_directional > 0 THEN n_rebel / n_directional ELSE 0.0 END AS rebel_rate, n_absent / n_votes AS absence_rate FROM r
"""


@plan(_rates_sql("person"))
def discipline_rates(t: Tables) -> DataFrame:
    """Discipline, rebellion and absence of each person."""
    return A.discipline(A.enriched_votes(votes(t), "event", "party", "choice"), ["person"], "choice")


@plan(_rates_sql("party, scope, topic"))
def discipline_by_context(t: Tables) -> DataFrame:
    """The same rates of each group in each scope and topic."""
    return A.discipline(A.enriched_votes(votes(t), "event", "party", "choice"), ["party", "scope", "topic"], "choice")


@plan(f"""
WITH {_VOTES}, c AS (SELECT topic * 1000000 + event % 500 AS event, party, count(*) FILTER (WHERE choice = 'yes') AS yes, count(*) FILTER (WHERE choice = 'no') AS no FROM votes GROUP BY ALL),
d AS (SELECT event, party, yes - no AS diff, sum(yes - no) OVER (PARTITION BY event) AS margin FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY abs(diff), party) AS place FROM d WHERE (margin > 0 AND margin - diff <= 0) OR (margin < 0 AND margin - diff >= 0))
SELECT event, party, diff, CAST(margin AS BIGINT) AS margin, CAST(place AS INTEGER) AS place FROM r WHERE place <= 6
""")
def pivotal_groups(t: Tables) -> DataFrame:
    """Groups without which events would have gone another way."""
    v = votes(t).withColumn("event", F.col("topic") * 1000000 + F.col("event") % 500)
    return A.pivotal(A.vote_counts(v, ["event", "party"], "choice"), "event", "party")


@plan(f"""
WITH {_VOTES}, {_EVENT}, tp AS (SELECT DISTINCT event, topic FROM votes),
s AS (SELECT topic, CAST(sum(CASE WHEN yes + no > 0 THEN CAST(present * (1 - abs(yes - no) / (yes + no)) AS DECIMAL(18,8)) ELSE 0 END) AS DOUBLE) AS stakes, count(*) AS n_events FROM tp JOIN ev USING (event) GROUP BY topic),
top AS (SELECT *, row_number() OVER (ORDER BY stakes DESC, topic) AS place FROM s)
SELECT topic, stakes, n_events, place, place <= 3 AS is_high FROM top WHERE topic <> 4 AND (place <= 5 OR topic = 9) UNION SELECT topic, stakes, n_events, place, place <= 3 FROM top WHERE topic = 9
""")
def topic_stakes(t: Tables) -> DataFrame:
    """Topics by what was at stake, ranked, with excluded and pinned ones."""
    v = votes(t)
    ev = v.groupBy("event").agg(*[F.count_if(F.col("choice") == c).alias(c) for c in ("yes", "no")], F.count_if(F.col("choice").isin("yes", "no", "abstain")).alias("present"))
    close = F.when(F.col("yes") + F.col("no") > 0, (F.col("present") * (1 - F.abs(F.col("yes") - F.col("no")) / (F.col("yes") + F.col("no")))).cast("decimal(18,8)")).otherwise(F.lit(0).cast("decimal(18,8)"))
    s = v.select("event", "topic").distinct().join(ev, "event").groupBy("topic").agg(F.sum(close).cast("double").alias("stakes"), F.count(F.lit(1)).alias("n_events"))
    top = s.withColumn("place", F.row_number().over(Window.orderBy(F.desc("stakes"), "topic")).cast("long")).withColumn("is_high", F.col("place") <= 3)
    pins = top.filter("topic = 9")
    return top.filter("topic <> 4 AND place <= 5").union(pins).distinct()


_SIGNS = """
c AS (SELECT scope, party, event, count(*) FILTER (WHERE choice = 'yes') AS yes, count(*) FILTER (WHERE choice = 'no') AS no FROM v GROUP BY ALL),
sg AS (SELECT *, CASE WHEN yes > no THEN 1 ELSE -1 END AS sign FROM c WHERE yes <> no),
sv AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY scope, party) AS k FROM sg) WHERE k >= 5),
own AS (SELECT scope, party, count(*) FILTER (WHERE sign > 0) AS y, count(*) FILTER (WHERE sign < 0) AS n FROM sv GROUP BY ALL),
pr AS (SELECT a.scope, a.party AS a, b.party AS b, count(*) AS shared, CAST(sum(a.sign * b.sign) AS BIGINT) AS dot, count(*) FILTER (WHERE a.sign > 0 AND b.sign > 0) AS yy, count(*) FILTER (WHERE a.sign < 0 AND b.sign < 0) AS nn
  FROM sv a JOIN sv b ON a.scope = b.scope AND a.event = b.event AND a.party < b.party GROUP BY ALL),
sim AS (SELECT pr.scope, a, b, shared, dot / shared AS cosine, coalesce((yy + nn) / nullif(x.y + z.y - yy + x.n + z.n - nn, 0), 0.0) AS jaccard
  FROM pr JOIN own x ON x.scope = pr.scope AND x.party = a JOIN own z ON z.scope = pr.scope AND z.party = b WHERE shared >= 3)
"""


@plan(f"WITH {_VOTES}, v AS (SELECT scope, party, topic * 1000000 + event % 500 AS event, choice FROM votes), {_SIGNS} SELECT * FROM sim")
def pair_similarity(t: Tables) -> DataFrame:
    """Cosine and Jaccard of the sides that groups of a scope take."""
    v = votes(t).withColumn("event", F.col("topic") * 1000000 + F.col("event") % 500)
    signs = M.sign_vectors(A.vote_counts(v, ["scope", "party", "event"], "choice"), ["scope"], "party", "event", 5)
    return M.pair_similarity(signs, ["scope"], "party", "event", 3)


@plan(f"""
WITH {_VOTES}, every AS (SELECT unnest([scope, -1]) AS scope, party, topic, event % 500 AS event, choice FROM votes), v AS (SELECT (scope + 1) * 100 + topic AS scope, party, event, choice FROM every), {_SIGNS},
v2 AS (SELECT scope, party, topic * 1000000 + event AS event, choice FROM every),
c2 AS (SELECT scope, party, event, count(*) FILTER (WHERE choice = 'yes') AS yes, count(*) FILTER (WHERE choice = 'no') AS no FROM v2 GROUP BY ALL),
s2 AS (SELECT scope, party, event, CASE WHEN yes > no THEN 1 ELSE -1 END AS sign FROM c2 WHERE yes <> no),
al AS (SELECT x.scope, x.party AS a, y.party AS b, CAST(sum(x.sign * y.sign) AS BIGINT) / count(*) AS overall FROM s2 x JOIN s2 y ON x.scope = y.scope AND x.event = y.event AND x.party < y.party GROUP BY ALL HAVING count(*) >= 1)
SELECT sim.scope // 100 - 1 AS scope, sim.scope % 100 AS topic, sim.a, sim.b, shared, cosine, coalesce(overall, 0.0) AS overall FROM sim LEFT JOIN al ON al.scope = sim.scope // 100 - 1 AND al.a = sim.a AND al.b = sim.b WHERE cosine >= 0.2 AND coalesce(overall, 0.0) <= 0.05
""")
def issue_coalitions(t: Tables) -> DataFrame:
    """Groups that agree on a topic but not overall in their scope: each scope by itself and,
    as -1, all of them together, where groups of different scopes meet."""
    v = votes(t).withColumn("event", F.col("event") % 500).withColumn("scope", F.explode(F.array("scope", F.lit(-1))))
    by_topic = A.vote_counts(v, ["scope", "topic", "party", "event"], "choice")
    topic = M.pair_similarity(M.sign_vectors(by_topic, ["scope", "topic"], "party", "event", 5), ["scope", "topic"], "party", "event", 3)
    v = v.withColumn("event", F.col("topic") * 1000000 + F.col("event"))
    overall = M.pair_similarity(M.sign_vectors(A.vote_counts(v, ["scope", "party", "event"], "choice"), ["scope"], "party", "event", 1), ["scope"], "party", "event")
    return M.issue_coalitions(topic, overall, 0.2, 0.05, scope=["scope"]).select("scope", "topic", "a", "b", "shared", "cosine", "overall")


_METHODS = f"""
{_EVIDENCE}, {_POSITIONS}, mv AS (SELECT person, topic, CASE WHEN score > 0.2 THEN 'support' WHEN score < -0.2 THEN 'oppose' ELSE 'unclear' END AS stance FROM scored),
ev2 AS (SELECT l_suppkey AS person, l_partkey % 50 AS topic, CASE WHEN l_linestatus = 'O' THEN 1 ELSE -1 END AS p FROM lineitem WHERE l_tax > 0.05),
md AS (SELECT person, topic, CASE WHEN avg(p) > 0.2 THEN 'support' WHEN avg(p) < -0.2 THEN 'oppose' ELSE 'unclear' END AS stance FROM ev2 GROUP BY ALL)
"""


def _methods(t: Tables) -> tuple[DataFrame, DataFrame]:
    v = A.weighted_stance(evidence(t), ["person", "topic"], "polarity", "w", "c").select("person", "topic", F.col("stance").alias("votes"))
    d = t.lineitem.filter("l_tax > 0.05").groupBy(F.col("l_suppkey").alias("person"), (F.col("l_partkey") % 50).alias("topic")).agg(A.stance(F.avg(F.when(F.col("l_linestatus") == "O", 1).otherwise(-1))).alias("declared"))
    return v, d


@plan(f"""
WITH {_METHODS}, j AS (SELECT mv.stance AS a, md.stance AS b FROM mv FULL JOIN md USING (person, topic))
SELECT count(*) FILTER (WHERE a IN ('support', 'oppose') AND b IN ('support', 'oppose')) AS comparable, count(*) FILTER (WHERE a IN ('support', 'oppose') AND a = b) AS n_match,
  count(*) FILTER (WHERE a IN ('support', 'oppose') AND b IN ('support', 'oppose') AND a <> b) AS mismatch, count(a) AS by_votes, count(b) AS by_declared FROM j
""")
def method_agreement(t: Tables) -> DataFrame:
    """How far two methods agree where both are clear."""
    v, d = _methods(t)
    j = v.join(d, ["person", "topic"], "full")
    a, b = F.col("votes"), F.col("declared")
    clear = a.isin("support", "oppose") & b.isin("support", "oppose")
    return j.agg(F.count_if(clear).alias("comparable"), F.count_if(clear & (a == b)).alias("n_match"), F.count_if(clear & (a != b)).alias("mismatch"), F.count(a).alias("by_votes"), F.count(b).alias("by_declared"))


@plan(f"""
WITH {_METHODS}
SELECT topic, count(*) AS n_overlap, count(*) FILTER (WHERE a IN ('support', 'oppose') AND b IN ('support', 'oppose')) AS n_explicit, count(*) FILTER (WHERE a IN ('support', 'oppose') AND a = b) AS coherent,
  CASE WHEN count(*) FILTER (WHERE a IN ('support', 'oppose') AND b IN ('support', 'oppose')) > 0 THEN count(*) FILTER (WHERE a IN ('support', 'oppose') AND a = b) / count(*) FILTER (WHERE a IN ('support', 'oppose') AND b IN ('support', 'oppose')) ELSE 0.0 END AS coherent_share
FROM (SELECT topic, mv.stance AS a, md.stance AS b FROM mv JOIN md USING (person, topic)) GROUP BY topic
""")
def coherence_pairs(t: Tables) -> DataFrame:
    """What is said against what is done, by topic."""
    v, d = _methods(t)
    a, b = F.col("votes"), F.col("declared")
    clear = a.isin("support", "oppose") & b.isin("support", "oppose")
    g = v.join(d, ["person", "topic"]).groupBy("topic").agg(F.count(F.lit(1)).alias("n_overlap"), F.count_if(clear).alias("n_explicit"), F.count_if(clear & (a == b)).alias("coherent"))
    return g.withColumn("coherent_share", S.ratio("coherent", "n_explicit"))


@plan(f"""
WITH {_METHODS}, u AS (SELECT person, topic, 'votes' AS method, stance, 1 AS o FROM mv WHERE stance <> 'unclear' UNION ALL SELECT person, topic, 'declared', stance, 2 FROM md)
SELECT person, topic, method, stance FROM (SELECT *, row_number() OVER (PARTITION BY person, topic ORDER BY o) AS r FROM u) WHERE r = 1
""")
def combined_positions(t: Tables) -> DataFrame:
    """One position of each person and topic: by votes, else declared."""
    v, d = _methods(t)
    u = v.filter("votes <> 'unclear'").select("person", "topic", F.lit("votes").alias("method"), F.col("votes").alias("stance"), F.lit(1).alias("o"))
    u = u.unionByName(d.select("person", "topic", F.lit("declared").alias("method"), F.col("declared").alias("stance"), F.lit(2).alias("o")))
    return J.best_row(u, ["person", "topic"], [F.asc("o")]).drop("o")


@plan("""
WITH a AS (SELECT DATE '1996-06-01' AS d UNION ALL SELECT DATE '1998-01-15'),
x AS (SELECT a.d, o_orderpriority AS party, CASE WHEN CAST(o_orderdate AS DATE) < a.d THEN 'pre' ELSE 'post' END AS side, o_orderstatus FROM orders JOIN a ON CAST(o_orderdate AS DATE) BETWEEN a.d - 90 AND a.d + 90),
g AS (SELECT d, party, count(*) FILTER (WHERE side = 'pre') AS pre, count(*) FILTER (WHERE side = 'post') AS post, count(*) FILTER (WHERE side = 'pre' AND o_orderstatus = 'F') AS f1, count(*) FILTER (WHERE side = 'post' AND o_orderstatus = 'F') AS f2 FROM x GROUP BY ALL)
SELECT CAST(d AS VARCHAR) AS anchor, party, pre, post, CASE WHEN post > 0 THEN f2 / post ELSE 0.0 END - CASE WHEN pre > 0 THEN f1 / pre ELSE 0.0 END AS shift FROM g WHERE pre >= 20 OR post >= 20
""")
def anchor_window_behavior(t: Tables) -> DataFrame:
    """Behaviour in windows before and after anchor dates, and its shift."""
    d = F.to_date("o_orderdate")
    near = lambda a: F.abs(F.datediff(d, F.lit(a))) <= 90
    anchors = F.array_compact(F.array(*[F.when(near(a), F.lit(a).cast("date")) for a in ("1996-06-01", "1998-01-15")]))
    x = t.orders.select(F.explode(anchors).alias("d"), d.alias("day"), F.col("o_orderpriority").alias("party"), (F.col("o_orderstatus") == "F").alias("f"))
    pre = F.col("day") < F.col("d")
    g = x.groupBy("d", "party").agg(F.count_if(pre).alias("pre"), F.count_if(~pre).alias("post"), F.count_if(pre & F.col("f")).alias("f1"), F.count_if(~pre & F.col("f")).alias("f2")).filter("pre >= 20 OR post >= 20")
    return g.select(F.col("d").cast("string").alias("anchor"), "party", "pre", "post", (S.ratio("f2", "post") - S.ratio("f1", "pre")).alias("shift"))


@plan("""
WITH v AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1996-12-31' AND CAST(o_orderdate AS DATE) + 365 >= DATE '1996-12-31')
SELECT o_orderpriority AS party, c_nationkey AS territory, count(*) AS seats FROM v JOIN customer ON o_custkey = c_custkey WHERE r = 1 GROUP BY ALL
""")
def seats_snapshot(t: Tables) -> DataFrame:
    """Seats at a date: one valid mandate a person, by party and territory."""
    at, d = F.lit("1996-12-31").cast("date"), F.to_date("o_orderdate")
    valid = t.orders.filter((d <= at) & (F.date_add(d, 365) >= at))
    one = J.best_row(valid, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return one.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("o_orderpriority").alias("party"), F.col("c_nationkey").alias("territory")).agg(F.count(F.lit(1)).alias("seats"))


@plan(f"""
WITH {_EVIDENCE}, {_POSITIONS}, g AS (SELECT s_nationkey AS party, topic, CASE WHEN avg(score) > 0.1 THEN 'support' WHEN avg(score) < -0.1 THEN 'oppose' ELSE 'unknown' END AS st FROM scored JOIN supplier ON person = s_suppkey GROUP BY ALL),
pk AS (SELECT * FROM (VALUES ('a', 0), ('a', 1), ('a', 2), ('b', 2), ('b', 3), ('c', 40)) t(pack, topic))
SELECT pack, count(*) AS cells, count(*) FILTER (WHERE coalesce(st, 'unknown') <> 'unknown') / count(*) AS clear_share FROM pk CROSS JOIN nation LEFT JOIN g ON g.party = n_nationkey AND g.topic = pk.topic GROUP BY pack
""")
def pack_score(t: Tables) -> DataFrame:
    """Packs of topics scored over the whole grid of groups."""
    pos = A.weighted_stance(evidence(t), ["person", "topic"], "polarity", "w", "c").join(t.supplier, F.col("person") == F.col("s_suppkey"))
    g = pos.groupBy(F.col("s_nationkey").alias("party"), "topic").agg(F.avg("score").alias("m"))
    g = g.select("party", "topic", F.when(F.col("m") > 0.1, "support").when(F.col("m") < -0.1, "oppose").otherwise("unknown").alias("st"))
    packs = t.spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 2), ("b", 3), ("c", 40)], "pack string, topic long")
    grid = J.full_grid(packs, t.nation.select(F.col("n_nationkey").alias("party")), g, ["party", "topic"], {"st": "unknown"})
    return grid.groupBy("pack").agg(F.count(F.lit(1)).alias("cells"), F.avg(F.when(F.col("st") != "unknown", 1.0).otherwise(0.0)).alias("clear_share"))
