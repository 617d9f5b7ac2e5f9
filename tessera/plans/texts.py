"""Stances and subjects of running text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import text as X
from .registry import Tables, plan

#: Parts of the statements that are put before the turns of conversations.
_OPENERS = ("", "Señorías, ", "Hoy, ", "Por eso ")
_NEGATIONS = ("", "no ", "nunca ", "")
_VERBS = ("votaremos a favor de", "votaremos en contra de", "nos abstendremos en", "apoyamos", "rechazamos", "respaldamos", "vamos a votar que sí a", "vamos a apoyar", "defenderemos", "nos oponemos a", "votaremos, por tanto, a favor de", "hablamos de", "mantenemos nuestra")
_OBJECTS = ("esta iniciativa", "la enmienda", "su modelo social", "las medidas del texto", "enmienda a la totalidad")
_ENDS = (". ", ". Nuestro voto será negativo. ", ". Rechazamos la propuesta. ", ". Gracias. ", "; mi voto sea favorable. ")
#: Each list with the number of turns after which it goes on.
_PARTS = ((_OPENERS, 1), (_NEGATIONS, 4), (_VERBS, 16), (_OBJECTS, 5), (_ENDS, 3))


def _statement() -> Column:
    number = F.col("conv_id") * 7 + F.col("turn")
    pick = lambda values, step: F.get(F.array(*[F.lit(v) for v in values]), F.pmod(F.floor(number / step), F.lit(len(values))).cast("int"))
    return F.concat(*[pick(values, step) for values, step in _PARTS], F.coalesce("text", F.lit("")))


def _sql_statement() -> str:
    pick = lambda values, step: "[" + ", ".join(f"'{v}'" for v in values) + f"][((conv_id * 7 + turn) // {step}) % {len(values)} + 1]"
    return " || ".join([*[pick(values, step) for values, step in _PARTS], "coalesce(text, '')"])


def _sql_stance() -> str:
    """Every match with the negation before it, if it has one; one without is a hit."""
    lexicon = X.SPANISH
    families = {"vf": lexicon.support_explicit, "va": lexicon.oppose_explicit, "ab": lexicon.abstain_explicit, "sf": lexicon.support_declared_strong, "sa": lexicon.oppose_declared_strong, "wf": lexicon.support_declared_weak, "wa": lexicon.oppose_declared_weak}
    hit = lambda family: f"list_contains(regexp_extract_all(t, '(\\b(?:{'|'.join(lexicon.negations)}) |)(?:{'|'.join(family)})', 1), '')"
    hits = ", ".join(f"{hit(family)} AS {name}" for name, family in families.items())
    return f"""
WITH s AS (SELECT conv_id, turn, trim(regexp_replace(strip_accents(lower({_sql_statement()})), '\\s+', ' ', 'g')) AS t FROM conversations),
h AS (SELECT conv_id, turn, {hits} FROM s),
v AS (SELECT *, CASE WHEN (ab AND (vf OR va OR sf OR wf OR sa OR wa)) OR (vf AND (va OR sa OR wa)) OR (va AND (sf OR wf)) THEN 'mixed conflicting_signal 58'
  WHEN vf THEN 'support explicit_vote_intent 74' WHEN va THEN 'oppose explicit_vote_intent 74' WHEN ab THEN 'mixed abstention_intent 68' WHEN sf AND sa THEN 'mixed conflicting_signal 58'
  WHEN sf THEN 'support declared_support 66' WHEN sa THEN 'oppose declared_oppose 66' WHEN wf AND wa THEN 'mixed conflicting_signal 58'
  WHEN wf THEN 'support weak_declared_support 58' WHEN wa THEN 'oppose weak_declared_oppose 58' END AS x FROM h)
SELECT conv_id, turn, string_split(x, ' ')[1] AS stance, string_split(x, ' ')[2] AS reason, CAST(string_split(x, ' ')[3] AS INTEGER) / 100.0::DOUBLE AS confidence FROM v
"""


@plan(_sql_stance())
def stance_classifier(t: Tables) -> DataFrame:
    """Declared stances of whole turns that begin with statements of varied wording."""
    c = t.conversations.select("conv_id", "turn", X.declared_stance(_statement()).alias("d"))
    return c.select("conv_id", "turn", "d.stance", "d.reason", "d.confidence")


#: What is put before documents, and their titles.
_LEADS = ("", "El proyecto de ley sobre ", "Moción: ", "Visto. La pregunta, que el grupo formuló ayer, ", "Enmienda. Dictamen; ")
_TITLES = ("", "Proyecto de Ley de presupuestos generales del Estado", "Convenio breve", "Informe anual sobre la actividad de las oficinas")


def _sql_subject() -> str:
    pick = lambda values, n: "[" + ", ".join(f"'{v}'" for v in values) + f"][({n}) % {len(values)} + 1]"
    strong = "|".join(f"\\b{p}\\b" for p in X.STRONG_TITLES)
    clip = lambda c, n: f"CASE WHEN length({c}) <= {n} THEN {c} ELSE rtrim(left({c}, {n - 1})) || '…' END"
    return f"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '' ELSE trim(regexp_replace({pick(_LEADS, 'doc_id')} || coalesce(text, ''), '\\s+', ' ', 'g')) END AS t, {pick(_TITLES, 'doc_id // 5')} AS title FROM documents),
w AS (SELECT *, length(title) >= 35 AND regexp_matches(title, '(?i){strong}') AS strong, trim(regexp_extract(t, '(?i)((?:{"|".join(X.SUBJECT_STARTS)})[^.;:]{{20,320}})', 1)) AS k,
  list_filter(list_transform(regexp_split_to_array(t, '[.;:!?]+'), lambda x: trim(x)), lambda x: length(x) >= 40 AND regexp_matches(lower({clip("x", 320)}), '{"|".join(X.SUBJECT_WORDS)}'))[1] AS s FROM d),
c AS (SELECT doc_id, CASE WHEN t = '' AND title = '' THEN 'empty' WHEN t = '' AND strong THEN 'title_fallback_strong' WHEN t = '' THEN 'title_fallback' WHEN k <> '' AND length(k) < 40 AND strong THEN 'title_hint_strong_from_short_window'
  WHEN k <> '' THEN 'keyword_window' WHEN s IS NOT NULL THEN 'keyword_sentence' WHEN title <> '' AND strong THEN 'title_hint_strong' WHEN title <> '' THEN 'title_hint' ELSE 'excerpt_fallback' END AS method, t, title, {clip("k", 320)} AS k, {clip("s", 320)} AS s FROM w)
SELECT doc_id, method, CASE method WHEN 'empty' THEN '' WHEN 'keyword_window' THEN k WHEN 'keyword_sentence' THEN s WHEN 'excerpt_fallback' THEN {clip("t", 220)} ELSE title END AS subject,
  CASE method WHEN 'empty' THEN 0.0 WHEN 'keyword_window' THEN 0.82 WHEN 'keyword_sentence' THEN 0.76 WHEN 'title_fallback' THEN 0.72 WHEN 'title_hint' THEN 0.68 WHEN 'excerpt_fallback' THEN 0.56 ELSE 0.74 END::DOUBLE AS confidence FROM c
"""


@plan(_sql_subject())
def subject_extraction(t: Tables) -> DataFrame:
    """Subjects by keyword window, sentence, title or beginning, with a confidence."""
    pick = lambda values, n: F.get(F.array(*[F.lit(v) for v in values]), F.pmod(n, F.lit(len(values))).cast("int"))
    text = F.when(F.col("doc_id") % 13 == 0, "").otherwise(F.concat(pick(_LEADS, F.col("doc_id")), F.coalesce("text", F.lit(""))))
    s = t.documents.select("doc_id", X.subject(text, pick(_TITLES, F.floor(F.col("doc_id") / 5))).alias("s"))
    return s.select("doc_id", "s.method", "s.subject", "s.confidence")


@plan("""
SELECT doc_id, md5(strip_accents(lower(text))) AS folded, length(strip_accents(lower(text))) AS n_chars FROM documents
""")
def unicode_fold(t: Tables) -> DataFrame:
    """Whole texts without marks, by full Unicode decomposition."""
    folded = t.documents.select("doc_id", X.fold_unicode("text").alias("f"))
    return folded.select("doc_id", F.md5(F.col("f").cast("binary")).alias("folded"), F.length("f").cast("long").alias("n_chars"))


@plan("""
WITH d AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS x FROM documents),
h AS (SELECT doc_id, x, rtrim(left(x, 60)) AS h FROM d)
SELECT doc_id, CASE WHEN length(x) <= 60 THEN x WHEN regexp_matches(h, '^.{25,} [^ ]*$') THEN regexp_replace(h, ' [^ ]*$', '') || '...' ELSE h || '...' END AS short FROM h
""")
def shorten(t: Tables) -> DataFrame:
    """Texts cut at a word's end."""
    return t.documents.select("doc_id", S.shorten("text", 60).alias("short"))


@plan("""
SELECT role, count(*) AS n_turns, count(DISTINCT conv_id) AS n_conversations, sum(length(text)) AS n_chars, max(turn) AS last_turn FROM conversations GROUP BY role
""".replace("sum(length(text))", "CAST(sum(length(text)) AS BIGINT)"))
def conversation_summary(t: Tables) -> DataFrame:
    """Turns and sizes by role."""
    return t.conversations.groupBy("role").agg(F.count(F.lit(1)).alias("n_turns"), F.countDistinct("conv_id").alias("n_conversations"), F.sum(F.length("text")).alias("n_chars"), F.max("turn").alias("last_turn"))
