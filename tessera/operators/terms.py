"""Tables of terms and rules looked for in texts.

All terms of a table are found in one scan of the texts, by an automaton that every worker
builds once. It is sent out only while the terms are small enough for that; a larger table
joins the texts by the first characters of its terms instead, and the texts decide.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of terms in one automaton, each with the cost of an entry beside its text.
MOST_BYTES = 32 << 20
ENTRY = 64
#: Characters by which a larger table is joined.
LEAD = 6

_automata: dict[str, object] = {}


def _automaton(name: str, terms: list[str]):
    """One automaton a Python worker, kept between tasks of a scan."""
    if name not in _automata:
        import ahocorasick

        found = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            found.add_word(term, i)
        found.make_automaton()
        _automata.clear()
        _automata[name] = found
    return _automata[name]


def found_terms(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, term_col: str, fold=F.lower, most_bytes: int = MOST_BYTES) -> DataFrame:
    """id_col and term (folded): each term that a text contains, once for a row of docs.
    Both sides are folded; null texts contain nothing, null and empty terms are nowhere."""
    known = terms.select(fold(F.col(term_col)).alias("term")).filter("term <> ''").distinct()
    rows = docs.select(F.col(id_col).alias("_id"), fold(F.col(text_col)).alias("_text")).filter(F.col("_text").isNotNull())
    size = known.agg(F.sum(F.octet_length("term") + ENTRY)).first()[0] or 0
    if size > most_bytes:
        return _by_lead(rows, known).withColumnRenamed("_id", id_col)
    every = [r.term for r in known.collect()]
    name, sent = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(every)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value
        automaton = _automaton(name, terms) if terms else None
        for batch in batches:
            places, hits = [], []
            for k, text in enumerate(batch.column(1).to_pylist() if terms else []):
                own = {i for _, i in automaton.iter(text)}
                places += [k] * len(own)
                hits += [terms[i] for i in own]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places, pa.int64())), pa.array(hits, pa.string())], ["_id", "term"])

    return rows.mapInArrow(run, f"_id {kind}, term string").withColumnRenamed("_id", id_col)


def _by_lead(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Texts give each of their stretches of the lengths that leads have, once; a lead's
    terms are then looked for in the texts that have it."""
    led = terms.withColumn("_lead", F.substring("term", 1, LEAD))
    lengths = sorted(r[0] for r in led.select(F.length("_lead")).distinct().collect())  # LEAD of them at most
    numbered = rows.withColumn("_row", F.xxhash64("_id", "_text"))

    def stretches_of(n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length("_text") - n + 1, F.lit(1)))
        return F.transform(places, lambda i: F.substring(F.col("_text"), i, F.lit(n)))

    stretches = F.array_distinct(F.flatten(F.array(*[stretches_of(n) for n in lengths])))
    texts = numbered.groupBy("_row", "_id", "_text").agg(F.count(F.lit(1)).alias("_times"))  # equal rows are looked at once
    likely = texts.select("_row", F.explode(stretches).alias("_lead")).distinct().join(led, "_lead").select(F.col("_row").alias("_r"), "term")
    found = texts.join(likely, F.col("_row") == F.col("_r")).filter(F.contains("_text", F.col("term")))
    return found.select("_id", "term", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("col")


def matched_rules(found: DataFrame, rules: DataFrame, id_col: str, rule_col: str, term_col: str, fold=F.lower) -> DataFrame:
    """id_col, rule_col: the rules all of whose terms a text contains. ``rules`` has a row
    for each rule and term; found comes from found_terms. A rule with a null or empty term
    matches nothing. An id counts once, its rows together."""
    asked = rules.select(F.col(rule_col).alias("_rule"), F.coalesce(fold(F.col(term_col)), F.lit("")).alias("term")).distinct()
    sizes = asked.groupBy("_rule").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("_rule", "_sized")
    met = found.select(F.col(id_col).alias("_id"), "term").distinct().join(asked, "term").groupBy("_id", "_rule").agg(F.count(F.lit(1)).alias("_met"))
    whole = met.join(sizes, (F.col("_rule") == F.col("_sized")) & (F.col("_met") == F.col("_n")))
    return whole.select(F.col("_id").alias(id_col), F.col("_rule").alias(rule_col))


def first_rule(matched: DataFrame, id_col: str, rule_col: str) -> DataFrame:
    """The first rule of each id, in the order of the rules."""
    return matched.groupBy(id_col).agg(F.min(rule_col).alias(rule_col))
