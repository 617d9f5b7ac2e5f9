"""Audit of how far sources diverge, by systolic rotation.

A group is a language and source. Its vector holds the smoothed shares of the terms that
the language keeps; two groups diverge by the sum over terms of (p-q)^2/(p+q), in whole
numbers. Vectors are cut into chunks of terms and groups into blocks, so a piece is
bounded whatever the vocabulary and the number of sources.

The blocks of a language play a round-robin tournament (circle method). Residents are a
table bucketed by (language, chunk, block), which no round shuffles; in each round the
blocks that travel go, compressed, to their hosts of that round, and a meeting gives the
values of both directions. A round's sums are written to the shared folder, so a lost
executor costs a round at most and no plan grows with the rounds. At home, the pairs
inside a block are evaluated, and a heap for each group and chunk keeps the terms that
stand out most against the language; the heaps' best are ranked at the end.

Counting is done in tasks with bounded dictionaries, then summed by (language, source,
term), so a source or word that has a third of all rows is one row a task.

Defined cases: null text, language and source count as ''; groups without terms take part
with all counts 0; a language that keeps no term gives its pairs the value 0; repeated
rows and ids count as documents of their own; ties by UTF-8 order of the item; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import uuid
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import stored

#: Over UTF-8 bytes with A-Z lower-cased: letters of ASCII, and all bytes of other characters.
TERMS = re.compile(rb"[a-z\x80-\xff]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SCALE = 1_000_000_000
MIN_DOCS, TOP = 10, 10
#: Terms of a chunk (about; terms are dealt by hash), groups of a block.
CHUNK, BLOCK = 32_768, 4
SALTS = 64
#: Entries of a task's dictionaries.
MOST_COUNTS = 300_000


def term_counts(docs: DataFrame, text: Column, lang: Column, source: Column) -> DataFrame:
    """lang, source, term: occurrences n and documents df. A group without terms has one
    row with a null term."""
    rows = docs.select(*[F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in counts.items():
                terms = list(n) or [None]
                columns = [[lang] * len(terms), [source] * len(terms), terms, [n[t] for t in terms], [df[t] for t in terms]]
                texts = [pa.array(c, pa.binary()).cast(pa.string()) for c in columns[:3]]
                yield pa.RecordBatch.from_arrays([*texts, *(pa.array(c, pa.int64()) for c in columns[3:])], ["lang", "source", "term", "n", "df"])
            counts.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.cast(pa.binary()).to_pylist() for c in batch.columns), strict=True):
                n, df = counts[lang, source]
                found = TERMS.findall(text.translate(_LOWER))
                before = len(n)
                n.update(found)
                df.update(set(found))
                held += len(n) - before
                if held > MOST_COUNTS:
                    yield from out()
                    held = 0
        yield from out()

    found = rows.mapInArrow(run, "lang string, source string, term string, n long, df long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: np.ndarray, n: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (n + 2 * terms)), exact for all 64-bit counts."""
    whole = n + 2 * terms
    if whole >= 1 << 53:
        return np.array([1 + SCALE * (int(c) + 2) // whole for c in count], np.int64)
    out, rest = np.divmod(count.astype(np.int64) + 2, whole)
    for _ in range(3):  # long division: the remainder stays below whole * 1000
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return 1 + out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _packed(groups: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Places (gaps) and counts of each group's terms, compressed."""
    sizes = np.array([len(at) for at, _ in groups], "<u4")
    gaps = np.concatenate([np.diff(at, prepend=0) for at, _ in groups] or [[]]).astype("<u4")
    counts = np.concatenate([n for _, n in groups] or [[]]).astype("<i8")
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in (gaps, counts)]
    return zlib.compress(len(sizes).to_bytes(4, "little") + sizes.tobytes() + b"".join(planes), 1)


def _shares(payload: bytes, totals: list[int], width: int, terms: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The p of each group of a block over a chunk's terms, and the places that occur."""
    raw = zlib.decompress(payload)
    head = 4 + 4 * int.from_bytes(raw[:4], "little")
    sizes = np.frombuffer(raw[:head], "<u4", offset=4)
    m = int(sizes.sum())
    gaps = np.frombuffer(raw, np.uint8, 4 * m, head).reshape(4, m).T.copy().view("<u4").ravel()
    counts = np.frombuffer(raw, np.uint8, 8 * m, head + 4 * m).reshape(8, m).T.copy().view("<i8").ravel()
    out, places, at = np.empty((len(totals), width), np.int64), [], 0
    for row, size, total in zip(out, sizes.tolist(), totals, strict=False):  # the last block may have free seats
        where = np.cumsum(gaps[at : at + size], dtype=np.int64)
        row[:] = share(np.zeros(1, np.int64), total, terms) if terms else 0
        row[where] = share(counts[at : at + size], total, terms)
        places.append(where)
        at += size
    return out, places


_SUMS = "lang string, source string, item string, value long"


def _sums(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:3]), pa.array(columns[3], pa.int64())], ["lang", "source", "item", "value"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values of all pairs between the groups of a resident and those of its visitor."""
    for batch in batches:
        for r in batch.to_pylist():
            p, _ = _shares(r["payload"], r["totals"], r["width"], r["terms"])
            q, _ = _shares(r["visitor"], r["visitor_totals"], r["width"], r["terms"])
            rows = []
            for own, mine in zip(r["sources"], p, strict=True):
                for other, value in zip(r["visitor_sources"], divergence(mine, q).sum(axis=1).tolist(), strict=True):
                    rows += [(r["lang"], own, other, value), (r["lang"], other, own, value)]
            yield _sums(rows)


def _home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs inside a block, and each group's heap of terms against the language."""
    for batch in batches:
        for r in batch.to_pylist():
            p, places = _shares(r["payload"], r["totals"], r["width"], r["terms"])
            rows = []
            for i, own in enumerate(r["sources"]):
                for other, value in zip(r["sources"][:i], divergence(p[i], p[:i]).sum(axis=1).tolist(), strict=True):
                    rows += [("pair", own, other, value), ("pair", other, own, value)]
            if r["lang_counts"] is not None:
                q = share(np.frombuffer(r["lang_counts"], "<i8"), r["lang_total"], r["terms"])
                for own, mine, at in zip(r["sources"], p, places, strict=True):
                    at = at[mine[at] > q[at]]
                    values = divergence(mine[at], q[at]).tolist()
                    best = heapq.nsmallest(TOP, zip((-v for v in values), (r["names"][k].encode() for k in at.tolist()), strict=True))
                    rows += [("term", own, item.decode(), -v) for v, item in best]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            arrays = [pa.array([r["lang"]] * len(rows), pa.string()), *(pa.array(columns[k], pa.string()) for k in (1, 0, 2)), pa.array(columns[3], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "source", "part", "item", "value"])


def host_of(block: Column, blocks: Column, turn: int) -> Column:
    """The block that ``block`` meets in a round of the circle method; null if none."""
    last = blocks + blocks % 2 - 1  # an odd number gets a bye
    moving = F.pmod(F.lit(turn) - block, last)
    met = F.when(block == last, F.pmod(F.lit(turn) * ((last + 1) / 2).cast("long"), last)).when(moving == block, last).otherwise(moving)
    return F.when((F.lit(turn) < last) & (met < blocks), met)


def vectors(counts: DataFrame, min_docs: int = MIN_DOCS, chunk: int = CHUNK, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """From term_counts: one row for each (lang, chunk, block) with its groups' packed
    vectors, and one for each (lang, chunk) with its terms and their counts in lang."""
    kept = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).filter(F.col("df") >= min_docs)
    kept = stored(kept)
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    # a language of most terms meets its size in many tasks
    salted = kept.withColumn("_salt", F.pmod(F.xxhash64("term", F.lit(1)), F.lit(SALTS)))
    dealt = salted.join(sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["lang", "_salt"]).drop("_salt").withColumn("chunk", F.pmod(F.xxhash64("term"), F.ceil(F.col("terms") / chunk)).cast("long"))
    in_chunk = Window.partitionBy("lang", "chunk")
    placed = dealt.withColumn("place", F.row_number().over(in_chunk.orderBy("term")) - 1).select("lang", "term", "chunk", "place", "lang_n", "terms", "lang_total")
    placed = stored(placed)
    terms = placed.groupBy("lang", "chunk", "terms", "lang_total").agg(F.array_sort(F.collect_list(F.struct("place", "term", "lang_n"))).alias("t"))
    terms = terms.select("lang", "chunk", "terms", "lang_total", F.col("t.term").alias("names"), F.col("t.lang_n").alias("lang_ns"))

    found = counts.join(placed.select("lang", "term", "chunk", "place"), ["lang", "term"])
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.groupBy("lang", "source").agg(F.count("*").alias("c")).join(totals, ["lang", "source"], "left")
    in_lang = Window.partitionBy("lang")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), (F.row_number().over(in_lang.orderBy("source")) - 1).alias("nr"))
    groups = groups.withColumns({"block": F.floor(F.col("nr") / block).cast("long"), "seat": (F.col("nr") % block).cast("int")})
    groups = stored(groups)
    blocks = groups.groupBy("lang").agg((F.max("block") + 1).alias("blocks"))
    rosters = groups.groupBy("lang", "block").agg(F.array_sort(F.collect_list(F.struct("seat", "source", "total"))).alias("g"))
    rosters = rosters.select("lang", "block", F.col("g.source").alias("sources"), F.col("g.total").alias("totals")).join(blocks, "lang")
    # a language without terms has one chunk without terms
    widths = terms.select("lang", "chunk", "terms", F.size("names").alias("width"))
    rosters = rosters.join(widths, "lang", "left").fillna(0, ["chunk", "terms", "width"])

    seated = found.join(groups.select("lang", "source", "block", "seat"), ["lang", "source"]).select("lang", "chunk", "block", "seat", "place", "n")

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        frame = rows.select(["seat", "place", "n"]).to_pandas().sort_values(["seat", "place"])
        own = {seat: part for seat, part in frame.groupby("seat")}
        empty = frame.iloc[:0]
        packed = _packed([(own.get(s, empty)["place"].to_numpy(), own.get(s, empty)["n"].to_numpy()) for s in range(block)])
        return pa.table({"lang": [key[0].as_py()], "chunk": [key[1].as_py()], "block": [key[2].as_py()], "payload": pa.array([packed], pa.binary())})

    packed = seated.groupBy("lang", "chunk", "block").applyInArrow(pack, "lang string, chunk long, block long, payload binary")
    return rosters.join(packed, ["lang", "chunk", "block"], "left"), terms


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """lang, source, part (``pair``: the other source is the item; ``term``: the term),
    item, value, rank. All pairs of a language; the TOP terms of a group."""
    spark = docs.sparkSession
    counts = stored(term_counts(docs, F.col(f"`{text_col}`"), F.col(f"`{lang_col}`"), F.col(f"`{source_col}`")))
    made, terms = vectors(counts, min_docs, chunk, block)
    keys = ["lang", "chunk", "block"]
    empty = F.lit(_packed([(np.zeros(0, np.int64), np.zeros(0, np.int64))] * block))
    made = made.withColumn("payload", F.coalesce("payload", empty))
    name, n = f"residents_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    made.repartition(n, *keys).write.bucketBy(n, *keys).saveAsTable(name)
    try:
        residents = spark.table(name)
        visitors = residents.select("lang", "chunk", F.col("block").alias("from"), "blocks", F.col("payload").alias("visitor"), F.col("sources").alias("visitor_sources"), F.col("totals").alias("visitor_totals"))
        home = residents.join(terms.select("lang", "chunk", "names", "lang_ns", "lang_total"), ["lang", "chunk"], "left")
        home = home.select("lang", "sources", "totals", "payload", "width", "terms", "names", _binary("lang_ns").alias("lang_counts"), "lang_total")
        parts = [stored(home.mapInArrow(_home, "lang string, source string, part string, item string, value long"))]
        most = residents.agg(F.max("blocks")).first()[0] or 0
        for turn in range(most + most % 2 - 1 if most > 1 else 0):
            met = host_of(F.col("from"), F.col("blocks"), turn)
            # of the two that meet, the one with the larger number travels, in odd rounds the other
            guests = visitors.withColumn("block", met).filter(F.col("block") < F.col("from") if turn % 2 == 0 else F.col("block") > F.col("from")).drop("from", "blocks")
            met_rows = residents.join(guests, keys).select("lang", "sources", "totals", "payload", "width", "terms", "visitor", "visitor_sources", "visitor_totals")
            parts.append(stored(met_rows.mapInArrow(_meetings, _SUMS)).select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    values = parts[0]
    for p in parts[1:]:
        values = values.unionByName(p)
    values = values.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return values.withColumn("rank", rank).filter((F.col("part") == "pair") | (F.col("rank") <= TOP))


def _binary(numbers: str) -> Column:
    """An array of longs as little-endian bytes."""

    @F.pandas_udf("binary")
    def run(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda a: None if a is None else np.asarray(a, "<i8").tobytes())

    return run(numbers)
