"""A training corpus in five stages: rules, near-dedup, repeats, mixture, tokens.

Every stage is a function of (spark, docs, sf_dir) on all rows that its predecessor
kept. All but the last return the columns of ``documents``; ``run`` chains them over
Parquet tables in the shared folder.

Defined cases, for all stages: an empty table gives an empty result; null ids and repeated
ids are rows of their own; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, mixing, repetition, simhash, substring
from tessera.llm.lineage import stored
from tessera.llm.queries import tokenizer_path

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are too short or repeat themselves. Null and empty texts are too
    short; repeated rows are judged alike; a long text is measured whole."""
    return repetition.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of every group of near-duplicates. Of equal texts,
    null, empty and repeated ones too, one row stays; a null id is the smallest."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 35 words and more that stand anywhere else too out of the texts. Null
    and shorter texts stay as they are; a text may become empty; no row goes."""
    out = substring.remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mixture of the sources asks for: up to three equal
    rows, or none. A null source is one of its own; texts without words are not taken."""
    source = F.col("source").cast("string")
    out = mixing.mix(docs, F.array(source), mixing.word_count(F.col("text")), mixing.cycle((1, 2, 3)))
    given, copy = mixing.fresh(docs.columns, "_given"), mixing.fresh(docs.columns, "_copy")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(given).alias(copy)).drop(copy)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text as little-endian unsigned 32-bit integers, their number, and
    the digest of the text that the ids decode to. Null and empty texts have no tokens."""
    keep = tuple(c for c in ("doc_id", "lang", "source") if c in docs.columns)
    tokens = bpe.encode(docs, tokenizer_path(), keep=keep, out_col="decoded")
    tokens = tokens.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")
    return tokens.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
