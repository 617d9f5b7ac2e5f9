"""The queries of this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, divergence, hilbert, labelled, lsh, mixing, repetition, simhash, substring, subword, suffixes, tokenfile, toxicity
from .lineage import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, list_slice(w, i, i + 34) AS seq
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY seq) AS n FROM win) WHERE n > 1),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
gone AS (
  SELECT word.doc_id, p, word, max(dup.i) OVER (PARTITION BY word.doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS cut
  FROM word LEFT JOIN dup ON dup.doc_id = word.doc_id AND dup.i = word.p
),
agg AS (
  SELECT doc_id, count(*) FILTER (WHERE cut) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT cut) AS kept
  FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN agg USING (doc_id)
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(simhash.fingerprints(_table(spark, sf_dir, "documents")))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    size = F.octet_length(F.coalesce("text", F.lit("")))
    dimensions = {"lang": F.col("lang"), "source": F.col("source"), "length": F.floor(4 * F.log2(size + 1))}
    out = hilbert.shard(docs, dimensions, shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def op4_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.verdict(repetition.measure(_table(spark, sf_dir, "documents")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_chars", *[f"dup_chars_{n}" for n in repetition.MAX_NGRAM_SHARE])


def op6_min_cost_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("source").cast("string").alias("source"), mixing.word_count(F.col("text")).alias("size"))
    out = mixing.mix(docs, F.array("source"), F.col("size"), mixing.cycle((1, 2, 3)))
    return out.select("doc_id", "size", F.col("_sizes")[0].alias("source_size"), F.col("_targets")[0].alias("target"), (F.col("size") * F.size("_given")).alias("taken"), "source")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    tokens = bpe.encode(_table(spark, sf_dir, "documents"), path, out_col="decoded")
    return tokens.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def _scored(scores: DataFrame, fold: int, folds: int, threshold: float) -> DataFrame:
    held_out = labelled.fold("doc_id", folds) == fold
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    known = labelled.sample(docs, labels, "quality", labelled.fold("doc_id", 5) != 0, subword.PER_CLASS)
    model = subword.train([t for t, _ in known], [y for _, y in known])
    return _scored(subword.score(docs, model), 0, 5, 0.3)


def op9_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    counts = toxicity.counts_table(toxicity.trigram_counts(docs))
    known = labelled.sample(docs, labels, "toxic", labelled.fold("doc_id", 3) != 1, toxicity.PER_CLASS)
    lexicon, curve = toxicity.fit(known, toxicity.Restorer(toxicity.language_model(counts)))
    return _scored(toxicity.score(docs, toxicity.language_model(counts, lexicon), lexicon, curve), 1, 3, 0.7)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    tokenfile.write(_table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=1)
    return tokenfile.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_systolic_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_label_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.align(_table(spark, sf_dir, "documents"), *paths, digest=True).withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_substring_dedup, op2_simhash, op3_hilbert_sharding, op4_repetition_coverage, op5_subword_quality, op6_min_cost_mixing, op7_bpe_roundtrip,
        op8_multiprobe_lsh, op9_noisy_channel_toxicity, op10_suffix_array_dedup, op11_elias_fano_tokens, op12_systolic_divergence, op13_label_alignment,
    )
    return {f.__name__: f for f in found}


OP10_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p, hash(substr(h, 2 * p + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM d WHERE length(h) >= 200)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r FROM win) WHERE r > 1),
byte AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS b FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS p FROM d)),
gone AS (
  SELECT byte.doc_id, byte.p, b, max(dup.p) OVER (PARTITION BY byte.doc_id ORDER BY byte.p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) IS NOT NULL AS cut
  FROM byte LEFT JOIN dup ON dup.doc_id = byte.doc_id AND dup.p = byte.p
),
edge AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY p), false) AS starts FROM gone),
agg AS (
  SELECT doc_id, count(*) FILTER (WHERE cut) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans, string_agg(b, '' ORDER BY p) FILTER (WHERE NOT cut) AS kept
  FROM edge GROUP BY doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN agg USING (doc_id)
"""


def op4_sql() -> str:
    """The counts of repetition coverage and its verdict."""
    lengths = tuple(repetition.MAX_NGRAM_SHARE)
    gram = lambda n: f"CASE WHEN l{n - 1} IS NOT NULL THEN hash([word, {', '.join(f'l{k}' for k in range(1, n))}]) END"
    lead = ", ".join(f"lead(word, {k}) OVER (PARTITION BY doc_id ORDER BY i) AS l{k}" for k in range(1, max(lengths)))
    seen = ", ".join(f"row_number() OVER (PARTITION BY doc_id, g{n} ORDER BY i) > 1 AND g{n} IS NOT NULL AS r{n}" for n in lengths)
    inside = ", ".join(f"bool_or(r{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS in{n}" for n in lengths)
    sums = ", ".join(f"CAST(coalesce(sum(chars) FILTER (WHERE in{n}), 0) AS BIGINT) AS dup_chars_{n}" for n in lengths)
    columns = ", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in lengths)
    bad = " OR ".join(f"dup_chars_{n} > {share} * word_chars" for n, share in repetition.MAX_NGRAM_SHARE.items())
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
base AS (SELECT doc_id, text, w, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols FROM d),
line AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY p) > 1 AS dup, length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS p FROM base) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dup) AS n_dup_lines, CAST(coalesce(sum(chars) FILTER (WHERE dup), 0) AS BIGINT) AS dup_line_chars FROM line GROUP BY doc_id),
flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, n_words + 1)) AS i FROM base),
next AS (SELECT *, {lead} FROM flat),
word AS (SELECT doc_id, i, length(word) AS chars, {gram(3)} AS g3, {", ".join(f"{gram(n)} AS g{n}" for n in lengths)} FROM next),
rep AS (SELECT doc_id, i, chars, count(*) OVER (PARTITION BY doc_id, g3) > 1 AND g3 IS NOT NULL AS r3, {seen} FROM word),
cov AS (SELECT doc_id, chars, bool_or(r3) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS in3, {inside} FROM rep),
agg AS (SELECT doc_id, count(*) FILTER (WHERE in3) AS n_repeat_words, {sums} FROM cov GROUP BY doc_id),
all_counts AS (SELECT base.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(dup_line_chars, 0) AS dup_line_chars, coalesce(n_repeat_words, 0) AS n_repeat_words, {columns}
  FROM base LEFT JOIN lines ON lines.doc_id = base.doc_id LEFT JOIN agg ON agg.doc_id = base.doc_id),
judged AS (SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.MAX_REPEAT_WORDS_PERCENT} * n_words AS base_failed,
  dup_line_chars > {repetition.MAX_LINE_CHAR_SHARE} * word_chars OR n_dup_lines > {repetition.MAX_LINE_SHARE} * n_lines OR {bad} AS bad FROM all_counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR bad) AS kept, dup_line_chars, {", ".join(f"dup_chars_{n}" for n in lengths)} FROM judged
"""


OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
tok AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
one AS (SELECT r, lang, source, term, count(*) AS n FROM tok GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM one GROUP BY ALL HAVING count(*) >= 10),
lang AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
seen AS (SELECT one.lang, one.source, one.term, sum(one.n) AS n FROM one JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS total FROM seen GROUP BY ALL),
grp AS (SELECT g.lang, g.source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN total USING (lang, source)),
vec AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(seen.n, 0) AS n,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(seen.n, 0) + 2) // (grp.total + 2 * lang.v) AS BIGINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (kept.n + 2) // (lang.total + 2 * lang.v) AS BIGINT) AS q
  FROM grp JOIN kept USING (lang) JOIN lang USING (lang) LEFT JOIN seen ON seen.lang = grp.lang AND seen.source = grp.source AND seen.term = kept.term
),
met AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM vec a JOIN vec b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(met.value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN met ON met.lang = a.lang AND met.source = a.source AND met.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM vec WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op4_repetition_coverage": op4_sql(), "op10_suffix_array_dedup": OP10_SQL, "op12_systolic_divergence": OP12_SQL}
