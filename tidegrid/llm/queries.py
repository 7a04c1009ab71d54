"""Queries of the text operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import audio, bpe_automaton, html_extract, kneser_ney, langid, ngram_join, packing, quality_rules, sharding, token_counts


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_extract.main_text(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def placed(docs: DataFrame) -> DataFrame:
    pieces = packing.packed(docs, vocabulary("byte_bpe_50k.json"), capacity=2048)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()))
    found = langid.predicted(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).drop("rejected_by")


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.audio_digests(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=85)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.balanced_shards(table(spark, sf_dir, "documents"), shards=24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encoded(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), with_text=False)


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_token_counts, op3_best_fit_packing, op4_language_id, op5_quality_rules, op6_media_columns, op7_quality_classifier, op8_ngram_jaccard_join, op9_sharding, op10_bpe_automaton)}



def _crc_table() -> list[int]:
    """The 256 remainders of CRC-32 by its reversed polynomial."""
    out = list(range(256))
    for _ in range(8):
        out = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in out]
    return out


ORACLE_SQL = {
    "op9_sharding": f"""
WITH b AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 8 AS size, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS pairs FROM documents),
t AS (SELECT doc_id, CAST(size AS BIGINT) AS size, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(pairs, lambda x: CAST('0x' || x AS BIGINT))), lambda c, x: xor(k.crc[CAST(xor(c, x) & 255 AS INTEGER) + 1], c >> 8)), 4294967295) AS text_crc32
      FROM b, (SELECT CAST({_crc_table()} AS BIGINT[]) AS crc) k),
s AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS r FROM t),
p AS (SELECT *, CAST(least(23, (2 * upto - size) * 24 // (2 * total)) AS INTEGER) AS shard FROM s)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, r - min(r) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p""",
    "op5_quality_rules": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
p AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM t),
g AS (SELECT doc_id, i, a, lead(a) OVER d AS b, lead(a, 2) OVER d AS c FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL),
f AS (SELECT DISTINCT doc_id, i + k AS at FROM r, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1),
m AS (SELECT doc_id, count(*) AS n_repeat_words FROM f GROUP BY doc_id),
c AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS upper,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters,
         length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS marks
  FROM t LEFT JOIN m USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 6 * n_lines OR word_chars > 20 * n_words
            OR 2 * word_chars < 3 * n_words OR 2 * marks > n_words OR 2 * letters < word_chars OR 2 * upper > word_chars) AS kept
FROM b""",
}
