"""The queries of this subpackage by name, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tablewright.llm import pieces
from tablewright.llm.bpe import decode, encode
from tablewright.llm.language import held_out, identify, train
from tablewright.llm.mixing import mix
from tablewright.llm.pivots import near_vectors
from tablewright.llm.quality import BASE, POLICIES, ledger, passes
from tablewright.llm.quotes import link_quotes
from tablewright.llm.runs import periodic_runs, plant, run_digests
from tablewright.llm.simhash import near_duplicates
from tablewright.llm.spelling import variants, word_counts
from tablewright.llm.substring import remove_repeated_words
from tablewright.llm.suffix_dedup import remove_repeated_bytes
from tablewright.llm.warc import read_archive, read_files, write_archive, write_files
from tablewright.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_bpe_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    done = decode(encode(_texts(spark, sf_dir), path).drop("text"), path)
    return done.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = ledger(_texts(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE)).alias("base_failed"), passes(POLICIES["clean_prose"]).alias("kept"),
    )


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(table(spark, sf_dir, "conversations"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(_texts(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_texts(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(documents)
    return identify(documents.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), f"{path}/archive")
    write_files(read_archive(spark, f"{path}/archive", revisits=False), f"{path}/files")
    return read_files(spark, f"{path}/files", payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(_texts(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(plant(_texts(spark, sf_dir)))).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )


def op12_sentencepiece_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = pieces.decode(pieces.encode(_texts(spark, sf_dir), path).drop("text"), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(_texts(spark, sf_dir), id_col="doc_id", damage=199)
    return variants(counts.where("n >= 5"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe_encoding_and_decoding,
        op2_quality_rules,
        op3_chat_formatting,
        op4_suffix_array_dedup,
        op5_simhash_near_dedup,
        op6_embedding_near_dedup,
        op7_language_id,
        op8_mixing_sources,
        op9_warc,
        op10_substring_dedup,
        op11_periodic_runs,
        op12_sentencepiece_encoding_and_decoding,
        op13_spelling_variant_grouping,
        pipeline,
    )
}

#: SQL for DuckDB, where it can express a query.
ORACLE: dict[str, str] = {
    "op2_quality_rules": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM places
), repeated AS (
  SELECT doc_id, least(3, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 3)) AS own FROM windows WHERE n > 1
), repeats AS (
  SELECT doc_id, sum(own) AS n FROM repeated GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(repeats.n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM measured
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * len(lines)
    OR word_chars > 15 * n_words OR word_chars < 2 * n_words OR 2 * n_capitals > word_chars) AS kept
FROM judged
"""
}
