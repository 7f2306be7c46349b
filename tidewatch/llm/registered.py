"""The operators of this package as queries over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm import oracles
from tidewatch.llm.bpe import bpe_round_trip
from tidewatch.llm.decontamination import contained_items
from tidewatch.llm.hard_negatives import hard_negatives, integer_vectors
from tidewatch.llm.licenses import license_notices
from tidewatch.llm.near_duplicates import near_duplicates
from tidewatch.llm.phrases import collocations
from tidewatch.llm.pieces import encode_pieces
from tidewatch.llm.pii import BASE, find_pii, is_base, spelt
from tidewatch.llm.quality import judged
from tidewatch.llm.substrings import repeated_words
from tidewatch.llm.token_counts import token_counts
from tidewatch.llm.token_files import read_token_files, write_token_files
from tidewatch.llm.transcripts import numbered_lines, parse_transcripts, train, with_features
from tidewatch.scratch import fresh_dir
from tidewatch.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

# Rows of an Arrow batch: whole texts are some kilobytes each, so batches stay small.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts(_documents(spark, sf_dir), vocabulary)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", is_base)

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(kind.name).alias(f"n_{kind.name}") for kind in BASE],
        F.sha2(spelt(base), 256).alias("base_sha256"),
        spelt(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    plain = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    n_words = F.when(plain == "", 0).otherwise(
        F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1
    )
    whole = docs.select(
        "doc_id",
        F.xxhash64("text").alias("copy"),
        n_words.cast("bigint").alias("n_words"),
        F.sha2(plain, 256).alias("_whole"),
    )
    less = repeated_words(docs)
    less = less.select("doc_id", "copy", "n_removed", F.sha2("kept_text", 256).alias("_left"))
    return whole.join(less, ["doc_id", "copy"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("_left", "_whole").alias("kept_sha256"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    write_token_files(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_token_files(spark, path).select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return contained_items(_documents(spark, sf_dir), items).drop("copy")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return bpe_round_trip(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = with_features(numbered_lines(table(spark, sf_dir, "conversations")))
    parsed = parse_transcripts(lines, train(lines))
    return parsed.select(
        "conv_id", "position", F.col("state_role").alias("role"), "opens", "rendered"
    )


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), round_trip=True)
    return encoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("bigint").alias("bytes_spanned"),
    )


QUERIES: dict[str, Query] = {
    name: query for name, query in list(globals().items()) if name.startswith("op")
}

# For the others SQL has no form at all (vocabulary files, trained models, links of near copies) or none
# within reasonable time on whole tables; the tests compare with plain versions instead.
ORACLE_SQL: dict[str, str] = {
    "op11_collocations": oracles.COLLOCATIONS,
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
}
