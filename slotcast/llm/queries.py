"""Registered queries of the corpus operators, over the whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact, hamming, language_model, licenses, lines, near, packing, quality, runs, spelling, unigram, urls
from .common import GAP, free_name, table, text_of

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.similarity_classes(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """Every tenth text by the CRC-32 of its id made periodic from some word on: the planted runs of op11.

    With h the CRC-32, g = h div 10 and n words: word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) div (3 + g % 8).
    """
    words, n = free_name(docs, "words"), F.size
    out = docs.withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    out = out.withColumn(words, F.when(F.col("_h") % 10 == 0, F.filter(F.split(text_of("text"), GAP), lambda w: w != "")))
    g, count = F.floor(F.col("_h") / 10), F.nullif(n(F.col(words)).cast("long"), F.lit(0))
    out = out.withColumn("_a", (g % count).cast("int"))
    rest = count - F.col("_a")
    out = out.withColumn("_p", (1 + F.floor(rest / (3 + g % 8))).cast("int"))
    unit = F.slice(words, F.col("_a") + 1, F.col("_p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("_p")).cast("int"))), F.lit(1), rest.cast("int"))
    made = F.concat_ws(" ", F.concat(F.slice(words, F.lit(1), F.col("_a")), tail))
    return out.withColumn("text", F.when(n(F.col(words)) > 0, made).otherwise(F.col("text"))).select(*docs.columns)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(repeated_tails(table(spark, sf_dir, "documents").select("doc_id", "text")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines_ = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines_, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.near_classes(table(spark, sf_dir, "documents"))


def dropped_letters(doc_id: int | None, words: dict[bytes, int]) -> dict[bytes, int]:
    """The planted slips of op13: with h the CRC-32 of "doc_id:word", a word whose h is a multiple
    of 199 loses its letter h % length.  A null id changes nothing."""
    if doc_id is None:
        return words
    start, crc = zlib.crc32(b"%d:" % doc_id), zlib.crc32
    slips = [word for word in words if crc(word, start) % 199 == 0]
    if not slips:
        return words
    # All leave before any arrives: what a slip makes may slip itself where the text has it.
    out = dict(words)
    moved = [(word, out.pop(word)) for word in slips]
    for word, n in moved:
        letters = word.decode()
        at = crc(word, start) % len(letters)
        short = (letters[:at] + letters[at + 1 :]).encode()
        out[short] = out.get(short, 0) + n
    return out


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), change=dropped_letters)
    return spelling.spelling_variants(words)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_line_dedup,
        op3_lm_scoring,
        op4_token_counts,
        op5_ngram_jaccard_join,
        op6_exact_dedup,
        op7_quality_rules,
        op8_packing,
        op9_license_scans,
        op10_bpe_round_trip,
        op11_periodic_runs,
        op12_minhash_hamming,
        op13_spelling_variants,
    )
}
