"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import (
    decontaminate,
    fim,
    hard_negatives,
    html_text,
    jaccard,
    line_dedup,
    pieces,
    pii,
    quality,
    rlz,
    secret_scan,
    token_files,
    warc,
)
from ledgerlens.llm.frames import sha256_hex, shared_folder, table


def joined_spans(spans, kind="kind"):
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s[kind], s["start"], s["end"])), ",")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.ngram_jaccard_join(docs, every_link=False)[0]  # the classes need no link inside a component


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                         table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rlz.drop_repeated_passages(docs).select(
        "doc_id", "n_words", "n_removed", sha256_hex(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda kind: F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("bigint")
    return pii.find_pii(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS],
        sha256_hex(joined_spans(F.col("pii_base"))).alias("base_sha256"),
        joined_spans(F.col("pii")).alias("spans"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", sha256_hex(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.round_trip(docs).select("doc_id", "n_pieces", "ids_sha256", "round_trip")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.rebuilt(pages)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_secrets(docs).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), sha256_hex(joined_spans(base)).alias("base_sha256"),
                        joined_spans(F.col("secrets")).alias("spans"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_pages(pages).select("page_id", "url", "text", "n_chars")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fim.restore(fim.fill_in_middle(docs).drop("text")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha256_hex(F.col("output")).alias("output_sha256"), sha256_hex(F.col("restored")).alias("restored_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    ident, label = F.col("vec_id"), F.col("label")
    return hard_negatives.mine(vectors, ident % 50 == 0, F.when(ident % 7 == 0, (label + 1) % 10).otherwise(label))


def op13_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    token_files.write_ids(token_files.staged_tokens(table(spark, sf_dir, "documents")), path)
    return token_files.read_ids(spark, path, with_ids=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_ngram_jaccard, op2_decontamination, op3_substring_dedup, op4_quality_rules, op5_pii, op6_line_dedup,
        op7_sentencepiece, op8_warc, op9_secret_scan, op10_html_text, op11_fill_in_middle, op12_hard_negatives, op13_token_ids)}
