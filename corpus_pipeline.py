"""From raw documents to training tokens, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import decontaminate, jaccard, line_dedup, pieces, quality
from ledgerlens.llm.frames import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules reject go."""
    return quality.keep_quality(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share go, except in the largest id; documents stay."""
    done = line_dedup.dedup_lines(docs)
    return done.select(*[F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col(c)).alias(c)
                         if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays, the one with the smallest id."""
    return jaccard.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every remaining document, checked by decoding them."""
    return pieces.round_trip(docs.select("doc_id", "text"), with_ids=True).drop("text")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", tokens),
]

#: Expectation maximisation (stage 1) and the pieces (stage 5) have no SQL form; tests hold
#: run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
