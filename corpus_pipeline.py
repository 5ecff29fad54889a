"""From raw documents to packed training pieces: five stages, each over all that the one before kept.

Null columns, empty texts, repeated rows and an empty table go through every stage as its operator defines it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import jaccard_join, language_mixture, line_spread, piece_dropout, suffix_decontam
from tradewind.llm.common import crc_part, fresh, staged

NEAR_COPY = dict(words=5, num=80, den=100)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language, or in several, stay; those without a letter go.  Learns from the documents whose id's crc32 modulo 3 isn't 1."""
    held_out = F.coalesce(crc_part(F.col("doc_id"), 3) == 1, F.lit(False))
    model = language_mixture.train(docs.where(~held_out))
    name = fresh(docs, "_language")
    found = language_mixture.identify(docs, model, into=name)
    return found.where(~language_mixture.rejected(F.col(name))).drop(name)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many sites stay in one place only; the length column follows the text."""
    before = fresh(docs, "_before")
    cut = line_spread.drop_spread_lines(docs.withColumn(before, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(before))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    # a text that lost every line holds nothing that isn't kept elsewhere
    return cut.where(~(changed & (F.col("text") == ""))).drop(before).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.drop_near_copies(docs, **NEAR_COPY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return suffix_decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text; `lossless` says that they decode to the text again."""
    coded = piece_dropout.encode(docs.select("doc_id", "source", "lang", "text"))
    return coded.select("doc_id", "source", "lang", "encoded.n_pieces", "encoded.ids", "encoded.lossless")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

ORACLE_SQL = None  # language inference and seeded segmentation have no SQL form; a test compares each stage's rows with plain Python, and the pieces by what they decode to


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
