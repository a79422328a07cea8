"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

quality -> line dedup -> near-dedup -> decontamination -> SentencePiece encoding and decoding. Each stage works on all
that its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from farelake.llm import decontaminate, lattice, linededup, nearcopies, quality
from farelake.llm.common import fold_of, free_name
from farelake.session import Staging

PIECES = "piece_bpe_32k.model"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labels outside the held-out third.

    Null and empty texts have a score like others. Without labels every document is kept.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold_of(F.col("doc_id"), 3) != 1)
    model = quality.fit_quality(docs, labels)
    score = free_name(docs, "_llm_score")
    return quality.score_quality(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of repeated runs of lines.

    A document that loses all of its lines goes on as an empty one; a null text stays null.
    """
    deleted = free_name(docs, "deleted_lines")
    cleaned = linededup.deduplicate_lines(docs, Staging(spark), wordless=0, deleted=deleted)
    changed = F.size(deleted) > 0
    return cleaned.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, similarity 0.8 or more).

    Null texts and texts without words are copies of each other. Of equal rows one stays; rows with a null id come last.
    """
    return nearcopies.keep_first(docs, Staging(spark))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Null and empty texts contain none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    matches = free_name(docs, "_llm_matches")
    return decontaminate.with_matches(docs, benchmark, matches).where(F.size(matches) == 0).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: its token ids and the text that they decode to. A null text has null ids and a null text."""
    path = public_tokenizers.path(PIECES)
    encoded = lattice.encode(docs.select("doc_id", "text"), path, Staging(spark)).drop("text")
    return lattice.decode(encoded, path, "text").select("doc_id", "ids", F.size("ids").alias("n_tokens"), "text")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near-dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

# The classifier's numerical fit and the encoding can't be expressed in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
