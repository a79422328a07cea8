"""The queries of this folder, as the driver registers them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import Staging
from . import alignment, collisions, decontaminate, langid, lattice, licenses, linededup, neargraph, pii, quality, simhash, simple8b, whitening
from .common import fold_of

# The key is the caller's secret; the registered query uses a plain one.
DEMONSTRATION_KEY = b"farelake demonstration key"
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id"), 3) == 1
    model = quality.fit_quality(docs, table(spark, folder, "labels").where(~held_out))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, folder, "documents"), Staging(spark))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    matched = decontaminate.with_matches(docs, table(spark, folder, "benchmark"))
    return matched.select("doc_id", F.explode("_llm_matches").alias("match")).select("doc_id", "match.*")


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    model = langid.fit_languages(docs.select("doc_id", "text", "lang").where(~held_out))
    predicted = langid.predict_languages(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", F.size(F.split("text", "\n", -1)).alias("n_lines"))
    found = linededup.deduplicate_lines(docs, Staging(spark), wordless=0)
    kept = F.col("n_lines") - F.size("deleted_lines")
    return found.select(
        "doc_id", F.size("deleted_lines").alias("n_deleted"), "deleted_lines", kept.alias("n_kept"),
        F.crc32("text").alias("text_crc32"))


def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neargraph.near_duplicates(table(spark, folder, "embeddings"), Staging(spark))


def op8_token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    target = f"{Staging(spark).path}/corpus"
    simple8b.write_corpus(table(spark, folder, "documents").select("doc_id", "text"), target, lambda: simple8b.WordEncoder(path))
    stored = simple8b.read_corpus(spark, target)
    return stored.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = pii.pseudonymise_documents(docs, DEMONSTRATION_KEY)
    return done.select("doc_id", F.size("pii_spans").alias("n_values"), "text")


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(corpus_pipeline.PIECES)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = lattice.encode(docs, path, Staging(spark)).withColumn("text", F.crc32("text"))
    checked = lattice.digests(encoded, path)
    return checked.select("doc_id", F.size("ids").alias("n_tokens"), "ids_crc32", (F.col("text") == F.col("decoded_crc32")).alias("round_trip"))


def op11_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return collisions.nearest_neighbours(table(spark, folder, "embeddings"), Staging(spark), lambda vec_id: vec_id % 20 == 0)


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    # A deviation that no long holds is null.
    return whitening.whiten(table(spark, folder, "embeddings"), Staging(spark)).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return alignment.align_corpus(
        docs, public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(corpus_pipeline.PIECES), Staging(spark))


LLM_QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_license_scan": op4_license_scan,
    "op5_language_id": op5_language_id,
    "op6_line_dedup": op6_line_dedup,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_token_output": op8_token_output,
    "op9_pii": op9_pii,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLE: dict[str, str] = {}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
