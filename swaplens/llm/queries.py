"""The queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from swaplens.llm import (
    collocation, decontamination, embedding_dedup, hmm_scoring, html_text, language_id, merkle, mixing, ngram_join, sharding, suffix_dedup, token_output, toxicity,
)
from swaplens.llm.common import held_out, table, tokenizer_path


def op1_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(table(spark, sf_dir, "embeddings"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.drop("score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    tagged = toxicity.tag_documents(docs, model)
    return tagged.select(
        "doc_id",
        held_out(5).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_hmm_scoring": op1_hmm_scoring,
    "op2_token_output": op2_token_output,
    "op3_ngram_join": op3_ngram_join,
    "op4_html_text": op4_html_text,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_sharding": op9_sharding,
    "op10_mixing": op10_mixing,
    "op11_collocation": op11_collocation,
    "op12_language_id": op12_language_id,
    "op13_merkle": op13_merkle,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op3_ngram_join": ngram_join.ORACLE,
    "op5_embedding_dedup": embedding_dedup.ORACLE,
    "op6_decontamination": decontamination.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_collocation": collocation.ORACLE,
    "op13_merkle": merkle.ORACLE,
}
