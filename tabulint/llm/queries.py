"""The registered queries of the operators for training data, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulint.llm import language, quality, substring_dedup, suffix_dedup, whitening
from tabulint.llm.decontamination import leaks
from tabulint.llm.exact_dedup import exact_duplicates
from tabulint.llm.fingerprints import edited_neighbours
from tabulint.llm.line_dedup import drop_repeated_lines
from tabulint.llm.near_dedup import near_duplicates
from tabulint.llm.negatives import hard_negatives
from tabulint.llm.packing import pack, public_tokenizer
from tabulint.llm.sharding import assign_shards
from tabulint.llm.shipping import ship
from tabulint.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARDS = 40


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = shipped
        return shipped

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/embeddings.parquet")


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir), [1.0] * SHARDS)


@query("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.col("text").alias("kept_text"))


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.train(docs, read_table(spark, f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", quality.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizer(), keep_ids=False)


@query("op1_near_dedup")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), read_table(spark, f"{sf_dir}/benchmark.parquet"))


@query("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(documents(spark, sf_dir))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return suffix_dedup.digests(suffix_dedup.drop_repeated_bytes(docs))


@query("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substring_dedup.digests(substring_dedup.drop_repeated_words(docs))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embeddings(spark, sf_dir)
    return whitening.whitened_components(vectors, whitening.fit(vectors))


@query("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embeddings(spark, sf_dir)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("op12_exact_dedup")
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))
