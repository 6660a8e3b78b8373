"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulint.llm import quality
from tabulint.llm.decontamination import clean_documents
from tabulint.llm.line_dedup import drop_repeated_lines
from tabulint.llm.near_dedup import one_of_each_class
from tabulint.llm.packing import pack, public_tokenizer
from tabulint.llm.shipping import ship
from tabulint.llm.storage import stored
from tabulint.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# SQL expresses none of the trained, sampled or optimised stages; tests hold them against brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that naive Bayes support vectors score below one half go."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, read_table(spark, f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter("score >= 0.5").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a repeated three-line window covers go, but for the window's first occurrence."""
    ship(spark)
    kept = drop_repeated_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least doc_id stays."""
    ship(spark)
    return one_of_each_class(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go."""
    ship(spark)
    return clean_documents(docs.select(*COLUMNS), read_table(spark, f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all remaining documents, each with its training sequence and place there."""
    ship(spark)
    return pack(docs, public_tokenizer(), keep_ids=False)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what each returns is written as Parquet and reread for the next."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
