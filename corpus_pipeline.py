"""The corpus pipeline: stages in order, each over all documents that its predecessor kept.

Each stage is one of the operators of ``tidemark.llm``.  All but the last return the
columns of ``documents``; the last packs what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, languages, lines, packing, simhash
from tidemark.llm.queries import tokenizer_path
from tidemark.session import cut_lineage

# A document stays if its language is known and likelier than all others together.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    guessed = languages.identify(docs, languages.learn(docs.select("doc_id", "text", "lang")))
    return guessed.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, recurring lines taken out of all but the first that has them."""
    cleaned = lines.drop_recurring(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    marked = decontaminate.mark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.filter(~F.col("contaminated")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the pieces of all documents with their sequence and place."""
    return packing.pack(packing.pieces(docs, tokenizer_path(packing.TOKENIZER))).drop("certified")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Byte-context models, XXH64 and the tokenizer cannot be stated in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage before it is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
