"""One query per operator, over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, importance, languages, lines, merkle, minhash, packing, pages, periodic, simhash, substrings, urls
from tidemark.llm.common import table
from tidemark.llm.registry import query
from tidemark.llm.sql import CHAT, DECONTAMINATE, IMPORTANCE, LINES, MINHASH, SUBSTRINGS, URLS

TOKENIZERS = "/opt/tokenizers"


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file."""
    try:
        import public_tokenizers
    except ImportError:
        return f"{TOKENIZERS}/{name}"
    return str(public_tokenizers.path(name))


@query(SUBSTRINGS)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


@query(DECONTAMINATE)
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query(LINES)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_recurring(docs).select("doc_id", "n_lines", "n_dropped", "text")


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, tokenizer_path(packing.TOKENIZER))).drop("certified")


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = languages.learn(docs.select("doc_id", "text", "lang"))
    guessed = languages.identify(docs.select("doc_id", "text"), model)
    return guessed.select("doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query(CHAT)
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(extra), tokenizer_path(chat.TOKENIZER)))


@query(URLS)
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", F.col("host"), "path", "rule", "verdict")


@query()
def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@query(MINHASH)
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.find_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), planted=True))


@query(IMPORTANCE)
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
