"""One query per operator over its whole table, and the SQL that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import oracle
from tidemark.llm.chat_format import formatted_conversations
from tidemark.llm.decontaminate import contamination
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.fill_middle import fill_in_middle_digests
from tidemark.llm.html_extract import extract_main_text
from tidemark.llm.ngram_join import ngram_jaccard_groups
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import quality_scores
from tidemark.llm.suffix_dedup import repeated_spans
from tidemark.llm.token_counts import token_counts
from tidemark.llm.token_store import token_store
from tidemark.llm.warc import deduplicated_archives
from tidemark.llm.whitening import whitened_components


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_groups(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated_archives(table(spark, sf_dir, "pages"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: Said by both rows of the conversation that op11 adds to its table: control strings inside a text.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    return formatted_conversations(table(spark, sf_dir, "conversations").select(*added.columns).unionByName(added))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digests(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_decontamination,
        op3_exact_dedup,
        op4_token_counts,
        op5_html_extraction,
        op6_warc_revisits,
        op7_quality_classifier,
        op8_suffix_dedup,
        op9_token_store,
        op10_packing,
        op11_chat_format,
        op12_fill_in_middle,
        op13_embedding_whitening,
    )
}
ORACLE_SQL: dict[str, str] = oracle.SQL
