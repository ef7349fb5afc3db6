"""A training corpus from ``documents``: quality, exact copies, near copies, contamination, packing.

Every stage takes the rows that the one before kept. All but the last return whole rows of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm._common import stored
from tidemark.llm.decontaminate import without_contaminated
from tidemark.llm.exact_dedup import without_copies
from tidemark.llm.ngram_join import one_of_each_group
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import without_rejected

#: Bytes of words that a worker remembers in the last stage: executors still hold memory of the stages before.
WORD_MEMORY = 32 << 20


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels that are not held out, scores at 0.5 or more.

    Each row by its own text, also without an id or where it repeats; null and empty texts by the bias. An
    empty table stays empty.
    """
    return without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text, the one with the smallest id.

    Exactly one row of each text, also where rows repeat their id or have none (those last); null counts as
    empty, and empty texts are equal. An empty table stays empty.
    """
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.75 or more over five-word shingles, the one with the smallest id.

    Rows of one id stay or go together. Rows without an id, and texts without words, stay. An empty table
    stays empty.
    """
    return one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lie in benchmark windows.

    Each row by its own text, also without an id or where it repeats; null and empty texts stay. An empty
    table stays empty.
    """
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 1,024 ids.

    Every row is a document of its own, also without an id or where it repeats; null and empty texts are one id. An
    empty table gives no pieces.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), memory_bytes=WORD_MEMORY)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages in turn, each result written to the shared folder as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
