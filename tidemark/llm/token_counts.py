"""Token counts by a digest cache.

The cache is a table of (content digest, tokenizer digest, count) in the shared folder. Contents whose
digest it lacks are reduced to one row each and encoded; their counts are appended, and every document
is joined to the cache by its digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import BROADCAST_ROWS, id_and_text, remembering, scratch, spread_join, stored
from tidemark.llm.tokens import encoder, text_chunks

SCHEMA = "content binary, tokenizer string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: another vocabulary never meets stored counts of this one."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()[:32]


def _counted(tokenizer: str):
    @remembering
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(ids) // 4 for _, texts in text_chunks(batch.column("text")) for ids in encoder(tokenizer).encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(n, pa.int64())], names=["content", "n_tokens"])

    return run


def _cache(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], SCHEMA)


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, cache_path: str | None = None
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``cache_path`` names a cache that lasts between runs, in a folder all executors share; by default
    the run has one of its own. ``tokenizer`` is a tokenizers file that driver and executors have.
    over_limit: n_tokens > limit.

    Null text counts as empty and has no tokens. Repeated rows and null ids give their rows; an empty
    table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    path, version = cache_path or scratch(spark, "token_counts"), tokenizer_version(tokenizer)
    texts = id_and_text(docs, id_col, text_col).withColumn("content", F.unhex(F.sha2("text", 256)))
    known = _cache(spark, path).where(F.col("tokenizer") == version).select("content", "n_tokens")

    keyed = stored(texts.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "content"), "contents")
    contents = stored(keyed.groupBy("content").agg(F.count("*").alias("rows")), "distinct_contents")
    missing = few = None
    if not known.isEmpty():
        missing = stored(contents.select("content").join(known, "content", "left_anti"), "missing")
        few = missing.count() <= BROADCAST_ROWS
    source = texts.join(F.broadcast(missing), "content", "left_semi") if few else texts
    distinct = source.groupBy("content").agg(F.first("text").alias("text"))
    if few is False:
        distinct = distinct.join(missing, "content", "left_semi")
    new = distinct.mapInArrow(_counted(tokenizer), "content binary, n_tokens long")
    new.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(path)

    counts = _cache(spark, path).where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    counts = stored(contents.join(counts, "content"), "counts")
    return spread_join(keyed, counts, ["content"], "rows").select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
