"""Every stage against a plain version, over what the stage before kept."""

import public_tokenizers

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SF
from tests.llm.test_tokens import ids_of, packed_right
from tidemark.llm.quality import quality_scores


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r["doc_id"] for r in scores.collect() if r["predicted"]}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if name == "packing":
            break
        if name == "quality classifier":
            want = good
        elif name == "exact dedup":
            want = {d for d, found in brute.exact_groups(kept).items() if found[2]}
        elif name == "n-gram Jaccard join":
            want = {d for d, found in brute.jaccard_groups(kept).items() if found[1] == d}
        else:
            want = {d for d, found in brute.contamination(kept, items).items() if not found[4]}
        assert docs.columns == columns
        assert {r["doc_id"] for r in docs.collect()} == want and 0 < len(want) < len(kept)
        kept = {d: kept[d] for d in want}
    packed_right(docs.collect(), ids_of(public_tokenizers.path("byte_bpe_50k.json"), kept, 0))


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 0 and corpus_pipeline.ORACLE_SQL is None
