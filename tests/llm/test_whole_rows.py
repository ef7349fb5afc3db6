"""The stages of the pipeline decide on rows: repeated ids, ids with several texts and rows without an id."""

from tests.llm.conftest import AWKWARD
from tidemark.llm.decontaminate import without_contaminated
from tidemark.llm.exact_dedup import without_copies
from tidemark.llm.quality import quality_scores, without_rejected


def test_one_row_of_each_text_stays(spark, awkward):
    kept = without_copies(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [-10, 1, 3, 4, 5, 6, 7, 8, 11]
    assert {tuple(r) for r in kept.collect()} <= set(AWKWARD)


def test_copies_without_ids_and_with_shared_ids(spark):
    rows = [("u", None, "x\t"), ("a", 9, "x "), ("u", None, "y"), ("u", None, "y"), ("b", 4, "p"), ("c", 4, "q"), ("d", 3, "q"), ("e", 4, "p")]
    rows += [("f", 7, None), ("g", None, "")]
    docs = spark.createDataFrame(rows, "lang string, doc_id long, text string").repartition(3)
    kept = without_copies(docs)
    found = sorted((r["doc_id"] or 0, (r["text"] or "").strip()) for r in kept.collect())
    assert kept.columns == docs.columns and found == [(0, "y"), (3, "q"), (4, "p"), (7, ""), (9, "x")]


def test_all_rows_without_ids(spark):
    docs = spark.createDataFrame([(None, "x")] * 3 + [(None, "z")], "doc_id long, text string").repartition(2)
    assert sorted(r["text"] for r in without_copies(docs).collect()) == ["x", "z"]
    assert without_copies(docs.where("text = 'z'")).count() == 1


def test_rows_are_rejected_by_their_own_text(spark):
    good, bad = "plain words of a calm story " * 4, "$$$ BUY !!! 99 %% NOW $$$ " * 4
    rows = [(i, good if i % 2 else bad) for i in range(60)] + [(None, good), (None, bad), (None, None), (1, bad), (0, good)]
    docs = spark.createDataFrame([("x", *r) for r in rows], "lang string, doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(2, 60)], "doc_id long, quality int")
    kept = without_rejected(docs, labels)
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in kept.collect() if r["text"])
    assert kept.columns == docs.columns and found == sorted([(-1, good), (0, good)] + [(i, good) for i in range(1, 60, 2)])
    assert kept.count() == quality_scores(docs, labels).where("predicted = 1").count()


def test_rows_are_contaminated_by_their_own_text(spark):
    rows = [(1, "clean text here"), (1, "one two three"), (None, "one two three"), (None, "other words"), (None, None), (2, "ONE, two")]
    docs = spark.createDataFrame([("x", *r) for r in rows], "text string, doc_id long, body string").repartition(3)
    items = spark.createDataFrame([(1, "one two"), (2, "two three")], "item_id long, text string")
    for block_bytes in (8 << 20, 60):
        kept = without_contaminated(docs, items, text_col="body", block_bytes=block_bytes)
        found = sorted((r["doc_id"] or 0, r["body"] or "") for r in kept.collect())
        assert kept.columns == docs.columns and found == [(0, ""), (0, "other words"), (1, "clean text here")]
