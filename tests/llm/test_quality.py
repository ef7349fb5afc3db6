"""The quality classifier on labels that it has not seen."""

import zlib

import numpy as np

from tests.llm.conftest import AWKWARD
from tidemark.llm.quality import BITS, features, quality_scores, score_quality, train_quality, without_rejected

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).join(labels, "doc_id", "left").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    seen = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] == r["quality"] for r in seen) >= 0.97 * len(seen)


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - quality else quality end quality")
    one, two = ({r["doc_id"]: r["score"] for r in quality_scores(docs, x, updates=2000).collect()} for x in (labels, turned))
    assert one == two


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1), (5, 1), (8, 0), (9, 0), (None, 1), (2, None), (77, 0)], "doc_id long, quality int")
    found = quality_scores(awkward, labels)
    assert found.count() == len(AWKWARD)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[1]["score"] == rows[2]["score"] == rows[3]["score"]
    assert quality_scores(nothing, labels).count() == 0
    assert {r["score"] for r in quality_scores(awkward, labels.limit(0)).collect()} == {0.5}
    assert without_rejected(awkward, labels.limit(0)).count() == len(AWKWARD)


def test_sample_is_bounded(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").selectExpr("doc_id id", "quality label")
    a = train_quality(docs, labels, sample_rows=10, updates=100)
    b = train_quality(docs.repartition(5), labels.repartition(3), sample_rows=10, updates=100)
    assert len(a) == 1 << BITS and np.array_equal(a, b) and np.any(a)
    assert score_quality(docs, a).count() == docs.count()


def test_features_have_unit_length():
    data = np.frombuffer("Aa bb bb, cc!! \xe9".encode(), np.uint8)
    (index, value), (none, one) = features(np.concatenate((data, data[:0])), np.array([0, len(data), len(data)]))
    assert len(set(index.tolist())) == len(index) and abs(np.sqrt((value[1:] ** 2).sum()) - 4) < 1e-9
    assert none.tolist() == [0] and one.tolist() == [1.0]


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [t.encode() for t in ("same words", "same words", "words!", "!words", "", "x", "x x", "x" * 9, "9 a 9 a", "a")]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    together = list(features(np.frombuffer(b"".join(texts), np.uint8), offsets))
    for text, (index, value) in zip(texts, together):
        ((alone, of_alone),) = features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert np.array_equal(index, alone) and np.array_equal(value, of_alone)
