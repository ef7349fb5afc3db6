"""The learner and the decoding of trees against plain versions, and rows without ids through every operator that names them."""

import itertools
import math
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tests.llm.test_tokens import ids_of, packed_right
from tidemark.llm._dom import decoded
from tidemark.llm.fill_middle import fill_in_middle
from tidemark.llm.html_extract import extract_main_text
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import features, train_quality
from tidemark.llm.token_counts import token_counts
from tidemark.llm.warc import deduplicated_archives

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def plain_ftrl(examples, rounds, alpha, beta, l1, l2):
    """Follow the regularised leader, one coordinate after another; {coordinate: weight}."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(rounds):
        for x, y in examples:
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


@pytest.mark.parametrize("rounds", [1, 3])
def test_weights_are_those_of_a_plain_learner(spark, rounds):
    texts = ["calm words of a story", "BUY now !!! 99 % 99 % 99 %", "another calm story, in words", "!!! !!! $$$ now", "", "words words words words"]
    labels = [1, 0, 1, 0, 1, 0]
    rows = spark.createDataFrame(list(zip(range(6), texts)), "doc_id long, text string")
    learnt = spark.createDataFrame(list(zip(range(6), map(float, labels))), "id long, label double")
    bits, options = 12, {"alpha": 0.2, "beta": 1.0, "l1": 0.02, "l2": 0.1}
    found = train_quality(rows, learnt, bits=bits, updates=6 * rounds, **options)
    order = [r[0] for r in spark.sql("select id from range(6) order by xxhash64(id, 1), id").collect()]
    examples = []
    for d in order:
        data = np.frombuffer(texts[d].encode(), np.uint8)
        ((index, value),) = features(data, np.array([0, len(data)]), bits)
        examples.append((dict(zip(index.tolist(), value.tolist())), labels[d]))
    want = np.zeros(1 << bits)
    for i, w in plain_ftrl(examples, rounds, **options).items():
        want[i] = w
    assert np.count_nonzero(want) > 20 and np.allclose(found, want, atol=1e-6)


class Tree:
    def __init__(self, parents, chars):
        self.nodes = [type("Node", (), {"parent": p, "own_chars": c})() for p, c in zip(parents, chars)]


def test_decoding_finds_the_best_closed_set():
    r = random.Random(8)
    for _ in range(200):
        n = r.randrange(1, 12)
        parents = [-1] + [r.randrange(i) for i in range(1, n)]
        page, logits = Tree(parents, [r.choice((0, 3, 40, 500)) for _ in range(n)]), [r.uniform(-3, 3) for _ in range(n)]
        value = [x * (1 + math.log1p(node.own_chars)) for x, node in zip(logits, page.nodes)]
        closed = (s for s in itertools.product((False, True), repeat=n) if all(not k or p < 0 or s[p] for k, p in zip(s, parents)))
        best = max(sum(v for v, k in zip(value, s) if k) for s in closed)
        keep = decoded(page, logits)
        assert all(not k or p < 0 or keep[p] for k, p in zip(keep, parents))
        assert math.isclose(sum(v for v, k in zip(value, keep) if k), best, abs_tol=1e-9)


ROWS = [(None, "first text of no one", "x"), (None, "first text of no one", "x"), (None, None, None), (3, "named", "y"), (3, "", "y"), (None, "z" * 3000, "x")]


def unnamed(spark, id_name, text_name):
    return spark.createDataFrame([(*r, "clash", 1) for r in ROWS], f"{id_name} long, {text_name} string, url string, id string, row int").repartition(2)


def test_counts_and_examples_of_rows_without_ids(spark):
    rows = unnamed(spark, "doc_id", "text")
    want = sorted((r[0] or -1, len((r[1] or "").encode()), len(i)) for r, i in zip(ROWS, ids_of(BYTE, dict(enumerate(r[1] for r in ROWS))).values()))
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in token_counts(rows, BYTE).collect()) == want
    assert sorted(r["doc_id"] or -1 for r in fill_in_middle(rows).collect()) == [-1] * 4 + [3, 3]


def test_pieces_of_rows_without_ids(spark):
    found = pack_documents(unnamed(spark, "doc_id", "text"), BYTE).collect()
    lengths = sorted((r["doc_id"] or -1, r["doc_tokens"]) for r in found if r["start"] == 0)
    want = ids_of(BYTE, dict(enumerate(r[1] for r in ROWS)), 0)
    assert lengths == sorted((r[0] or -1, len(i)) for r, i in zip(ROWS, want.values()))
    assert sum(r["length"] for r in found) == sum(map(len, want.values()))


def test_pages_without_ids(spark):
    html = "<html><body><article><p>" + "Plain words of an article that go on for a while. " * 6 + "</p></article></body></html>"
    pages = spark.createDataFrame([(None, None, html, 1), (None, "u", html, 2), (None, None, None, 3), (4, "u", html, 4)], "page_id long, url string, html string, id int")
    found = extract_main_text(pages).collect()
    assert sorted((r["page_id"] or -1, r["n_chars"] > 0) for r in found) == [(-1, False), (-1, True), (-1, True), (4, True)]
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in deduplicated_archives(pages).collect())
    assert len(kinds) == 4 and (4, "response", None) in kinds


def test_the_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.count() == 0 and rows.columns[0] == "doc_id"


def test_the_pipeline_of_rows_without_ids_and_of_copies(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(80))
    texts = [(None, words), (None, words), (5, words + " tail"), (7, words), (9, "other words of another text altogether, none the same"), (None, None), (8, "")]
    rows = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in texts], spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = [(d, t) for d, t in [(5, words + " tail"), (9, "other words of another text altogether, none the same"), (8, "")]]
    want = ids_of(BYTE, dict(kept), 0)
    assert sorted((r["doc_id"], r["doc_tokens"]) for r in found if r["start"] == 0) == sorted((d, len(i)) for d, i in want.items())
    packed_right(found, want)
