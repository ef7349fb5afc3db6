"""Main text of HTML pages: gradient-boosted trees over DOM-node features, and hierarchical decoding.

Every block-level node gets a probability that it holds main text, from its subtree's density, its
attribute tokens, depth and siblings, and what stands above it. Decoding keeps the ancestor-closed set
of nodes with the largest total score, so no kept node lies within a dropped one. The trees are
trained by Spark's GBTClassifier on a fixed number of made-up pages whose main text is known.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._common import col, trimmed
from tidemark.llm._dom import decoded, features, main_text, parse
from tidemark.llm._practice_pages import MARK, PageMaker

#: Pages that training makes, and the forest's size.
TRAINING_PAGES = 600
TREES = 24
DEPTH = 5


class Forest:
    """Trees as arrays: node i goes to left[i] where feature[i] <= threshold[i], else to right[i]; leaves point to themselves."""

    def __init__(self, trees: list[str], weights: list[float]):
        self.trees = [(w, *self._read(t)) for w, t in zip(weights, trees)]

    @staticmethod
    def _read(text: str):
        lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]
        feature, threshold, left, right, value = [], [], [], [], []

        def node(at: int) -> tuple[int, int]:
            me = len(feature)
            for column, start in ((feature, 0), (threshold, 0.0), (left, me), (right, me), (value, 0.0)):
                column.append(start)
            if m := re.match(r"Predict: (\S+)", lines[at]):
                value[me] = float(m[1])
                return me, at + 1
            feature[me], threshold[me] = (f(x) for f, x in zip((int, float), re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()))
            left[me], at = node(at + 1)
            right[me], at = node(at + 1)
            return me, at

        node(0)
        return tuple(np.array(x) for x in (feature, threshold, left, right, value))

    def logits(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for weight, feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
            total += weight * value[at]
        return 2 * total


def _practice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, rows = [], []
        for seed in batch.column("id").to_pylist():
            page = parse(PageMaker(seed).page())
            holds = [any(MARK in t for block in node.texts for t in block) for node in page.nodes]
            for node in page.nodes:
                node.texts = [[t.replace(MARK, "") for t in block] for block in node.texts]
                node.own_chars = sum(len(t.strip()) for block in node.texts for t in block)
                node.link_chars = min(node.link_chars, node.own_chars)
            for i in range(len(page.nodes) - 1, 0, -1):
                holds[page.nodes[i].parent] |= holds[i]
            labels += map(float, holds)
            rows += features(page)
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.float64()), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])


@functools.cache
def train_extractor(pages: int = TRAINING_PAGES, trees: int = TREES) -> Forest:
    """The forest for these numbers; the same at every call, so a driver trains it once."""
    spark = SparkSession.getActiveSession()
    nodes = spark.range(0, pages, 1, 4).mapInArrow(_practice, "label double, x array<double>")
    nodes = nodes.select("label", array_to_vector("x").alias("features")).cache()
    try:
        model = GBTClassifier(maxIter=trees, maxDepth=DEPTH, stepSize=0.25, seed=1, minInstancesPerNode=8).fit(nodes)
    finally:
        nodes.unpersist()
    return Forest([t.toDebugString for t in model.trees], list(model.treeWeights))


def _extract(broadcast):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = broadcast.value
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                pages = [parse(html.as_py()) for html in part.column("html")]
                rows = [features(page) for page in pages]
                logits = forest.logits(np.array([r for own in rows for r in own]))
                ends = np.cumsum([len(r) for r in rows])
                texts = [main_text(p, decoded(p, logits[e - len(r) : e].tolist())) for p, r, e in zip(pages, rows, ends)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return run


def extract_main_text(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Text is that of the blocks that the forest keeps, in page order, one a line; character references
    are decoded and white space in a block is single. Null, empty and textless pages give an empty
    text. Repeated rows repeat their result; an empty table gives an empty result. Other columns are
    ignored.
    """
    rows = pages.select(col(page_col).alias("page_id"), col(url_col).alias("url"), F.coalesce(col(html_col), F.lit("")).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    broadcast = pages.sparkSession.sparkContext.broadcast(train_extractor())
    return rows.mapInArrow(_extract(broadcast), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
