"""Delimited text and feeds where reading by lines or by counting marks goes wrong."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.sources import delimited
from tidemark.sources import statistics as X
from tidemark.sources.delimited import cells_of, csv_cells, told_mark

CASES = [
    ('"a,b,c,d,e,f,g,h,i,j";k\n1;2', ";", [["a,b,c,d,e,f,g,h,i,j", "k"], ["1", "2"]]),
    ('x,y\n"1\n2",3\n', ",", [["x", "y"], ["1\n2", "3"]]),
    ('x\ty\r\n"a ""b""\tc"\t2\r\n\r\n   \r\n', "\t", [["x", "y"], ['a "b"\tc', "2"]]),
    ("name;price\n" + "a;1,5\n" * 9, ";", [["name", "price"]] + [["a", "1,5"]] * 9),
    ("a, b\n1, 2\n", ",", [["a", "b"], ["1", "2"]]),
    ("only one column\nhere\n", ",", [["only one column"], ["here"]]),
    ('open,"quote\nto the end', ",", [["open", "quote\nto the end"]]),
    ("", ",", []),
    (" \n\n", ",", []),
    ("a;;\n;b;\n", ";", [["a", "", ""], ["", "b", ""]]),
    ("a;b\rc;d", ";", [["a", "b"], ["c", "d"]]),
]


@pytest.mark.parametrize("text, mark, cells", CASES)
def test_cells(text, mark, cells):
    assert told_mark(text)[0] == mark and cells_of(text) == cells
    assert cells_of("﻿" + text) == cells and cells_of("title, with; marks\r\n" + text, 1) == cells


def test_a_long_text_is_told_by_its_head_and_read_whole():
    text = 'k;"v, v, v"\n' + "".join(f'{i};"{"x, " * 40}"\n' for i in range(2000)) + '9;"' + "y" * 200_000 + '"\n'
    found = cells_of(text)
    assert len(found) == 2002 and {len(r) for r in found} == {2} and len(found[-1][1]) == 200_000


def test_cells_of_a_column(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)] + [(99, None)], "k int, t string").repartition(3)
    found = {r["k"]: r["c"] for r in rows.select("k", csv_cells(F.col("t")).alias("c")).collect()}
    assert found == {i: c[2] for i, c in enumerate(CASES)} | {99: None}


def test_cells_leave_a_task_in_batches(monkeypatch):
    """all cells of an Arrow batch, which may be ten times its bytes, were held at once."""
    monkeypatch.setattr(delimited, "BATCH_SIZE", 1 << 16)
    texts = pa.array(["\n".join(["1;2;3;4"] * 25), None, ""] * 50)
    found = list(delimited._decoded(0)(iter([texts, texts])))
    assert max(map(len, found)) <= 30 and sum(map(len, found)) == 300
    assert pa.chunked_array(found).to_pylist() == [[["1", "2", "3", "4"]] * 25, None, []] * 100


def feed(*items):
    return "<rss><channel>" + "".join(f"<item>{i}</item>" for i in items) + "</channel></rss>"


def test_items_are_counted_after_the_filter(spark):
    bad = ["<title>no link</title>", "<link>https://example.org/x</link>", "<title> </title><link>https://example.org/y</link>"]
    good = [f"<title>t{i}</title><link>\n https://example.org/{i}\n</link>" for i in range(6)]
    feeds = spark.createDataFrame([(1, feed(*bad, *good)), (2, feed(*bad)), (3, None), (4, "<rss>")], "n int, text string")
    found = [(r[0], r[1], r["title"], r["url"]) for r in X.rss_items(feeds, most=4).collect()]
    assert found == [(1, i, f"t{i}", f"https://example.org/{i}") for i in range(4)]
    assert X.rss_items(feeds, most=None).count() == 6


def test_prefixes_go_from_tags_alone(spark):
    item = '<m:title xmlns:m="u">a</m:title><link>https://example.org</link><description>see <![CDATA[<ns:z> & <b:c xmlns="x">]]> and <![CDATA[]]>end</description>'
    row = X.rss_items(spark.createDataFrame([(feed(item),)], "text string")).first()
    assert row["title"] == "a" and row["summary"] == 'see <ns:z> & <b:c xmlns="x"> and end'
