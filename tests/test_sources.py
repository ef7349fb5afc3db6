"""Readers and the story flow on rows that break them, and on rows that name their columns as the readers do."""

import io
import tracemalloc
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import classes as C
from tidemark.functions import numbers as N
from tidemark.operators import stories as S
from tidemark.plans import source_queries as Q
from tidemark.sources import documents as D
from tidemark.sources import statistics as X


def test_documents_that_cannot_be_read(spark):
    docs = [("a.xlsx", b"no zip"), ("b.xlsx", None), ("c.html", None), ("d.csv", b""), ("e.json", b"{"), ("f.pdf", b"%PDF"), ("g", b"\xff\xfe;x"), ("h.html", b"<table><tr><td>1")]
    found = D.document_tables(spark.createDataFrame(docs, "path string, content binary")).collect()
    errors = {r["source_url"]: r["error"] for r in found}
    assert errors == {"a.xlsx": "BadZipFile", "b.xlsx": "BadZipFile", "d.csv": None, "e.json": "no_table", "f.pdf": "unsupported_format", "g": None, "h.html": None}
    assert [r["cells"] for r in found if r["source_url"] == "h.html"] == [[["1"]]]


def test_bounds_report_what_they_leave_out(spark):
    page = b"<table><tr><td>1</td></tr><tr><td>2</td></tr></table>" * 3
    docs = spark.createDataFrame([("a.html", page)], "path string, content binary")
    cut = [(r["location"], r["error"], r["cut"]) for r in D.document_tables(docs, D.Bounds(tables=2, table_rows=1)).orderBy("location").collect()]
    assert cut == [("html:1", None, 1), ("html:2", None, 1), ("html:3", "left_out", 1)]
    assert [len(r["cells"]) for r in D.document_tables(docs, D.WHOLE).collect()] == [2, 2, 2]


def test_zip_members(spark):
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("x.csv", "1")
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("y.zip", inner.getvalue())
    docs = spark.createDataFrame([("a", outer.getvalue()), ("b", b"?"), ("c", None)], "path string, content binary")
    found = {(r["path"], bytes(r["content"] or b""), r["error"]) for r in D.zip_members(docs, "csv$").collect()}
    assert found == {("a/y.zip/x.csv", b"1", None), ("b", b"", "BadZipFile"), ("c", b"", "BadZipFile")}


def test_readers_keep_columns_of_any_name(spark):
    doc = '{"dataflow":"F","structure":{"dimensions":{"series":[{"id":"A","values":[{"id":"x"}]}],"observation":[{"id":"TIME","values":[{"id":"2020"}]}]}},"dataSets":[{"series":{"0":{"observations":{"0":[5.0]}}}}]}'
    rows = spark.createDataFrame([(1, 2, 3, 4, 5, 6, doc), (1, 2, 3, 4, 5, 6, None), (1, 2, 3, 4, 5, 6, "{")], "key int, s int, d int, o int, raw int, times int, text string")
    found = X.sdmx_json_indexed(rows).collect()
    assert [(r["key"], r["raw"], r["dims"], r["period"], r["value"]) for r in found] == [(1, 5, {"A": "x", "DATAFLOW": "F"}, "2020", 5.0)]
    for reader in (X.sdmx_xml, X.sdmx_json_flat, X.json_stat, X.rss_items):
        assert reader(rows).collect() == []


def test_exact_round(spark):
    values = [2.675, -2.675, 0.125, 0.375, 1e-30, 0.0, 123456.785, 2.5, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = [tuple(r) for r in rows.select(N.exact_round(F.col("v"), 2), N.exact_round(F.col("v"), 0)).collect()]
    assert got == [(None, None) if v is None else (round(v, 2), float(round(v))) for v in values]


def test_row_tests_on_nulls(spark):
    rows = spark.createDataFrame([(None, None, None)], "a string, b string, n int")
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    got = rows.select(C.is_total_sex(a), C.region_of(a), C.is_national_goal(a, b, a), C.is_monthly_total(a, n, b), C.count_or_zero(a), C.area(a, b), C.green_pillar(a, n)).first()
    assert tuple(got) == (False, None, False, False, 0.0, None, None)


def test_replacement_of_stories(spark):
    schema = "id string, url string, headline string, published_at string"
    head = "Casa, nuovo dato per Bari"
    old = spark.createDataFrame([("a", "http://x.org/1", head, "3"), ("b", "https://www.x.org/1/", head, "2"), ("c", "https://x.org/1", "Other", "1"), ("d", "https://x.org/2", head, "1"), ("e", None, head, "1")], schema)
    new = spark.createDataFrame([("n", "https://x.org/1?q", "New", "9"), ("d", "https://x.org/2", "New", "9"), ("m", "https://x.org/3", "New", "9")], schema)
    got = sorted((r["id"], r["headline"], r["published_at"]) for r in S.replace_legacy(old, new).collect())
    assert got == [("c", "Other", "1"), ("d", "New", "1"), ("e", head, "1"), ("m", "New", "9"), ("n", "New", "2")]
    assert S.replace_legacy(old.limit(0), new.limit(0)).collect() == []


def test_members_are_chosen_by_name(spark):
    def packed(*names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in names:
                z.writestr(n, n)
        return out.getvalue()

    docs = [("a.zip", packed("x.csv", "My_Data.CSV", "data2.csv")), ("b.zip", packed("y.csv", "z.csv")), ("c.zip", packed("n.txt")), ("d.zip", b"?"), ("data.zip", packed("q.csv"))]
    found = {r["archive"]: (r["path"], r["error"]) for r in D.chosen_members(spark.createDataFrame(docs, "path string, content binary"), "csv$", "data").collect()}
    assert found == {"a.zip": ("a.zip/My_Data.CSV", None), "b.zip": ("b.zip/y.csv", None), "d.zip": ("d.zip", "BadZipFile"), "data.zip": ("data.zip/q.csv", None)}


def test_documents_are_made_and_read_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def content(n):
        made.add(1)
        return b"a,b\n1,2\n"

    docs = spark.range(12, numPartitions=2).select(F.concat(F.lit("/in/"), "id", F.lit(".csv")).alias("path"), content("id").alias("content"))
    assert D.document_tables(docs.localCheckpoint()).count() == 12
    before = made.value
    assert [r["cells"] for r in D.document_tables(docs).collect()] == [[["a", "b"], ["1", "2"]]] * 12
    assert made.value - before == 12


def test_plain_pages_are_read_as_the_parser_reads_them(monkeypatch):
    pages = ["<table><tr><td>a &amp; b<td>c</table>", '<!DOCTYPE html>x<TABLE><caption> t</caption><tr><th class="q">1</th></tr>', "<table><td>1 < 2</td></table>", "<table><!-- <td>x --><td>y</td>", "<table><td><script><td>z</td></script></table>", "<table><td>a<br/>b</td", ""]
    quick = [D.html_tables(p) for p in pages]
    monkeypatch.setattr(D, "_RAW", {"table", *D._RAW})
    assert [D.html_tables(p) for p in pages] == quick
    assert quick[0] == ([("", [["a & b", "c"]], 0)], 0) and quick[3][0][0][1] == [["y"]]


def test_members_leave_a_task_in_batches():
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("a.csv", "1")
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"path": [f"{i}.zip" for i in range(50)], "content": [archive.getvalue()] * 50})
    assert [b.num_rows for b in D._member_rows("csv", 1)(iter([batch]))] == [50]


def test_an_item_is_parsed_once(spark):
    """not once for each of its four fields."""
    feeds = spark.createDataFrame([(1, "<rss><item><title>a</title><link>b</link></item><item><title>c</title></item></rss>")], "key int, text string")
    found = X.rss_items(feeds, most=2)
    assert [(r["n"], r["title"], r["url"], r["summary"]) for r in found.collect()] == [(0, "a", "b", "")]
    assert found._jdf.queryExecution().analyzed().toString().lower().count("from_xml(") == 1


def test_documents_are_parsed_once(spark):
    """A condition on what is parsed must not parse again: neither one that Spark infers nor one that it moves."""
    rows = spark.createDataFrame([(1, "{}")], "id int, text string").repartition(2)
    for reader in (X.sdmx_xml, X.sdmx_json_indexed, X.json_stat):
        plan = reader(rows)._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
        assert not [line for line in filters if "from_json" in line or "from_xml" in line or "regexp_extract_all" in line], reader.__name__


def test_json_stat_labels_by_place(spark):
    """Places with gaps and places that two labels share; values as a list and as an object, and neither."""
    index = '"dimension":{"a":{"category":{"index":{"x":1,"y":1,"w":null,"z":2}}},"b":{"category":{"index":{"q":1,"p":0}}}}'
    docs = [
        (1, '{"id":["a","b"],"size":[3,2],"value":[1,null,2,3.5,null,4],' + index + "}"),
        (2, '{"id":["a","b"],"size":[3,2],"value":{"5":7,"x":8,"2":null},' + index + "}"),
        (3, '{"id":["a","b"],"size":[3,2],"value":9,' + index + "}"),
        (4, '{"id":["a"],"value":[1'),
    ]
    found = {(r["id"], r["value"]): r["coords"] for r in X.json_stat(spark.createDataFrame(docs, "id int, text string")).collect()}
    assert found == {
        (1, 1.0): {"a": None, "b": "p"}, (1, 2.0): {"a": "x", "b": "p"}, (1, 3.5): {"a": "x", "b": "q"}, (1, 4.0): {"a": "z", "b": "q"},
        (2, 7.0): {"a": "z", "b": "q"},
    }


def test_a_broken_series_leaves_the_others(spark):
    series = '<Series><SeriesKey><Value id="A" value="1"/><Value id="A" value="2"/></SeriesKey><Obs><ObsDimension value="2020"/><ObsValue value="{}"/></Obs>{}</Series>'
    docs = [(1, "<D>" + series.format(1, "") + series.format(2, "<open>") + series.format(3, "") + "</D>"), (2, "<D>" + series.format(4, "") + "</D>")]
    found = sorted((r["id"], r["series"], r["value"], r["dims"]["A"]) for r in X.sdmx_xml(spark.createDataFrame(docs, "id int, text string")).collect())
    assert found == [(1, 0, 1.0, "1"), (1, 2, 3.0, "1"), (2, 0, 4.0, "1")]


@pytest.mark.parametrize("decoder", [D._member_rows("csv", 1), D._sheet_rows("Lines", D.WHOLE, 1), D._decoder(D.WHOLE)])
def test_documents_of_a_batch_are_held_one_by_one(decoder):
    """a decoder made Python objects of all documents of a batch, some 64 MB, besides the batch."""
    batch = pa.RecordBatch.from_pydict({"path": ["a.xlsx"] * 100, "content": [b"no zip" + bytes(200_000)] * 100})
    if decoder.__qualname__.startswith("_decoder"):
        batch = pa.RecordBatch.from_pydict({"path": ["a.xlsx"] * 100, "kind": ["xlsx"] * 100, "text": pa.array([None] * 100, pa.string()), "content": batch.column("content")})
    tracemalloc.start()
    list(decoder(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4_000_000


def test_short_cells_fill_a_batch(monkeypatch):
    """a cell takes a Python string, so that batches bounded by characters alone held many times their bytes."""
    monkeypatch.setattr(D, "BATCH_SIZE", 1 << 16)
    texts = ["\n".join(["1,2,3,4"] * 25)] * 50
    batch = pa.RecordBatch.from_pydict({"path": ["a.csv"] * 50, "kind": ["csv"] * 50, "text": texts, "content": pa.array([None] * 50, pa.binary())})
    found = [b.num_rows for b in D._decoder(D.WHOLE)(iter([batch]))]
    assert sum(found) == 50 and max(found) <= 10


def test_workbooks_are_not_made_of_arrow_batches(spark):
    """of these a task held thousands of workbooks and archives, each several times."""
    rows = spark.createDataFrame([("<si><t>a</t></si>", "<row/>")], "shared string, rows string")
    plan = rows.select(Q._workbook("shared", "rows"), Q._several(F.lit("n"), F.lit("b"), "shared", "rows"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython") == 1 and "ArrowEvalPython" not in plan


def test_archives_are_not_made_of_arrow_batches(spark):
    """of these a task held thousands of texts and archives, each several times."""
    plan = spark.createDataFrame([("a;b",)], "text string").select(Q._archive("text"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_archives_give_their_texts(spark):
    """empty and long texts, and more archives than a batch of the function holds."""
    texts = [f"k;v\r\n{i};{'x' * (i % 3 * 40_000)}" for i in range(250)]
    made = spark.createDataFrame(enumerate(texts), "n int, text string").coalesce(1).select(F.concat("n", F.lit(".zip")).alias("path"), Q._archive("text").alias("content"))
    found = {r["path"]: (bytes(r["content"]).decode(), r["error"]) for r in D.zip_members(made, r"\.csv$").collect()}
    assert found == {f"{i}.zip/year.zip/data.CSV": (t, None) for i, t in enumerate(texts)}


def test_sheets_leave_a_task_in_batches(monkeypatch):
    """sheets of short cells were held until their characters alone filled a batch."""
    monkeypatch.setattr(D, "BATCH_SIZE", 1 << 16)
    line = "".join(f'<row><c r="{letter}1"><v>{i}</v></c></row>' for i, letter in enumerate("ABCD"))
    books = [Q._workbook.func("", line * 50)] * 40
    batch = pa.RecordBatch.from_pydict({"path": ["a.xlsx"] * 40, "kind": ["xlsx"] * 40, "text": pa.array([None] * 40, pa.string()), "content": books})
    found = list(D._decoder(D.WHOLE)(iter([batch])))
    assert sum(b.num_rows for b in found) == 40 and max(b.num_rows for b in found) <= 5
    assert {str(c) for b in found for c in b.column("cells").to_pylist()} == {str([["0"], ["", "1"], ["", "", "2"], ["", "", "", "3"]] * 50)}
