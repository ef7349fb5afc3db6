"""Addresses, names and stages of verification on the cases that define them."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import links as L
from tidemark.operators import evidence as V
from tidemark.operators import names as M
from tidemark.operators import verification as W
from tidemark.sources import documents as D

#: RFC 3986, section 5.4, against this base.
BASE = "http://a/b/c/d;p?q"
REFERENCES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y",
    "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x",
    "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g",
    "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g",
    "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/",
    "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x",
    "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x",
}


def test_references_of_the_standard(spark):
    rows = spark.createDataFrame([(BASE, r) for r in REFERENCES] + [("http://a", "g"), (None, "g"), (BASE, None)], "base string, ref string")
    found = {(r["base"], r["ref"]): r["u"] for r in rows.select("base", "ref", L.resolved(F.col("base"), F.col("ref")).alias("u")).collect()}
    assert {k[1]: v for k, v in found.items() if k[0] == BASE and k[1] is not None} == REFERENCES
    assert found["http://a", "g"] == "http://a/g" and found[None, "g"] is None and found[BASE, None] is None


def test_attachments_are_files_of_the_same_host(spark):
    html = '<a href="data/one.XLSX">1</a><a href="/two.csv?x=1&amp;y=2#t">2</a><a href="https://other.example.net/three.csv">3</a><a href="four.pdf">4</a><a href=data/one.XLSX>again</a><a href="//www.stat.example.org/five.json">5</a><a name="x">6</a>'
    rows = spark.createDataFrame([(html, "https://stat.example.org/a/index.html"), (None, "https://stat.example.org/"), (html, None)], "h string, u string")
    found = [r[0] for r in rows.select(L.attachments(F.col("h"), F.col("u"))).collect()]
    assert found[0] == ["https://stat.example.org/a/data/one.XLSX", "https://stat.example.org/two.csv?x=1&y=2", "https://www.stat.example.org/five.json"]
    assert not found[1] and not found[2]
    assert rows.select(L.attachments(F.col("h"), F.col("u"), ["csv"], 1)).first()[0] == ["https://stat.example.org/two.csv?x=1&y=2"]


def test_ten_thousand_names(spark):
    r = random.Random(6)
    word = lambda n: "".join(r.choice("abcdeé ") for _ in range(n))
    names = [(word(r.randrange(2, 7)).upper(), f"d{r.randrange(300)}", r.randrange(500)) for _ in range(10_000)]
    names += [("", "never", 1), (None, "never", 1), ("abc", None, 0), ("abc", "same", 3), ("abc", "same", 9)]
    texts = [(i, word(r.randrange(200)), "x") for i in range(60)] + [(97, None, "x"), (98, "", "x"), (99, "no name: zzz", "x"), (99, "ABC", "x")]
    rows = spark.createDataFrame(texts, "id int, text string, row string").repartition(3)
    table = spark.createDataFrame(names, "name string, domain string, rank int").repartition(2)

    def plain(text):
        met = {}
        for name, domain, rank in names:
            if name and domain and name.lower() in (text or "").lower():
                met[domain] = min(rank, met.get(domain, rank))
        return sorted(met, key=lambda d: (met[d], d))

    want = sorted((i, t or "", plain(t)) for i, t, _ in texts)
    for name_bytes in (1 << 20, 60_000):
        found = M.named_domains(rows, table, name_bytes=name_bytes)
        assert found.columns == [*rows.columns, "domains"]
        assert sorted((r["id"], r["text"] or "", r["domains"]) for r in found.collect()) == want
    assert M.named_domains(rows, table.limit(0)).where(F.size("domains") > 0).count() == 0


CLAIMS = [(1, ["12,5 %", "2024"], ["alpha", "beta"]), (2, ["7"], ["alpha", "beta"]), (3, ["99"], ["alpha"]), (4, ["2024"], ["alpha", "beta"]), (None, ["5"], ["alpha"]), (1, ["12,5 %", "2024"], ["alpha", "beta"])]
PAGES = [("u1", "ALPHA and beta: 12.5 in all"), ("u2", "alpha beta 12,5"), ("u3", "alpha beta 7"), ("u4", None), ("u5", "alpha 2024 beta gamma")]


def test_later_stages_look_at_open_claims_only(spark):
    claims = spark.createDataFrame(CLAIMS, "claim int, numbers array<string>, keywords array<string>")
    pages = spark.createDataFrame(PAGES, "url string, text string")
    seen = []

    def stage(rows):
        def candidates(open_):
            seen.append(sorted(r["claim"] for r in open_.collect()))
            return spark.createDataFrame(rows, "claim int, place int, url string, trusted boolean")

        return candidates

    one = [(1, 5, "u1", True), (1, 2, "u2", True), (2, 0, "u4", True), (4, 0, "u5", True), (9, 0, "u1", True)]
    two = [(2, 0, "u3", True), (1, 0, "u1", True), (3, 0, "u3", False)]
    found, did = W.in_stages(claims, [("links", stage(one)), ("search", stage(two)), ("broad", stage([]))], pages)
    assert seen == [[1, 2, 3, 4], [2, 3, 4], [3, 4]]
    assert sorted((r["claim"], r["stage"], r["method"], r["url"], r["verification_score"]) for r in found.collect()) == [(1, 1, "links", "u2", 71), (2, 2, "search", "u3", 71)]
    assert [tuple(r)[2:] for r in did.orderBy("stage").collect()] == [(4, 3, 1), (3, 2, 1), (2, 0, 0)]


@pytest.mark.parametrize("content, kept", [('{"notes": "series break in 2020"}', 0), ('{"notes": "as before"}', 3), ("{", 3), (None, 3)])
def test_a_bulletin_withholds_every_series_of_its_page(spark, content, kept):
    html = '<a href="revision-2020.json">x</a><a href="one.csv">1</a><a href="two.csv">2</a>'
    pages = spark.createDataFrame([("https://e.example.org/p.html", html), ("https://e.example.org/q.html", '<a href="https://f.example.org/revision.json">x</a>')], "url string, html string")
    bulletins = spark.createDataFrame([("https://e.example.org/revision-2020.json", content), ("https://f.example.org/revision.json", '{"notes": "break"}')], "url string, content string")
    table = b"Share (%);2020;2021\nfirst part;1;2\nsecond part;3;5\nthird part;4;4\n"
    files = [(f"https://e.example.org/{n}.csv", table) for n in ("one", "two")]
    evidence = V.table_evidence(D.document_tables(spark.createDataFrame(files, "path string, content binary")))
    withheld = W.withheld_pages(pages, bulletins)
    series = W.page_series(pages, evidence, withheld, attached=3, each=2, most=3)
    assert [(r["n"], r["indicator"], r["delta"]) for r in series.orderBy("n").collect()] == [(1, "first part", 1.0), (2, "second part", 2.0), (3, "first part", 1.0)][:kept]
    assert W.page_series(pages, evidence, withheld, None, None, None).count() == 2 * kept


def test_trusted_hosts(spark):
    rows = spark.createDataFrame([(1, 0, "https://www.a.example.org/x"), (2, 0, "https://xa.example.org/"), (3, 0, None)], "claim int, place int, url string")
    domains = spark.createDataFrame([("a.example.org",), ("a.example.org",)], "domain string")
    assert {r["claim"]: r["trusted"] for r in W.trusted_hosts(rows, domains).collect()} == {1: True, 2: False, 3: False}
