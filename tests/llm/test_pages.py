"""HTML extraction and WARC archives."""

import base64
import hashlib
import html
import re

import pytest

from tests.llm.conftest import SF
from tidemark.llm._dom import decoded, features, main_text, parse
from tidemark.llm._practice_pages import MARK, PageMaker
from tidemark.llm.html_extract import extract_main_text, train_extractor
from tidemark.llm.warc import deduplicated_archives, read_archives, records, resolve_revisits, write_archives, write_deduplicated

AWKWARD = [
    (1, None, None, 1, "x"),
    (2, "http://a", "", 1, "x"),
    (3, "http://b c\n", "<p>only</p>", 1, "x"),
    (3, "http://b c\n", "<p>only</p>", 1, "x"),
    (4, "", "<p>only</p>", 1, "x"),
    (5, "u", "<html><body><article><p>" + "long words here. " * 50_000 + "</article>", 1, "x"),
    (6, "u", "no markup at all < 3 & \U0001f600", 1, "x"),
    (7, "u", "<div><div><!-- open <p>", 1, "x"),
]


@pytest.fixture(scope="session")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="session")
def awkward_pages(spark):
    return spark.createDataFrame(AWKWARD, "page_id long, url string, html string, text int, path string").repartition(2)


def test_extraction_of_the_articles(spark, pages):
    for r in extract_main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        blocks = (html.unescape(re.sub("<[^>]*>", "", b)) for b in re.split("</?(?:p|h1)>|<br>", article))
        assert r["text"] == "\n".join(" ".join(b.split()) for b in blocks if b.strip()) and r["n_chars"] == len(r["text"])


def test_extraction_of_unseen_layouts(spark):
    forest = train_extractor()
    import numpy as np

    exact = kept = wanted = right = 0
    for seed in range(10_000, 10_200):
        source = PageMaker(seed).page()
        marked = parse(source)
        want = [b for n, k in marked.order if MARK in (b := marked.block(n, k))]
        want = "\n".join(b.replace(MARK, "") for b in want)
        page = parse(source.replace(MARK, ""))
        got = main_text(page, decoded(page, forest.logits(np.array(features(page))).tolist()))
        exact += got == want
        a, b = got.split(), want.split()
        kept, wanted = kept + len(a), wanted + len(b)
        right += len(set(got.split("\n")) & set(want.split("\n"))) / max(1, len(set(want.split("\n")) | set(got.split("\n"))))
    assert exact >= 140 and right >= 180 and abs(kept - wanted) < 0.1 * wanted


def test_comments_notices_and_forms_go(spark):
    body = "".join(f"<p>{'plain words of the story go on here, '.strip() * 6}</p>" for _ in range(5))
    source = (
        "<html><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies.</div>"
        f"<main><article class=post><h1>Title &amp; more</h1>{body}<aside class=sidebar>Look here too</aside></article>"
        "<section class=comments><div class=comment><p>First! I say something about it.</p></div></section></main>"
        "<form><label>Mail</label><input></form><footer>&copy; me</footer></body></html>"
    )
    df = spark.createDataFrame([(1, "u", source)], "page_id long, url string, html string")
    text = extract_main_text(df).first()["text"]
    assert text.startswith("Title & more\nplain words") and text.count("\n") == 5


def test_kept_nodes_have_kept_ancestors():
    page = parse("<body><div><p>a</p></div><div><p>b</p><p>c</p></div>")
    by_text = {page.block(n, k): n for n, k in page.order}
    logits = [-1.0] * len(page.nodes)
    logits[by_text["b"]] = 9.0
    keep = decoded(page, logits)
    assert keep[by_text["b"]] and not keep[by_text["a"]] and not keep[by_text["c"]]
    assert all(keep[page.nodes[i].parent] for i, k in enumerate(keep) if k and i)


def test_markup_that_is_not_closed():
    page = parse("<ul><li>one<li>two</ul><p><b>three<br>four<p>five &amp; &lt;six&gt<script>x='</p>'</script> seven<table><tr><td>a<td>b</table>")
    assert [page.block(n, k) for n, k in page.order] == ["one", "two", "three four", "five & <six> seven", "a", "b"]


def test_extraction_of_awkward_pages(spark, awkward_pages):
    rows = sorted(extract_main_text(awkward_pages).collect(), key=lambda r: r["page_id"])
    assert len(rows) == len(AWKWARD) and rows[0]["text"] == rows[1]["text"] == "" and rows[0]["n_chars"] == 0
    assert rows[5]["n_chars"] == 17 * 50_000 - 1
    assert extract_main_text(awkward_pages.limit(0)).count() == 0


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def test_archives_round_trip(spark, pages, tmp_path):
    twice = pages.unionByName(pages.selectExpr("page_id + 1000 page_id", "url", "html").where("page_id % 3 = 0")).repartition(4)
    want = {r["page_id"]: r["html"] for r in twice.collect()}
    found = {r["page_id"]: tuple(r)[1:] for r in deduplicated_archives(twice).collect()}
    assert found == {
        p: (len(h.encode()), digest(h), "revisit" if p >= 1000 else "response", p - 1000 if p >= 1000 else None) for p, h in want.items()
    }
    headers = write_archives(twice, archive_bytes=10_000, path=str(tmp_path / "a"))
    assert headers.select("path").distinct().count() > 8
    archives = write_deduplicated(headers, resolve_revisits(headers), path=str(tmp_path / "b"))
    for path in (r["path"] for r in archives.collect()):
        for fields, block in records(path):
            page = want[int(fields["X-Page-ID"])]
            assert fields["WARC-Type"] == "revisit" or block.endswith(page.encode())
            assert fields["WARC-Type"] == "response" or {"WARC-Refers-To", "WARC-Profile", "WARC-Refers-To-Date"} <= set(fields)
    assert read_archives(archives).count() == len(want)


def test_archives_of_awkward_pages(spark, awkward_pages):
    rows = awkward_pages.unionByName(spark.createDataFrame([(None, "n", "<p>only</p>", 1, "x")], awkward_pages.schema))
    found = sorted((tuple(r) for r in deduplicated_archives(rows).collect()), key=str)
    assert len(found) == len(AWKWARD) + 1
    assert [r[3:] for r in found if r[0] == 1] == [("response", None)] and [r[3:] for r in found if r[0] == 2] == [("revisit", 1)]
    assert sorted(r[3:] for r in found if r[0] == 3) == [("response", None), ("revisit", 3)]
    assert [r[3:] for r in found if r[0] in (4, None)] == [("revisit", 3)] * 2
    assert all(r[1] == 11 for r in found if r[2] == digest("<p>only</p>"))
    small = {r["page_id"]: r["record_type"] for r in deduplicated_archives(rows, min_bytes=12).collect()}
    assert set(small.values()) == {"response"}
    assert deduplicated_archives(awkward_pages.limit(0)).count() == 0


@pytest.mark.parametrize("siblings", [63, 64, 200])
def test_share_of_siblings_with_the_same_tag(siblings):
    page = parse("<section>" + "<p>text</p>" * (siblings - 1) + "<div>advert</div></section>")
    share = {page.nodes[i].tag: row[13] for i, row in enumerate(features(page))}
    assert share["div"] == 1 / siblings and share["p"] == (siblings - 1) / siblings
