"""Identities, scores and places of stories against a plain version, over pages and over texts that break patterns."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
NUMBER = re.compile(r"(?<!\w)[+-]?(?:20\d{2}|\d{1,3}(?:[\.,]\d+)?)\s*(?:%|milioni|miliardi|mila)?")
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def page_text(html):
    text = re.sub(r"(?is)<(script|style|nav|footer|header|aside)\b.*?</\1\s*>|<!--.*?-->", " ", html)
    text = re.sub("(?s)<[^>]*>", " ", text)
    for entity, char in ENTITIES.items():
        text = text.replace(entity, char)
    return re.sub(r"\s+", " ", text).strip(" ")


def core(token):
    for word in ("milioni", "miliardi", "mila", "%"):
        token = token.lower().replace(word, "")
    return re.sub("[^0-9,.-]", "", token).strip(" .,-")


def figures(tokens):
    return "|".join(sorted({c for c in map(core, tokens) if c and not re.fullmatch(r"20\d{2}", c)}))


def words_of(title):
    return [w for w in re.sub("[^a-z0-9à-ù ]", " ", title.lower()).split(" ") if w]


def topic_of(text):
    return next((name for name, words in T.TOPICS.items() if any(w in text.lower() for w in words)), "ALTRO")


def score_of(text):
    low = text.lower()
    score = min(35, 5 * sum(t in low for t in T.STAT_TERMS)) + min(30, 6 * len(NUMBER.findall(low)))
    score += 10 * bool(re.search(r"\b(20\d{2}|\d{1,2}[\.,]\d+\s*%\b)", low)) + 15 * any(w in low for w in T.RECORD_WORDS) + 5 * any(g in low for g in T.GEO)
    return min(100, score)


def places_of(text):
    return [g for g in sorted(T.GEO) if re.search(r"(?<!\w)" + re.escape(g) + r"(?!\w)", text.lower())][:12]


def identities(url, title, text):
    subject, tokens = topic_of(text), NUMBER.findall(text.lower())
    key = " ".join(words_of(title))
    host, path = re.match(r"[a-z]+://(?:www\.)?([^/:?#]*)[^/?#]*([^?#]*)", url).groups()
    link = f"https://{host.lower()}{path.rstrip('/')}"
    story = hashlib.sha256(f"{link}|{key or subject}".encode()).hexdigest()[:24]
    head = title.lower().split(" - ")[0].split(" | ")[0]
    long = [w for w in words_of(head) if len(w) >= 4 and w not in T.KEY_STOP_WORDS][:7]
    semantic = hashlib.sha256(f"{subject}|{' '.join(sorted(set(long)))}|{figures(tokens)}".encode()).hexdigest()[:20]
    return story, semantic


def test_identities_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = {r["page_id"]: r for r in registry.QUERIES["story_identities"](spark, SF).collect()}
    assert len(found) == len(pages) > 0
    for p in pages:
        title, text, got = (re.search("<h1>(.*?)</h1>", p["html"]) or ["", ""])[1], page_text(p["html"]), found[p["page_id"]]
        assert (got["story"], got["semantic"]) == identities(p["url"], title, text), p["page_id"]
        assert got["score"] == score_of(text) and got["places"] == places_of(text)


TEXTS = [
    "Istat: +2,5% nel 2024 e 38.000 addetti, record a Roma",
    "x12 a1,5 -3% (4) 5 milioni 6miliardi 7.5 mila 1234 20245 0,5%.",
    "valle d'aosta e Aostana, l'Emilia-Romagna; romano, bari.",
    "è9 é 9é _8 8_ 12.345,6",
    "",
    "pressione fiscale al 42,1 %, 2023",
]


@pytest.mark.parametrize("text", TEXTS)
def test_numbers_scores_and_places(spark, text):
    row = spark.createDataFrame([(text,)], "t string")
    got = row.select(T.numbers(F.col("t")), T.candidate_score(F.col("t")), T.places(F.col("t")), T.topic(F.col("t"))).first()
    assert [n.strip() for n in got[0]] == [n.strip() for n in NUMBER.findall(text.lower())]
    assert tuple(got[1:]) == (score_of(text), places_of(text), topic_of(text))


def test_spellings_of_numbers(spark):
    rows = spark.createDataFrame([("12,5 %",), ("38.000",), ("1,234",), ("2024",), ("%",), ("-3,1 milioni",)], "t string")
    found = [sorted(r[0]) for r in rows.select(T.number_variants(F.col("t"))).collect()]
    assert found == [["12,5", "12.5"], ["38,000", "38.000", "38000"], ["1,234", "1.234", "1234"], ["2024"], [], ["3,1", "3.1"]]


def test_editorial_titles_and_article_scores(spark):
    rows = spark.createDataFrame([("Il FESTIVAL della statistica", 61, ["roma"], ["1", "2"]), ("Prezzi in calo", 100, [], []), (None, 40, [], ["1"])], "t string, c int, g array<string>, n array<string>")
    found = rows.select(T.is_editorial(F.col("t")), T.article_score(F.col("c"), F.col("g"), F.col("n"))).collect()
    assert [tuple(r) for r in found] == [(True, 95), (False, 100), (None, 70)]
