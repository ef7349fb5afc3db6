import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n long, id string, hash int, keep boolean"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))

#: Nulls, empty and blank texts, a very long one, ties, near ties, repeated rows and ids, names that operators use.
AWKWARD = [
    (1, None, None, None, None, None, None),
    (2, "", "en", 0, "a", 1, True),
    (3, "  \t\n ", "en", 3, "a", 1, True),
    (4, "one two", "en", 7, "a", 1, True),
    (5, "ONE  two", "en", 8, "a", 1, True),
    (6, LONG, None, 1, None, None, None),
    (7, LONG + " end", None, 1, None, None, None),
    (8, "the same words again and again in one text for all", "en", 1, "b", 2, False),
    (8, "the same words again and again in one text for all", "en", 1, "b", 2, False),
    (9, "the same words again and again in one text for all", "de", 1, "b", 2, False),
    (-10, "ünï cödé 日本語 \U0001f600 Ünï <|endoftext|> x y", "xx", 1, "c", 3, None),
    (11, "a b c d e f g h i j k l m n o p", "en", 1, "d", 4, True),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}
