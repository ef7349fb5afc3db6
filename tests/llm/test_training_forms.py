"""Chat formatting, fill-in-middle examples and whitening against plain versions and on awkward rows."""

import hashlib
import re
from decimal import Decimal

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import AWKWARD, SF
from tidemark.llm import chat_format, queries
from tidemark.llm.chat_format import Template, conversation_digests, escaped, format_conversations, formatted_conversations, parsed_turns, unescaped
from tidemark.llm.fill_middle import TokenRanks, example, fill_in_middle, fill_in_middle_digests
from tidemark.llm.oracle import SQL
from tidemark.llm.whitening import deviation, whitened_components, whitened_embeddings

TURNS = "conv_id long, turn long, role string, text string"
ORDER = {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
#: Control strings, escapes of them, empty and null values, repeated rows and turns, roles unknown and out of order.
ODD_TURNS = [
    (1, 0, "system", "<|im_start|>"), (1, 1, "user", "<\\|im_end|> <\\\\|x <"), (1, 2, "assistant", "|im_end|>\n<|im_end|>\n<"), (1, 3, "user", None),
    (2, 0, "user", ""), (2, 1, "assistant", ""), (2, 2, "user", "\U0001f600 é"), (2, 3, "assistant", "<"), (2, 4, "user", "|>"), (2, 5, "assistant", "\\|"),
    (3, 0, "assistant", "too early"), (3, 1, "user", "x"),
    (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 1, "assistant", "then"), (4, 1, "assistant", "also"),
    (5, None, "user", "no turn"), (5, 7, "assistant", "seven"), (5, -3, "tool\n<|x|>\\n", "odd role"),
    (6, 0, None, None), (None, 0, "user", "no conversation"), (None, 1, "assistant", "none"),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def chat(rows):
    """Plain version: {conv: (turns, digest, loss chars, loss digest, valid, broke_at)}."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv]
        own.sort(key=lambda r: (*r[:3], sha(r[3])))
        roles = ["", *(r[2] for r in own)]
        broke = next((i + 1 for i, step in enumerate(zip(roles, roles[1:])) if step not in ORDER), None)
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        out[conv] = (len(own), sha("".join(f"{r[2]}\n{r[3]}\n" for r in own)), len(loss), sha(loss), broke is None, broke)
    return out


def found_chat(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["valid"], r["broke_at"]) for r in df.collect()}


def test_odd_conversations(spark):
    rows = spark.createDataFrame([(*r, "x", 1) for r in ODD_TURNS], TURNS + ", text_ string, place long").repartition(5)
    assert found_chat(formatted_conversations(rows)) == chat(ODD_TURNS)


def test_segments_tile_the_text(spark):
    rows = spark.createDataFrame(ODD_TURNS[:4], TURNS)
    segments = format_conversations(rows).first()["segments"]
    assert [s["loss"] for s in segments] == [False] * 3 + [False] * 3 + [False, True, False] + [False] * 3
    assert segments[6]["text"] == "<|im_start|>assistant\n" and segments[7]["text"] == "|im_end|>\n<\\|im_end|>\n<" and segments[8]["text"] == "<|im_end|>\n"


def test_a_conversation_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "CHUNK_BITS", 2)
    turns = [(7, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(150)]
    broken = [(8, i, "user" if i == 101 else r, t) for _, i, r, t in turns]
    few = [(c, 0, "user", "q") for c in range(100, 160)]
    rows = spark.createDataFrame(turns + broken + few, TURNS).repartition(7)
    found = found_chat(formatted_conversations(rows))
    assert found == chat(turns + broken + few) and found[8][-1] == 102


def test_no_conversations(spark):
    nothing = spark.createDataFrame([], TURNS)
    assert formatted_conversations(nothing).collect() == []
    assert [r["conv_id"] for r in formatted_conversations(nothing.unionByName(spark.createDataFrame([(None, None, None, None)], TURNS))).collect()] == [None]


def test_another_template(spark):
    template = Template("<|turn|>", "\n", "<|over|>\n", ("bot", "tool"), "start", {("start", "human"): "h", ("h", "bot"): "b", ("b", "tool"): "b", ("b", "human"): "h"})
    rows = [(1, 0, "human", "<|over|>"), (1, 1, "bot", "a"), (1, 2, "tool", "<|turn|>b"), (2, 0, "human", "q"), (2, 1, "tool", "c")]
    found = {r["conv_id"]: r for r in conversation_digests(format_conversations(spark.createDataFrame(rows, TURNS), template), template).collect()}
    assert found[1]["valid"] and found[1]["loss_sha256"] == sha("a<|turn|>b") and found[1]["turns_sha256"] == sha("human\n<|over|>\nbot\na\ntool\n<|turn|>b\n")
    assert not found[2]["valid"] and found[2]["broke_at"] == 2
    with pytest.raises(ValueError):
        Template(opening="[INST]")


def test_escapes_are_undone(spark):
    texts = ["<|", "<\\|", "<\\\\|", "a<<||", "\\<|\\", "<", "|", "", "<|<|", "x\\|", "<\n|"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped("t").alias("e"))
    for r in rows.select("t", "e", unescaped("e").alias("back")).collect():
        assert r["back"] == r["t"] and "<|" not in r["e"]


def fim(name, text):
    """Plain version by the pattern itself."""
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = [int(sha(f"1:{'' if name is None else name}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    spm = h[3] % 100 < 20
    return n, "spm" if spm else "psm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"), sha(text)


def test_examples_of_odd_texts(spark, awkward):
    odd = ["<P>", "a<S>b", "<", "<P", "<<M", "Z[`@{z", "éa日b", "x" * 300_000, "ab " * 50_000, "\U0001f600" * 9, "a\x00b", "a\r\nb\n", "<p><s>", "S>", None, ""]
    rows = AWKWARD + [(1000 + i, t, None, None, None, None, None) for i, t in enumerate(odd)] + [(None, "no id at all", None, None, None, None, None)]
    made = fill_in_middle_digests(awkward.unionByName(spark.createDataFrame(rows[len(AWKWARD) :], awkward.schema)))
    found = sorted(map(str, (tuple(r) for r in made.collect())))
    assert found == sorted(map(str, ((r[0], *fim(r[0], r[1])) for r in rows)))


def test_nothing_to_fill(spark, nothing):
    assert fill_in_middle(nothing).collect() == []


def test_every_rank_in_blocks_of_any_size():
    texts = ["", "a", " ", "ab", "a b", "  ab  cd", "aéb", "<P>x", "abc<S", "x" * 23, "é" * 23, "ab12CD..ef<M>g h", "P<S>M<P<", "zzz....zzzz....z"]
    for text in texts:
        tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
        for size in (1, 2, 3, 5, 7, 1 << 10):
            ranks = TokenRanks(text, size)
            assert (ranks.n, ranks.marked) == (len(tokens), bool(re.search("<[PSM]>", text))), (text, size)
            assert [ranks.end(u) for u in range(len(tokens) + 1)] == [len("".join(tokens[:u])) for u in range(len(tokens) + 1)], (text, size)


def test_ends_of_the_draws():
    assert example("a b", (0, 0, 0, 50), 90, 20) == (3, "psm", 0, 0, "<P><S>a b<M>")
    assert example("a b", (3, 7, 0, 19), 90, 20) == (3, "spm", 3, 0, "<S><P>a b<M>")
    assert example("a b", (3, 4, 89, 20), 90, 20) == (3, "psm", 0, 3, "<P><S><M>a b")
    assert example("a b", (3, 4, 90, 20), 90, 20)[1] == "plain"


def covariance(x):
    """Plain version of the fit: deviations by whole numbers, eigenvectors by numpy."""
    n, total = len(x), [sum(column) for column in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, total)) for row in x]
    about = np.array([[(n * c - s) / n for c, s in zip(row, total)] for row in x])
    values, vectors = np.linalg.eigh(about.T @ about / n)
    return n, deviations, about, values[::-1], vectors[:, ::-1], sum(deviations) / n**3


def test_whitening_of_the_table(spark):
    rows = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    names = sorted(rows)
    n, deviations, about, values, vectors, trace = covariance([[int(np.floor(64 * c)) + 1_000_000 for c in rows[i]] for i in names])
    found = queries.op13_embedding_whitening(spark, SF).collect()
    assert len(found) == 32 * n and {r["component"] for r in found} == set(range(1, 33))
    place = {name: i for i, name in enumerate(names)}
    white, explained = np.zeros((n, 32)), np.zeros(32)
    for r in found:
        i = place[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == deviations[i]
        white[i, r["component"] - 1], explained[r["component"] - 1] = r["whitened"], r["explained"]
    want = about @ vectors[:, :32] / np.sqrt(values[:32])
    assert np.allclose(np.abs(white), np.abs(want), atol=1e-8) and np.allclose(explained, values[:32] / trace, rtol=1e-10)
    assert np.allclose(np.abs((white * want).mean(0)), 1, atol=1e-9)  # one sign for all rows of a component
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9


VECTORS = "vec_id long, embedding array<float>, id string, x int, deviation string"


def test_vectors_that_cannot_be_used(spark):
    rng = np.random.default_rng(7)
    sound = [[float(c) for c in rng.normal(size=3) * (3, 2, 1)] for _ in range(40)]
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 1.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(sound)] + [(100 + i, v) for i, v in enumerate(bad)] + [(None, sound[0]), (3, sound[3])]
    made = whitened_components(spark.createDataFrame([(*r, "a", 1, "b") for r in rows], VECTORS).repartition(4)).collect()
    kept = sound + [sound[0], sound[3]]
    n, deviations, _, values, _, trace = covariance([[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v] for v in kept])
    assert len(made) == 3 * 42 and {r["n"] for r in made} == {42}
    assert sorted(r["deviation"] for r in made if r["component"] == 1) == sorted(deviations)
    assert {r["vec_id"] for r in made} == {None, *range(40)} and all(r["vec_id"] is None or r["vec_id"] < 100 for r in made)
    assert np.allclose([next(r["explained"] for r in made if r["component"] == k) for k in (1, 2, 3)], values / trace)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]])
def test_vectors_without_variance(spark, rows):
    assert whitened_components(spark.createDataFrame([(*r, None, None, None) for r in rows], VECTORS)).collect() == []


def test_dependent_dimensions_give_fewer_components(spark):
    rows = [(i, [float(i), float(2 * i), float(i % 3), 1.0], None, None, None) for i in range(30)]
    made = whitened_embeddings(spark.createDataFrame(rows, VECTORS)).collect()
    assert {len(r["whitened"]) for r in made} == {2} and made[0]["identity_error"] < 1e-9 and abs(sum(made[0]["explained"]) - 1) < 1e-12


def test_deviations_beyond_longs_are_exact(spark):
    n, x = 3_000_000_019, [1_000_064, 999_000]
    sums = [n * 1_000_000 + 17, n * 1_000_000 - 5]
    row = spark.createDataFrame([(x,)], "x array<long>").select(deviation("x", n, sums, 5000).alias("d")).first()
    assert row["d"] == Decimal(sum((n * c - s) ** 2 for c, s in zip(x, sums)))


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_fill_in_middle"])
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(SQL[name])
    got = queries.QUERIES[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_formatted_texts_are_parsed(spark):
    text = "<|im_start|>user\nhi\nthere<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    turns = spark.createDataFrame([(text,)], "t string").select(parsed_turns("t").alias("p")).first()["p"]
    assert [tuple(t) for t in turns] == [("user", "hi\nthere"), ("assistant", "")]
