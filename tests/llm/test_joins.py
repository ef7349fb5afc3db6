"""N-gram join, decontamination, exact dedup and suffix dedup against plain versions."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import AWKWARD, SF
from tidemark.llm import _common, ngram_join, suffix_dedup
from tidemark.llm.components import connected_components
from tidemark.llm.decontaminate import contamination, without_contaminated, without_spans
from tidemark.llm.exact_dedup import _told_apart, build_index, directory, exact_dedup, without_copies
from tidemark.llm.ngram_join import ngram_jaccard_groups, one_of_each_group
from tidemark.llm.suffix_dedup import repeated_spans


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def near_copies(seed, groups=40):
    """Groups whose members differ from each other around the threshold, and texts that share one passage."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    out, passage = {}, [word() for _ in range(40)]
    for _ in range(groups):
        base = [word() for _ in range(r.choice((3, 6, 9, 14, 25, 60, 200, 500)))]
        for _ in range(r.choice((1, 2, 3, 8))):
            own = list(base)
            for _ in range(r.randrange(1 + len(base) // 12)):
                own[r.randrange(len(own))] = word()
            out[len(out)] = " ".join(own + (passage if r.random() < 0.2 else []))
    return out


def test_groups_agree_with_all_pairs(spark, docs, texts):
    assert by_id(ngram_jaccard_groups(docs), "n_shingles", "component_id") == brute.jaccard_groups(texts)


@pytest.mark.parametrize("tile_rows", [4096, 3])
def test_groups_near_the_threshold(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(ngram_join, "BATCH_KEYS", tile_rows)
    made = near_copies(7)
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    assert by_id(ngram_jaccard_groups(df), "n_shingles", "component_id") == brute.jaccard_groups(made)


@pytest.mark.parametrize("percent", [50, 60, 75, 90])
def test_linked_sets_share_a_key(percent):
    """At the threshold itself, for sets of all sizes up to 20,000 shingles: one inside the other, equal sizes and between."""
    r, keys = np.random.default_rng(percent), ngram_join.Keys(percent)
    draw = lambda n: r.integers(0, 1 << 64, int(n), np.uint64, endpoint=False)
    for n in [*range(1, 26), 40, 64, 90, 130, 300, 900, 2000, 6000, 20_000]:
        for _ in range(60 if n < 1000 else 4):
            a = draw(n)
            for lost in {0, n * (100 - percent) // 100, r.integers(0, n * (100 - percent) // 100 + 1)}:
                both = n - lost
                gained = both * 100 // percent - n if both else -1
                if gained < 0:
                    continue
                b = np.concatenate((a[:both], draw(r.choice([0, gained, r.integers(0, gained + 1)]))))
                x, y = np.unique(a), np.unique(b)
                assert 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))
                assert len(np.intersect1d(keys.of(x), keys.of(y)))


def test_spoilt_runs_at_the_front():
    """The differences lie where the keys are: in the first quarter of the common order."""
    r, keys = np.random.default_rng(8), ngram_join.Keys(75)
    for n in (9, 12, 40, 400, 4000):
        a = np.sort(r.integers(0, 1 << 64, n, np.uint64, endpoint=False))
        gone = np.arange(0, 3 * (n // 4), 3)
        assert len(np.intersect1d(keys.of(a), keys.of(np.delete(a, gone))))
        assert len(np.intersect1d(keys.of(a), keys.of(a[n // 4 :])))


def test_bitmaps_bound_from_above():
    r = np.random.default_rng(1)
    for _ in range(300):
        pool = np.unique(r.integers(0, 1 << 64, 300, np.uint64, endpoint=False))
        a, b = (np.unique(r.choice(pool, r.integers(1, 300))) for _ in range(2))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert ngram_join._possible((len(a), ngram_join._bitmap(a)), (len(b), ngram_join._bitmap(b)), 75)


def test_groups_of_awkward_rows(awkward, nothing):
    found = by_id(ngram_jaccard_groups(awkward), "n_shingles", "component_id")
    assert found[1] == (0, 1) and found[2] == (0, 2) and found[3] == (0, 3)
    assert found[4] == (1, 4) and found[5] == (1, 4) and found[7][1] == 6 and found[9] == (7, 8)
    assert ngram_jaccard_groups(awkward).count() == len(AWKWARD)
    assert ngram_jaccard_groups(nothing).count() == 0
    kept = one_of_each_group(awkward)
    assert kept.columns == awkward.columns and sorted(r[0] for r in kept.collect()) == [-10, 1, 2, 3, 4, 6, 8, 8, 11]


def test_groups_without_ids_and_with_shared_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (5, "a b c d e f"), (5, "q r s t u v"), (4, "q r s t u v")]
    found = ngram_jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in found) == [(0, 0), (0, 0), (3, 3), (4, 3), (5, 3), (5, 3)]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (7, 7)]
    r = random.Random(3)
    r.shuffle(edges)
    found = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {400: 400, 500: 400}


def test_contamination_agrees(spark, docs, texts):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute.contamination(texts, [tuple(r) for r in items.collect()])
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert by_id(contamination(docs, items), *columns) == want
    assert by_id(contamination(docs, items, block_bytes=4000), *columns) == want
    assert any(w[4] for w in want.values())


def test_contamination_of_awkward_rows(spark, awkward, nothing):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "..."), (4, "One two"), (4, "C D E"), (None, "again"), (None, "c d e"), (5, "f g h i j k l m n o p q"), (6, "d e f"), (7, "日本語")],
        "item_id long, text string",
    )
    docs = {r[0]: r[1] for r in AWKWARD}
    want = brute.contamination(docs, [(r["item_id"], r["text"]) for r in items.collect()])
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert by_id(contamination(awkward, items), *columns) == want
    assert by_id(contamination(awkward, items, block_bytes=150), *columns) == want
    assert want[11][:2] == (16, 4) and want[-10][2] == 1
    unnamed = awkward.where("doc_id in (4, 8)").select(F.lit(None).cast("long").alias("doc_id"), "text")
    assert sorted((r["doc_id"], r["n_hit"], r["n_items"]) for r in contamination(unnamed, items).collect()) == [(None, 2, 0), (None, 2, 0), (None, 2, 1)]
    assert contamination(nothing, items).count() == 0
    assert contamination(awkward, items.limit(0)).where("n_hit > 0 or contaminated").count() == 0
    assert {r["doc_id"] for r in without_contaminated(awkward, items).collect()} == {1, 2, 3, 6, 7}
    cut = by_id(without_spans(awkward.where("doc_id not in (8)"), items), "text")
    assert cut[11] == ("a b  g h i j k l m n o p",) and cut[4] == ("",) and cut[2] == ("",)


def test_exact_groups_agree(spark, docs, texts):
    found = exact_dedup(docs)
    assert by_id(found, "keep_id", "group_size", "kept", "text_sha256") == brute.exact_groups(texts)


def test_exact_groups_of_awkward_rows(awkward, nothing):
    found = exact_dedup(awkward)
    rows = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found.collect()]
    assert len(rows) == len(AWKWARD)
    assert sorted(r for r in rows if r[0] in (1, 2, 3, 4, 5)) == [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 1, True)]
    assert sorted(r[:3] for r in rows if r[1] == 8) == [(8, 8, 3), (8, 8, 3), (9, 8, 3)] and sum(r[3] for r in rows if r[1] == 8) == 1
    assert exact_dedup(nothing).count() == 0
    assert without_copies(awkward).columns == awkward.columns


def test_exact_dedup_keeps_a_named_row(spark):
    df = spark.createDataFrame([(None, "x"), (9, "x "), (None, "x\t"), (4, "x\n")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"]) for r in exact_dedup(df).collect()) == [(0, 0, 1), (0, 4, 3), (4, 4, 3), (9, 4, 3)]


def test_directory_doubles(spark):
    hashes = spark.range(1000).select(F.xxhash64("id").alias("hash"))
    depth, slots = directory(hashes, 40)
    assert slots.count() == 1 << depth and slots.select("slot").distinct().count() == 1 << depth
    loads = hashes.withColumn("slot", F.shiftrightunsigned("hash", 64 - depth)).join(slots, "slot").groupBy("bucket").count()
    assert loads.agg(F.max("count")).first()[0] <= 40 and loads.agg(F.sum("count")).first()[0] == 1000
    assert directory(hashes, 1000)[0] == 0


def test_index_holds_every_entry(spark, docs):
    assert by_id(exact_dedup(docs, bucket_entries=20), "keep_id", "group_size") == by_id(exact_dedup(docs), "keep_id", "group_size")


def test_index_chains_colliding_hashes(spark):
    """Hashes that collide make a chain in their bucket, and bodies with equal digests are told apart by their bytes."""
    rows = [(0, 5, 1, "s"), (1, 3, 1, "t"), (2, 9, 1, "s"), (3, None, 1, "t"), (4, 7, -8, "s")]
    keyed = spark.createDataFrame(rows, "row long, id long, hash long, text_sha256 string")
    depth, slots = directory(keyed.select("hash").distinct(), 1)
    index = build_index(keyed.withColumn("clash", F.lit(0)), depth, slots)
    found = {(r["hash"], r["text_sha256"]): (r["link"], r["keep_id"], r["group_size"]) for r in index.collect()}
    assert found == {(1, "s"): (1, 5, 2), (1, "t"): (2, 3, 2), (-8, "s"): (1, 7, 1)} and index.select("bucket").distinct().count() == 2
    texts = spark.createDataFrame([(0, 5, "x"), (1, 3, "y"), (2, 9, "x")], "row long, id long, body string")
    same = texts.select("row", "id", F.xxhash64("body").alias("hash"), F.sha2("body", 256).alias("text_sha256"))
    alike = same.where("row < 2").select("hash", "text_sha256").distinct()
    assert {r["row"]: r["clash"] for r in _told_apart(same, texts, alike).collect()} == {0: 1, 1: 1, 2: 1}


@pytest.mark.parametrize("hot_rows", [1000, 1])
def test_copies_of_a_third_of_all_rows(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(_common, "HOT_ROWS", hot_rows)
    rows = [(i, "copy" if i % 3 == 0 else f"text {i % 50}") for i in range(300)]
    want = brute.exact_groups(dict(rows))
    assert by_id(exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")), "keep_id", "group_size", "kept", "text_sha256") == want


def test_repeated_bytes_agree(spark, docs, texts):
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert by_id(repeated_spans(docs), *columns) == brute.repeated_bytes(texts)


@pytest.mark.parametrize("bucket_rows", [4096, 2])
def test_repeated_passages(spark, bucket_rows):
    r = random.Random(5)
    letters = lambda n: "".join(r.choice("abcdef é") for _ in range(n))
    passage, made = letters(90), {}
    for i in range(60):
        a, b = sorted(r.sample(range(90), 2))
        made[i] = letters(r.randrange(60)) + passage[a:b] + letters(r.randrange(30)) + r.choice(("", passage, "ab" * r.randrange(40)))
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(3)
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert by_id(repeated_spans(df, length=40, bucket_rows=bucket_rows), *columns) == brute.repeated_bytes(made, 40)


def test_repeated_bytes_of_awkward_rows(spark, awkward, nothing):
    found = by_id(repeated_spans(awkward), "n_bytes", "n_removed", "n_spans")
    size = len(AWKWARD[5][1])
    assert found[1] == found[2] == (0, 0, 0) and found[6] == (size, size, 1) and found[7] == (size + 4, size, 1)
    assert repeated_spans(nothing).count() == 0
    twice = spark.createDataFrame([(None, "x" * 500), (None, "y" * 399), (3, "z" * 400), (3, "z" * 400)], "doc_id long, text string")
    assert sorted((r["n_bytes"], r["n_removed"]) for r in repeated_spans(twice).collect()) == [(399, 0), (400, 400), (400, 400), (500, 500)]


@pytest.mark.parametrize("bucket_rows", [4096, 1])
def test_unequal_texts_of_equal_polynomial_hash_stay(spark, bucket_rows):
    """Strings whose difference, at a stride of 32 bytes, is (y - 1)^9 (y + 1)^3: equal under any odd base modulo 2^64."""
    difference = np.poly1d([1])
    for root, times in ((1, 9), (-1, 3)):
        for _ in range(times):
            difference *= np.poly1d([1, -root])
    one, two = bytearray(b"!" * 400), bytearray(b"!" * 400)
    for i, c in enumerate(difference.coeffs.astype(int)):
        (one if c > 0 else two)[32 * i] += abs(c)
    one, two = one.decode("ascii"), two.decode("ascii")
    df = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"]) for r in repeated_spans(df, bucket_rows=bucket_rows).collect()) == [(1, 0), (2, 0)]


def test_multikey_quicksort_orders_and_measures():
    r = random.Random(11)
    for letters, most in (("ab", 60), ("a\0", 30), ("abcdefgh", 90)):
        strings = ["".join(r.choice(letters) for _ in range(r.randrange(most))).encode() for _ in range(400)]
        strings += [strings[0] + b"x" * 50, b"", b"", strings[1]] + [b"q" * 100 + bytes([i % 3]) for i in range(80)]
        for width in (40, 33):
            order, common = suffix_dedup.multikey_quicksort(strings, width)
            got = [strings[i][:width] for i in order]
            assert got == sorted(s[:width] for s in strings) and sorted(order) == list(range(len(strings)))
            assert common[0] == -1
            assert [len(os.path.commonprefix((a, b))) for a, b in zip(got, got[1:])] == common[1:].tolist()


def test_equal_windows_have_equal_anchors():
    r = np.random.default_rng(2)
    data = r.integers(97, 101, 900).astype(np.uint8)
    text = np.concatenate((r.integers(97, 101, 300).astype(np.uint8), data, data[:200]))
    one, two = (suffix_dedup.anchors(x, 100, 8) for x in (data, text))
    starts = lambda f: {s: (p - s, g) for g, p, lo, hi, *_ in zip(*f) for s in range(lo, hi + 1)}
    one, two = starts(one), starts(two)
    assert len(one) == 801 and all(one[s] == two[s + 300] for s in one)


def test_anchors_of_blocks_and_runs_are_those_of_the_text():
    r = random.Random(4)
    for _ in range(300):
        parts = [bytes(r.choices(b"abc", k=r.randrange(1, 9))) * r.randrange(1, 25) for _ in range(5)]
        text = b"".join(parts)
        length, data = r.choice((5, 8, 20)), np.frombuffer(text, np.uint8)
        if len(text) < length:
            continue
        want = {w: (g, p) for g, p, lo, hi in zip(*suffix_dedup._block_anchors(data, length, 4)) for w in range(lo, hi + 1)}
        for block in (1, 7, 64, 1 << 18):
            found = {}
            for g, p, lo, hi, times, step in zip(*suffix_dedup.anchors(data, length, 4, block)):
                for k in range(times):
                    assert text[lo : hi + length] == text[lo + k * step : hi + k * step + length]
                    found |= {w: (g, p + k * step) for w in range(lo + k * step, hi + k * step + 1)}
            assert found == want


def test_repeats_inside_a_text(spark):
    """One letter or a period over megabytes; the same letters as a single window elsewhere."""
    unit = "abcdéfg\n"
    period = unit * 250_000
    rows = {1: "x" * 2_000_000, 2: period, 3: "start " + "x" * 400, 4: "z" + period[3:403], 5: "x" * 399, 6: period[:401] + "tail", 7: "-" * 400 + "=" * 401}
    size = {k: len(v.encode()) for k, v in rows.items()}
    found = by_id(repeated_spans(spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)), "n_bytes", "n_removed", "n_spans")
    want = {1: size[1], 2: size[2], 3: 400, 4: size[4] - 1, 5: 0, 6: len(period[:401].encode()), 7: 401}
    assert found == {k: (size[k], want[k], int(want[k] > 0)) for k in rows}
