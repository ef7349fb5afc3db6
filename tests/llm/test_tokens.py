"""Token counts, the token store and packing against the tokenizer itself."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import AWKWARD
from tidemark.llm.packing import SquaresPacker, pack_documents
from tidemark.llm.token_counts import token_counts
from tidemark.llm.token_store import Shard, lookup, read_token_store, token_store, write_token_store
from tidemark.llm.tokens import Encoder

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def ids_of(path, texts, end=None):
    tokenizer = Tokenizer.from_file(path)
    return {d: tokenizer.encode(t or "", add_special_tokens=False).ids + ([] if end is None else [end]) for d, t in texts.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_whole_texts(path, texts):
    odd = ["a  b", "a   b\n\n c", " x", "x ", "\n", "it's I'LL 12 34a!?! ...", "a  b", "a \tb", "x<|endoftext|> y", "A<|STARTOFTEXT|>b", "é ́", "İstanbul ΑΣ", "!\x1c!", "\x00a"]
    every = [*odd, *(t or "" for t in texts.values())]
    tokenizer = Tokenizer.from_file(path)
    want = [e.ids for e in tokenizer.encode_batch(every, add_special_tokens=False)]
    for memory in (32 << 20, 4096):
        encoder = Encoder(path, memory)
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(every)] == want
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(every[::-1])] == want[::-1]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_every_code_point(path):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = ["\t".join(f"a{c}'d" for c in points[i : i + 256]) for i in range(0, len(points), 256)]
    encoder = Encoder(path)
    assert list(encoder.encode(every)) == encoder._library(every)


def test_long_texts_in_blocks():
    encoder = Encoder(BYTE)
    every = ["x" * 300_000, "ab, C 12\n" * 40_000, "é" * 270_000 + " a", "a " + " " * 280_000]
    assert list(encoder.encode(every)) == encoder._library(every)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_memory_is_bounded(path):
    encoder = Encoder(path, 1 << 20)
    for i in range(40):
        list(encoder.encode([" ".join(f"w{i}x{j}" for j in range(2000))] * 2))
        size = sum(len(p) + len(v) + 120 for held in (encoder.known, encoder.older) for p, v in held.items())
        assert size <= (1 << 20) + 2 * 120 * 8000


def test_counts(spark, docs, texts):
    want = {d: (len((texts[d] or "").encode()), len(i), len(i) > 512) for d, i in ids_of(BYTE, texts).items()}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(docs, BYTE).collect()} == want


def test_counts_come_from_the_cache(spark, docs, tmp_path):
    path = str(tmp_path / "cache")
    first = token_counts(docs.where("doc_id < 50"), BYTE, cache_path=path).collect()
    held = spark.read.parquet(path).count()
    assert held <= 50
    both = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, BYTE, cache_path=path).collect()}
    assert all(both[r["doc_id"]] == r["n_tokens"] for r in first)
    cached = spark.read.parquet(path)
    assert cached.count() == cached.select("content").distinct().count() == docs.select("text").distinct().count()
    token_counts(docs, BYTE, cache_path=path).collect()
    assert spark.read.parquet(path).count() == cached.count()
    other = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, WORD, cache_path=path).collect()}
    assert other != both


def test_counts_of_awkward_rows(awkward, nothing):
    want = ids_of(BYTE, {r[0]: r[1] for r in AWKWARD})
    found = token_counts(awkward, BYTE).collect()
    assert len(found) == len(AWKWARD) and all(r["n_tokens"] == len(want[r["doc_id"]]) for r in found)
    assert token_counts(nothing, BYTE).count() == 0


def test_store_round_trip(spark, docs, texts):
    want, start = {}, 0
    for d, ids in sorted(ids_of(WORD, texts, 1).items()):
        want[d] = (start, len(ids), crc(ids))
        start += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_store(docs, WORD).collect()} == want


def test_store_lookups(spark, docs, texts):
    manifest = write_token_store(docs.repartition(3), WORD)
    want = ids_of(WORD, texts, 1)
    for d in list(texts)[::17]:
        assert [i.tolist() for i in lookup(manifest, d)] == [want[d]]
    assert lookup(manifest, 10**9) == [] and lookup(manifest, -5) == []
    shards = [Shard(r["path"]) for r in manifest.collect()]
    assert sum(s.entries for s in shards) == len(texts)
    keys = [k for s in shards for k, _ in s]
    assert keys == sorted(keys)


def test_store_of_awkward_rows(spark, awkward, nothing):
    rows = awkward.unionByName(spark.createDataFrame([(None, "no id", None, None, None, None, None)], awkward.schema))
    found = sorted(token_store(rows, WORD).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None, -10, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 11]
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    assert token_store(nothing, WORD).count() == 0
    assert read_token_store(write_token_store(nothing, WORD)).count() == 0


def packed_right(rows, want, window=1024):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(want)
    for d, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(want[d])
            assert r["ids_crc32"] == crc(want[d][at : at + r["length"]])
            at += r["length"]
        assert at == len(want[d])
    sizes = []
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        sizes.append(at)
    return sizes


def test_packing(spark, docs, texts):
    sizes = packed_right(pack_documents(docs.repartition(3), BYTE).collect(), ids_of(BYTE, texts, 0))
    assert sum(s != 1024 for s in sizes) <= 33 and all(s & (s - 1) == 0 for s in sizes)


def test_packing_of_awkward_rows(awkward, nothing):
    texts = {r[0]: r[1] for r in AWKWARD}
    rows = pack_documents(awkward.dropDuplicates(["doc_id"]), BYTE).collect()
    packed_right(rows, ids_of(BYTE, texts, 0))
    assert pack_documents(nothing, BYTE).count() == 0
    every = pack_documents(awkward, BYTE).collect()
    assert sum(r["length"] for r in every if r["doc_id"] == 8) == 2 * len(ids_of(BYTE, texts, 0)[8])


def test_level_minimises_the_sum_of_squares():
    packer = SquaresPacker(16)
    rng = np.random.default_rng(4)
    for i in range(400):
        n = int(rng.integers(1, 16))
        best = None
        for level in range(16 - n + 1):
            if level and not packer.count[level]:
                continue
            after = packer.count.copy()
            after[level] -= level > 0
            after[level + n] += 1
            cost = int((after[1:16] ** 2).sum())
            if best is None or cost <= best[0]:
                best = cost, level
        assert packer._level(n) == best[1]
        list(packer.add(i, b"\0\0\0\0" * n))
    sizes = Counter(sum(len(p[2]) // 4 for p in s) for s in packer.finish())
    assert all(s & (s - 1) == 0 for s in sizes)
