"""BPE against tiktoken, the token store against the tokenizers library."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandframe.llm import bpe, common, pretokens, tokenstore

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(RANKS, "rb") as f:
        return bpe.model(f.read())


def test_random_texts_match_the_library(own, reference, monkeypatch):
    monkeypatch.setattr(pretokens, "CHUNK", 5000)
    rng = random.Random(1)
    letters = "aabbcst'' \n\t é世界1٣²½_-—😀’\x1c\x85reveLl"
    texts = [None, "", "   ", "don't 's  'sx ''s I'll we've they're 'LL", "ab" * 3000, "x" * 1000, " " * 500 + "z", "\n" * 300, "word " * 5000]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    got = [[] for _ in texts]
    for i, ids in own.encode_texts(texts):
        got[i] += ids.tolist()
    for text, ids in zip(texts, got, strict=True):
        assert ids == reference.encode_ordinary(text or ""), text
        assert own.decode(np.array(ids, np.int64)).tobytes() == (text or "").encode()


def test_cache_that_starts_anew_changes_nothing(own, reference):
    cache = pretokens.WordCache(own.encode_words, most=3)
    for group in pretokens.groups(["one two three", "four five six seven", "one two"]):
        ids, upto = cache.ids(group)
        assert [ids[upto[a] : upto[b]].tolist() for _, a, b in group.docs] == [reference.encode_ordinary(t) for t in ("one two three", "four five six seven", "one two")]


def test_digests_and_ids(odd, empty, reference):
    rows = bpe.encode_digests(odd, RANKS).collect()
    assert len(rows) == odd.count()
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    for r in rows:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    encoded = bpe.encode(odd, RANKS)
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in bpe.decode(encoded, RANKS).collect()} == texts
    assert bpe.encode_digests(empty, RANKS).count() == 0


@pytest.mark.parametrize("high", [255, 300, 50257, 2**31])
def test_store_gives_any_id_and_any_range(high):
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = rng.integers(0, high, n)
        file = tokenstore.TokenFile(tokenstore.file_bytes(np.array([1, 2]), np.array([0, n]), ids))
        assert (file.ids() == ids).all() and [file[i] for i in range(0, n, 29)] == ids[::29].tolist()
        for a, b in ((0, n), (n // 3, n // 2), (n, n), (min(n, 511), min(n, 514))):
            assert (file.ids(a, b) == ids[a:b]).all()
        assert (file.document(1) == ids).all()
    with pytest.raises(IndexError):
        file[3000]


def test_store_round_trip(odd, empty, small_docs):
    tokenizer = Tokenizer.from_file(JSON)
    assert tokenstore.roundtrip(empty, JSON).count() == 0
    special = odd.select("doc_id", F.concat(F.lit("a <|endoftext|> b <|endoftext|"), F.coalesce("text", F.lit(">"))).alias("text"))
    assert len(tokenizer.encode("x<|endoftext|>", add_special_tokens=False).ids) == 2
    for docs in (odd, small_docs, odd.select("doc_id", "text").unionByName(special)):
        rows = sorted(tokenstore.roundtrip(docs, JSON).collect(), key=lambda r: r["start"])
        texts = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
        assert [r["doc_id"] for r in rows] == [i if known else None for known, i, _ in texts]
        start = 0
        for r, (_, _, text) in zip(rows, texts, strict=True):
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
            assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            start += len(ids)


def test_ranges_follow_ids_and_texts_and_split_a_hot_id(spark):
    rows = [(7, f"text {i:04} " + "x" * (i % 90)) for i in range(1500)] + [(i, "other words " * 3) for i in range(1500)] + [(None, "n" * i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ranged, parts = common.by_ranges(docs, 8)
    found = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"]), r["part"], len(r["text"])) for r in ranged.collect())
    assert [p for _, p, _ in found] == sorted(p for _, p, _ in found) and 6 <= parts <= 10
    sizes = [sum(n + 64 for _, p, n in found if p == k) for k in range(parts)]
    assert max(sizes) < 2 * sum(sizes) / parts and len({p for (_, i, _), p, _ in found if i == 7}) > 1


def test_a_range_may_be_several_files(spark, small_docs):
    folder, manifest = tokenstore.write(small_docs, JSON, file_ids=5000)
    assert manifest.count() > 10 and manifest.agg(F.max("n_ids")).first()[0] < 60_000
    one, two = (sorted(map(tuple, df.collect())) for df in (tokenstore.read(spark, folder, manifest), tokenstore.roundtrip(small_docs, JSON)))
    assert one == two
