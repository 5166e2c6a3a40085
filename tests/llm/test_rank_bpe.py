"""Rank-file BPE: equal to the library on whole texts, exact round trip, safe cuts, edge rows."""

from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from sharelens.llm import queries, rank_bpe

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rank_bpe.default_ranks(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op11_rank_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_safe_cuts_leave_the_ids(monkeypatch, library):
    monkeypatch.setattr(rank_bpe, "PIECE", 7)
    own = rank_bpe.codec(rank_bpe.default_ranks(), public_tokenizers.PATTERN)
    rng = random.Random(5)
    letters = ["a", "B", "don't", "'ll", "'s", " ", "  ", "\n", "\t ", " \n", "7", "42", "é", "日本", "。", "!", "'", "--", "\xa0", "\x1c",
               "　", "²", "🙂", "́", "<|endoftext|>", "_", "x9y"]
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(8, 60)))
        assert own.encode(text) == library.encode_ordinary(text), text
        assert own.decode(own.encode(text)) == text.encode()


def test_long_runs(library):
    own = rank_bpe.codec(rank_bpe.default_ranks(), public_tokenizers.PATTERN)
    n = rank_bpe.PIECE
    for text in ("a" + " " * n + "b", "a" + " " * n, "\n" * n + " tail", "x" * (2 * n), "word " * n, " " * n + "\n" * n + "'s", "日本。" * n):
        assert own.encode(text) == library.encode_ordinary(text)
    huge = "a" + " " * 3_000_000 + "b"        # the library's pattern engine overflows on this one
    assert own.decode(own.encode(huge)) == huge.encode()


def test_decode_gives_raw_bytes(spark):
    own = rank_bpe.codec(rank_bpe.default_ranks(), public_tokenizers.PATTERN)
    ids = own.encode("日")
    df = spark.createDataFrame([(ids[:1],), ([],), (None,)], "ids array<int>")
    got = [r["bytes"] for r in rank_bpe.decode(df).collect()]
    assert [None if x is None else bytes(x) for x in got] == [own.decode(ids[:1]), b"", None]
    with pytest.raises(Exception, match="null among"):
        rank_bpe.decode(spark.createDataFrame([([1, None],)], "ids array<int>")).collect()


def test_edge_rows(spark, messy, nothing, library):
    got = rank_bpe.decode(rank_bpe.encode(messy)).collect()
    assert len(got) == messy.count()
    for r in got:
        text = r["row"]["text"] or ""
        assert list(r["ids"]) == library.encode_ordinary(text)
        assert bytes(r["bytes"]) == text.encode()
        assert r["row"]["q"] == 9
    assert rank_bpe.decode(rank_bpe.encode(nothing)).count() == 0
