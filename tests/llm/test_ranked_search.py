"""Ranked search: equal to scoring every document, with ties, copies, blocks, small segments, edge rows; work of the intervals."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sharelens.llm import ranked_search

from .conftest import CLASHING, clash

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Every row of docs scored for each row of items."""
    bags = [(i, Counter(_terms(t))) for i, t in docs]
    size = {j: sum(b.values()) for j, (_, b) in enumerate(bags)}
    n_docs, n_terms = sum(n > 0 for n in size.values()), sum(size.values())
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for j, (i, bag) in enumerate(bags):
            score = 0
            for t in set(_terms(text)):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 10 + 90 * size[j] * n_docs // n_terms
                    score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def order(rows):
    return sorted(rows, key=str)


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["É", "Zz", "日本", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 30)))) for i in range(n)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)]          # a group of copies: equal scores
    docs += [docs[5], docs[5], (None, docs[6][1]), (None, docs[6][1]), (900, None), (901, ""), (902, "--- !!")]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 12)))) for i in range(12)]
    items += [(50, docs[3][1]), (50, docs[3][1]), (None, "W1 w2"), (51, None), (52, "..."), (53, "nowhere"), (54, "w0 " + "w0. " * 50)]
    return docs, items


@pytest.mark.parametrize("seed,segment,block", [(1, 4 << 20, 8 << 20), (2, 300, 8 << 20), (3, 300, 200)])
def test_equals_scoring_all(spark, monkeypatch, seed, segment, block):
    """Few and many segments (one of them holding a part of the copies), one and many blocks."""
    monkeypatch.setattr(ranked_search, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    docs, items = corpus(random.Random(seed), 150)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert order(map(tuple, ranked_search.search(d, q).collect())) == order(brute(docs, items))


def test_intervals_score_few_documents():
    """With one rare term the search scores its documents, not the whole segment; equal copies end after k."""
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["the", "of", "and", "in"], k=20)) for _ in range(5000)]
    for i in (17, 1200, 4999):
        texts[i] += " needle"
    texts[3000:4000] = ["same needless copy of the text"] * 1000
    queries = ranked_search.Queries([{"query": "a", "terms": ["needle", "the"]}, {"query": "b", "terms": ["copy"]}])
    row = ranked_search._segment(list(range(5000)), texts, queries.vocabulary)
    row = {k: np.asarray(v) if isinstance(v, np.ndarray) else v for k, v in row.items()}
    n_docs, n_terms = row["n_docs"], row["n_terms"]
    df = np.zeros(len(queries.vocabulary), np.int64)
    df[row["terms"]] = row["df"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df], np.int64)
    index = ranked_search.Index(row, weights, n_docs, n_terms)
    best = []
    assert ranked_search._search(index, index.slots(queries.terms[0]), best, 3, None, None) < 500
    assert sorted(x[2] for x in best) == [17, 1200, 4999]
    best = []
    assert ranked_search._search(index, index.slots(queries.terms[1]), best, 10, None, None) < 100
    assert [x[2] for x in best] == list(range(3000, 3010))


def test_impacts_beyond_64_bits():
    row = {"ids": [1], "n": np.array([1 << 40]), "terms": np.array([0]), "df": np.array([1]), "docs": np.array([0]), "tf": np.array([3])}
    n_docs, n_terms = 1 << 30, 1 << 45
    index = ranked_search.Index(row, np.array([7]), n_docs, n_terms)
    m = 10 + 90 * (1 << 40) * n_docs // n_terms
    assert index.impact.tolist() == [7 * (3_000_000_000 // (3000 + 8 * m))]


def test_edge_rows(spark, messy, nothing):
    docs = [(r["doc_id"], r["text"]) for r in messy.collect()]
    items = [(1, "same words"), (1, "same words"), (None, "committee xx word77"), (2, None)]
    q = spark.createDataFrame(clash([(i, t, "en") for i, t in items]), CLASHING)
    got = ranked_search.search(messy, q, item_id_col="doc_id").collect()
    assert order(map(tuple, got)) == order(brute(docs, items))
    assert ranked_search.search(nothing, q, item_id_col="doc_id").count() == 0
    assert ranked_search.search(messy, nothing, item_id_col="doc_id").count() == 0
    named = messy.where("doc_id is not null").selectExpr("concat('d', doc_id) as doc_id", "text")
    want = brute([(f"d{i}", t) for i, t in docs if i is not None], items)
    assert order(map(tuple, ranked_search.search(named, q, item_id_col="doc_id").collect())) == order(want)
