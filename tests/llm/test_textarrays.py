"""Vectorised words, lines and windows against plain Python."""

from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sharelens.llm import textarrays as T

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b.日 Z", max_size=60)), min_size=0, max_size=6)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_and_lines(batch):
    buf, offsets = T.encode(batch)
    start, end, text = T.words(buf, offsets)
    want = [(i, w) for i, t in enumerate(batch) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert [(int(i), buf[a:b].tobytes().decode()) for a, b, i in zip(start, end, text, strict=True)] == want
    start, end, text = T.lines(buf, offsets)
    want = [(i, x) for i, t in enumerate(batch) for x in (t or "").split("\n")]
    assert [(int(i), buf[a:b].tobytes().decode()) for a, b, i in zip(start, end, text, strict=True)] == want


@settings(max_examples=100, deadline=None)
@given(texts)
def test_hashes_agree_where_words_do(batch):
    buf, offsets = T.encode(batch)
    start, end, text = T.words(buf, offsets)
    h = T.span_hashes(buf, start, end)
    words = [buf[a:b].tobytes() for a, b in zip(start, end, strict=True)]
    assert len(set(h.tolist())) == len(set(words))
    keys, first = T.windows(h, text, 2)
    pairs = [(words[i], words[i + 1]) for i in range(len(words) - 1) if text[i] == text[i + 1]]
    assert [(words[i], words[i + 1]) for i in first] == pairs
    assert len(set(keys.tolist())) == len(set(pairs))


def test_slices_cover_all_rows():
    sizes = [3, 0, 5, 100, 1, 1, 1]
    parts = list(T.groups_of_bytes(sizes, 6))
    assert [k for i, j in parts for k in range(i, j)] == list(range(len(sizes)))
    assert all(sum(sizes[i:j]) <= 6 or j - i == 1 for i, j in parts)
    assert list(T.groups_of_bytes([])) == []


def test_covered():
    assert T.covered(np.array([1, 2]), 3, 7).tolist() == [False, True, True, True, True, False, False]
