"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last ``ROLL`` bytes cuts every text into chunks where
its low bits are zero, so equal passages give equal chunks wherever they stand.
Documents are dealt out by their smallest chunk digest, which brings copies and
near copies into one task (``rebalance`` splits a task that would get too
much); each worker keeps the vocabulary for all its tasks, encodes a chunk once and
keeps its ids in a cache of bounded size.  The ids at a chunk join are then repaired: the text around the join is
encoded again, over a window that grows until both its ends are places where
the pre-tokenizer always cuts (a space between two printable ASCII characters),
so that the left chunk, the window and the right chunk agree exactly with the
encoding of the whole text.

Defined results: a null text counts as empty and has no ids; repeated rows give
the same ids; an empty table gives an empty one; other columns stay as they
are, inside struct ``row``.
"""

from __future__ import annotations

import hashlib
import json
from collections import OrderedDict
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from . import textarrays as T
from .frames import packed, text_of, text_udf

ROLL = 32
#: a chunk has about so many bytes on average
MEAN_CHUNK = 1024
MAX_CHUNK = 1 << 16
CACHE_BYTES = 24 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """The vocabulary, its encoder, and the cache of chunks of one worker."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_alphabet()
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        self._encoder = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        size = max([*ranks.values(), *special.values()]) + 1
        pieces = [b""] * size
        for piece, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            pieces[i] = piece
        self.lengths = np.array([len(x) for x in pieces], np.int64)
        self._starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self._flat = np.frombuffer(b"".join(pieces), np.uint8)
        self._cache: OrderedDict[bytes, np.ndarray] = OrderedDict()
        self._held = 0
        self.encoded_bytes = 0

    def _direct(self, piece: bytes) -> np.ndarray:
        self.encoded_bytes += len(piece)
        return np.array(self._encoder.encode(piece.decode("utf-8"), allowed_special="all"), np.int32)

    def chunk(self, piece: bytes) -> np.ndarray:
        """Ids of a chunk on its own; encoded once while the cache holds it."""
        key = hashlib.blake2b(piece, digest_size=16).digest()
        ids = self._cache.get(key)
        if ids is None:
            ids = self._cache[key] = self._direct(piece)
            self._held += ids.nbytes + 150
            while self._held > CACHE_BYTES:
                self._held -= self._cache.popitem(last=False)[1].nbytes + 150
        else:
            self._cache.move_to_end(key)
        return ids

    def encode(self, data: bytes, cuts: np.ndarray) -> np.ndarray:
        """Ids of the whole text from the ids of its chunks ``cuts[i]:cuts[i+1]``."""
        if len(cuts) <= 2:
            return self.chunk(data) if data else np.zeros(0, np.int32)
        buf = np.frombuffer(data, np.uint8)
        printable = (buf > 32) & (buf < 127)
        safe = np.flatnonzero((buf[1:-1] == 32) & printable[:-2] & printable[2:]) + 1
        safe = np.concatenate([[0], safe, [len(data)]])
        joins = cuts[1:-1]
        left = safe[np.searchsorted(safe, joins, "right") - 1]
        right = safe[np.searchsorted(safe, joins, "left")]
        out, at = [], 0  # at: the ids of data[:at] are in out
        i = 0
        while i < len(joins):
            first, last = left[i], right[i]
            while i + 1 < len(joins) and left[i + 1] <= last:  # windows that meet are one
                i += 1
                last = max(last, right[i])
            self._take(data, cuts, at, first, out)
            if last > first:
                out.append(self.chunk(data[first:last]))
            at = last
            i += 1
        self._take(data, cuts, at, len(data), out)
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def _take(self, data: bytes, cuts: np.ndarray, a: int, b: int, out: list) -> None:
        """Ids of data[a:b], which lies in one chunk, out of that chunk's ids."""
        if a >= b:
            return
        c = np.searchsorted(cuts, a, "right") - 1
        start, end = cuts[c], cuts[c + 1]
        ids = self.chunk(data[start:end])
        if a > start or b < end:
            edges = np.concatenate([[0], np.cumsum(self.lengths[ids])])
            i, j = np.searchsorted(edges, [a - start, b - start])
            if edges[i] != a - start or edges[j] != b - start:
                raise AssertionError("a window does not end where its chunk's tokens do")
            ids = ids[i:j]
        out.append(ids)

    def decode(self, ids: np.ndarray) -> str:
        n = self.lengths[ids]
        total = int(n.sum())
        begin = np.cumsum(n) - n
        at = np.repeat(self._starts[ids] - begin, n) + np.arange(total)
        return self._flat[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec, and one cache of chunks, for all tasks of a worker: its tables take 0.4 s, more than a small task's texts."""
    return Codec(path)


def chunk_cuts(buf: np.ndarray, offsets: np.ndarray, mean: int = MEAN_CHUNK) -> list[np.ndarray]:
    """For each text the places of its chunk borders, 0 and its length included."""
    ends = [np.zeros(0, np.int64)]
    for at in range(0, max(len(buf) - ROLL, 0), T.BATCH_BYTES):  # in blocks, each with the ROLL bytes before it
        block = buf[at:at + T.BATCH_BYTES + ROLL]
        p, q = T._power_table(len(block))
        prefix = np.zeros(len(block) + 1, T.U64)
        np.cumsum(T._BYTE[block] * p[:len(block)], out=prefix[1:])
        rolled = T.mix((prefix[ROLL:-1] - prefix[:-ROLL - 1]) * q[:len(block) - ROLL])
        ends.append(np.flatnonzero((rolled % T.U64(mean) == 0) & T.LEAD[block[ROLL:]]) + at + ROLL)
    ends = np.concatenate(ends)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        own = ends[np.searchsorted(ends, a + ROLL, "left"):np.searchsorted(ends, b, "left")] - a
        cuts = np.concatenate([[0], own, [b - a]])
        if len(gaps := np.flatnonzero(np.diff(cuts) > MAX_CHUNK)):
            lead = T.LEAD[buf[a:b]]
            more = [np.arange(cuts[g] + MAX_CHUNK, cuts[g + 1], MAX_CHUNK) for g in gaps]
            more = [x - np.argmax([lead[x], lead[x - 1], lead[x - 2], lead[x - 3]]) for m in more for x in m]
            cuts = np.unique(np.concatenate([cuts, more]))
        out.append(np.unique(cuts))
    return out


def _route(texts) -> dict:
    """The smallest digest of a text's chunks: copies and most near copies agree on it."""
    buf, offsets = T.encode(texts)
    cuts = chunk_cuts(buf, offsets)
    out = np.zeros(len(texts), np.int64)
    for i, c in enumerate(cuts):
        if len(c) > 1:
            at = c + offsets[i]
            out[i] = int(T.span_hashes(buf[at[0]:at[-1]], c[:-1], c[1:]).min() >> T.U64(1))
    return {"route": out}


def encode_decode(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Struct ``row`` (the input's columns) beside struct ``bpe``: ``ids`` (little-endian
    unsigned 32-bit integers), ``n_tokens``, and ``decoded``, the text that the ids stand for."""
    path = vocabulary or default_vocabulary()

    def fn(texts, own):
        buf, offsets = T.encode(texts)
        data = buf.tobytes()
        ids = [own.encode(data[a:b], c) for a, b, c in
               zip(offsets[:-1], offsets[1:], chunk_cuts(buf, offsets), strict=True)]
        return {"ids": [x.astype("<u4").tobytes() for x in ids], "n_tokens": [len(x) for x in ids],
                "decoded": [own.decode(x) for x in ids]}

    df = packed(docs)
    dealt = df.withColumn("route", text_udf(_route, "route long")(text_of(df, text_col))["route"]).hint("rebalance", "route")
    return dealt.select("row", text_udf(fn, "ids binary, n_tokens long, decoded string", lambda: codec(path))(
        text_of(dealt, text_col)).alias("bpe"))


