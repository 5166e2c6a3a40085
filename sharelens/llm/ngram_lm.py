"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by the workers.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end token
for each text.  Counting runs in three jobs, each of which adds up its task's
n-grams, deals the sums to shards and merges a shard in one task:

1. words -> sorted word hashes and counts;
2. (context, word) pairs -> contexts (sorted hashes, totals, numbers of words
   seen once, twice, more) and one sorted array of keys, context index and 40
   bits of the word's hash, with its counts;
3. the pair arrays -> the number of different contexts of each word.

A shard is a few ``.npy`` files in the session's shared checkpoint folder,
written under another name first and then renamed, so a task that runs again
(lost executor, speculation) just writes the same files again.  Scoring maps
the arrays into memory and searches them in batches; resident are only the
pages that a batch touches.  The number of shards follows the size of the
corpus.  A context with over a quarter of its shard's tokens is hot (at most
four for each shard): its pairs are dealt over all shards by the word, and its
totals, a few numbers for each, are added up on the driver.

Defined results: a null text counts as empty and has one token, the end; with
no training text the base score and the score are 0 for each token (log10 of
1); repeated rows count as often as they are there when learning and get equal
scores; null ids belong to the training part; other columns stay in ``row``.
"""

from __future__ import annotations

import os
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.session import scratch_path

from . import textarrays as T
from .frames import packed, releasing, text_of, text_udf

U64 = np.uint64
END, START = T.mix(np.array([0xE0D, 0xB05], U64))
FP_BITS = 40
FLUSH_TOKENS = 2_500_000
SHARD_BYTES = 64 << 20
MIN_SHARDS = 48
BLOB = "shard int, a binary, b binary, c binary, d binary"


# ---- files -----------------------------------------------------------------

def _local(uri: str) -> str:
    """The shared folder as a path that workers can map; it must be mounted on every machine."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{uri}: the model folder must be on a file system mounted by all executors, "
                         "since workers map its files into memory")
    return parts.path


def _save(folder: str, name: str, array: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}.{os.getpid()}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, f"{folder}/{name}.npy")


def _load(folder: str, name: str, kind) -> np.ndarray:
    path = f"{folder}/{name}.npy"
    return np.load(path, mmap_mode="r") if os.path.exists(path) else np.zeros(0, kind)


# ---- tokens ----------------------------------------------------------------

def tokens(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context hash, word hash, text index) of every token in order."""
    buf, offsets = T.encode(texts)
    buf = T.lower_ascii(buf)
    start, end, text = T.words(buf, offsets)
    h = T.span_hashes(buf, start, end)
    n = len(texts)
    counts = np.bincount(text, minlength=n)
    stops = np.cumsum(counts + 1) - 1
    word = np.empty(len(h) + n, U64)
    own = np.repeat(np.arange(n), counts + 1)
    is_end = np.zeros(len(word), bool)
    is_end[stops] = True
    word[~is_end], word[is_end] = h, END
    context = np.empty(len(word), U64)
    context[1:] = word[:-1]
    context[np.concatenate([[0], stops[:-1] + 1])[:n]] = START
    return context, word, own


def _sums(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sum of their weights."""
    if weights is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    k, w = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(w, first) if len(k) else w


def _fp(word: np.ndarray) -> np.ndarray:
    return word >> U64(64 - FP_BITS)


def _pack(fp: np.ndarray) -> bytes:
    return fp.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :FP_BITS // 8].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, FP_BITS // 8)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :FP_BITS // 8] = raw
    return out.view("<u8").ravel()


def _flushes(batches, make):
    """Rows of ``make(context, word)`` for each ``FLUSH_TOKENS`` tokens of a task."""
    held, n = [], 0
    for b in batches:
        texts = b.column(0).to_pylist()
        for i, j in T.groups_of_bytes([len(t or "") for t in texts]):
            context, word, _ = tokens(texts[i:j])
            held.append((context, word))
            n += len(word)
            if n >= FLUSH_TOKENS:
                yield _blobs(make(*map(np.concatenate, zip(*held, strict=True))))
                held, n = [], 0
    if held:
        yield _blobs(make(*map(np.concatenate, zip(*held, strict=True))))


def _blobs(rows) -> pa.RecordBatch:
    rows = list(rows)
    fields = [("shard", pa.int32()), *((x, pa.binary()) for x in "abcd")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)],
                                      [name for name, _ in fields])


def _by_shard(shard: np.ndarray, n_shards: int):
    """Shards that occur, with the slices of the arrays ordered by ``shard``."""
    edges = np.searchsorted(shard, np.arange(n_shards + 1))
    return [(s, edges[s], edges[s + 1]) for s in range(n_shards) if edges[s] < edges[s + 1]]


def _merged(batches, merge, fields):
    """One output row of ``merge(shard, blobs)`` for each shard of a task; a task gets one shard."""
    held: dict[int, list] = {}
    for b in batches:
        for s, *blobs in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
            held.setdefault(s, []).append(blobs)
    for s in sorted(held):
        row = merge(s, held.pop(s))
        yield pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in fields], [k for k, _ in fields])


def _joined(blobs, i: int, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x[i], kind) for x in blobs])


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts as 32-bit numbers where all of them fit, else as they are."""
    return counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts


def _few(values: np.ndarray) -> list[int]:
    """How many are 1, 2, 3 and 4."""
    return [int((values == k).sum()) for k in (1, 2, 3, 4)]


# ---- the three counting jobs -------------------------------------------------

def _pair_shard(context: np.ndarray, fp: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
    key = context.copy()
    if len(hot):
        key[np.isin(context, hot)] ^= T.mix(fp[np.isin(context, hot)])
    return (T.mix(key) % U64(n)).astype(np.int64)


def train(docs: DataFrame, text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> dict:
    """Count ``docs`` and write the model; returns its folder and the numbers that all shards share."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(MIN_SHARDS, -(-size // shard_bytes))
    folder = _local(scratch_path(spark, "ngram-lm"))

    def words(context, word):
        keys, counts = _sums(word)
        shard = (_fp(keys) % U64(n)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        keys, counts = keys[order], counts[order].astype(np.uint32)
        for s, i, j in _by_shard(shard[order], n):
            yield s, keys[i:j].tobytes(), counts[i:j].tobytes(), None, None

    def merge_words(s, blobs):
        keys, counts = _sums(_joined(blobs, 0, U64), _joined(blobs, 1, np.uint32).astype(np.int64))
        _save(folder, f"{s}.word", keys)
        _save(folder, f"{s}.count", counts)
        hot = keys[counts * 4 > counts.sum()]
        return {"shard": s, "types": len(keys), "total": int(counts.sum()), "hot": hot.astype(np.int64).tolist()}

    kinds = [("shard", pa.int32()), ("types", pa.int64()), ("total", pa.int64()), ("hot", pa.list_(pa.int64()))]
    found = (texts.mapInArrow(releasing(lambda b: _flushes(b, words)), BLOB).repartitionById(n, "shard")
             .mapInArrow(releasing(lambda b: _merged(b, merge_words, kinds)), "shard int, types long, total long, hot array<long>")).collect()
    model = {"folder": folder, "shards": n, "types": sum(r["types"] for r in found), "total": sum(r["total"] for r in found)}
    hot = np.unique(np.array([x for r in found for x in r["hot"]] + [int(START.astype(np.int64))], np.int64).astype(U64))

    def pairs(context, word):
        fp = _fp(word)
        shard = _pair_shard(context, fp, hot, n)
        order = np.lexsort((fp, context, shard))
        shard, context, fp = shard[order], context[order], fp[order]
        new = np.concatenate([[True], (context[1:] != context[:-1]) | (fp[1:] != fp[:-1]) | (shard[1:] != shard[:-1])])
        at = np.flatnonzero(new)
        counts = np.diff(np.concatenate([at, [len(fp)]])).astype(np.uint32)
        shard, context, fp = shard[at], context[at], fp[at]
        for s, i, j in _by_shard(shard, n):
            c = context[i:j]
            first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            runs = np.diff(np.concatenate([first, [j - i]])).astype(np.uint32)
            yield s, c[first].tobytes(), runs.tobytes(), _pack(fp[i:j]), counts[i:j].tobytes()

    def merge_pairs(s, blobs):
        context = np.repeat(_joined(blobs, 0, U64), _joined(blobs, 1, np.uint32))
        fp = np.concatenate([_unpack(x[2]) for x in blobs])
        heads, index = np.unique(context, return_inverse=True)
        if len(heads) >= 1 << (64 - FP_BITS):
            raise ValueError("too many contexts in a shard: make shard_bytes smaller")
        keys, counts = _sums((index.astype(U64) << U64(FP_BITS)) | fp, _joined(blobs, 3, np.uint32).astype(np.int64))
        owner = (keys >> U64(FP_BITS)).astype(np.int64)
        per = lambda mask, w=None: np.bincount(owner[mask], w, len(heads)).astype(np.int64)
        stats = np.stack([per(slice(None), counts), per(counts == 1), per(counts == 2), per(counts >= 3)])
        _save(folder, f"{s}.head", heads)
        _save(folder, f"{s}.stats", stats)
        _save(folder, f"{s}.pair", keys)
        _save(folder, f"{s}.times", _narrow(counts))
        mine = np.flatnonzero(np.isin(heads, hot))
        return {"shard": s, "few": _few(counts), "hot": heads[mine].astype(np.int64).tolist(),
                "stats": stats[:, mine].T.ravel().tolist()}

    kinds2 = [("shard", pa.int32()), ("few", pa.list_(pa.int64())), ("hot", pa.list_(pa.int64())), ("stats", pa.list_(pa.int64()))]
    found = (texts.mapInArrow(releasing(lambda b: _flushes(b, pairs)), BLOB).repartitionById(n, "shard")
             .mapInArrow(releasing(lambda b: _merged(b, merge_pairs, kinds2)),
                         "shard int, few array<long>, hot array<long>, stats array<long>")).collect()
    model["pair_few"] = [sum(r["few"][k] for r in found) for k in range(4)]
    totals: dict[int, np.ndarray] = {}
    for r in found:
        for head, stats in zip(r["hot"], np.array(r["stats"], np.int64).reshape(-1, 4), strict=True):
            totals[head] = totals.get(head, 0) + stats
    model["hot"] = hot  # sorted
    model["hot_stats"] = np.array([totals.get(int(x), [0, 0, 0, 0]) for x in hot.astype(np.int64)], np.int64).reshape(-1, 4)

    def continuations(batches):
        for b in batches:
            for s in b.column(0).to_pylist():
                keys, counts = _sums(_load(folder, f"{s}.pair", U64) & U64((1 << FP_BITS) - 1))
                shard = (keys % U64(n)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                keys, counts = keys[order], counts[order].astype(np.uint32)
                yield _blobs((t, _pack(keys[i:j]), counts[i:j].tobytes(), None, None) for t, i, j in _by_shard(shard[order], n))

    def merge_continuations(s, blobs):
        fp, counts = _sums(np.concatenate([_unpack(x[0]) for x in blobs]), _joined(blobs, 1, np.uint32).astype(np.int64))
        word = _load(folder, f"{s}.word", U64)
        _save(folder, f"{s}.heads", counts[np.searchsorted(fp, _fp(word))] if len(word) else np.zeros(0, np.int64))
        return {"shard": s, "few": [*_few(counts), int((counts >= 3).sum()), int(counts.sum())]}

    kinds3 = [("shard", pa.int32()), ("few", pa.list_(pa.int64()))]
    found = (spark.range(0, n, 1, n).mapInArrow(releasing(continuations), BLOB).repartitionById(n, "shard")
             .mapInArrow(releasing(lambda b: _merged(b, merge_continuations, kinds3)), "shard int, few array<long>")).collect()
    model["word_few"] = [sum(r["few"][k] for r in found) for k in range(6)]
    return model


# ---- scoring -----------------------------------------------------------------

def discounts(few) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more; half a count where the numbers of counts leave a discount undefined."""
    n1, n2, n3, n4 = few[:4]
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return np.array([0.0, *(min(max(x, 0.01), k - 0.01) for k, x in enumerate(d, 1))])


class Scorer:
    """Probabilities from the memory-mapped shards."""

    def __init__(self, model: dict):
        self.m = model
        self._open: dict[tuple[int, str], np.ndarray] = {}
        self._pair_d, self._word_d = discounts(model["pair_few"]), discounts(model["word_few"])
        n1, n2, _, _, n3, total = model["word_few"]
        self._word_total = max(total, 1)
        left = float(np.dot(self._word_d[1:], [n1, n2, n3])) / self._word_total if total else 1.0
        self._floor = left / (model["types"] + 1)

    def _array(self, s: int, name: str, kind) -> np.ndarray:
        if (s, name) not in self._open:
            self._open[s, name] = _load(self.m["folder"], f"{s}.{name}", kind)
        return self._open[s, name]

    @staticmethod
    def _find(array: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each key in the sorted array, and whether it is there."""
        at = np.searchsorted(array, keys)
        at[at == len(array)] = 0
        return at, (array[at] == keys) if len(array) else np.zeros(len(keys), bool)

    def words(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count and unigram (continuation) probability."""
        count, p = np.zeros(len(word), np.int64), np.full(len(word), self._floor)
        shard = (_fp(word) % U64(self.m["shards"])).astype(np.int64)
        order = np.lexsort((word, shard))
        for s, i, j in _by_shard(shard[order], self.m["shards"]):
            own = order[i:j]
            at, there = self._find(self._array(s, "word", U64), word[own])
            own, at = own[there], at[there]
            count[own] = self._array(s, "count", np.int64)[at]
            heads = self._array(s, "heads", np.int64)[at]
            p[own] += (heads - self._word_d[np.minimum(heads, 3)]) / self._word_total
        return count, p

    def pairs(self, context: np.ndarray, word: np.ndarray, p_word: np.ndarray) -> np.ndarray:
        """Interpolated probability of each word after its context."""
        fp = _fp(word)
        shard = _pair_shard(context, fp, self.m["hot"], self.m["shards"])
        order = np.lexsort((fp, context, shard))
        times, stats = np.zeros(len(word), np.int64), np.zeros((4, len(word)), np.int64)
        for s, i, j in _by_shard(shard[order], self.m["shards"]):
            own = order[i:j]
            at, there = self._find(self._array(s, "head", U64), context[own])
            own, at = own[there], at[there]
            stats[:, own] = self._array(s, "stats", np.int64)[:, at] if len(own) else 0
            key = (at.astype(U64) << U64(FP_BITS)) | fp[own]
            k, seen = self._find(self._array(s, "pair", U64), key)
            times[own[seen]] = self._array(s, "times", np.uint32)[k[seen]]
        hot, is_hot = self._find(self.m["hot"], context)
        stats[:, is_hot] = self.m["hot_stats"][hot[is_hot]].T
        total, n1, n2, n3 = stats
        d = self._pair_d
        some = np.maximum(total, 1)
        mixed = np.maximum(times - d[np.minimum(times, 3)], 0) / some + (d[1] * n1 + d[2] * n2 + d[3] * n3) / some * p_word
        return np.where(total > 0, mixed, p_word)

    def score(self, texts) -> dict:
        context, word, own = tokens(texts)
        different, index = np.unique(word, return_inverse=True)
        count, p_word = (x[index] for x in self.words(different))
        p = self.pairs(context, word, p_word)
        base = np.log10((count + 1) / (self.m["total"] + self.m["types"] + 1))
        per = lambda w=None: np.bincount(own, w, len(texts))
        return {"n_tokens": per(), "n_known": per(count > 0).astype(np.int64), "base_score": per(base), "score": per(np.log10(p))}


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """Struct ``row`` beside struct ``lm``: n_tokens, n_known, base_score, score, perplexity."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fn(texts, scorer):
        out = scorer.score(texts)
        out["perplexity"] = 10.0 ** (-out["score"] / out["n_tokens"])
        return out

    df = packed(docs)
    return df.select("row", text_udf(
        fn, "n_tokens long, n_known long, base_score double, score double, perplexity double",
        lambda: Scorer(shared.value))(text_of(df, text_col)).alias("lm"))
