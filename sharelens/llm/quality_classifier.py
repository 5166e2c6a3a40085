"""Quality classifier from weak labels.

``LABELLERS`` heuristics vote good, bad or abstain on every document.  The
votes are counted by pattern over all documents (at most 3^8 patterns, whatever
the corpus holds), and expectation-maximisation estimates from the counts how
often documents are good and how each labeller votes on good and on bad ones.
Each document's posterior then labels it, and a logistic scorer over hashed
words and word shapes is fitted on about ``SAMPLE_DOCS`` documents, those whose
hash falls under the share that gives this number.  The scorer, a vector of
fixed size, scores every whole text.

Defined results: null, empty and blank texts have no features; they are scored
by the intercept and the votes count them as bad; repeated rows get equal
scores; an empty table gives no rows; if all votes agree the posterior is the
same for all documents and so is the score; other columns stay in ``row``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as T
from .frames import packed, text_of, text_udf
from .quality_rules import base_columns

LABELLERS = ("length", "symbols", "repeats", "capitals", "exclamations", "sentences", "duplicate_lines", "plain_prose")
PATTERNS = 3 ** len(LABELLERS)
FEATURES = 1 << 14
SAMPLE_DOCS = 6_000
KEEP = 0.5
_DIGIT_WEIGHTS = 3 ** np.arange(len(LABELLERS))


def votes(texts) -> np.ndarray:
    """-1 (bad), 0 (abstains) or 1 (good) of each labeller on each text."""
    base = base_columns(texts)
    buf, offsets = T.encode(texts)
    n = len(texts)
    n_words = np.maximum(base["n_words"], 1)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    upper, lower = total((buf >= 65) & (buf <= 90)), total((buf >= 97) & (buf <= 122))
    caps = upper / np.maximum(upper + lower, 1)
    bangs = total(buf == 33) / n_words
    start, end, text = T.words(buf, offsets)
    last = buf[end - 1] if len(end) else buf[:0]
    stops = np.bincount(text[np.isin(last, list(b".!?"))], minlength=n) / n_words
    lines = total(buf == 10) + 1
    mean = base["word_chars"] / n_words
    symbols = base["n_symbols"] / n_words
    repeats = base["n_repeat_words"] / n_words
    dup = base["n_dup_lines"] / lines

    def vote(bad, good=False):
        return np.where(bad, -1, np.where(good, 1, 0))

    # the absence of one fault says little about the others: all but the last vote bad or abstain
    plain = (symbols < 0.05) & (caps < 0.3) & (bangs < 0.05) & (repeats < 0.2) & (dup < 0.25) & (mean < 15)
    out = np.stack([
        vote(base["n_words"] < 2),
        vote(symbols > 0.1),
        vote(repeats > 0.25),
        vote(caps > 0.4),
        vote(bangs > 0.1),
        vote((stops < 0.02) | (stops > 0.5)),
        vote(dup > 0.3),
        vote((mean < 1.5) | (mean > 25), plain)], axis=1)
    out[base["n_words"] == 0] = -1
    return out


def pattern_of(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * _DIGIT_WEIGHTS).sum(axis=1)


def votes_of(pattern: np.ndarray) -> np.ndarray:
    return (pattern[:, None] // _DIGIT_WEIGHTS) % 3 - 1


def fit_votes(pattern: np.ndarray, count: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of being good for each of the PATTERNS vote patterns, by expectation-maximisation."""
    v = votes_of(pattern) + 1
    good = 1 / (1 + np.exp(-(v - 1).sum(axis=1, dtype=float)))
    weight = count.astype(float)
    onehot = np.eye(3)[v]
    table = np.full((2, v.shape[1], 3), 1 / 3)
    prior = 0.5
    for _ in range(rounds):
        for k, share in enumerate((1 - good, good)):
            sums = np.einsum("p,pjc->jc", weight * share, onehot) + 1.0
            table[k] = sums / sums.sum(axis=1, keepdims=True)
        prior = (np.dot(weight, good) + 1) / (weight.sum() + 2)
        logs = np.log(table)
        each = [np.einsum("pjc,jc->p", onehot, logs[k]) for k in (0, 1)]
        good = 1 / (1 + np.exp(np.clip(each[0] - each[1] + np.log(1 - prior) - np.log(prior), -500, 500)))
    every = np.eye(3)[votes_of(np.arange(PATTERNS)) + 1]
    each = [np.einsum("pjc,jc->p", every, np.log(table[k])) for k in (0, 1)]
    return 1 / (1 + np.exp(np.clip(each[0] - each[1] + np.log(1 - prior) - np.log(prior), -500, 500)))


def features(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, value, text index): hashed words and word shapes, each text's values of length 1."""
    buf, offsets = T.encode(texts)
    start, end, text = T.words(buf, offsets)
    if not len(start):
        e = np.zeros(0, np.int64)
        return e, e.astype(float), e
    h = T.span_hashes(buf, start, end)
    kind = np.full(256, 4, np.uint64)  # other, upper, lower, digit, ASCII sign
    kind[65:91], kind[97:123], kind[48:58] = 0, 1, 2
    kind[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
    size = np.minimum(end - start, 15).astype(np.uint64)
    edge = lambda at: kind[buf[np.clip(at, start, end - 1)]]
    shape = T.mix((((edge(start) * T.U64(5) + edge(start + 1)) * T.U64(5) + edge(end - 2)) * T.U64(5) + edge(end - 1)) * T.U64(16) + size)
    bucket = np.concatenate([h, shape]) % T.U64(FEATURES)
    owner = np.concatenate([text, text])
    key, times = np.unique(owner.astype(np.uint64) * T.U64(FEATURES) + bucket, return_counts=True)
    owner, bucket = (key // T.U64(FEATURES)).astype(np.int64), (key % T.U64(FEATURES)).astype(np.int64)
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(owner, value ** 2, len(texts)))
    return bucket, value / norm[owner], owner


def fit_scorer(bucket, value, owner, target, rounds: int = 150, decay: float = 1e-5) -> np.ndarray:
    """Weights of a logistic scorer, the intercept last; Adam on the whole sample, a fixed number of rounds."""
    n = len(target)
    w, m, s = (np.zeros(FEATURES + 1) for _ in range(3))
    for t in range(1, rounds + 1):
        z = np.bincount(owner, value * w[bucket], n) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / n
        g = np.concatenate([np.bincount(bucket, value * err[owner], FEATURES), [err.sum()]]) + decay * w
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w -= 0.2 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
    return w


def learn(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """(posterior by pattern, scorer weights) from all votes and a bounded sample of texts."""
    df = packed(docs)
    text = text_of(df, text_col)
    voted = df.select(text.alias("text"), text_udf(lambda t: {"p": pattern_of(votes(t))}, "p int")(text)["p"].alias("p"))
    rows = voted.groupBy("p").agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    if not rows:
        return np.full(PATTERNS, 0.5), np.zeros(FEATURES + 1)
    pattern, count = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    posterior = fit_votes(pattern, count)
    share = min(1.0, sample_docs / count.sum())
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    picked = df.select(text.alias("text")).withColumn("h", h).where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)))

    def sample(texts):
        bucket, value, owner = features(texts)
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
        return {"b": [bucket[i:j].astype(np.uint16).tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)],
                "v": [value[i:j].astype(np.float32).tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)],
                "p": pattern_of(votes(texts))}

    # copies of a text are one row of the sample, however many there are; the limit is the sample's hard bound
    one = picked.select("h", text_udf(sample, "b binary, v binary, p int")(F.col("text")).alias("s")).groupBy("h").agg(F.first("s").alias("s"))
    got = one.orderBy("h").limit(2 * sample_docs).select("s.*").collect()
    got.sort(key=lambda r: (r["p"], bytes(r["b"])))
    if not got:
        return posterior, np.zeros(FEATURES + 1)
    sizes = [len(r["b"]) // 2 for r in got]
    owner = np.repeat(np.arange(len(got)), sizes)
    bucket = np.frombuffer(b"".join(r["b"] for r in got), np.uint16).astype(np.int64)
    value = np.frombuffer(b"".join(r["v"] for r in got), np.float32).astype(float)
    return posterior, fit_scorer(bucket, value, owner, posterior[[r["p"] for r in got]])


def score(docs: DataFrame, posterior: np.ndarray, weights: np.ndarray, text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """Struct ``row`` beside struct ``c``: score, weak_label (the posterior of the votes), kept."""
    shared = docs.sparkSession.sparkContext.broadcast((posterior, weights))

    def fn(texts):
        post, w = shared.value
        bucket, value, owner = features(texts)
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, value * w[bucket], len(texts)) + w[-1], -50, 50)))
        return {"score": p, "weak_label": post[pattern_of(votes(texts))], "kept": p >= keep}

    df = packed(docs)
    return df.select("row", text_udf(fn, "score double, weak_label double, kept boolean")(text_of(df, text_col)).alias("c"))
