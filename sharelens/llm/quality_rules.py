"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Every word and word pair of a text is hashed into ``BUCKETS`` buckets.  Two
multinomials with add-one smoothing are counted over the buckets: one over all
documents, one over trusted documents.  The score of a document is the mean of
``log p_target - log p_raw`` over its n-grams, so it does not depend on the
length; a document is kept when it passes the base rules and its score reaches
the threshold.  The multinomials are two vectors of fixed size, whatever the
corpus holds.

The scale of the scores depends on the corpus, so the threshold is taken from
the trusted documents by cross-fitting: they are dealt into ``FOLDS``, each fold
is scored with a target that lacks it, and ``CLEAN_LOSS`` of those that pass the
base rules score below the threshold.  So every trusted document counts, and
the rule is the same at every size.

Defined results: a null or empty text has no words and fails the base rules; a
repeated row is judged like its copies; with no trusted documents, or an empty
table, the ratio is 0 and only the base rules decide; extra columns are kept by
``keep_documents`` whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles
from ..session import cut_lineage, cut_lineage_counted
from . import textarrays as T
from .frames import packed, releasing, text_of, text_udf

BUCKETS = 1 << 16
#: nats for each n-gram; where no trusted document passes the base rules, so that there is nothing to calibrate on
THRESHOLD = -0.3
#: share of the trusted documents that the calibrated threshold gives up
CLEAN_LOSS = 0.05
#: each of so many parts of the trusted documents is scored without itself in the target
FOLDS = 8
#: up to so many trusted ids are broadcast; the result is the same above
BROADCAST_IDS = 100_000
MIN_WORDS = 20
MAX_REPEATED = 30
WINDOW = 8

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _grams(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text index of every word and word pair."""
    pair, first = T.windows(h, text, 2)
    mask = T.U64(BUCKETS - 1)
    return (np.concatenate([h & mask, pair & mask]).astype(np.int64), np.concatenate([text, text[first]]))


def _repeats(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """True where the key occurs twice or more in its text."""
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    same = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _later_equal(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """True where an earlier item of the same text has the key."""
    order = np.lexsort((np.arange(len(keys)), keys, text))
    k, t = keys[order], text[order]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    return out


def base_columns(texts, ratio: np.ndarray | None = None) -> dict:
    """Base counts of each text, and the score when the ratio vector is given."""
    buf, offsets = T.encode(texts)
    n = len(texts)
    start, end, text = T.words(buf, offsets)
    h = T.span_hashes(buf, start, end)
    per = lambda idx, weights=None: np.bincount(idx, weights, n).astype(np.int64)
    n_words = per(text)
    leads = np.concatenate([[0], np.cumsum(T.LEAD[buf])])
    n_symbols = np.concatenate([[0], np.cumsum(_SYMBOL[buf])])
    ls, le, lt = T.lines(buf, offsets)
    worded = np.searchsorted(start, le, "left") > np.searchsorted(start, ls, "left")
    ls, le, lt = ls[worded], le[worded], lt[worded]
    dup = _later_equal(T.span_hashes(buf, ls, le), lt)
    wh, first = T.windows(h, text, WINDOW)
    again = first[_repeats(wh, text[first])]
    hit = T.covered(again, WINDOW, len(h))
    n_repeat = per(text[hit])
    out = {
        "n_words": n_words,
        "word_chars": per(text, leads[end] - leads[start]),
        "n_symbols": n_symbols[offsets[1:]] - n_symbols[offsets[:-1]],
        "n_dup_lines": per(lt[dup]),
        "n_repeat_words": n_repeat,
        "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEATED * n_words),
    }
    if ratio is not None:
        bucket, owner = _grams(h, text)
        total = np.bincount(owner, ratio[bucket], n)
        out["score"] = total / np.maximum(np.bincount(owner, minlength=n), 1)
    return out


def _bucket_counts(df: DataFrame) -> DataFrame:
    """``df(text, fold)`` to (bucket, n_raw, t0, t1, ...), the counts of all texts and of each fold's (-1: none); each task
    adds up its rows first."""
    names = ["bucket", "n_raw", *(f"t{k}" for k in range(FOLDS))]

    def count(batches):
        total = np.zeros((1 + FOLDS, BUCKETS), np.int64)
        for b in batches:
            texts, folds = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), np.int64)
            for i, j in T.groups_of_bytes([len(t or "") for t in texts]):
                buf, offsets = T.encode(texts[i:j])
                start, end, text = T.words(buf, offsets)
                bucket, owner = _grams(T.span_hashes(buf, start, end), text)
                total[0] += np.bincount(bucket, minlength=BUCKETS)
                own = folds[i:j][owner]
                for k in np.unique(own[own >= 0]):
                    total[1 + k] += np.bincount(bucket[own == k], minlength=BUCKETS)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(x[some]) for x in total)], names)

    parts = df.mapInArrow(releasing(count), ", ".join(f"{x} long" for x in names))
    return parts.groupBy("bucket").agg(*[F.sum(x).alias(x) for x in names[1:]])


def _trusted(docs: DataFrame, trusted_ids: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(text, fold) of the documents with a trusted id, all of them.

    Up to ``BROADCAST_IDS`` ids are sent to every task; more are joined by a shuffle, whose result is kept since it is read twice."""
    key = F.col(f"`{trusted_ids.columns[0]}`")
    ids, n_ids = cut_lineage_counted(trusted_ids.select(key.alias("trusted_id")).where("trusted_id is not null").distinct().withColumn(
        "fold", F.pmod(F.xxhash64(F.lit("fold"), "trusted_id"), F.lit(FOLDS)).cast("int")))
    texts = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").alias("own_id"))
    few = n_ids <= BROADCAST_IDS
    joined = texts.join(F.broadcast(ids) if few else ids, F.col("own_id") == F.col("trusted_id")).select("text", "fold")
    return joined if few else cut_lineage(joined)


def _counts(docs: DataFrame, trusted: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the buckets in all documents, and in each fold of the trusted ones; a row for each bucket reaches the driver."""
    raw, target = np.zeros(BUCKETS), np.zeros((FOLDS, BUCKETS))
    every = docs.select(F.col(f"`{text_col}`").alias("text"), F.lit(-1).alias("fold"))
    for bucket, n_raw in _bucket_counts(every).select("bucket", "n_raw").collect():
        raw[bucket] = n_raw
    for bucket, _, *folds in _bucket_counts(trusted).collect():
        target[:, bucket] = folds
    return raw, target


def _log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def log_ratio(docs: DataFrame, trusted_ids: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> np.ndarray:
    """log p_target - log p_raw for each bucket.

    ``trusted_ids`` has the trusted ids in its first column; every one of them
    counts.  What reaches the driver is one row for each bucket.
    """
    raw, target = _counts(docs, _trusted(docs, trusted_ids, text_col, id_col), text_col)
    return _log_ratio(raw, target.sum(axis=0))


def judge(texts_df: DataFrame, ratio: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The input's columns as struct ``row`` beside struct ``q``: base columns, score, kept."""
    shared = texts_df.sparkSession.sparkContext.broadcast(ratio)

    def fn(texts):
        out = base_columns(texts, shared.value)
        out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
        return out

    df = packed(texts_df)
    return df.select("row", text_udf(fn, BASE + ", score double, kept boolean")(text_of(df, text_col)).alias("q"))


def fit(docs: DataFrame, trusted_ids: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> tuple[np.ndarray, float]:
    """(log ratio, threshold): one pass over all texts, and two over the trusted ones, each scored without its own fold."""
    trusted = _trusted(docs, trusted_ids, text_col, id_col)
    raw, target = _counts(docs, trusted, text_col)
    whole = target.sum(axis=0)
    shared = docs.sparkSession.sparkContext.broadcast([_log_ratio(raw, whole - own) for own in target])

    def score(batches):
        for b in batches:
            texts, folds = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), np.int64)
            for i, j in T.groups_of_bytes([len(t or "") for t in texts]):
                for k in np.unique(folds[i:j]):
                    got = base_columns([texts[x] for x in np.flatnonzero(folds[i:j] == k) + i], shared.value[k])
                    yield pa.RecordBatch.from_arrays([pa.array(np.asarray(got["score"], float)[~np.asarray(got["base_failed"], bool)])], ["score"])

    cut = exact_quantiles(trusted.mapInArrow(releasing(score), "score double"), [], "score", [CLEAN_LOSS]).first()
    return _log_ratio(raw, whole), THRESHOLD if cut is None else cut["quantile"]


def keep_documents(docs: DataFrame, trusted_ids: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   threshold: float | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are; without a threshold it is calibrated."""
    ratio, fitted = fit(docs, trusted_ids, text_col, id_col)
    return judge(docs, ratio, text_col, fitted if threshold is None else threshold).where("q.kept").select("row.*")


def trusted_labels(labels: DataFrame) -> DataFrame:
    """Ids that the labels table calls good and not toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
