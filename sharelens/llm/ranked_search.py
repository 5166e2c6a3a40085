"""Ranked lexical search with range-maximum tables: exact top-k documents for a stated set of items.

1. The items' distinct term sets are the queries, dealt into blocks of at most
   ``BLOCK_BYTES`` of terms; only a block's vocabulary reaches the driver, and
   each block meets all documents.
2. One pass over the texts writes segments: for about ``SEGMENT_BYTES`` of text
   the documents in id order with their lengths, and a posting list (documents,
   frequencies) for each term of the vocabulary.  Corpus counts are sums over
   the segments.
3. A posting's impact is its exact integer contribution to the score.  Each
   posting list of a segment gets a sparse table of range-maximum places.  A
   query starts with the interval of all the segment's documents; an interval
   is bounded by the sum of its terms' range maxima, and its split document is
   the one with the largest of these maxima.  The intervals with the highest
   bounds are taken first, their split documents scored, and the intervals left
   and right of them bounded in turn; an interval whose bound cannot reach the
   ten best so far ends.  Intervals are taken ``WAVE`` at a time so that numpy
   does the arithmetic of a wave at once.
4. The pass runs twice: a first one that stops after a few waves gives real
   scores, whose k-th best is a bound that no answer lies under; the second one
   starts from it and is exact.  A task keeps its best ones from segment to
   segment, so k rows for each query and task are shuffled.

Terms are compared by 64-bit hashes (a false match has odds of 2^-64 for each
pair of terms compared).

Defined results: a null or empty text has no terms and is in no answer; an item
without terms has no rows; repeated documents rank one after another; a
repeated item row repeats its ranking; equal scores go by ascending id, null
ids last; only the id and text columns are read, whatever the others are called.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sharelens.session import cut_lineage, scratch_path

from . import textarrays as T
from .decontaminate import LOWER, UPPER
from .frames import releasing

K = 10
#: bytes of distinct terms that one pass over the documents looks for
BLOCK_BYTES = 8 << 20
SEGMENT_BYTES = 4 << 20
WAVE = 32
#: waves for each query and segment in the first pass
FIRST_WAVES = 2
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: bytes of terms: ASCII letters and digits, and all beyond ASCII
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = True
_TERM[128:] = True


def terms(text: Column) -> Column:
    """The distinct lower-cased (A-Z) terms of a text, sorted."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_sort(F.array_distinct(F.array_remove(F.split(low, BETWEEN), "")))


def _hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term of the texts, and the index of its text."""
    buf, offsets = T.encode(texts)
    buf = T.lower_ascii(buf)
    start, end, text = T.runs(_TERM[buf], offsets)
    return T.span_hashes(buf, start, end), text


class Queries:
    """One block of queries: the sorted term hashes, and each query's terms as indexes into them."""

    def __init__(self, rows):
        hashes, text = _hashes([" ".join(r["terms"]) for r in rows])
        self.vocabulary, places = np.unique(hashes, return_inverse=True)
        cuts = np.searchsorted(text, np.arange(len(rows) + 1))
        self.keys = [r["query"] for r in rows]
        self.terms = [np.unique(places[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _blocks(queries: DataFrame) -> list[DataFrame]:
    size = queries.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 16))).first()[0] or 0
    n = max(1, -(-int(size) // BLOCK_BYTES))
    return [queries] if n == 1 else [queries.where(F.pmod(F.xxhash64("query"), F.lit(n)) == i) for i in range(n)]


# ---- segments ------------------------------------------------------------------

def _id_key(x):
    return (x is None, 0 if x is None else x)


def _segment(ids: list, texts: list, vocabulary: np.ndarray) -> dict:
    order = sorted(range(len(ids)), key=lambda i: _id_key(ids[i]))
    h, doc = _hashes([texts[i] for i in order])
    n = np.bincount(doc, minlength=len(ids))
    place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    hit = vocabulary[place] == h
    key, tf = np.unique(place[hit] * len(ids) + doc[hit], return_counts=True)
    term, df = np.unique(key // len(ids), return_counts=True)
    return {"ids": [ids[i] for i in order], "n": n, "n_docs": int((n > 0).sum()), "n_terms": int(n.sum()),
            "terms": term, "df": df, "docs": key % len(ids), "tf": tf}


def _segment_schema(id_type) -> StructType:
    ints, longs = ArrayType(IntegerType()), ArrayType(LongType())
    return StructType([StructField("ids", ArrayType(id_type)), StructField("n", longs), StructField("n_docs", LongType()),
                       StructField("n_terms", LongType()), StructField("terms", ints), StructField("df", ints),
                       StructField("docs", ints), StructField("tf", longs)])


def segments(docs: DataFrame, id_col: str, text_col: str, vocabulary: np.ndarray) -> DataFrame:
    """A row for each segment of the documents that have a term at all."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _segment_schema(docs.schema[id_col].dataType)

    @releasing
    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            for i, j in T.groups_of_bytes(sizes.tolist(), SEGMENT_BYTES):
                part = batch.slice(i, j - i)
                got = _segment(part["id"].to_pylist(), part["text"].to_pylist(), vocabulary)
                yield pa.RecordBatch.from_arrays([pa.array([got[f.name]], f.type) for f in arrow], schema=arrow)

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, schema)


# ---- search --------------------------------------------------------------------

class Index:
    """The posting lists of one segment, their impacts and range-maximum tables."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids, self.n = row["ids"], len(row["ids"])
        n = row["n"]
        if self.n and 90 * int(n.max()) * n_docs < 1 << 63:
            m = 10 + 90 * n * n_docs // n_terms
        else:  # beyond 64 bits on the way
            m = np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], np.int64)
        self.terms, df, doc, tf = row["terms"], row["df"], row["docs"].astype(np.int64), row["tf"]
        self.starts = np.concatenate([[0], np.cumsum(df)])
        slot = np.repeat(np.arange(len(df)), df)
        self.impact = weights[self.terms][slot] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        self.doc = doc
        self.key = slot * self.n + doc
        # best[k, i]: the place of the largest impact among the 2^k postings from i on, the first of equal ones
        size = len(doc)
        levels = max(int(df.max(initial=1)).bit_length(), 1)
        self.best = np.empty((levels, size), np.int32)
        self.best[0] = np.arange(size)
        for k in range(1, levels):
            half = 1 << (k - 1)
            self.best[k] = self.best[k - 1]
            left, right = self.best[k - 1][:max(size - half, 0)], self.best[k - 1][half:]
            self.best[k][:len(left)] = np.where(self.impact[left] >= self.impact[right], left, right)

    def slots(self, query_terms: np.ndarray) -> np.ndarray:
        """Where the query's terms stand among the segment's."""
        at = np.searchsorted(self.terms, query_terms)
        return at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query_terms)] if len(self.terms) else at[:0]

    def maxima(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest impact in each posting range [left, right), 0 in an empty one, and the document that has it."""
        size = right - left
        full = size > 0
        k = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        a = self.best[k, np.where(full, left, 0)]
        b = self.best[k, np.where(full, right - (1 << k), 0)]
        va, vb = self.impact[a], self.impact[b]
        place = np.where(vb > va, b, a)
        return np.where(full, np.maximum(va, vb), 0), self.doc[place]


def _search(index: Index, slots: np.ndarray, best: list, k: int, floor, waves: int | None) -> int:
    """Put the best documents of the segment into ``best``, sorted (-score, id key, id); returns the documents scored."""
    if not len(slots):
        return 0
    heap, serial, scored = [], 0, 0

    def bound(lo, hi, left, right):
        """Bound the intervals [lo, hi) and keep those that an answer may lie in."""
        nonlocal serial
        top, where = index.maxima(left, right)
        total = top.sum(1)
        limit = best[-1] if len(best) == k else None
        least = max(1, -limit[0] if limit else 1, -floor[0] if floor else 1)
        for i in np.flatnonzero((total >= least) & (hi > lo)):
            key = (-int(total[i]), _id_key(index.ids[lo[i]]))
            if (limit and key >= limit[:2]) or (floor and key > floor):
                continue
            serial += 1
            heapq.heappush(heap, (*key, serial, int(where[i, top[i].argmax()]), int(lo[i]), int(hi[i]), left[i], right[i]))

    first, last = index.starts[slots][None], index.starts[slots + 1][None]
    bound(np.array([0]), np.array([index.n]), first, last)
    while heap and (waves is None or waves > 0):
        if waves is not None:
            waves -= 1
        wave = []
        while heap and len(wave) < WAVE:
            x = heapq.heappop(heap)
            if len(best) == k and x[:2] >= best[-1][:2]:
                heap.clear()     # the others are no better
                break
            wave.append(x)
        if not wave:
            break
        split = np.array([x[3] for x in wave])
        lo, hi = np.array([x[4] for x in wave]), np.array([x[5] for x in wave])
        left, right = np.stack([x[6] for x in wave]), np.stack([x[7] for x in wave])
        want = slots * index.n + split[:, None]
        at = np.searchsorted(index.key, want)
        held = (at < right) & (index.key[np.minimum(at, len(index.key) - 1)] == want)
        scores = np.where(held, index.impact[np.minimum(at, len(index.key) - 1)], 0).sum(1)
        scored += len(wave)
        for s, d in zip(scores.tolist(), split.tolist(), strict=True):
            key = (-s, _id_key(index.ids[d]), index.ids[d])
            if s > 0 and (len(best) < k or key[:2] < best[-1][:2]):
                insort(best, key, key=lambda x: x[:2])
                del best[k:]
        bound(np.concatenate([lo, split + 1]), np.concatenate([split, hi]),
              np.concatenate([left, at + held]), np.concatenate([at, right]))
    return scored


def _best_of_tasks(parts: DataFrame, id_type, queries: Queries, weights: np.ndarray, n_docs: int, n_terms: int, k: int,
                   floors: dict | None, waves: int | None) -> DataFrame:
    """(q, score, id): the k best of each query among the segments of each task."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([StructField("q", IntegerType()), StructField("score", LongType()), StructField("id", id_type)])
    query_terms, names = queries.terms, ("n", "terms", "df", "docs", "tf")

    @releasing
    def run(batches):
        best = [[] for _ in query_terms]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {x: batch[x][i].values.to_numpy(zero_copy_only=False) for x in names}
                index = Index(row | {"ids": batch["ids"][i].as_py()}, weights, n_docs, n_terms)
                for q, own in enumerate(query_terms):
                    _search(index, index.slots(own), best[q], k, floors.get(q) if floors else None, waves)
        rows = [(q, -s, x) for q, found in enumerate(best) for s, _, x in found]
        arrow = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(arrow)], schema=arrow)

    return parts.mapInArrow(run, schema)


def _ranked(rows: DataFrame, k: int, keys: list[str], salt: Column | None = None) -> DataFrame:
    """The k best rows of each key, with their ``rank``; by ``salt`` first, so that no task gets all of a key."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    if salt is not None:
        some = Window.partitionBy(*keys, "salt").orderBy(*order)
        rows = rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k).drop("salt", "rank")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def top_documents(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(query, rank, id, score) for ``queries(query, terms)`` with distinct keys and term sets that are not empty."""
    spark, found = docs.sparkSession, []
    id_type = docs.schema[id_col].dataType
    for block in _blocks(queries):
        asked = Queries(block.collect())     # at most BLOCK_BYTES
        if not asked.keys:
            continue
        path = scratch_path(spark, "search-segments")
        segments(docs, id_col, text_col, asked.vocabulary).write.parquet(path)
        parts = spark.read.parquet(path)
        n_docs, n_terms = (x or 0 for x in parts.agg(F.sum("n_docs"), F.sum("n_terms")).first())
        if not n_docs:
            continue
        weights = np.zeros(len(asked.vocabulary), np.int64)
        counts = parts.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(F.sum("x.df").alias("df"))
        for term, df in counts.collect():    # a row for each term of the block
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        salt = F.pmod(F.spark_partition_id(), F.lit(64))
        first = _best_of_tasks(parts, id_type, asked, weights, n_docs, n_terms, k, None, FIRST_WAVES)
        floors = {r["q"]: (-r["score"], _id_key(r["id"]))
                  for r in _ranked(first, k, ["q"], salt).where(F.col("rank") == k).collect()}    # a row for each query
        exact = _best_of_tasks(parts, id_type, asked, weights, n_docs, n_terms, k, floors, None)
        keys = spark.createDataFrame(list(enumerate(asked.keys)), "q int, query string")
        found.append(cut_lineage(_ranked(exact, k, ["q"], salt).join(F.broadcast(keys), "q").select("query", "rank", "id", "score")))
    if not found:
        kind = id_type.simpleString()
        return spark.createDataFrame([], f"query string, rank int, id {kind}, score long")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", k: int = K) -> DataFrame:
    """(item, rank, id, score): the k documents of ``docs`` with the highest scores above 0 for each row of ``items``."""
    asked = items.select(F.col(f"`{item_id_col}`").alias("item"), terms(F.col(f"`{item_text_col}`")).alias("terms"))
    asked = asked.where(F.size("terms") > 0).withColumn("query", F.sha2(F.concat_ws(" ", "terms").cast("binary"), 256))
    answers = top_documents(docs, asked.select("query", "terms").distinct(), id_col, text_col, k)
    return asked.select("item", "query").join(answers, "query").select("item", "rank", "id", "score")
