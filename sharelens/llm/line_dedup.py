"""Line dedup: align overlapping documents on shared rare lines, delete the common blocks from the later one.

Lines are cut at newlines and, since passages are often pasted into running
text, also after a word that ends a sentence and before a capitalised word.  A
line is cut further, by its content: before each word whose pair with the word
before it has the smallest hash among the ``REACH`` pairs on either side, pairs
within ``EDGE`` words of the line's ends apart, so the same words are cut at the
same places wherever they stand.  A line's hash is over its words, so white space does not matter.  The first
document (by id) that holds a line owns it.  Rare are the lines that a document
does not have alone, and of interest the runs of them with ``MIN_WORDS`` words
or more: each run is paired with the owners of its lines, never with all
documents that share a line, so the number of pairs follows the number of
lines, however common one is.
Each pair is aligned with patience diff (common head and tail, lines that are
unique on both sides in their longest increasing order, then the gaps between
them).  Aligned lines that make a run of ``MIN_WORDS`` words in the later
document, over all its pairs, are deleted from it.

Defined results: null texts stay null and empty ones empty; rows with equal id
and text are one document and get one result; rows that share an id only are
never compared with each other; null ids come after all others, and are not
compared with each other; of equal texts the first id keeps its text and the
others lose it; a single-column or wider table keeps its columns.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sharelens.session import scratch_path

from . import textarrays as T
from .frames import packed, releasing, text_of, text_udf

#: a block is deleted when it has so many words
MIN_WORDS = 25
#: lines are cut by content into pieces of about 2 * REACH + 1 words
REACH = 4
#: and no nearer to the line's ends
EDGE = 8
LAST_ID = (1 << 63) - 1
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[list(b".!?")] = True


def _cuts(h: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """True for the words that begin a piece: the least pair hash within ``REACH``, ``EDGE`` words or more from the line's ends."""
    n = len(h)
    at = np.flatnonzero(begins)
    sizes = np.diff(at, append=n)
    place = np.arange(n) - np.repeat(at, sizes)
    inner = (place >= EDGE) & (np.repeat(sizes, sizes) - place >= EDGE)
    score = np.full(n, T.U64(2**64 - 1))
    where = np.flatnonzero(inner)
    score[where] = T.mix(h[where] * T.U64(3) + h[where - 1])
    for r in range(1, REACH + 1):
        inner[r:] &= score[r:] < score[:-r]
        inner[:-r] &= score[:-r] <= score[r:]
    return inner


def split_lines(texts):
    """(hash, first byte, end byte, words, text index) of the lines of each text; bytes count from the text's start."""
    buf, offsets = T.encode(texts)
    start, end, text = T.words(buf, offsets)
    if not len(start):
        e = np.zeros(0, np.int64)
        return e.astype(T.U64), e, e, e, e
    h = T.span_hashes(buf, start, end)
    newline = np.concatenate([[0], np.cumsum(buf == 10)])
    second = buf[np.minimum(start + 1, len(buf) - 1)]
    first = buf[start]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    last, before = buf[end - 1], buf[np.maximum(end - 2, 0)]
    stop = _SENTENCE_END[last] & ~(_SENTENCE_END[before] & (end - start > 1))   # not after "!!" or "..."
    begins = np.ones(len(start), bool)
    begins[1:] = ((text[1:] != text[:-1]) | (newline[start[1:]] != newline[end[:-1]])
                  | stop[:-1] | (capital[1:] & ~capital[:-1]))
    at = np.flatnonzero(begins | _cuts(h, begins))
    stop = np.concatenate([at[1:], [len(start)]])
    p, q = T._power_table(len(h))
    prefix = np.zeros(len(h) + 1, T.U64)
    np.cumsum(T.mix(h) * p[:len(h)], out=prefix[1:])
    hashes = T.mix((prefix[stop] - prefix[at]) * q[at])
    own = text[at]
    return hashes, start[at] - offsets[own], end[stop - 1] - offsets[own], stop - at, own


# ---- alignment ---------------------------------------------------------------

def _increasing(pairs):
    """Longest subsequence of (i, j), ordered by i, in which j increases too."""
    tops, piles, back = [], [], [None] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back[k] = piles[at - 1] if at else None
        if at == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[at], piles[at] = j, k
    out, k = [], piles[-1] if piles else None
    while k is not None:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _anchors(a, b, a0, a1, b0, b1):
    """Lines that occur once on both sides; else the occurrences, in order, of the shared line with the fewest."""
    left: dict = {}
    right: dict = {}
    for i in range(a0, a1):
        left.setdefault(a[i], []).append(i)
    for j in range(b0, b1):
        if b[j] in left:
            right.setdefault(b[j], []).append(j)
    once = [(left[x][0], y[0]) for x, y in right.items() if len(y) == 1 and len(left[x]) == 1]
    if once:
        return _increasing(sorted(once))
    if not right:
        return []
    x = min(right, key=lambda k: (len(left[k]) + len(right[k]), k))
    return list(zip(left[x], right[x], strict=False))


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i, j) of two sequences, a[i] == b[j], increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        last = (a0, b0)
        found = _anchors(a, b, a0, a1, b0, b1)
        for i, j in found:
            out.append((i, j))
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        if found:
            todo.append((last[0], a1, last[1], b1))
    return sorted(out)


# ---- the Spark job -----------------------------------------------------------

def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


_INTS = pa.list_(pa.int64())


def _line_rows(docs: DataFrame) -> DataFrame:
    """(hash, ord, key, place): a row for each line; ``place`` is its number and its words, packed."""

    def explode(batches):
        for batch in batches:
            ords, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = batch.column(2)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for i, j in T.groups_of_bytes(sizes):
                h, _, _, words, own = split_lines(texts.slice(i, j - i).to_pylist())
                at = np.arange(len(own)) - np.searchsorted(own, own, "left")
                yield _batch({"hash": (h.astype(np.int64), pa.int64()), "ord": (ords[i:j][own], pa.int64()),
                              "key": (keys[i:j][own], pa.int64()), "place": ((at << 32) | words, pa.int64())})

    return docs.select("ord", "key", "text").mapInArrow(releasing(explode), "hash long, ord long, key long, place long")


def _slices(column: pa.ListArray, *fields: str):
    """For each row of a list-of-struct column, its fields as arrays."""
    offsets = column.offsets.to_numpy()
    arrays = [column.values.field(f).to_numpy(zero_copy_only=False) for f in fields]
    for i, j in zip(offsets[:-1], offsets[1:], strict=True):
        yield [a[i:j] for a in arrays]


def _long_runs(place: np.ndarray, min_words: int):
    """Slices of the sorted packed places that are consecutive lines with so many words in all."""
    at, words = place >> 32, place & 0xFFFFFFFF
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
    total = np.add.reduceat(words, first)
    edges = np.concatenate([first, [len(at)]])
    return [(edges[k], edges[k + 1]) for k in np.flatnonzero(total >= min_words)]


def _pair(batches, min_words: int):
    """For each run of repeated lines of a document, its lines once for each owner of one of them."""
    for batch in batches:
        rows = []
        for order, key, (place, hashes, owner) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                       _slices(batch.column(2), "place", "hash", "owner"), strict=True):
            place, at = np.unique(place, return_index=True)
            hashes, owner = hashes[at], owner[at]
            later = owner < order
            place, hashes, owner = place[later], hashes[later], owner[later]
            if len(place):
                for i, j in _long_runs(place, min_words):
                    rows += [(order, key, o, place[i:j], hashes[i:j]) for o in np.unique(owner[i:j]).tolist()]
                if len(rows) > 2000:
                    yield _pairs(rows)
                    rows = []
        yield _pairs(rows)


def _pairs(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [("ord", pa.int64()), ("key", pa.int64()), ("owner", pa.int64()), ("place", _INTS), ("hash", _INTS)]
    return _batch({name: (list(c), t) for c, (name, t) in zip(cols, kinds, strict=True)})


def _align(batches):
    """Aligned places of the later document's run, for each run and owner."""
    for batch in batches:
        orders, keys = batch.column(0), batch.column(1)
        out = []
        later = zip(*[_rows_of(batch.column(i)) for i in (2, 3)], strict=True)
        for (place, hashes), (theirs, mine) in zip(later, _slices(batch.column(4), "place", "hash"), strict=True):
            theirs, first = np.unique(theirs, return_index=True)
            pairs = patience(mine[first].tolist(), hashes.tolist())
            out.append(place[[j for _, j in pairs]])
        yield _batch({"ord": (orders, pa.int64()), "key": (keys, pa.int64()), "place": (out, _INTS)})


def _rows_of(column: pa.ListArray):
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[i:j] for i, j in zip(offsets[:-1], offsets[1:], strict=True)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = packed(docs)
    text = text_of(rows, text_col)
    own = rows["row"].getField(id_col)
    number = own.cast("long") if isinstance(docs.schema[id_col].dataType, IntegralType) else F.shiftright(F.xxhash64(own), 1)
    order = F.coalesce(F.when(own.isNotNull(), number), F.lit(LAST_ID))
    return rows.select("row", order.alias("ord"), F.xxhash64(order, text).alias("key"), text.alias("text"))


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows from a table in the session's shared folder: columns, a third of a checkpoint's size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def repeated_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(ord, key, places): the lines of each document to delete; documents without any have no row."""
    lines = _line_rows(_keyed(docs, id_col, text_col))
    owners = lines.groupBy("hash").agg(F.min("ord").alias("owner"), F.max("ord").alias("last"))
    # written apart from the aggregate, so that a line that very many documents hold can be split in the join
    owners = _written(owners.where("owner < last").select("hash", "owner"), "line-owners")
    held = _written(lines.join(owners, "hash").groupBy("ord", "key").agg(
        F.collect_list(F.struct("place", "hash", "owner")).alias("lines")), "line-held")
    pairs = held.mapInArrow(releasing(lambda b: _pair(b, min_words)), "ord long, key long, owner long, place array<long>, hash array<long>")
    earlier = held.select(F.col("ord").alias("owner"), F.transform("lines", lambda x: F.struct(
        x["place"].alias("place"), x["hash"].alias("hash"))).alias("earlier"))
    both = pairs.join(earlier, "owner").select("ord", "key", "place", "hash", "earlier")
    aligned = both.mapInArrow(releasing(_align), "ord long, key long, place array<long>")
    merged = aligned.groupBy("ord", "key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("place")))).alias("place"))

    def kept(batches):
        for batch in batches:
            out = []
            for place in _rows_of(batch.column(2)):
                runs = _long_runs(place, min_words) if len(place) else []
                out.append(np.concatenate([place[i:j] >> 32 for i, j in runs]) if runs else place[:0])
            yield _batch({"ord": (batch.column(0), pa.int64()), "key": (batch.column(1), pa.int64()), "places": (out, _INTS)})

    return merged.mapInArrow(releasing(kept), "ord long, key long, places array<long>").where(F.size("places") > 0)


def without(text: str, places) -> tuple[str, list[tuple[int, int]], int]:
    """The text without these lines, the deleted byte spans, and the number of lines."""
    _, start, end, _, _ = split_lines([text])
    data = text.encode("utf-8", "replace")
    drop, spans = set(places), []
    for i in range(len(start)):
        if i in drop:
            stop = int(start[i + 1]) if i + 1 < len(start) else len(data)
            if spans and spans[-1][1] == start[i]:
                spans[-1] = (spans[-1][0], stop)
            else:
                spans.append((int(start[i]), stop))
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "replace"), spans, len(start)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Struct ``row`` (the input's columns) beside ``text`` after the deletions and ``spans`` (deleted bytes, start and end)."""
    places = repeated_places(docs, id_col, text_col, min_words).select(F.col("ord").alias("o"), F.col("key").alias("k"), "places")
    keyed = _keyed(docs, id_col, text_col)
    joined = keyed.join(places, (F.col("ord") == F.col("o")) & (F.col("key") == F.col("k")), "left")

    @F.arrow_udf("text string, spans array<array<long>>")
    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        got = [(t, []) if t is None or not p else without(t, p)[:2] for t, p in zip(texts.to_pylist(), places.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()),
                                           pa.array([g[1] for g in got], pa.list_(pa.list_(pa.int64())))], ["text", "spans"])

    changed = cut(F.col("text"), F.col("places"))
    return joined.withColumn("cut", changed).select("row", F.col("cut.text").alias("text"), F.col("cut.spans").alias("spans"))


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows of ``docs`` with the repeated blocks deleted from their texts; the other columns as they are."""
    done = dedup_lines(docs, id_col, text_col, min_words)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
