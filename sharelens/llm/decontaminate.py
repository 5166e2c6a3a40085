"""Benchmark decontamination: a prefix-filtered set join of item windows with documents, DataFrame functions only.

A window is 13 consecutive words of an item (all its words where it has
fewer).  A document that holds a window holds all its words, so for exact
containment the necessary prefix of a window, its words ordered by rarity in
the corpus, is the rarest one.  The plan is narrow up to the verified hits: the
words of a document are exploded with their positions, joined with the windows'
rarest words, bounded by length and position, and verified against the
document's own words inside the same join; no document text is shuffled.

The windows are broadcast in blocks of at most ``BLOCK_BYTES``, as many as the
benchmark needs, and each block meets all documents; a larger benchmark costs
more passes, never memory.

Defined results: null or empty texts have no words; a null item id counts for
hits but is not listed; an empty benchmark leaves every document clean;
repeated rows of ``docs`` come back as often as they are there; columns other
than id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sharelens.session import cut_lineage

WINDOW = 13
#: estimated bytes of windows in one broadcast
BLOCK_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, BETWEEN), "")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """(window array<string>, items array<string>), a row for each different window."""
    w = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), words(F.col(f"`{text_col}`")).alias("w"))
    last = F.greatest(F.size("w") - width, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, width))
    return (w.where(F.size("w") > 0).select("item", F.explode(cut).alias("window"))
            .groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")))


def _positions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each word with its position, and one with word '' after the last: (id, key, w, pos, word)."""
    text = F.col(f"`{text_col}`")
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("key"),
                       F.concat(words(text), F.array(F.lit(""))).alias("w"))
    return base.select("id", "key", "w", F.posexplode_outer("w").alias("pos", "word"))


def _blocks(df: DataFrame, key: str, size: Column) -> list[DataFrame]:
    """``df`` in blocks of at most about BLOCK_BYTES, by the hash of ``key``; one number comes to the driver."""
    total = df.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-int(total) // BLOCK_BYTES))
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def anchored(windows: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each window with its rarest word in the documents and that word's offset."""
    placed = windows.select("window", "items", F.posexplode("window").alias("offset", "word"))
    vocabulary = placed.select("word").distinct()
    counts = [_positions(docs, id_col, text_col).select("word").join(F.broadcast(block), "word")
              .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
              for block in _blocks(vocabulary, "word", F.octet_length("word") + 40)]
    seen = reduce(DataFrame.unionByName, counts)
    ranked = placed.join(seen, "word", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("a"), F.first("items").alias("items"))
    return ranked.select("window", "items", F.col("a.word").alias("word"), F.col("a.offset").alias("offset"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, key, copies, n_words, n_hit, items), a row for each different document.

    ``key`` is the md5 of the text, ``copies`` the number of equal rows,
    ``n_hit`` the words inside any occurrence of a window, ``items`` the sorted
    ids (as strings) of the items with an occurring window.
    """
    windows = cut_lineage(item_windows(items, item_id_col, item_text_col))
    anchors = cut_lineage(anchored(windows, docs, id_col, text_col))
    weight = F.size("window") * 32 + F.size("items") * 24 + 100
    end = docs.sparkSession.range(1).select(
        F.array().cast("array<string>").alias("window"), F.lit(None).cast("array<string>").alias("items"),
        F.lit("").alias("word"), F.lit(0).alias("offset"))
    hits = []
    for i, block in enumerate(_blocks(anchors, "word", weight)):
        if i == 0:  # the row after the last word is met once: it carries the number of words
            block = block.unionByName(end)
        block = block.select("word", "window", "items", F.col("offset").alias("o"), F.size("window").alias("n"))
        start = F.col("pos") - F.col("o")
        p = _positions(docs, id_col, text_col)
        hits.append(p.join(F.broadcast(block), (p["word"] == block["word"]) & (start >= 0)
                           & (start + F.col("n") <= F.size("w") - 1)
                           & (F.slice("w", start + 1, F.col("n")) == F.col("window")))
                    .select("id", "key", start.alias("start"), (start + F.col("n")).alias("end"), "items"))
    rows = reduce(DataFrame.unionByName, hits)
    earlier = Window.partitionBy("id", "key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("end").over(earlier)
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    last = F.col("items").isNull()
    return (rows.withColumn("covered", covered).groupBy("id", "key").agg(
        F.count(F.when(last, 1)).alias("copies"), F.max(F.when(last, F.col("start"))).cast("long").alias("n_words"),
        F.sum("covered").cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))


def is_contaminated() -> Column:
    """The rule: some word is hit, and at least a twentieth of the words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rule does not call contaminated, with their columns as they are."""
    bad = contamination(docs, items, id_col, text_col).where(is_contaminated()).select("id", "key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.select(row, F.col(f"`{id_col}`").alias("own_id"), F.unhex(F.md5(text.cast("binary"))).alias("own_key"))
    same = keyed["own_key"].eqNullSafe(bad["key"]) & keyed["own_id"].eqNullSafe(bad["id"])
    return keyed.join(bad, same, "left_anti").select("row.*")
