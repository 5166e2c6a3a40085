"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

Shingles are five consecutive lower-cased words (all words of a shorter text),
weighted with 1 + ln(occurrences).  Each shingle sends a Poisson process of
arrivals, at a rate of its weight, to the registers of the signature; a register
keeps the shingle of its earliest arrival, and a shingle stops once its next
arrival comes later than the latest register.  Two registers agree with the
probability Jaccard similarity of the texts.  ``BANDS`` bands of ``ROWS``
registers give the buckets.  The weights make candidates only: a link is
verified on the Jaccard similarity of the shingle sets, which is the same
measure where no shingle repeats.

Texts with the same words are one node before anything is compared, so copies
make no pairs.  In a bucket of at most ``SMALL`` nodes every pair is a
candidate.  In a larger one each node is first compared with the bucket's leader
and with its ``NEAR`` next nodes in an order of keys; candidates are verified on
the exact Jaccard similarity of the shingle sets.  Where the components of these
links leave a large bucket with nodes of several components, all its pairs
across components are found by an exact prefix join (rarest shingles first,
with length and position bounds) and verified too.  So the classes, the
connected components, are those of all pairs in the buckets; pairs within one
class of a large bucket are not all compared, and ``n_links`` counts the
verified ones only.

Defined results: null, empty and blank texts have no shingle and form one class;
repeated rows are in one class; a null id sorts after all others; an empty table
gives no rows; other columns are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sharelens.session import cut_lineage, cut_lineage_counted

from . import textarrays as T
from .components import components
from .frames import packed, releasing, text_of, text_udf

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
SMALL, NEAR = 16, 4
PART = 4096
#: pairs, and nodes of the prefix join, for one task: few of them run in few tasks and write few files
TASK_PAIRS, TASK_NODES = 50_000, 2_000


def shingles(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, occurrences, text index) of the different shingles of each text, ordered by text and hash."""
    buf, offsets = T.encode(texts)
    start, end, text = T.words(T.lower_ascii(buf), offsets)
    h = T.span_hashes(T.lower_ascii(buf), start, end)
    keys, first = T.windows(h, text, SHINGLE)
    owner = text[first]
    count = np.bincount(text, minlength=len(texts))
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        begins = np.cumsum(count) - count
        extra = [T.windows(h[begins[i]:begins[i] + count[i]], text[begins[i]:begins[i] + count[i]], count[i])[0] for i in short]
        keys, owner = np.concatenate([keys, *extra]), np.concatenate([owner, short])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])) if len(keys) else order
    times = np.diff(np.concatenate([new, [len(keys)]]))
    return keys[new], times, owner[new]


def signatures(keys: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int, size: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash signatures, one row of ``size`` shingle hashes for each of the n texts."""
    when = np.full(n * size, np.inf)
    who = np.zeros(n * size, T.U64)
    has = np.bincount(owner, minlength=n) > 0
    t = np.zeros(len(keys))
    step = 0
    while len(keys):
        step += 1
        bits = T.mix(keys + T.U64(0x9E3779B97F4A7C15 * step & (2**64 - 1)))
        t = t - np.log(((bits >> T.U64(11)).astype(np.float64) + 1) / 2**53) / weight
        slot = owner * size + (T.mix(bits) % T.U64(size)).astype(np.int64)
        np.minimum.at(when, slot, t)
        won = when[slot] == t
        who[slot[won]] = keys[won]
        latest = when.reshape(n, size).max(axis=1)
        go = t < latest[owner]
        keys, weight, owner, t = keys[go], weight[go], owner[go], t[go]
    who[~np.repeat(has, size)] = 0
    return who.reshape(n, size)


def _describe(texts) -> dict:
    """Digest of the words, number of shingles and band hashes of each text."""
    keys, times, owner = shingles(texts)
    sig = signatures(keys, 1 + np.log(times), owner, len(texts))
    bands = np.zeros((len(texts), BANDS), T.U64)
    for b in range(BANDS):
        acc = np.full(len(texts), b + 1, T.U64)
        for r in range(ROWS):
            acc = T.mix(acc * T.U64(3) + sig[:, b * ROWS + r])
        bands[:, b] = acc
    return {"key": _digests(texts), "n": np.bincount(owner, minlength=len(texts)),
            "bands": list(bands.astype(np.int64))}


def _digests(texts) -> list[bytes]:
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    return [hashlib.blake2b(b" ".join((t or "").encode("utf-8", "replace").translate(lower).split()), digest_size=16).digest()
            for t in texts]


def jaccard(left, right) -> np.ndarray:
    """Exact Jaccard similarity of the shingle sets of each pair of texts."""
    out = np.zeros(len(left))
    a, _, i = shingles(left)
    b, _, j = shingles(right)
    n = len(left)
    ea, eb = np.searchsorted(i, np.arange(n + 1)), np.searchsorted(j, np.arange(n + 1))
    for k in range(n):
        x, y = a[ea[k]:ea[k + 1]], b[eb[k]:eb[k + 1]]
        both = len(np.intersect1d(x, y, assume_unique=True))
        out[k] = both / max(len(x) + len(y) - both, 1)
    return out


def candidates(nodes: DataFrame) -> DataFrame:
    """Distinct (a, b, a_leads, b_leads) with a < b from the buckets of ``nodes(key, bands)``.

    The flags tell whether a (or b) leads a large bucket that holds the other.
    """
    rows = nodes.where("n > 0").select("key", F.col("bands")[0].alias("near"), F.posexplode("bands").alias("band", "bucket"))
    bucket = ["band", "bucket"]
    rank = F.xxhash64("key", "band")
    lead = rows.groupBy(*bucket).agg(F.min(F.struct(rank.alias("r"), "key")).alias("lead"), F.count(F.lit(1)).alias("m")).where("m > 1")
    # cut from the aggregate, so that a bucket that holds much of all rows can be split in the join
    lead = cut_lineage(lead.select(*bucket, F.col("lead.key").alias("lead"), "m"))
    rows = rows.join(lead, bucket)
    star = rows.where("key <> lead").select(F.col("lead").alias("x"), F.col("key").alias("y"), (F.col("m") > SMALL).alias("leads"))
    small = rows.where(F.col("m") <= SMALL).groupBy(*bucket).agg(F.sort_array(F.collect_list("key")).alias("keys"))
    pairs = small.where(F.size("keys") > 2).select(F.col("keys"), F.posexplode("keys").alias("i", "x")).select(
        "x", F.explode(F.slice("keys", F.col("i") + 2, F.lit(SMALL))).alias("y"), F.lit(False).alias("leads"))
    # neighbours in a large bucket, by band 0 and key; a bucket is dealt into parts of about PART nodes
    order = Window.partitionBy(*bucket, "part").orderBy("near", "key")
    large = rows.where(F.col("m") > SMALL).withColumn("part", F.pmod(F.xxhash64("key"), F.ceil(F.col("m") / PART)))
    near = large.select(F.col("key").alias("x"), F.array(*[F.lead("key", i).over(order) for i in range(1, NEAR + 1)]).alias("next"))
    near = near.select("x", F.explode("next").alias("y"), F.lit(False).alias("leads"))
    every = star.unionByName(pairs).unionByName(near.where("y is not null")).where("x <> y")
    return every.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(
        F.max(F.col("leads") & (F.col("x") < F.col("y"))).alias("a_leads"),
        F.max(F.col("leads") & (F.col("x") > F.col("y"))).alias("b_leads"))


def unsettled(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, root) of the nodes that share a large bucket's leader with a node of another component."""
    star = pairs.where("a_leads").select(F.col("a").alias("lead"), F.col("b").alias("key")).unionByName(
        pairs.where("b_leads").select(F.col("b").alias("lead"), F.col("a").alias("key")))
    star = star.join(roots.select(F.col("node").alias("key"), F.col("root")), "key", "left").withColumn("root", F.coalesce("root", "key"))
    star = star.unionByName(star.select("lead").distinct().join(
        roots.select(F.col("node").alias("lead"), F.col("root")), "lead", "left").select(
        "lead", F.col("lead").alias("key"), F.coalesce("root", "lead").alias("root")))
    mixed = star.groupBy("lead").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("lead")
    return star.join(mixed, "lead", "left_semi").select("key", "root").distinct()


def _prefixes(texts: DataFrame, similarity: float, tasks: int) -> DataFrame:
    """(key, root, n, pos, token): the tokens of each node's prefix, rarest first, numbered from 0; ``indexed`` marks those
    that a longer partner's prefix must share one of."""

    def explode(batches):
        for batch in batches:
            keys, roots = batch.column(0), batch.column(1)
            texts = batch.column(2)
            for i, j in T.groups_of_bytes(pc.binary_length(texts).to_pylist()):
                h, _, owner = shingles(texts.slice(i, j - i).to_pylist())
                n = np.bincount(owner, minlength=j - i)
                at = pa.array(owner + i)
                yield pa.RecordBatch.from_arrays([keys.take(at), roots.take(at), pa.array(n[owner]), pa.array(h.astype(np.int64))],
                                                 ["key", "root", "n", "token"])

    tokens = texts.select("key", "root", "text").mapInArrow(releasing(explode), "key binary, root binary, n long, token long")
    often = cut_lineage(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").coalesce(tasks))
    # a token that only one node has joins nothing, but it has its place in the order: counted, not carried
    ranked = tokens.join(often, "token").coalesce(tasks).groupBy("key", "root", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
    alone = F.col("n") - F.size("t")
    first = F.greatest(F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1 - alone, F.lit(0)).cast("int")
    held = ranked.select("key", "root", "n", alone.alias("alone"), F.posexplode(F.slice("t", F.lit(1), first)).alias("at", "t"))
    pos = F.col("alone") + F.col("at")
    both = 2 * similarity / (1 + similarity)
    return held.select("key", "root", "n", pos.alias("pos"), F.col("t.token").alias("token"),
                       (pos <= F.col("n") - F.ceil(F.col("n") * both - 1e-9)).alias("indexed"))


def crossing(texts: DataFrame, similarity: float, n_nodes: int) -> DataFrame:
    """Distinct (a, b), a < b, of ``texts(key, root, text)`` with different roots: every pair that can reach ``similarity``.

    In a global order of the shingles, rarest first, let two sets of n <= m
    shingles have their first common one at places p and q.  All they share
    stands from there on, so similarity t needs min(n - p, m - q) >= t / (1 + t) *
    (n + m): the shorter set's place lies in a prefix shorter than the longer's.
    The bound is met before any pair is made: for each shingle the lengths with
    their least places are joined first, and only nodes whose own place fits a
    pair of lengths are put together, in a group of that shingle and those two
    lengths.  Pairs within a shingle's commonest root are not listed.
    """
    tasks = 1 + n_nodes // TASK_NODES
    held = cut_lineage(_prefixes(texts.coalesce(tasks), similarity, tasks).coalesce(tasks))
    major = held.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m")).groupBy("token").agg(
        F.max_by("root", F.struct("m", "root")).alias("major"), F.count(F.lit(1)).alias("k")).where("k > 1").select("token", "major")
    major = cut_lineage(major.coalesce(tasks))
    held = cut_lineage(held.join(major, "token").withColumn("minor", F.col("root") != F.col("major")).drop("major").coalesce(tasks))
    share = similarity / (1 + similarity)
    need = F.ceil((F.col("n") + F.col("m")) * share - 1e-9)
    lengths = held.groupBy("token", "n").agg(F.min(F.when(F.col("indexed"), F.col("pos"))).alias("p"), F.min("pos").alias("q"))
    shorter = lengths.where("p is not null").select("token", "n", "p")
    longer = lengths.select("token", F.col("n").alias("m"), "q")
    fit = shorter.join(longer, "token").where((F.col("n") <= F.col("m")) & (F.col("n") >= F.col("m") * similarity - 1e-9)
                                              & (F.col("n") - F.col("p") >= need) & (F.col("m") - F.col("q") >= need))
    fit = cut_lineage(fit.select("token", "n", "m", need.alias("need")).coalesce(tasks))
    x = held.where("indexed").join(fit, ["token", "n"]).where("n - pos >= need").select(
        "token", "n", "m", F.col("key").alias("x"), F.col("root").alias("x_root"), F.col("minor").alias("x_minor"))
    y = held.withColumnRenamed("n", "m").join(fit, ["token", "m"]).where("m - pos >= need").select(
        "token", "n", "m", F.col("key").alias("y"), F.col("root").alias("y_root"), F.col("minor").alias("y_minor"))
    group = ["token", "n", "m"]
    pairs = x.where("x_minor").join(y, group).unionByName(x.where("not x_minor").join(y.where("y_minor"), group))
    return pairs.where("x_root <> y_root").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _first(id_col: str, key: str):
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(key).alias("key"))


def _texts(docs: DataFrame, nodes: DataFrame, needed: DataFrame, text_col: str) -> DataFrame:
    """(key, text) of the nodes in ``needed(need)``."""
    needed = needed.join(nodes.select("key", "id"), F.col("need") == F.col("key")).select("need", "id")
    keyed = _keyed(docs, text_col)
    texts = keyed.join(needed, (F.col("key") == F.col("need")) & F.col("own_id").eqNullSafe(F.col("id")))
    return cut_lineage(texts.groupBy("key").agg(F.min("text").alias("text")))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) of ``pairs(a, b)`` that reach the similarity."""
    with_b = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")

    def compare(batches):
        for batch in batches:
            size = pc.add(pc.binary_length(batch.column(2)), pc.binary_length(batch.column(3))).to_pylist()
            for i, j in T.groups_of_bytes(size):
                part = batch.slice(i, j - i)
                sims = jaccard(part.column(2).to_pylist(), part.column(3).to_pylist())
                ok = pa.array(sims >= similarity)
                yield pa.RecordBatch.from_arrays([pc.filter(part.column(k), ok) for k in (0, 1)], ["u", "v"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(releasing(compare), "u binary, v binary")


def links(docs: DataFrame, nodes: DataFrame, text_col: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Verified pairs (u, v) of nodes, and (node, root) of their components."""
    pairs, n_pairs = cut_lineage_counted(candidates(nodes))
    pairs = pairs.coalesce(1 + n_pairs // TASK_PAIRS)
    needed = pairs.select(F.col("a").alias("need")).unionByName(pairs.select(F.col("b").alias("need"))).distinct()
    texts = _texts(docs, nodes, needed, text_col)
    found, n_found = cut_lineage_counted(_verified(pairs.select("a", "b"), texts, similarity))
    found = found.coalesce(1 + n_found // TASK_PAIRS)
    roots = components(found)
    rest, n = cut_lineage_counted(unsettled(pairs, roots))
    if n:
        rest = rest.coalesce(1 + n // TASK_PAIRS)
        more = crossing(texts.join(rest, "key"), similarity, n).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
        more = cut_lineage(_verified(more, texts, similarity))
        found = found.unionByName(more)
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))
    return found, roots


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = text_of(docs, text_col)
    got = text_udf(lambda texts: {"key": _digests(texts)}, "key binary")(text)
    return docs.select("own_id", F.coalesce(text, F.lit("")).alias("text"), got["key"].alias("key"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Two tables: (own_id, key), a row for each document, and (key, first, n_links) of every node.

    ``first`` is the struct (none, id, key) of the class's first document, by id
    and then by words; ``n_links`` counts the node's verified pairs.
    """
    rows = packed(docs)
    rows = rows.withColumn("own_id", rows["row"].getField(id_col))
    described = rows.select("own_id", text_udf(_describe, "key binary, n long, bands array<long>")(text_of(rows, text_col)).alias("d"))
    described = cut_lineage(described.select("own_id", "d.*"))
    nodes = described.groupBy("key").agg(F.min(_first("own_id", "key")).alias("f"), F.max("n").alias("n"), F.first("bands").alias("bands"))
    nodes = nodes.select("key", F.col("f.id").alias("id"), "n", "bands")
    found, roots = links(rows, nodes, text_col, similarity)
    degree = found.select(F.col("u").alias("x")).unionByName(found.select(F.col("v").alias("x"))).groupBy("x").agg(F.count(F.lit(1)).alias("n_links"))
    firsts = nodes.select("key", "id").join(roots, F.col("key") == F.col("node"), "left").select(
        "key", "id", F.coalesce("root", "key").alias("root"))
    best = firsts.groupBy("root").agg(F.min(_first("id", "key")).alias("first"))
    out = firsts.join(best, "root").join(degree, F.col("key") == F.col("x"), "left").select(
        "key", "first", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return described.select("own_id", "key"), cut_lineage(out)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, its first document, with the columns of ``docs`` as they are."""
    _, nodes = classes(docs, id_col, text_col, similarity)
    winners = nodes.where(F.col("key") == F.col("first.key")).select(F.col("key").alias("win"))
    rows = packed(docs)
    text = text_of(rows, text_col)
    own_id = rows["row"].getField(id_col)
    keyed = rows.select("row", F.struct(own_id.isNull().alias("none"), own_id.alias("id"), text.alias("text")).alias("order"),
                        text_udf(lambda texts: {"key": _digests(texts)}, "key binary")(text)["key"].alias("key"))
    # the winner among rows with the same words is chosen in each task first, then once for each key
    one = keyed.groupBy("key").agg(F.min_by("row", "order").alias("row"))
    return one.join(winners, F.col("key") == F.col("win"), "left_semi").select("row.*")
