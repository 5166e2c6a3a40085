"""License scan: canonical digests of entire texts looked up among those of known licences.

A text is put in canonical form: A-Z lower-cased, lines that start with a
copyright mark left out, equivalent spellings made one, everything but letters
and digits turned into single spaces.  The SHA-256 of the whole document, and of
each of its lines as a text of its own (licence notices), is joined with the
digests of the known licences: the default ones, or a table of any size, which
the planner broadcasts or joins by shuffles as its size asks for.

Defined results: null, empty and blank texts match nothing; repeated rows come
back as often as they are there; an empty table of licences gives rows without
a match; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharelens.session import scratch_path

from .licenses import EQUIVALENT, KNOWN

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT = r"^[ \t]*(copyright|\(c\)|©)"
BETWEEN = r"[^\p{L}\p{N}]+"


def canonical(text: str) -> str:
    """The canonical form, as ``canonical_column`` gives it."""
    low = text.translate(str.maketrans(UPPER, LOWER))
    body = " ".join(x for x in low.split("\n") if not regex.match(COPYRIGHT, x))
    plain = regex.sub(BETWEEN, " ", body.replace("&", " and ")).strip(" ")
    for old, new in EQUIVALENT:
        plain = plain.replace(old, new)
    return plain


def canonical_column(lines: Column) -> Column:
    """Canonical form of the text with these lines (already lower-cased)."""
    body = F.array_join(F.filter(lines, lambda x: ~x.rlike(COPYRIGHT)), " ")
    plain = F.trim(F.regexp_replace(F.replace(body, F.lit("&"), F.lit(" and ")), BETWEEN, " "))
    for old, new in EQUIVALENT:
        plain = F.replace(plain, F.lit(old), F.lit(new))
    return plain


def known_digests(known=KNOWN) -> list[tuple[str, str]]:
    """(digest, licence) of each known text; the first licence by name where texts agree."""
    out: dict[str, str] = {}
    for name, text in sorted(known):
        if form := canonical(text):
            out.setdefault(hashlib.sha256(form.encode()).hexdigest(), name)
    return sorted(out.items())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known=KNOWN) -> DataFrame:
    """(id, whole_license, licenses, n_notices), a row for each row of ``docs``.

    ``known``: pairs (licence, text), or a table of any size with columns license and text.

    ``whole_license``: the licence that the entire text is, else null;
    ``licenses``: the sorted licences of its lines and of the whole;
    ``n_notices``: how many of its lines are known texts.
    """
    spark = docs.sparkSession
    if isinstance(known, DataFrame):
        # written, so that the planner broadcasts it by its size or joins it by shuffles
        path = scratch_path(spark, "license-digests")
        lines = F.split(F.translate("text", UPPER, LOWER), "\n")
        forms = known.where("license is not null and text is not null").select("license", canonical_column(lines).alias("form"))
        forms.where("form <> ''").groupBy(F.sha2(F.col("form").cast("binary"), 256).alias("digest")).agg(
            F.min("license").alias("license")).write.parquet(path)
        table = spark.read.parquet(path)
    else:
        table = F.broadcast(spark.createDataFrame(known_digests(known), "digest string, license string"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("key"),
                       F.split(F.translate(text, UPPER, LOWER), "\n").alias("lines"))
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.col("lines").alias("lines")))
    each = F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), F.array(x).alias("lines")))
    units = base.select("id", "key", F.explode(F.concat(whole, each)).alias("u")).select(
        "id", "key", "u.whole", F.sha2(canonical_column(F.col("u.lines")).cast("binary"), 256).alias("digest"))
    found = units.join(table, "digest", "left").groupBy("id", "key").agg(
        F.count(F.when(F.col("whole"), 1)).alias("copies"),
        F.max(F.when(F.col("whole"), F.col("license"))).alias("whole_license"),
        F.array_sort(F.collect_set("license")).alias("licenses"),
        F.count(F.when(~F.col("whole") & F.col("license").isNotNull(), 1)).alias("n"))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "id", "whole_license", "licenses", (F.col("n") / F.col("copies")).cast("long").alias("n_notices"))
