"""Language identification by compression: the language whose dictionary makes a text smallest.

For each language a raw-content zstandard dictionary of at most ``DICT_BYTES``
is filled with whole training texts: up to ``SAMPLE_DOCS`` different ones, those
of at most ``SAMPLE_CHARS`` characters first, in the order of a hash.  Every text is
lower-cased and compressed whole, in pieces of ``PIECE`` bytes, with each
dictionary; the smallest total wins (on a tie the first language in natural order).  The score
is the relative margin to the second; where it is under ``MIN_MARGIN`` the
answer is marked ``rejected``.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text when nothing could be learned; with one learned language the
score is 1; repeated rows get equal answers; rows with a null language or null
text teach nothing; other columns are kept inside struct ``row``.
"""

from __future__ import annotations

import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sharelens.session import cut_lineage

from .frames import packed, text_of, text_udf

DICT_BYTES = 1 << 17
SAMPLE_DOCS = 300
LEVEL = 9
SAMPLE_CHARS = 4096
#: dictionaries are learned for at most so many languages, those with the most sampled texts
MAX_LANGS = 1000
PIECE = 2048
MIN_MARGIN = 0.01
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary of each language; a bounded number of rows for each reaches the driver."""
    rows = train.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")).where(
        "lang is not null and text is not null and length(text) > 0")
    # texts are ranked, not rows: copies take one place
    texts = rows.select("lang", (F.length("text") > SAMPLE_CHARS).alias("long_one"), F.xxhash64("text").alias("h")).distinct()
    order = ["long_one", "h"]
    some = Window.partitionBy("lang", "part").orderBy(*order)      # by parts first: no task ranks a whole language
    texts = texts.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(64))).withColumn("rank", F.row_number().over(some))
    rank = Window.partitionBy("lang").orderBy(*order)
    chosen = texts.where(F.col("rank") <= SAMPLE_DOCS).withColumn("rank", F.row_number().over(rank))
    chosen = chosen.where(F.col("rank") <= SAMPLE_DOCS).select("lang", "h")
    chosen = cut_lineage(chosen)
    known = chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LANGS).select("lang")
    chosen = chosen.join(F.broadcast(known), "lang", "left_semi")
    picked = (rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"])
              .groupBy("lang", "h").agg(F.max(F.left("text", F.lit(DICT_BYTES))).alias("text")))
    parts: dict[str, list[bytes]] = {}
    for r in picked.orderBy("lang", "h").collect():
        parts.setdefault(r["lang"], []).append(r["text"].lower().encode("utf-8", "replace"))
    return {lang: b"\n".join(x)[-DICT_BYTES:] for lang, x in sorted(parts.items())}


class Sizes:
    """One compressor for each language."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self._compressors = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=PIECE, dict_size=len(dictionaries[lang]), write_content_size=False, write_dict_id=False,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            d.precompute_compress(compression_params=params)
            self._compressors.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))

    def of(self, text: str) -> list[int]:
        data = text.lower().encode("utf-8", "replace")
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self._compressors]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0
        if len(self.langs) == 1:
            return self.langs[0], 1.0
        sizes = self.of(text)
        first, second = sorted(sizes)[:2]
        return self.langs[sizes.index(first)], 1.0 - first / second


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text",
            min_margin: float = MIN_MARGIN) -> DataFrame:
    """Struct ``row`` beside struct ``lid``: lang, score, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def fn(texts, model):
        got = [model.predict(t) for t in texts]
        return {"lang": [g[0] for g in got], "score": [g[1] for g in got], "rejected": [g[1] < min_margin for g in got]}

    df = packed(docs)
    return df.select("row", text_udf(fn, "lang string, score double, rejected boolean", lambda: Sizes(shared.value))(
        text_of(df, text_col)).alias("lid"))
