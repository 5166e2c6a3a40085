"""Byte-level BPE by a rank file: the tiktoken library on safe pieces of a text, and raw-byte decoding.

A rank file names a byte string and its rank on each line; the pattern cuts a
text into matches, and each match is merged by the ranks on its own.  The
library's pattern engine overflows its stack on runs of about a million white
spaces, so long texts are cut first, only at places where every match ends
whatever stands around them, so that the pieces' ids are those of the whole text:

* after an ASCII letter or digit before an ASCII character of another kind, and
  between visible ASCII and white space: no match goes on across these, and the
  pattern never looks back;
* a run of white space of ``SPACES`` or more is one match, but for its last
  character where something follows; that match goes to the merger as it is.

A piece has about ``PIECE`` characters; where a text has no safe place for
longer (one long word), the piece is as long as it takes.

Decoding joins the tokens' raw bytes: ids whose bytes are no valid UTF-8 come
back as those bytes.

Defined results: a null text counts as empty and has no ids; a null list of ids
decodes to null, a null id in it and an unknown id are errors; repeated rows
give the same ids; an empty table gives an empty one; the other columns stay as
they are, inside struct ``row``.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import packed, release_memory, text_of, text_udf

PIECE = 1 << 16
SPACES = 1 << 12
#: Unicode white space, as the pattern's engine has it
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LONG_SPACE = re.compile(f"[{_WHITE}]{{{SPACES},}}")
_SAFE = re.compile(r"[A-Za-z](?=[\t-\r -@\[-`{-~])|[0-9](?=[\t-\r -/:-~])|[!-~](?=[\t-\r ])")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class RankCodec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self._ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, filter(bytes.strip, f))}
        self._encoding = self._library(pattern)
        self._whole = None

    def _library(self, pattern: str):
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self._ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE:
            return self._encoding.encode_ordinary(text)
        ids, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            self._pieces(text, at, run.start(), ids)
            if self._whole is None:
                self._whole = self._library(r"[\s\S]+")
            ids += self._whole.encode_ordinary(text[run.start():end])
            at = end
        self._pieces(text, at, len(text), ids)
        return ids

    def _pieces(self, text: str, a: int, b: int, ids: list[int]) -> None:
        """Add the ids of text[a:b], whose ends are safe places."""
        while a < b:
            cut = _SAFE.search(text, a + PIECE, b) if b - a > PIECE else None
            end = cut.end() if cut else b
            ids += self._encoding.encode_ordinary(text[a:end])
            a = end

    def decode(self, ids: list[int]) -> bytes:
        return self._encoding.decode_bytes(ids)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> RankCodec:
    """One codec for all tasks of a worker."""
    return RankCodec(path, pattern)


def encode(docs: DataFrame, text_col: str = "text", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Struct ``row`` (the input's columns) beside ``ids``, an array of ints."""
    path, rule = ranks or default_ranks(), pattern or default_pattern()

    def fn(texts, own):
        return {"ids": [own.encode(t) if t else [] for t in texts]}

    df = packed(docs)
    return df.select("row", text_udf(fn, "ids array<int>", lambda: codec(path, rule))(text_of(df, text_col))["ids"].alias("ids"))


def decode(coded: DataFrame, ids_col: str = "ids", out: str = "bytes", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``coded`` with binary column ``out``: the bytes that the ids stand for."""
    path, rule = ranks or default_ranks(), pattern or default_pattern()

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, rule)
        try:
            for batch in batches:
                yield pa.array([None if x is None else own.decode(x.tolist()) for x in _lists(batch)], pa.binary())
        finally:
            release_memory()

    return coded.withColumn(out, run(F.col(ids_col)))


def _lists(batch):
    """Each row's ids as a numpy array, one row at a time."""
    for x in batch:
        if not x.is_valid:
            yield None
        elif x.values.null_count:
            raise ValueError("a null among the ids")
        else:
            yield x.values.to_numpy(zero_copy_only=False)
