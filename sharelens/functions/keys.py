"""Name keys as Column expressions.

All three stay JVM-side (``regexp_replace``/``substring_index``/``btrim``), so
they run inside whole-stage codegen and can be used in any ``select``/``join``
condition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference for equal keys) -----------------
# Separator between artist and title in a chart row.
TITLE_SEPARATOR = " - "
# Company suffixes dropped once from the end of a label key, longer words first:
# entertainment, recordings, recording, records, limited, company, music, group,
# gmbh, inc, llc, ltd, plc, co, sa, bv, ab
LABEL_SUFFIXES = (
    "entertainment", "recordings", "recording", "records", "limited", "company",
    "music", "group", "gmbh", "inc", "llc", "ltd", "plc", "co", "sa", "bv", "ab",
)
# Replacements that make a text key out of lower-cased text, in order.
TEXT_STEPS = (("[^a-z0-9 ]", ""), (" +", " "))
# ---------------------------------------------------------------------------

LABEL_STEPS = (*TEXT_STEPS, (r"\s*(" + "|".join(LABEL_SUFFIXES) + r")\s*$", ""))

# Steps that few names need: a plain test spares the others the regular expression, whose result is the name itself
_NEEDED = {
    " +": lambda x: F.contains(x, F.lit("  ")),
    LABEL_STEPS[-1][0]: lambda x: F.substring(F.rtrim(x), -2, 2).isin(sorted({s[-2:] for s in LABEL_SUFFIXES})),
}

# Unicode space separators (category Zs), trimmed from chart titles
_ZS = "\u0020\u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u202f\u205f\u3000"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_trim(c: str | Column) -> Column:
    """Trim every Unicode space separator (NBSP included) on both ends."""
    return F.btrim(_col(c), F.lit(_ZS))


def split_title(c: str | Column, sep: str = TITLE_SEPARATOR) -> tuple[Column, Column]:
    """Split "Artist - Title" at the first separator.

    artist = trimmed text before the first separator (the whole text when
    there is none); title = trimmed rest ('' when there is no separator).
    """
    text = _col(c)
    head = F.substring_index(text, sep, 1)      # = split_part(text, sep, 1), one indexOf
    rest = F.substr(text, F.length(head) + F.lit(len(sep) + 1))
    return unicode_trim(head), unicode_trim(rest)


def _key(c: str | Column, steps: tuple[tuple[str, str], ...]) -> Column:
    x = F.lower(F.trim(_col(c)))
    for pattern, replacement in steps:
        changed = F.regexp_replace(x, pattern, replacement)
        x = F.when(_NEEDED[pattern](x), changed).otherwise(x) if pattern in _NEEDED else changed
    # only U+0020 can be left as whitespace here, so a plain trim is exact
    return F.trim(x)


def normalize_text(c: str | Column) -> Column:
    """lower(trim) -> keep [a-z0-9 ] -> collapse spaces -> trim."""
    return _key(c, TEXT_STEPS)


def normalize_label(c: str | Column) -> Column:
    """As ``normalize_text`` plus one trailing company suffix dropped.

    The suffix match has no word boundary ('disco' -> 'dis'), exactly one
    suffix goes, and a name that is only a suffix becomes ''.
    """
    return _key(c, LABEL_STEPS)
