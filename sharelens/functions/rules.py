"""Ordered substring rule tables compiled to one native CASE expression.

A rule table is a sequence of ``(group, patterns)``; the first group with a
pattern contained in the (lower-cased) text wins.  Each group becomes one
test: an ``OR`` of ``contains`` up to ``FEW`` patterns, one ``rlike`` of their
prefix tree beyond, which reads the text once however many patterns there are.
So the whole classifier is a single expression -- no Python UDF, no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

RuleTable = Sequence[tuple[str, Sequence[str]]]

UMG = "Universal Music Group"
SONY = "Sony Music Entertainment"
WARNER = "Warner Music Group"
INDEPENDENT_OTHER = "Independent / Other"
INDEPENDENT_UNKNOWN = "Independent / Unknown"
INDEPENDENT_UNMAPPED = "Independent / Unmapped"

# --- fixed values: owner-name rules of the graph job (rules A), in order -----
OWNER_RULES: RuleTable = (
    (UMG, ("universal music", "umg", "vivendi", "polygram", "mca records", "mca inc",
           "interscope", "def jam", "geffen", "island records", "republic records", "verve")),
    (SONY, ("sony music", "sony corporation", "ソニー", "sony group", "cbs records",
            "cbs corporation", "bmg", "columbia records", "epic records", "rca records",
            "arista", "legacy recordings")),
    (WARNER, ("warner music", "warner records", "warner bros", "at&t", "time warner",
              "atlantic records", "elektra", "rhino", "parlophone", "reprise", "sire records",
              "access industries", "wea", "warner communications")),
)

# --- fixed values: owner-name rules of the SQL walk (rules B, ILIKE), in order
PATH_OWNER_RULES: RuleTable = (
    (UMG, ("universal music",)),
    (SONY, ("sony music",)),
    (WARNER, ("warner music",)),
)

# --- fixed values: direct label-string rules of the share fact (rules C) -----
LABEL_STRING_RULES: RuleTable = (
    (UMG, ("universal", "interscope", "def jam", "republic", "capitol", "geffen",
           "island", "polydor", "verve", "emi", "motown", "virgin", "harvest",
           "umg", "umc", "ume", "mca", "decca", "mercury", "am records", "a&m")),
    (SONY, ("sony", "columbia", "epic", "rca", "arista", "legacy", "century media",
            "provident", "jive", "zomba", "bmg", "the orchard", "kemosabe")),
    (WARNER, ("warner", "atlantic", "elektra", "parlophone", "reprise", "rhino",
              "sire", "wea", "nonesuch", "roadrunner", "fueled by ramen", "300 entertainment",
              "big beat", "east west", "asylum", "loma vista")),
)

# --- fixed values: groups accepted by the share-fact quality test ------------
ACCEPTED_GROUPS = (UMG, SONY, WARNER, INDEPENDENT_OTHER, INDEPENDENT_UNMAPPED)
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# so many patterns of a group are tested one by one
FEW = 24
# what a regular expression would not take as itself
_SPECIAL = set("\\^$.|?*+()[]{}-&~# \t\n\r\f\v")


def prefix_tree(patterns: Sequence[str]) -> str:
    """A regular expression that finds any of ``patterns``, with common beginnings taken once.

    A pattern that begins with another one adds nothing to finding either."""
    tree: dict = {}
    for p in sorted(set(patterns), key=lambda p: (len(p), p)):
        node = tree
        for c in p:
            if None in node:
                break
            node = node.setdefault(c, {})
        else:
            node.clear()
            node[None] = {}

    def spell(node: dict) -> str:
        if None in node:
            return ""
        parts = [(f"\\{c}" if c in _SPECIAL else c) + spell(below) for c, below in node.items()]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    return spell(tree)


def _contains_any(text: Column, patterns: Sequence[str]) -> Column:
    if len(patterns) > FEW:
        return text.rlike(prefix_tree(patterns))
    test = text.contains(patterns[0])
    for p in patterns[1:]:
        test = test | text.contains(p)
    return test


def classify(
    c: str | Column,
    rules: RuleTable,
    default: str | None = None,
    empty: str | None = None,
    lower: bool = True,
) -> Column:
    """First matching group of ``rules`` for the text in ``c``.

    ``default`` is returned when no pattern matches (NULL text included, as a
    SQL CASE does); ``empty``, when given, is returned for NULL or '' text
    before any rule is tried.
    """
    text = F.lower(_col(c)) if lower else _col(c)
    expr = None
    if empty is not None:
        expr = F.when(text.isNull() | (text == F.lit("")), F.lit(empty))
    for group, patterns in rules:
        if not patterns:
            continue
        cond = _contains_any(text, [p.lower() if lower else p for p in patterns])
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def owner_group(c: str | Column, rules: RuleTable = OWNER_RULES) -> Column:
    """Rules A: ordered substring groups; NULL/'' -> Independent / Unknown."""
    return classify(c, rules, default=INDEPENDENT_OTHER, empty=INDEPENDENT_UNKNOWN)


def path_owner_group(c: str | Column, rules: RuleTable = PATH_OWNER_RULES) -> Column:
    """Rules B: case-insensitive contains, else Independent / Other."""
    return classify(c, rules, default=INDEPENDENT_OTHER)


def label_string_group(c: str | Column, rules: RuleTable = LABEL_STRING_RULES) -> Column:
    """Rules C: plain substring on the raw label string, else NULL (P10)."""
    return classify(c, rules, default=None)


def resolve_group(direct: str | Column, hierarchy: str | Column, unmapped: str = INDEPENDENT_UNMAPPED) -> Column:
    """Direct match, else the hierarchy group, else ``unmapped``."""
    return F.coalesce(_col(direct), _col(hierarchy), F.lit(unmapped))
