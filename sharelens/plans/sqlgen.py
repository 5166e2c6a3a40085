"""SQL text for the DuckDB twins, generated from the same fixed tables the
Spark side uses (as the reference generates its CASE from a pattern list)."""

from __future__ import annotations

from ..functions.keys import LABEL_STEPS, TEXT_STEPS
from ..functions.rules import RuleTable


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_sql(expr: str, rules: RuleTable, default: str | None, empty: str | None = None) -> str:
    """CASE WHEN lower(expr) LIKE '%p%' ... in rule order."""
    low = f"lower({expr})"
    parts = ["CASE"]
    if empty is not None:
        parts.append(f" WHEN {expr} IS NULL OR {expr} = '' THEN {lit(empty)}")
    for group, patterns in rules:
        for p in patterns:
            parts.append(f" WHEN {low} LIKE {lit('%' + p.lower() + '%')} THEN {lit(group)}")
    parts.append(f" ELSE {lit(default) if default is not None else 'NULL'} END")
    return "".join(parts)


def _key_sql(expr: str, steps) -> str:
    out = f"lower(trim({expr}))"
    for pattern, replacement in steps:
        out = f"regexp_replace({out}, {lit(pattern)}, {lit(replacement)}, 'g')"
    return f"trim({out})"


def normalize_text_sql(expr: str) -> str:
    return _key_sql(expr, TEXT_STEPS)


def normalize_label_sql(expr: str) -> str:
    return _key_sql(expr, LABEL_STEPS)


def share_sql(total: str, by: str) -> str:
    """Share of the total of its ``by`` group, NULL where that total is 0."""
    return f"{total}::DOUBLE / NULLIF(SUM({total}) OVER (PARTITION BY {by}), 0)"


def split_title_sql(expr: str, sep: str = " - ") -> tuple[str, str]:
    head = f"split_part({expr}, {lit(sep)}, 1)"
    return (f"trim({head})", f"trim(substring({expr}, length({head}) + {len(sep) + 1}))")
