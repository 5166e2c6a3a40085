"""First HTML table of each page as rows (S3), over a column of raw pages.

Native functions only: the first ``<table>`` block, its ``<tr>`` rows, their
``<th>/<td>`` cells; tags stripped, entities decoded.  Tags are counted for their
depth, so a table inside a cell does not end the outer one: its text belongs
to the cell, its rows are none of the outer table's.  A cell with ``colspan`` or
``rowspan`` fills every place it covers: rows are folded from the top with the
cells that reach down from above, which stand where they began, or after the
row's last cell; what still reaches down after the last row makes more rows.
Closing tags of rows and cells may be missing.  The first row supplies
the column names, snake-cased (S5); it stays on the page's own row, so a page
is read and parsed once, nothing is shuffled, and pages that share a key keep
their own headers.  Output is long -- ``(page key, row_idx, col_idx,
column_name, value)`` -- because pages may carry different headers; pivot per
page family when the header is known.  Pages without a table give no rows, or an error with ``require_table=True`` (the
scraper's "no tables found").
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_CODE_POINT = 0x10FFFF


#: an array's length, and more
ALL = 1 << 30
_CODES = {**name2codepoint, "apos": 39}


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _character(code: Column) -> Column:
    """The character with this code point."""
    return F.when(code < 128, F.char(code)).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _named(name: Column) -> Column:
    """The code point of a named entity: by its first letter, then by its name."""
    letters = sorted({n[0] for n in _CODES})
    table = F.create_map(*[x for a in letters for x in (F.lit(a), F.create_map(*[F.lit(x) for kv in sorted(_CODES.items()) if kv[0][0] == a for x in kv]))])
    return F.try_element_at(F.try_element_at(table, F.substring(name, 1, 1)), name)


def _entity(part: Column) -> Column:
    """Text after an ``&`` with its entity decoded; without one, the ``&`` is put back."""
    token = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
    code = lambda t: (F.when(t == "", F.lit(None).cast("int"))
                      .when(F.lower(F.substring(t, 1, 2)) == "#x", F.conv(F.substring(t, 3, 6), 16, 10).cast("int"))
                      .when(F.substring(t, 1, 1) == "#", F.substring(t, 2, 7).cast("int"))
                      .otherwise(_named(t)))
    legal = lambda c: c.between(1, LAST_CODE_POINT) & ~c.between(0xD800, 0xDFFF)
    return _once(token, lambda t: _once(code(t), lambda c: F.when(
        legal(c), F.concat(_character(c), part.substr(F.length(t) + 2, F.length(part)))).otherwise(F.concat(F.lit("&"), part))))


def cell_text(c: Column) -> Column:
    """Tags stripped, entities decoded once, white space (no-break space too) collapsed and trimmed."""
    decoded = lambda x: F.when(~F.contains(x, F.lit("&")), x).otherwise(_once(F.split(x, "&"), lambda parts: F.concat(
        F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, ALL), _entity), ""))))
    x = _once(F.regexp_replace(c, r"(?s)<[^>]*>", ""), decoded)
    return F.trim(F.regexp_replace(x, "[\\s\u00a0]{2,}|[\\t\\n\\x0B\\f\\r\u00a0]", " "))


# --- fixed values: the largest spans that HTML allows ------------------------
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534
# ---------------------------------------------------------------------------
_SPANNED = "array<struct<col: int, text: string, left: int>>"


def first_table(html: Column) -> Column:
    """What stands inside the first ``<table>``, without the tags of tables within it; NULL without a table.  A table that is
    not closed goes to the end of the page."""
    tag = r"(?i)(?=<table\b|</table\b)"
    opens, closes = (lambda x: x.rlike(r"(?i)\A<table\b")), (lambda x: x.rlike(r"(?i)\A</table\b"))
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("over"), F.array().cast("array<string>").alias("kept"))

    def take(acc: Column, piece: Column) -> Column:
        depth = F.greatest(acc["depth"] + F.when(opens(piece), 1).when(closes(piece), -1).otherwise(0), F.lit(0))
        over = acc["over"] | ((acc["depth"] > 0) & (depth == 0))
        body = F.regexp_replace(piece, r"(?i)\A</?table\b[^>]*>?", "")
        text = F.when(depth > 1, F.regexp_replace(body, r"(?s)<[^>]*>", "")).otherwise(body)
        kept = F.when(over | (depth == 0), acc["kept"]).otherwise(F.concat(acc["kept"], F.array(text)))
        return F.struct(F.when(over, 0).otherwise(depth).alias("depth"), over.alias("over"), kept.alias("kept"))

    kept = F.aggregate(F.split(html, tag), start, take, lambda acc: acc["kept"])
    return F.when(html.rlike(r"(?i)<table\b"), F.array_join(kept, ""))


def _span(opening: Column, name: str, most: int) -> Column:
    number = F.regexp_extract(opening, rf"(?i)\s{name}\s*=\s*[\"']?\s*([0-9]{{1,9}})", 1)
    return F.when(opening.rlike(rf"(?i){name}"), F.least(F.coalesce(number.try_cast("int"), F.lit(1)), F.lit(most))).otherwise(1)


def _cells(row: Column) -> Column:
    """The row's cells: text, colspan, rowspan."""
    closing = r"(?i)</t[hd]\b|</tr\b|</?t(?:body|head|foot)\b"

    def cell(x: Column, opening: Column) -> Column:
        inner = F.split(x.substr(F.length(opening) + 1, F.length(x)), closing, 2)[0]
        return F.struct(cell_text(F.when(opening == "", "").otherwise(inner)).alias("text"),
                        _span(opening, "colspan", MAX_COLSPAN).alias("across"), _span(opening, "rowspan", MAX_ROWSPAN).alias("down"))

    return F.transform(F.slice(F.split(row, r"(?i)(?=<t[hd]\b)"), 2, ALL),
                       lambda x: _once(F.regexp_extract(x, r"\A<[^>]*>", 0), lambda opening: cell(x, opening)))


def _place_row(above: Column, cells: Column) -> Column:
    """``texts`` of a row and what reaches ``down`` from it, given what reaches down from above.

    One step places one text: another copy of the cell at hand, else a cell
    from above whose place has come (or any of them, once the row's own are used
    up), else the row's next cell."""
    steps = F.aggregate(cells, F.size(above), lambda n, c: n + c["across"])
    start = F.struct(F.array().cast("array<string>").alias("texts"), F.array().cast(_SPANNED).alias("down"),
                     F.lit(0).alias("own"), F.lit(0).alias("upper"), F.lit(0).alias("copies"))
    wide = F.filter(cells, lambda c: c["across"] > 0)

    def step(acc: Column, _: Column) -> Column:
        at, own, upper, copies = F.size(acc["texts"]), acc["own"], acc["upper"], acc["copies"]
        from_above = (copies == 0) & (upper < F.size(above)) & (
            (F.get(above, upper)["col"] <= at) | (own >= F.size(wide)))
        cell = F.get(wide, F.when(copies > 0, own - 1).otherwise(own))
        reach = F.when(from_above, F.struct(F.get(above, upper)["col"].alias("col"), F.get(above, upper)["text"].alias("text"),
                                            (F.get(above, upper)["left"] - 1).alias("left")))
        reach = reach.otherwise(F.struct(at.alias("col"), cell["text"].alias("text"), (cell["down"] - 1).alias("left")))
        return F.struct(
            F.concat(acc["texts"], F.array(reach["text"])).alias("texts"),
            F.when(reach["left"] > 0, F.concat(acc["down"], F.array(reach))).otherwise(acc["down"]).alias("down"),
            F.when(from_above | (copies > 0), own).otherwise(own + 1).alias("own"),
            F.when(from_above, upper + 1).otherwise(upper).alias("upper"),
            F.when(from_above, 0).when(copies > 0, copies - 1).otherwise(cell["across"] - 1).alias("copies"))

    numbers = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(numbers, start, step)


def span_grid(rows: Column) -> Column:
    """Rows of cells (text, across, down) as rows of texts, each span filled in."""
    start = F.struct(F.array().cast("array<array<string>>").alias("grid"), F.array().cast(_SPANNED).alias("down"))

    def take(acc: Column, cells: Column) -> Column:
        placed = F.array(_place_row(acc["down"], cells))     # an element, so that it is evaluated once
        return F.transform(placed, lambda r: F.struct(F.concat(acc["grid"], F.array(r["texts"])).alias("grid"), r["down"].alias("down")))[0]

    def rest(acc: Column) -> Column:
        most = F.coalesce(F.array_max(F.transform(acc["down"], lambda d: d["left"])), F.lit(0))
        numbers = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
        return F.concat(acc["grid"], F.transform(numbers, lambda k: F.transform(
            F.filter(acc["down"], lambda d: d["left"] >= k), lambda d: d["text"])))

    plain = ~F.exists(rows, lambda r: F.exists(r, lambda c: (c["across"] != 1) | (c["down"] != 1)))
    return F.when(plain, F.transform(rows, lambda r: F.transform(r, lambda c: c["text"]))).otherwise(F.aggregate(rows, start, take, rest))


def html_table_rows(pages: DataFrame, html_col: str, keys: Sequence[str],
                    require_table: bool = False) -> DataFrame:
    """``(keys..., row_idx, col_idx, column_name, value)`` of the first table of each page."""
    table = first_table(F.col(html_col))
    if require_table:
        table = F.when(table.isNull(), F.raise_error(F.lit("No tables found on the page"))).otherwise(table)
    pieces = F.split(F.concat(F.lit(" "), table), r"(?i)(?=<tr\b)")     # the first piece is what precedes the rows
    rows = F.transform(F.slice(pieces, 2, ALL), _cells)
    x = pages.select(*keys, rows.alias("_cells")).select(*keys, span_grid(F.col("_cells")).alias("_rows"))
    header = F.transform(F.get("_rows", F.lit(0)), lambda h: F.translate(F.lower(h), " ", "_"))      # once for each page
    body = x.select(*keys, header.alias("_h"), "_rows").select(*keys, "_h", F.posexplode_outer("_rows").alias("row_idx", "_c")).where("row_idx > 0")
    out = body.select(*keys, "row_idx", F.posexplode(F.arrays_zip(F.col("_h").alias("h"), F.col("_c").alias("c"))).alias("col_idx", "_z"))
    return out.select(*keys, "row_idx", "col_idx", F.col("_z.h").alias("column_name"), F.col("_z.c").alias("value"))
