"""Conversation structure repair by iterative-deepening A*.

A conversation is sound when the initials of its roles read ``(s?(ua)+)?``.
Rows are kept (K, 0), given the role that comes next (R, 1) or deleted (D, 2;
required for blank and repeated rows); an empty row of the role that comes next
may be inserted anywhere (I, 5); a truncated row that stays adds 5.  The
cheapest edits are found depth first in ASCII order of their letters, under a
cost bound that grows to the least cost left over, with a table of what each
failed state costs at least; the first accepting path under the first bound that
has one is the cheapest and, of equal ones, the ASCII-least.

Conversations of at most ``LONG_ROWS`` rows and ``LONG_BYTES`` of text are dealt out
by their id, sorted, and repaired as they stream by.  A longer one, which may
hold a third of all rows, is never in one task: its rows are numbered in ranges,
cut into blocks of ``BLOCK`` rows, each block is solved for every pair of
states before and after it, and neighbouring blocks are merged ``FAN`` at a time
until one is left; its edits then go back to the blocks, which give the repaired
rows.  Two answers of a block of equal cost are never prefixes of each other
(they differ in a row's edit, or in inserts and so in cost), so the least of the
joined ones is made of the least of the parts.

Faults: a row is blank without a character other than ASCII white space, else
``duplicate`` if the role and text are those of an earlier row, else truncated if
its last such character is not one of ``.!?``; the first that fits counts.

Defined results: rows go by turn, null turns first, those of one turn by role,
then by the digest of the text; a null role or text is one space; a role whose
initial is not s, u or a (an empty one too) cannot be kept; null ids are one
conversation; a conversation without rows needs a row with ``copies`` 0 to be
named, and has zeros, no edits and no messages; an empty table gives an empty one;
only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from sharelens.operators.indexing import sequence_index
from sharelens.session import cut_lineage, cut_lineage_counted, scratch_path

from .frames import releasing
from .textarrays import groups_of_bytes

LONG_ROWS = 1000
LONG_BYTES = 4 << 20
BLOCK = 64
FAN = 32

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ACCEPTING = (START, ASSISTANT)
#: the state after the role that comes next
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"


# ---- search --------------------------------------------------------------------

def keep_state(initial: str, state: int) -> int | None:
    """The state after a row is kept, None if it cannot be."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def cheapest(rows: list[tuple[str, int]], start: int, goals: tuple[int, ...]) -> tuple[int, str]:
    """Cost and edits that lead over ``rows`` (initial, fault) from a state to one of ``goals``, which one must reach."""
    n = len(rows)
    due = [0] * (n + 1)      # what the rows from i on cost at least
    for i in range(n - 1, -1, -1):
        due[i] = due[i + 1] + (DELETE if rows[i][1] else 0)
    failed: dict[tuple[int, int], int] = {}     # what is left from a state costs at least

    def search(i: int, state: int, budget: int) -> tuple[str | None, int]:
        if i == n and state in goals:
            return "", 0
        known = failed.get((i, state))
        if known is not None and known > budget:
            return None, known
        options = [("I", INSERT, i, AFTER[state])]
        if i < n:
            initial, fault = rows[i]
            options.insert(0, ("D", DELETE, i + 1, state))
            if fault not in (BLANK, DUPLICATE):
                more = CUT_OFF if fault == TRUNCATED else 0
                kept = keep_state(initial, state)
                if kept is not None:
                    options.append(("K", KEEP + more, i + 1, kept))
                options.append(("R", REROLE + more, i + 1, AFTER[state]))
        least = math.inf
        for letter, cost, j, then in options:
            need = cost + max(due[j], failed.get((j, then), 0))
            if need <= budget:
                path, more = search(j, then, budget - cost)
                if path is not None:
                    return letter + path, 0
                need = cost + more
            least = min(least, need)
        failed[i, state] = least
        return None, least

    bound = due[0]
    while True:
        path, more = search(0, start, bound)
        if path is not None:
            return bound, path
        bound = more


def reachable(rows: list[tuple[str, int]], a: int, b: int) -> bool:
    """Whether some edits lead from state a to state b: no edit makes a system row."""
    if b == START:
        return a == START
    if b == SYSTEM:
        return a == SYSTEM or a == START and any(i == "s" and f not in (BLANK, DUPLICATE) for i, f in rows)
    return True


def solve_block(rows: list[tuple[str, int]]) -> dict[tuple[int, int], tuple[int, str]]:
    return {(a, b): cheapest(rows, a, (b,)) for a in STATES for b in STATES if reachable(rows, a, b)}


def join_blocks(tables: Iterator[dict]) -> dict[tuple[int, int], tuple[int, str]]:
    """The table of consecutive blocks from their tables."""
    whole: dict[tuple[int, int], tuple[int, str]] | None = None
    for table in tables:
        if whole is None:
            whole = table
            continue
        joined: dict[tuple[int, int], tuple[int, str]] = {}
        for (a, m), (c1, p1) in whole.items():
            for b in STATES:
                if (m, b) in table:
                    c2, p2 = table[m, b]
                    found = (c1 + c2, p1 + p2)
                    if (a, b) not in joined or found < joined[a, b]:
                        joined[a, b] = found
        whole = joined
    return whole or {(a, a): (0, "") for a in STATES}


def edits_of(rows: list[tuple[str, int]]) -> tuple[int, str]:
    if len(rows) <= BLOCK:
        return cheapest(rows, START, ACCEPTING)
    table = join_blocks(solve_block(rows[i:i + BLOCK]) for i in range(0, len(rows), BLOCK))
    return min(table[START, b] for b in ACCEPTING if (START, b) in table)


def apply_edits(rows, edits: str, state: int = START) -> list[tuple[str, str, str]]:
    """(edit, role, text) of what is left of ``rows`` (role, text) from a state on."""
    out, i = [], 0
    for e in edits:
        if e == "I":
            state = AFTER[state]
            out.append((e, ROLE[state], ""))
            continue
        role, text = rows[i]
        i += 1
        if e == "K":
            state = keep_state(role[:1], state)
            out.append((e, role, text))
        elif e == "R":
            state = AFTER[state]
            out.append((e, ROLE[state], text))
    return out


def fault_of(role: str, text: str, seen: set) -> int:
    bare = text.strip(SPACE)
    known = (role, text) in seen
    seen.add((role, text))
    return BLANK if not bare else DUPLICATE if known else 0 if bare[-1] in ".!?" else TRUNCATED


def repair_one(rows: list[tuple[int | None, str, str]]) -> dict:
    """Report and messages of one conversation, given as (turn, role, text) in order."""
    seen: set = set()
    faults = [fault_of(role, text, seen) for _, role, text in rows]
    initials = [role[:1] for _, role, _ in rows]
    turns = {t for t, _, _ in rows if t is not None}
    cost, edits = edits_of(list(zip(initials, faults, strict=True)))
    messages = apply_edits([x[1:] for x in rows], edits)
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": faults.count(BLANK),
            "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost, "audit": edits, "messages": messages}


# ---- conversations of ordinary length -------------------------------------------

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
MESSAGES = "messages array<struct<edit: string, role: string, text: string>>"
REPORT_NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]



def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` with a fault planted by the crc32 of ``conv_id:turn`` modulo 20 (a null is one space): 0 drops the row
    (``copies`` 0), 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row (``copies`` 2), 4 makes its role user."""
    one = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    case, text = F.crc32(place.cast("binary")) % 20, F.coalesce(F.col("text"), one)
    return df.select("conv_id", "turn", F.when(case == 4, "user").otherwise(F.coalesce(F.col("role"), one)).alias("role"),
                     F.when(case == 1, "").when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                     F.when(case == 0, 0).when(case == 3, 2).otherwise(1).alias("copies"))


class Repaired(NamedTuple):
    """``whole``: (conv, report columns, messages), a row for each conversation of ordinary length;
    ``reports`` (conv, report columns) and ``parts`` (conv, part, messages): the long ones, None without any."""

    whole: DataFrame
    reports: DataFrame | None
    parts: DataFrame | None

    def report(self) -> DataFrame:
        """(conv, report columns) of every conversation."""
        mine = self.whole.drop("messages")
        return mine if self.reports is None else mine.unionByName(self.reports)

    def messages(self) -> DataFrame:
        """(conv, part, place, edit, role, text): the repaired rows; by part, then place."""
        mine = self.whole.select("conv", F.lit(0).cast("long").alias("part"), "messages")
        rows = mine if self.parts is None else mine.unionByName(self.parts)
        return rows.select("conv", "part", F.posexplode("messages").alias("place", "m")).select("conv", "part", "place", "m.*")


def line(m: Column) -> Column:
    return F.concat(m["role"], F.lit(":"), m["text"])


def digests(repaired: Repaired) -> DataFrame:
    """(conv, report columns, repaired_sha256): the SHA-256 of the messages as ``role:text`` lines.

    One digest runs over all messages of a conversation, one after the other,
    so those of a long one stream through a single task, part by part; no more
    than a part is held.
    """
    text = F.array_join(F.transform("messages", line), "\n")
    mine = repaired.whole.select("conv", *REPORT_NAMES, F.sha2(text.cast("binary"), 256).alias("repaired_sha256"))
    if repaired.parts is None:
        return mine
    schema = _schema(repaired.parts.schema["conv"].dataType, "repaired_sha256 string")

    @releasing
    def run(batches):
        out, conv, state, empty = [], None, None, True
        for c, n, text in _streamed(batches):
            if state is None or c != conv:
                if state is not None:
                    out.append({"conv": conv, "repaired_sha256": state.hexdigest()})
                conv, state, empty = c, hashlib.sha256(), True
            if n:
                state.update(text.encode() if empty else b"\n" + text.encode())
                empty = False
        if state is not None:
            out.append({"conv": conv, "repaired_sha256": state.hexdigest()})
        yield _batch(out, schema)

    lines = repaired.parts.select("conv", "part", F.size("messages").alias("n"), text.alias("text"))
    sha = lines.repartition("conv").sortWithinPartitions("conv", "part").select("conv", "n", "text").mapInArrow(run, schema)
    met = repaired.reports.alias("r").join(sha.alias("s"), F.col("r.conv").eqNullSafe(F.col("s.conv")))
    return mine.unionByName(met.select("r.conv", *REPORT_NAMES, "repaired_sha256"))


def _schema(conv_type, ddl: str) -> StructType:
    return StructType([*StructType().add("conv", conv_type), *StructType.fromDDL(ddl)])


def _batch(rows: list[dict], schema: StructType) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)

    def column(f):
        values = [r[f.name] for r in rows]
        if f.name == "messages":
            values = [[{"edit": e, "role": r, "text": t} for e, r, t in v] for v in values]
        return pa.array(values, f.type)

    return pa.RecordBatch.from_arrays([column(f) for f in arrow], schema=arrow)


def _streamed(batches):
    """Rows of Arrow batches as tuples, about a megabyte at a time."""
    for batch in batches:
        sizes = [1 << 8] * batch.num_rows
        if "text" in batch.schema.names:
            sizes = [(n or 0) + 64 for n in pc.binary_length(batch["text"]).to_pylist()]
        for i, j in groups_of_bytes(sizes):
            yield from zip(*(c.to_pylist() for c in batch.slice(i, j - i).columns), strict=True)


def _whole(rows: DataFrame) -> DataFrame:
    schema = _schema(rows.schema["conv"].dataType, f"{REPORT}, {MESSAGES}")

    @releasing
    def run(batches):
        out, size = [], 0
        own, conv, begun = [], None, False
        for c, turn, role, text, copies in _streamed(batches):
            if begun and c != conv:
                out.append({"conv": conv} | repair_one(own))
                own = []
                if size > 1 << 20:
                    yield _batch(out, schema)
                    out, size = [], 0
            conv, begun = c, True
            own += [(turn, role, text)] * copies
            size += len(text) * copies + 100
        if begun:
            out.append({"conv": conv} | repair_one(own))
        yield _batch(out, schema)

    placed = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "digest")
    return placed.select("conv", "turn", "role", "text", "copies").mapInArrow(run, schema)


# ---- long conversations ----------------------------------------------------------

TABLE = "table struct<first: string, last: string, illegal: long, paths: array<struct<a: int, b: int, cost: long, audit: string>>>"


def _as_rows(table: dict) -> list[dict]:
    return [{"a": a, "b": b, "cost": c, "audit": p} for (a, b), (c, p) in table.items()]


def _table_udf(make):
    kind = StructType.fromDDL(TABLE)["table"].dataType
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(blocks: pa.Array) -> pa.Array:
        return pa.array([make(x.as_py()) for x in blocks], arrow)

    return run


def _solved(rows: list[dict]) -> dict:
    initials = [r["initial"] for r in rows]
    return {"first": initials[0], "last": initials[-1],
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
            "paths": _as_rows(solve_block([(r["initial"], r["fault"]) for r in rows]))}


def _joined(parts: list[dict]) -> dict:
    tables = [p["table"] for p in parts]
    between = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(tables, tables[1:], strict=False))
    paths = join_blocks({(p["a"], p["b"]): (p["cost"], p["audit"]) for p in t["paths"]} for t in tables)
    return {"first": tables[0]["first"], "last": tables[-1]["last"], "illegal": between + sum(t["illegal"] for t in tables),
            "paths": _as_rows(paths)}


def _pieces(first: int, audit: str) -> Iterator[tuple[int, str]]:
    """(block, its edits after the number of the state before it) of the edits of rows numbered from ``first``.

    What is inserted goes with the row after it, or with the last row.  The
    number of messages tells the states: it is odd only with a system row, and
    after that users and assistants take turns.
    """
    system = (len(audit) - audit.count("D")) % 2
    last = max(audit.rfind(x) for x in "DKR")
    block, begin, pos, messages, state = first // BLOCK, 0, first, 0, START
    for i, e in enumerate(audit):
        messages += e != "D"
        pos += e != "I"
        if e != "I" and pos % BLOCK == 0 and i < last:
            yield block, f"{state}{audit[begin:i + 1]}"
            block, begin = block + 1, i + 1
            if messages:
                state = SYSTEM if messages == system else USER if (messages - system) % 2 else ASSISTANT
    yield block, f"{state}{audit[begin:]}"


def _long(rows: DataFrame, n_long: int) -> tuple[DataFrame, DataFrame]:
    conv_type = rows.schema["conv"].dataType
    copies = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    # the last two fields let a range end within equal rows
    placed = copies.withColumn("order", F.struct("conv", "turn", "role", "digest", F.monotonically_increasing_id().alias("row"), "copy"))
    numbered = cut_lineage(sequence_index(placed, "order", "pos").select(
        "conv", "turn", "role", "text", "digest", F.col("pos") - 1).toDF("conv", "turn", "role", "text", "digest", "pos"))
    earliest = cut_lineage(numbered.groupBy("conv", "role", "digest").agg(F.min("pos").alias("earliest"))).alias("e")
    same = (F.col("r.conv").eqNullSafe(F.col("e.conv")) & (F.col("r.role") == F.col("e.role")) & (F.col("r.digest") == F.col("e.digest")))
    bare = F.regexp_replace("r.text", r"[\x20\x09-\x0D]+$", "")
    fault = (F.when(bare == "", BLANK).when(F.col("pos") > F.col("earliest"), DUPLICATE)
             .when(bare.rlike(r"[.!?]\z"), 0).otherwise(TRUNCATED))
    marked = cut_lineage(numbered.alias("r").join(earliest, same).select(
        "r.conv", "turn", "r.role", "text", "pos", fault.alias("fault"), F.substring("r.role", 1, 1).alias("initial")))

    def number(x: int) -> Column:
        return F.count(F.when(F.col("fault") == x, 1))

    turns = marked.groupBy("conv", "turn").agg(number(BLANK).alias("b"), number(DUPLICATE).alias("d"), number(TRUNCATED).alias("t"),
                                               F.min("pos").alias("first"))
    counts = turns.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"), F.sum("b").alias("blank"),
        F.sum("d").alias("duplicate"), F.sum("t").alias("truncated"), F.min("first").alias("first"))
    block = F.floor(F.col("pos") / BLOCK)
    listed = marked.groupBy("conv", block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows"))
    tables, n = cut_lineage_counted(listed.select("conv", "block", _table_udf(_solved)("rows").alias("table")))
    while n > n_long:
        grouped = tables.groupBy("conv", F.floor(F.col("block") / FAN).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("block").alias("at"), "table"))).alias("parts"))
        tables, n = cut_lineage_counted(grouped.select("conv", "block", _table_udf(_joined)("parts").alias("table")))
    ends = F.filter("table.paths", lambda p: (p["a"] == START) & p["b"].isin(*ACCEPTING))
    best = F.array_min(F.transform(ends, lambda p: F.struct(p["cost"].alias("cost"), p["audit"].alias("audit"))))
    answers = cut_lineage(tables.select("conv", F.col("table.illegal").alias("illegal"), best.alias("best")))
    found = answers.alias("a").join(counts.alias("c"), F.col("a.conv").eqNullSafe(F.col("c.conv")))
    reports = cut_lineage(found.select("a.conv", "gaps", "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit", "first"))

    schema = _schema(conv_type, "block long, edits string")

    @releasing
    def deal(batches):
        for conv, first, audit in _streamed(batches):
            some = []
            for at, edits in _pieces(first, audit):
                some.append({"conv": conv, "block": at, "edits": edits})
                if len(some) == 1 << 13:
                    yield _batch(some, schema)
                    some = []
            yield _batch(some, schema)

    pieces = reports.select("conv", "first", "audit").mapInArrow(deal, schema).alias("p")
    texts = marked.groupBy("conv", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("rows")).alias("t")
    met = texts.join(pieces, F.col("t.conv").eqNullSafe(F.col("p.conv")) & (F.col("t.block") == F.col("p.block")))

    kind = StructType.fromDDL(MESSAGES)["messages"].dataType
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def edited(rows: pa.Array, edits: pa.Array) -> pa.Array:
        out = []
        for own, path in zip(rows.to_pylist(), edits.to_pylist(), strict=True):
            done = apply_edits([(x["role"], x["text"]) for x in own], path[1:], int(path[0]))
            out.append([{"edit": e, "role": r, "text": t} for e, r, t in done])
        return pa.array(out, arrow)

    parts = met.select("t.conv", F.col("t.block").alias("part"), edited("rows", "edits").alias("messages"))
    return reports.drop("first"), parts


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies: Column | None = None) -> Repaired:
    """The repaired conversations of ``df``.  ``copies``: how often each row stands there (once, by default)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(" "))
    rows = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                     F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"),
                     (F.lit(1) if copies is None else copies).cast("int").alias("copies"))
    path = scratch_path(df.sparkSession, "long-conversations")
    size = rows.groupBy("conv").agg(F.sum("copies").alias("n"), F.sum(F.octet_length("text").cast("long") * F.col("copies")).alias("b"))
    size.where((F.col("n") > LONG_ROWS) | (F.col("b") > LONG_BYTES)).select(F.col("conv").alias("long")).write.parquet(path)
    long = df.sparkSession.read.parquet(path)     # its size decides how it is joined
    n_long = long.count()
    if not n_long:
        return Repaired(_whole(rows), None, None)
    same = F.col("conv").eqNullSafe(F.col("long"))
    return Repaired(_whole(rows.join(long, same, "left_anti")), *_long(rows.join(long, same, "left_semi"), n_long))
