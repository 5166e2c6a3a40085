"""Entity dump loader: one JSON object per line.

Each object line is parsed once by its fields, as a lenient JSON reader does:
the last of repeated keys wins, and ``NaN`` is a number.  Rules:

* blank lines are skipped; a line that is not valid JSON fails the job with
  the file name and the line text; ``strict_load`` turns that into the file,
  line number and text of the first such line;
* valid JSON that is not an object (``[1]``, ``"x"``) is dropped;
* ``id -> mb_id``, ``name``;
* ``label-code`` falls back to ``label_code`` only when it is missing or
  JSON null (an empty string does not fall back);
* the code becomes an int leniently: numbers are truncated, strings must
  hold an integer (surrounding whitespace allowed), '' and anything else
  give NULL;
* ``relations`` is kept as JSON text, NULL when missing or null.

The read is a plain text scan: it splits by file block and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

INVALID = "Invalid JSON in "

_NUMERIC = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def _lenient_int(v: Column) -> Column:
    t = F.schema_of_variant(v)
    as_text = F.regexp_replace(F.try_variant_get(v, "$", "string"), r"^\s+|\s+$", "")
    return (F.when(v.isNull(), None)
            .when(t.isin(*_NUMERIC) | t.startswith("DECIMAL"),
                  F.try_variant_get(v, "$", "double").try_cast("int"))
            .when(t == F.lit("BOOLEAN"), F.try_variant_get(v, "$", "boolean").cast("int"))
            .when(t == F.lit("STRING"), F.when(as_text != F.lit(""), as_text.try_cast("int"))))


_FIELDS = "array<struct<id: string, name: string, `label-code`: variant, label_code: variant, relations: string>>"


def _marked(lines: DataFrame, text_col: str) -> DataFrame:
    """Lines that are not blank, trimmed (``_raw``), with the object in them (``_o``) and whether they are valid (``_ok``)."""
    raw = F.regexp_replace(F.col(text_col), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    x = lines.withColumn("_raw", raw).where(F.col("_raw") != F.lit(""))
    # as the only element of an array: what follows the object makes the array invalid, or longer
    alone = F.from_json(F.concat(F.lit("["), F.col("_raw"), F.lit("]")), _FIELDS)
    x = x.withColumn("_a", F.when(F.col("_raw").startswith("{"), alone))
    x = x.withColumn("_o", F.when(F.size("_a") == 1, F.col("_a")[0]))
    good = F.when(F.col("_raw").startswith("{"), F.col("_o").isNotNull()).otherwise(F.try_parse_json("_raw").isNotNull())
    return x.withColumn("_ok", good)


def parse_entities(lines: DataFrame, text_col: str = "value", strict: bool = True) -> DataFrame:
    """Parse a column of NDJSON lines into ``mb_id, name, label_code, relations``."""
    x = _marked(lines.select(F.col(text_col).alias("value"), F.input_file_name().alias("_file")), "value")
    if strict:
        bad = F.concat(F.lit(INVALID), F.col("_file"), F.lit(": "), F.substring("_raw", 1, 200))
        x = x.withColumn("_ok", F.when(F.col("_ok"), True).otherwise(F.raise_error(bad).cast("boolean")))
    x = x.where(F.col("_ok") & F.col("_o").isNotNull())
    code = F.col("_o.`label-code`")
    code = F.when(code.isNull() | (F.schema_of_variant(code) == F.lit("VOID")), F.col("_o.label_code")).otherwise(code)
    return x.select(
        F.col("_o.id").alias("mb_id"),
        F.col("_o.name").alias("name"),
        _lenient_int(code).alias("label_code"),
        F.col("_o.relations").alias("relations"),
    )


def load_entities(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Read NDJSON files (a file, folder or glob) as entities."""
    return parse_entities(spark.read.text(path), strict=strict)


def invalid_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, text)`` of the lines that are not valid JSON, numbered from 1 within their file.

    Lines have no number in a distributed read, but a split knows where it
    starts in its file: lines are counted for each split, the counts before a
    split are summed within the file, and a line's place in its split is its
    place in the task after the split's first line.  Both come from the same
    scan; one row for each split and the invalid lines are all that is shuffled.
    """
    rows = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"))
    splits = rows.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    bad = _marked(rows, "value").where(~F.col("_ok")).select("file", "start", "place", "value")
    return bad.join(offsets, ["file", "start"]).select(
        "file", (F.col("before") + F.col("place") - F.col("first") + 1).alias("line"), F.col("value").alias("text"))


class InvalidLine(ValueError):
    """The first line of an entity dump that is not valid JSON."""

    def __init__(self, file: str, line: int, text: str):
        super().__init__(f"{INVALID}{file}, line {line}: {text[:200]}")
        self.file, self.line, self.text = file, line, text


def strict_load(spark: SparkSession, path: str, job: Callable[[DataFrame], object]):
    """``job(load_entities(spark, path))``; where it fails on an invalid line, ``InvalidLine`` says which is the first.
    The lines are numbered only then, so a valid dump is read once."""
    try:
        return job(load_entities(spark, path))
    except PySparkException as exc:
        if INVALID not in str(exc):
            raise
        found = invalid_lines(spark, path).orderBy("file", "line").first()
        if found is None:
            raise
        raise InvalidLine(found["file"], found["line"], found["text"]) from exc


def load_dump_once(spark: SparkSession, dump_path: str, marker_dir: str, name: str, base_path: str,
                   ledger_name: str, ledger_base: str, dataset: str) -> bool:
    """Load an entity dump into catalog table ``name`` unless the ledger says
    this dump was the last one loaded (S2 + S6 + S7).

    The markers come from ``marker_dir``; an unchanged dump is skipped; of
    several loaders at once, one holds the dataset's claim (a file that only one
    can create) and the others skip; the ledger is read again under the claim.
    The table is replaced atomically (a failed parse leaves the old version); the
    ledger row is appended only after the replace succeeded; the claim is given
    back either way.  Returns whether a load happened.
    """
    from .tables import (LEDGER_SCHEMA, append_rows, claim, ensure_table, ledger_decision, ledger_row,
                         read_markers, replace_table)

    seq, ts = read_markers(spark, marker_dir)

    def loaded() -> bool:
        spark.catalog.refreshTable(ledger_name)
        return ledger_decision(spark.table(ledger_name), dataset, seq, ts).first()["skip"]

    with claim(spark, ledger_base, f"{dataset}-table") as first:
        if first:
            ensure_table(spark, ledger_name, LEDGER_SCHEMA, ledger_base)
    if not spark.catalog.tableExists(ledger_name) or loaded():
        return False
    with claim(spark, ledger_base, dataset) as mine:
        if not mine or loaded():
            return False
        strict_load(spark, dump_path, lambda entities: replace_table(entities, name, base_path))
        append_rows(ledger_row(spark, dataset, seq, ts), ledger_name)
    return True
