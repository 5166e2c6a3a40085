"""Table upkeep (S4, S6-S12): partition writes, atomic replace, range upsert,
incremental high-water mark, load ledger, append, ensure-exists.

Storage is plain parquet plus the session catalog; nothing here is a storage
engine.  Atomic replace writes a complete new version folder first and only
then moves one pointer: the location of an unpartitioned catalog table
(``ALTER TABLE ... SET LOCATION``), or, for a partitioned one, the view over its
current version (``ALTER VIEW``), a catalog table whose partitions are registered
before any reader sees it.  A range upsert makes such a version of the folders
it wrote and, by location, of the others, which it does not touch.  So a reader
sees one version or the next, never a mixture, and a job that dies at any
point leaves the old one.  Driver-side values are single-row aggregates (a max
date, a batch's date range, the latest ledger row), read as literals so that
the following scan prunes partitions, and the catalog's list of partitions.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..session import cut_lineage

LEDGER_SCHEMA = StructType([
    StructField("dataset", StringType()),
    StructField("replication_sequence", LongType()),
    StructField("dump_timestamp", StringType()),
    StructField("loaded_at", TimestampType()),
])


# ------------------------------------------------------------------ file system
def _folder(spark: SparkSession, path: str):
    """The file system of ``path`` and the path on it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _folder(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def _partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the first partition column, from the folder names; no file is opened."""
    mark = f"{col}="
    return [x.removeprefix(mark) for x in _children(spark, path) if x.startswith(mark) and "__HIVE_DEFAULT" not in x]


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


# ------------------------------------------------------------------ S4 / S5
def stamp_chart_date(df: DataFrame, extraction_date: _dt.date | Column | None = None,
                     extracted_at: _dt.datetime | Column | None = None) -> DataFrame:
    """``chart_date`` = extraction day - 1, ``extracted_at`` = extraction time."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    day = lit(extraction_date) if extraction_date is not None else F.current_date()
    at = lit(extracted_at) if extracted_at is not None else F.current_timestamp()
    return df.withColumn("chart_date", F.date_sub(day, 1)).withColumn("extracted_at", at)


def write_partitions(df: DataFrame, path: str, partition_col: str = "chart_date") -> None:
    """Write one folder per ``partition_col`` value; a re-run replaces only the
    partitions present in ``df`` (dynamic partition overwrite).  Rows are
    clustered by the value first, so a folder gets few files; a hot value is
    still split over several tasks (rebalance, not repartition)."""
    (df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Header normalisation: lower case, spaces to underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def read_charts(spark: SparkSession, path: str, schema: StructType | None = None, merge_schema: bool = False,
                base_path: str | None = None) -> DataFrame:
    """Scan a glob or partitioned folder of daily chart files (S1).  Filters on
    ``chart_date`` prune folders when the layout is partitioned by it.
    ``merge_schema`` reads the footer of every file to find columns that only
    some have; a given ``schema`` needs no footer.  For a glob below a
    partitioned folder, ``base_path`` is that folder, so its columns are kept."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", str(merge_schema).lower())
    return (reader.option("basePath", base_path) if base_path else reader).parquet(path)


# ------------------------------------------------------------------ S7 / S11 / S12
def _new_version(base: str) -> str:
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    return f"{base.rstrip('/')}/v={stamp}-{uuid.uuid4().hex[:8]}"


def replace_table(df: DataFrame, name: str, base_path: str,
                  partition_by: Sequence[str] = ()) -> str:
    """Full replace of ``name`` (S7), atomic for readers and on failure.

    The new content goes to a fresh version folder under ``base_path``; only
    a complete write moves the pointer.  Without ``partition_by``, ``name`` is a
    catalog table; with it, ``name`` is a view over the current version (a plain
    table of that name is dropped when the first version is complete).  Returns
    the new location."""
    spark = df.sparkSession
    loc = _new_version(base_path)
    if partition_by:
        (df.hint("rebalance", *partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(loc))
        _point(spark, name, _register_version(spark, name, df, loc, partition_by), _current_version(spark, name))
        return loc
    df.write.mode("errorifexists").parquet(loc)
    if _current_version(spark, name):
        raise ValueError(f"{name} is partitioned; replace it with partition_by")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{loc}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=loc, source="parquet")
    return loc


def _detail(spark: SparkSession, name: str, what: str) -> str | None:
    """A line of DESCRIBE TABLE EXTENDED; None without it or without the table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == F.lit(what)).collect()
    return rows[0]["data_type"] if rows else None


def _current_version(spark: SparkSession, name: str) -> str | None:
    """The version table that the view ``name`` shows; None for a plain table or none at all."""
    text = _detail(spark, name, "View Text")
    return text.rpartition(" ")[2] if text else None


def _register_version(spark: SparkSession, name: str, df: DataFrame, loc: str, partition_by: Sequence[str]) -> str:
    """A catalog table over the folders below ``loc``, with the column types of ``df``; nothing shows it yet."""
    version = f"{name}__{uuid.uuid4().hex[:12]}"
    columns = [c for c in df.columns if c not in partition_by] + list(partition_by)
    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    by = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE {version} ({types}) USING parquet PARTITIONED BY ({by}) LOCATION '{loc}'")
    spark.sql(f"MSCK REPAIR TABLE {version}")
    return version


def _point(spark: SparkSession, name: str, version: str, seen: str | None) -> None:
    """Let ``name`` show ``version``: one catalog update.  ``seen`` is the version that the new one was made of; if another
    writer has moved the pointer since, this one fails and the table stays as that one left it."""
    now = _current_version(spark, name)
    if now != seen:
        raise RuntimeError(f"{name} was changed by another writer: {now} instead of {seen}")
    if now:
        spark.sql(f"ALTER VIEW {name} AS SELECT * FROM {version}")
        return
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {version}")


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partitions_of(spark: SparkSession, version: str) -> list[tuple[dict[str, str | None], str]]:
    """(values, location) of each partition that the catalog has of a version table; a value is text, None for NULL."""
    table = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(version)
    found = spark._jsparkSession.sessionState().catalog().listPartitions(table, spark._jvm.scala.Option.empty()).iterator()
    columns, out = None, []
    while found.hasNext():
        x = found.next()
        spec = x.spec()
        if columns is None:
            names = spec.keysIterator()
            columns = []
            while names.hasNext():
                columns.append(names.next())
        values = {c: spec.apply(c) for c in columns}
        out.append(({c: None if v in (None, NULL_FOLDER) else v for c, v in values.items()}, spark._jvm.org.apache.hadoop.fs.Path(x.location()).toString()))
    return out


def _add_partitions(spark: SparkSession, version: str, parts: list[tuple[dict[str, str | None], str]]) -> None:
    def literal(v: str | None) -> str:
        return "null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    for i in range(0, len(parts), 500):
        specs = [f"PARTITION ({', '.join(f'`{c}` = {literal(v)}' for c, v in values.items())}) LOCATION {literal(loc)}"
                 for values, loc in parts[i:i + 500]]
        spark.sql(f"ALTER TABLE {version} ADD {' '.join(specs)}")


def table_location(spark: SparkSession, name: str) -> str:
    """The folder that catalog table ``name`` (or the version that view ``name`` shows) has as its own."""
    return _detail(spark, _current_version(spark, name) or name, "Location")


def drop_old_versions(spark: SparkSession, name: str, base_path: str) -> list[str]:
    """Delete what lies under ``base_path`` and ``name`` no longer reads: version
    folders, partition folders of them, and catalog tables of older versions.
    Returns the names of the folders.  Call it once no running query reads them."""
    version = _current_version(spark, name)
    base = base_path.rstrip("/")
    if version is None:
        current = table_location(spark, name).rstrip("/").rpartition("/")[2]
        old = [x for x in _children(spark, base) if x.startswith("v=") and x != current]
        for x in old:
            _delete(spark, f"{base}/{x}")
        return old
    for row in spark.sql(f"SHOW TABLES LIKE '{name.rpartition('.')[2]}__*'").collect():
        if row["tableName"] != version.rpartition(".")[2].strip("`") and not row["isTemporary"]:
            spark.sql(f"DROP TABLE {row['tableName']}")      # external: its files stay
    fs, root = _folder(spark, base)
    top = fs.makeQualified(root).toString()
    used = set()      # the folders on the way to a partition that is read, relative to the base
    for _, loc in partitions_of(spark, version):
        parts = fs.makeQualified(_folder(spark, loc)[1]).toString().removeprefix(top).strip("/").split("/")
        used.update("/".join(parts[:n]) for n in range(1, len(parts) + 1))
    old: list[str] = []

    def clear(at: str) -> None:
        for x in _children(spark, f"{base}/{at}"):
            inner = f"{at}/{x}"
            if "=" in x and inner not in used:
                _delete(spark, f"{base}/{inner}")
                old.append(inner)
            elif "=" in x:
                clear(inner)

    for x in _children(spark, base):
        if x.startswith("v="):
            if x in used:
                clear(x)
            elif f"{top}/{x}" != fs.makeQualified(_folder(spark, table_location(spark, name))[1]).toString():
                _delete(spark, f"{base}/{x}")
                old.append(x)
    return old


def ensure_table(spark: SparkSession, name: str, schema: StructType, base_path: str,
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """Create an empty table with ``schema`` unless it exists (S11), also if another writer creates it meanwhile."""
    if not spark.catalog.tableExists(name):
        try:
            replace_table(spark.createDataFrame([], schema), name, base_path, partition_by)
        except AnalysisException as e:
            if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
    return spark.table(name)


def append_rows(df: DataFrame, name: str) -> None:
    """Append to an existing catalog table, column by name (S10); a missing or
    an unknown column is an error."""
    want = df.sparkSession.table(name).columns
    if sorted(want) != sorted(df.columns):
        raise ValueError(f"{name} has columns {want}, the rows have {df.columns}")
    df.select(*want).write.mode("append").insertInto(_current_version(df.sparkSession, name) or name)


def materialize(df, name: str, kind: str = "view", base_path: str | None = None,
                date_col: str = "chart_date") -> DataFrame:
    """Materialise a model as ``view`` (temp view, inlined at query time),
    ``table`` (stored, atomic replace) or ``incremental`` (S12).

    For ``incremental`` pass ``build(since) -> DataFrame`` instead of a
    DataFrame: only dates after the table's high-water mark are computed and
    their partitions written (``incremental_append``); the catalog table over
    ``base_path`` is created once and its partitions recovered after each run.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if base_path is None:
        raise ValueError(f"{kind} materialisation needs base_path")
    if kind == "table":
        replace_table(df, name, base_path)
        return df.sparkSession.table(name)
    if kind == "incremental":
        spark = SparkSession.getActiveSession()
        incremental_append(df, base_path, date_col)
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=base_path, source="parquet")
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
        return spark.table(name)
    raise ValueError(f"unknown materialisation {kind!r}")


# ------------------------------------------------------------------ S8
def range_replace(target: DataFrame, batch: DataFrame, date_col: str,
                  scope_keys: Sequence[str] = ()) -> DataFrame:
    """Target rows with ``min(date) <= date <= max(date)`` of the batch removed,
    batch appended (S8).  With ``scope_keys`` only target rows whose keys occur
    in the batch are removed, so a key missing from the batch keeps its rows; a
    NULL key is a key like others.  Rows without a date are in no range: those
    of the target stay, those of the batch are appended.

    The batch range is read as two literals (one-row aggregate), so the
    delete predicate prunes the target scan."""
    lo, hi = batch.agg(F.min(date_col), F.max(date_col)).first()
    rows = batch.select(*target.columns)
    if lo is None:
        return target.unionByName(rows)
    in_range = F.coalesce(F.col(date_col).between(F.lit(lo), F.lit(hi)), F.lit(False))
    if scope_keys:
        keys = batch.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(scope_keys)]).distinct()
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(scope_keys)])
        keep = target.where(in_range).join(keys, same, "left_anti").unionByName(target.where(~in_range))
    else:
        keep = target.where(~in_range)
    return keep.unionByName(rows)


def upsert_range(batch: DataFrame, name: str, date_col: str, scope_keys: Sequence[str] = (),
                 partition_col: str | None = None) -> None:
    """Range-replace into ``name``, made by ``replace_table`` and partitioned by ``date_col``
    or by ``partition_col``, a coarser column that grows with the date (a month).

    The partitions between the batch's least and greatest value, compared in the
    column's type, are read, merged with the batch and written to a folder of a
    new version (and the NULL partition, where the batch has rows for it); the
    new version takes all other partitions as they are, by location.  Moving
    the pointer to it is the last step and a single one: a job that dies before
    leaves the table as it was, and a repeated batch gives the same table."""
    spark = batch.sparkSession
    folder = partition_col or date_col
    seen = _current_version(spark, name)
    if seen is None:
        raise ValueError(f"{name} is not a partitioned table made by replace_table")
    target = spark.table(name)
    batch = cut_lineage(batch.select(*target.columns))
    lo, hi, n, n_null = batch.agg(F.min(folder), F.max(folder), F.count(F.lit(1)), F.count(F.when(F.col(folder).isNull(), 1))).first()
    if not n:
        return
    touched = F.coalesce(F.col(folder).between(F.lit(lo), F.lit(hi)), F.lit(False)) if lo is not None else F.lit(False)
    if n_null:
        touched = touched | F.col(folder).isNull()
    loc = table_location(spark, name).rstrip("/").rpartition("/")[0]
    loc = _new_version(loc)
    new = range_replace(target.where(touched), batch, date_col, scope_keys)
    new.hint("rebalance", folder).write.mode("errorifexists").partitionBy(folder).parquet(loc)
    version = _register_version(spark, name, target, loc, [folder])
    old = partitions_of(spark, seen)
    kind = target.schema[folder].dataType
    if old:
        values = spark.createDataFrame([(i, v[folder]) for i, (v, _) in enumerate(old)], "i int, text string")
        typed = values.select("i", F.col("text").cast(kind).alias(folder))
        stay = {r["i"] for r in typed.where(~touched).collect()}
        _add_partitions(spark, version, [x for i, x in enumerate(old) if i in stay])
    _point(spark, name, version, seen)


# ------------------------------------------------------------------ S9
def high_water_mark(spark: SparkSession, path: str, date_col: str = "chart_date",
                    floor: str = "1900-01-01") -> _dt.date:
    """``coalesce(max(date), floor)`` of the table at ``path`` (missing table ->
    floor).  Where ``date_col`` is the partition column the folder names tell
    it, and no file is opened."""
    days = _partition_values(spark, path, date_col)
    if days:
        return _dt.date.fromisoformat(max(days))
    got = spark.read.parquet(path).agg(F.max(date_col)).first()[0] if _children(spark, path) and any(
        x.endswith(".parquet") for x in _children(spark, path)) else None
    return got or _dt.date.fromisoformat(floor)


# ------------------------------------------------------------------ S6
def read_markers(spark: SparkSession, folder: str) -> tuple[int | None, str | None]:
    """Dump markers: the whole stripped text of the files REPLICATION_SEQUENCE
    and TIMESTAMP.  A missing or blank file gives None, a bad number gives None."""
    def text(name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        if not path_exists(spark, path):
            return spark.range(1).select(F.lit(None).cast("string").alias("t"))
        trimmed = F.regexp_replace("value", r"^\s+|\s+$", "")
        return spark.read.text(path, wholetext=True).agg(F.nullif(F.max(trimmed), F.lit("")).alias("t"))

    number = text("REPLICATION_SEQUENCE").select(F.col("t").try_cast("bigint")).first()[0]
    return number, text("TIMESTAMP").first()[0]


def _latest_markers() -> Column:
    """Markers of the last load; of two at the same time, the larger ones."""
    markers = F.struct("replication_sequence", "dump_timestamp")
    return F.max_by(markers, F.struct("loaded_at", "replication_sequence", "dump_timestamp"))


def ledger_decision(ledger: DataFrame, dataset: str, seq: int | None, ts: str | None) -> DataFrame:
    """One row: ``skip`` is true when the latest ledger markers equal the
    incoming ones, NULL equal to NULL (S6).  An empty ledger never skips.
    A single global aggregate: count and latest row together."""
    rows = ledger.where(F.col("dataset") == F.lit(dataset))
    agg = rows.agg(F.count(F.lit(1)).alias("n"),
                   _latest_markers().alias("m"))
    eq = (F.col("m.replication_sequence").eqNullSafe(F.lit(seq).cast("bigint"))
          & F.col("m.dump_timestamp").eqNullSafe(F.lit(ts).cast("string")))
    return agg.select(((F.col("n") > 0) & eq).alias("skip"))


def ledger_decisions(ledger: DataFrame, incoming: DataFrame) -> DataFrame:
    """Batch form of ``ledger_decision``: ``incoming`` holds ``dataset,
    replication_sequence, dump_timestamp``; returns ``dataset, skip``."""
    last = (ledger.groupBy("dataset")
            .agg(_latest_markers().alias("m")))
    x = incoming.join(last, "dataset", "left")
    eq = (F.col("m").isNotNull()
          & F.col("m.replication_sequence").eqNullSafe(F.col("replication_sequence"))
          & F.col("m.dump_timestamp").eqNullSafe(F.col("dump_timestamp")))
    return x.select("dataset", eq.alias("skip"))


@contextmanager
def claim(spark: SparkSession, base_path: str, what: str):
    """Hold the claim on ``what``: yields True for the one that could create its file under ``base_path``, False
    for all others until it is given back.  The file system's exclusive create decides (atomic on HDFS and local
    disks; not on object stores).  The claim of a loader that died stays until ``drop_claim``."""
    fs, path = _folder(spark, _claim_path(base_path, what))
    try:
        fs.create(path, False).close()
        mine = True
    except Py4JJavaError as exc:
        if "AlreadyExists" not in exc.java_exception.getClass().getName():
            raise
        mine = False
    try:
        yield mine
    finally:
        if mine:
            fs.delete(path, False)


def _claim_path(base_path: str, what: str) -> str:
    name = "".join(c if c.isalnum() else f"_{ord(c):x}_" for c in what)
    return f"{base_path.rstrip('/')}/_claims/{name}"


def drop_claim(spark: SparkSession, base_path: str, what: str) -> bool:
    """Give back the claim of a loader that died; returns whether there was one."""
    fs, path = _folder(spark, _claim_path(base_path, what))
    return fs.delete(path, False)


def incremental_append(build, path: str, date_col: str = "chart_date",
                       reprocess_from: _dt.date | None = None, new_columns: bool = False) -> DataFrame:
    """Incremental materialisation with a high-water mark.

    ``build(since)`` returns the fact for dates ``> since`` (``since`` is a
    date literal Column, so the filter prunes the source scan).  The result
    replaces exactly the date partitions it contains, so a re-run, or
    ``reprocess_from`` for late corrections, upserts on (date, key).  With
    ``new_columns`` the table is read with the columns of all its files, so
    those that later partitions added are there.
    """
    spark = SparkSession.getActiveSession()
    since = high_water_mark(spark, path, date_col)
    if reprocess_from is not None:
        since = min(since, reprocess_from - _dt.timedelta(days=1))
    fresh = build(F.lit(since))
    write_partitions(fresh, path, date_col)
    return read_charts(spark, path, merge_schema=new_columns)


def ledger_row(spark: SparkSession, dataset: str, seq: int | None, ts: str | None,
               loaded_at: _dt.datetime | None = None) -> DataFrame:
    """The row appended after a successful load."""
    return spark.createDataFrame(
        [(dataset, seq, ts, loaded_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))],
        LEDGER_SCHEMA)
