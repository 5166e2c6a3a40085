from __future__ import annotations

import datetime as dt
import os
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sharelens.operators.linkage import (
    count_missing,
    hierarchy_groups,
    latest_per_key,
    lookup_counts,
    missing_keys,
    track_labels,
)
from sharelens.operators.quality import AcceptedValues, Expression, NotNull, Unique, check
from sharelens.session import scratch_path
from sharelens.sources.html import html_table_rows
from sharelens.sources.ndjson import load_entities
from sharelens.sources.prices import shape_quotes
from sharelens.sources.tables import (
    append_rows,
    drop_old_versions,
    ensure_table,
    high_water_mark,
    incremental_append,
    ledger_decision,
    ledger_row,
    range_replace,
    read_markers,
    replace_table,
    upsert_range,
    write_partitions,
)


def _write_bytes(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _local(spark, name):
    p = scratch_path(spark, name)
    return p[len("file:"):] if p.startswith("file:") else p


def test_ndjson_rules(spark):
    d = _local(spark, "nd")
    lines = [
        '{"id": "a", "name": "A", "label-code": 12, "relations": [{"type": "x"}]}',
        '',
        '   ',
        '[1]',
        '"just a string"',
        '{"id": "b", "name": "B", "label-code": "", "label_code": 5}',
        '{"id": "c", "label-code": null, "label_code": " 7 "}',
        '{"id": "d", "label_code": "x9", "relations": null}',
        '{"id": "e", "label-code": 12.9}',
        '{"id": "f", "label-code": true}',
    ]
    data = ("\n".join(lines) + "\n").encode() + b'{"id": "g", "name": "bad \xff byte"}\n'
    _write_bytes(f"{d}/label", data)
    got = {r.mb_id: r for r in load_entities(spark, f"{d}/label").collect()}
    assert sorted(got) == ["a", "b", "c", "d", "e", "f", "g"]
    assert got["a"].label_code == 12 and got["a"].relations.startswith("[")
    assert got["b"].label_code is None                   # '' does not fall back
    assert got["c"].label_code == 7                      # null falls back; whitespace allowed
    assert got["d"].label_code is None and got["d"].relations is None
    assert got["e"].label_code == 12                     # numbers truncate
    assert got["f"].label_code == 1
    assert "�" in got["g"].name


def test_ndjson_invalid_line_fails_with_file(spark):
    d = _local(spark, "nd-bad")
    _write_bytes(f"{d}/label", b'{"id": "a"}\n{not json}\n')
    with pytest.raises(Exception, match="Invalid JSON in .*label"):
        load_entities(spark, f"{d}/label").collect()


def test_markers_and_ledger(spark):
    d = _local(spark, "markers")
    _write_bytes(f"{d}/REPLICATION_SEQUENCE", b" 42 \n")
    _write_bytes(f"{d}/TIMESTAMP", b"2024-01-01\n")
    assert read_markers(spark, d) == (42, "2024-01-01")
    d2 = _local(spark, "markers2")
    _write_bytes(f"{d2}/REPLICATION_SEQUENCE", b"abc")
    assert read_markers(spark, d2) == (None, None)
    d3 = _local(spark, "markers3")
    _write_bytes(f"{d3}/REPLICATION_SEQUENCE", b"\n42\n")
    _write_bytes(f"{d3}/TIMESTAMP", b"2024-01-01\n12:00\n")
    assert read_markers(spark, d3) == (42, "2024-01-01\n12:00")
    empty = ledger_row(spark, "ds", 1, "t").where(F.lit(False))
    assert ledger_decision(empty, "ds", 1, "t").first().skip is False
    led = (ledger_row(spark, "ds", 1, "t", dt.datetime(2024, 1, 1))
           .unionByName(ledger_row(spark, "ds", None, None, dt.datetime(2024, 2, 1))))
    assert ledger_decision(led, "ds", None, None).first().skip is True       # NULL = NULL counts as equal
    assert ledger_decision(led, "ds", 1, "t").first().skip is False          # not the latest row
    assert ledger_decision(led, "other", None, None).first().skip is False
    tie = (ledger_row(spark, "ds", 1, "t", dt.datetime(2024, 1, 1))
           .unionByName(ledger_row(spark, "ds", 2, "s", dt.datetime(2024, 1, 1))))
    for order in (tie, tie.orderBy(F.col("replication_sequence").desc())):
        assert ledger_decision(order, "ds", 2, "s").first().skip is True         # of two at one time, the larger


def test_ndjson_repeated_key_and_nan(spark):
    d = _local(spark, "nd-lenient")
    _write_bytes(f"{d}/label", b'{"id":"a","id":"b","name":"N"}\n{"id":"c","label-code":NaN}\n'
                               b'{"id":"d","relations":[{"type":"x","type":"y"}]}\n[1]\n')
    got = {r.mb_id: r for r in load_entities(spark, f"{d}/label").collect()}
    assert sorted(got) == ["b", "c", "d"] and got["b"].name == "N"
    assert got["c"].label_code is None and '"y"' in got["d"].relations
    for bad in (b'{"id": "a"', b'{"id": "a"} x', b'[1', b'{"id": a}', b'{"id": "a"}{"id": "b"}', b'{"id": "a"}, {"id": "b"}'):
        e = _local(spark, "nd-broken")
        _write_bytes(f"{e}/label", bad + b"\n")
        with pytest.raises(Exception, match="Invalid JSON"):
            load_entities(spark, f"{e}/label").collect()


def test_append_by_name(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, name, spark.createDataFrame([], "a string, b string").schema, scratch_path(spark, "append"))
    append_rows(spark.createDataFrame([("B", "A")], "b string, a string"), name)
    assert [tuple(r) for r in spark.table(name).select("a", "b").collect()] == [("A", "B")]
    for wrong in ("a string", "a string, c string"):
        with pytest.raises(ValueError, match="has columns"):
            append_rows(spark.createDataFrame([], wrong), name)


def test_upsert_touches_only_the_range(spark):
    name, base = f"p_{uuid.uuid4().hex[:8]}", scratch_path(spark, "prices")
    rows = [(dt.date(2024, 1, d), t, 1.0) for d in range(1, 7) for t in ("A", "B")]
    replace_table(spark.createDataFrame(rows, "date date, ticker string, close double"), name, base, partition_by=["date"])
    files = lambda: {r[0]: r[1] for r in spark.table(name).select("date", F.input_file_name()).distinct().collect()}
    before = files()
    batch = spark.createDataFrame([(dt.date(2024, 1, 2), "A", 9.0), (dt.date(2024, 1, 4), "A", 9.0)], "date date, ticker string, close double")
    upsert_range(batch, name, "date", ["ticker"])
    got = {(r.date.day, r.ticker): r.close for r in spark.table(name).collect()}
    assert got[(3, "B")] == 1.0 and (3, "A") not in got and got[(4, "A")] == 9.0 and len(got) == 11
    after = files()
    assert all(before[dt.date(2024, 1, d)] == after[dt.date(2024, 1, d)] for d in (1, 5, 6))
    upsert_range(batch, name, "date")                               # without scope the whole range is replaced
    got = {(r.date.day, r.ticker): r.close for r in spark.table(name).collect()}
    assert sorted(got) == [(1, "A"), (1, "B"), (2, "A"), (4, "A"), (5, "A"), (5, "B"), (6, "A"), (6, "B")]


def test_old_versions_are_dropped(spark):
    name, base = f"v_{uuid.uuid4().hex[:8]}", scratch_path(spark, "versions")
    for n in (1, 2, 3):
        replace_table(spark.range(n), name, base)
    assert len(drop_old_versions(spark, name, base)) == 2 and spark.table(name).count() == 3
    assert drop_old_versions(spark, name, base) == []


def test_high_water_mark_reads_folder_names(spark):
    path = scratch_path(spark, "marks")
    assert high_water_mark(spark, path) == dt.date(1900, 1, 1)
    df = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 12, 3)], "chart_date date, v int")
    write_partitions(df.repartition(5), path)
    assert high_water_mark(spark, path) == dt.date(2024, 1, 12)
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() == 3      # a file for each day
    plain = scratch_path(spark, "marks-plain")
    df.write.parquet(plain)
    assert high_water_mark(spark, plain) == dt.date(2024, 1, 12)


def test_quotes_keep_the_exchange_day(spark):
    df = spark.sql("SELECT t AS Ticker, TIMESTAMP '2024-01-01 23:00:00' AS Date, 1.0 AS Open, 1.0 AS High, 1.0 AS Low, "
                   "1.0 AS Close, 1 AS Volume FROM VALUES ('UMG.AS'), ('WMG'), ('OTHER') AS x(t)")
    zones = {"UMG.AS": "Europe/Amsterdam", "WMG": "America/New_York"}
    got = {r.ticker: r.date.day for r in shape_quotes(df, "Ticker", {}, zones).collect()}
    assert got == {"UMG.AS": 2, "WMG": 1, "OTHER": 1}
    local = df.withColumn("Date", F.col("Date").cast("timestamp_ntz"))
    assert {r.date.day for r in shape_quotes(local, "Ticker", {}, zones).collect()} == {1}


def test_html_entities_and_shared_keys(spark):
    page = lambda h, c: f"<table><tr><th>{h}</th></tr><tr><td>{c}</td></tr></table>"
    df = spark.createDataFrame([("k", page("One", "&#233;&eacute;&#x1F600; &amp;lt; &nope; & &#0; a&lt;b")), ("k", page("Two", "x"))],
                               "k string, html string")
    got = sorted((r.column_name, r.value) for r in html_table_rows(df, "html", ["k"]).collect())
    assert got == [("one", "éé😀 &lt; &nope; & &#0; a<b"), ("two", "x")]
    plan = html_table_rows(df, "html", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_strict_link_sends_no_empty_key(spark):
    from sharelens.operators.linkage import link_tracks
    from sharelens.operators.staging import stage_metadata
    charts = spark.createDataFrame([("夜に駆ける", "歌手"), ("Song", "歌手")], "track_name string, artist_name string")
    meta = stage_metadata(spark.createDataFrame([("別の曲", "別の人", "L", "T1", dt.datetime(2024, 1, 1))],
                                                "track_name string, artist_name string, label string, track_id string, updated_at timestamp"))
    assert {r.track_id for r in link_tracks(charts, meta).collect()} == {None}
    assert {r.track_name: r.track_id for r in link_tracks(charts, meta, strict=False).collect()} == {"夜に駆ける": "T1", "Song": None}


def test_fanout_counts_matches(spark):
    from sharelens.plans.market_share import share_fact
    day = dt.date(2024, 1, 1)
    charts = spark.createDataFrame([("Band - Song", 5, day)] * 2, "artist_and_title string, streams long, chart_date date")
    meta = spark.createDataFrame([("Song", "Band", "Kona", "T1", dt.datetime(2024, 1, d)) for d in (1, 2, 3)],
                                 "track_name string, artist_name string, label string, track_id string, updated_at timestamp")
    dim = spark.createDataFrame([("kona", "G", "P", "l1"), ("kona", "G", "P", "l2")],
                                "normalized_label string, market_share_group string, ultimate_parent_name string, label_id string")
    fan = share_fact(charts, meta, dim, (), strict=False).collect()
    assert [(r.parent_group, r.total_streams, r.track_count, r.row_count) for r in fan] == [("G", 60, 1, 12)]
    strict = share_fact(charts, meta, dim, ()).collect()
    assert [(r.parent_group, r.total_streams, r.track_count, r.row_count) for r in strict] == [("G", 10, 1, 2)]


def test_replace_table_is_atomic(spark):
    name, base = f"t_{uuid.uuid4().hex[:8]}", scratch_path(spark, "atomic")
    replace_table(spark.range(3), name, base)
    bad = spark.range(10).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("id")))
    with pytest.raises(Exception):
        replace_table(bad, name, base)
    assert spark.table(name).count() == 3
    replace_table(spark.range(5), name, base)
    assert spark.table(name).count() == 5


def test_range_replace_scope(spark):
    target = spark.createDataFrame([(dt.date(2024, 1, d), t, 1.0) for d in range(1, 6) for t in ("A", "B")],
                                   "date date, ticker string, close double")
    batch = spark.createDataFrame([(dt.date(2024, 1, 2), "A", 9.0), (dt.date(2024, 1, 4), "A", 9.0)],
                                  "date date, ticker string, close double")
    plain = {(r.date.day, r.ticker): r.close for r in range_replace(target, batch, "date").collect()}
    assert (3, "B") not in plain and (3, "A") not in plain and plain[(2, "A")] == 9.0   # range delete
    scoped = {(r.date.day, r.ticker): r.close for r in range_replace(target, batch, "date", ["ticker"]).collect()}
    assert scoped[(3, "B")] == 1.0 and (3, "A") not in scoped and scoped[(4, "A")] == 9.0


def test_partition_overwrite_keeps_other_days(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(dt.date(2024, 1, d), float(d)) for d in (1, 2, 3)], "chart_date date, v double")
    write_partitions(df, path)
    write_partitions(df.where("chart_date = date'2024-01-02'").withColumn("v", F.lit(99.0)), path)
    got = {r.chart_date.day: r.v for r in spark.read.parquet(path).collect()}
    assert got == {1: 1.0, 2: 99.0, 3: 3.0}


def test_incremental_equals_full_and_reprocess(spark):
    path = scratch_path(spark, "inc")
    rows = [(dt.date(2024, 1, d), g, d * 10 + i) for d in range(1, 8) for i, g in enumerate(("x", "y"))]
    src = spark.createDataFrame(rows, "chart_date date, g string, v long")

    def build(data):
        return lambda since: (data.where(F.col("chart_date") > since).groupBy("chart_date", "g")
                              .agg(F.sum("v").alias("total")))

    incremental_append(build(src.where("chart_date <= date'2024-01-04'")), path)
    late = src.withColumn("v", F.when(F.col("chart_date") == F.lit(dt.date(2024, 1, 3)), F.lit(0)).otherwise(F.col("v")))
    out = incremental_append(build(late), path)
    got = {(r.chart_date.day, r.g): r.total for r in out.collect()}
    assert got[(3, "x")] == 30                    # strict '>' ignores the late correction
    out = incremental_append(build(late), path, reprocess_from=dt.date(2024, 1, 3))
    got = {(r.chart_date.day, r.g): r.total for r in out.collect()}
    assert got[(3, "x")] == 0 and len(got) == 14


def test_html_first_table(spark):
    page = ("<html><TABLE><tr><th>Pos</th><th>Artist and Title</th></tr>"
            "<tr><td>1</td><td><a href='#'>A &amp; B</a> - Song</td></tr>"
            "<tr><td>2</td><td>C&nbsp;- D</td></tr></TABLE><table><tr><td>x</td></tr></table></html>")
    df = spark.createDataFrame([(1, page), (2, "<p>no table</p>")], "k int, html string")
    got = sorted((r.row_idx, r.column_name, r.value) for r in html_table_rows(df, "html", ["k"]).collect())
    assert got == [(1, "artist_and_title", "A & B - Song"), (1, "pos", "1"),
                   (2, "artist_and_title", "C - D"), (2, "pos", "2")]
    with pytest.raises(Exception, match="No tables found"):
        html_table_rows(df, "html", ["k"], require_table=True).collect()


def test_quality_rules_on_broken_fact(spark):
    fact = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "A", 0.5), (dt.date(2024, 1, 1), "A", 0.5), (None, "B", 1.5), (dt.date(2024, 1, 2), None, None)],
        "chart_date date, parent_group string, market_share_pct double")
    got = {(r.rule, r.column): r.failed_rows for r in check(fact, [
        NotNull("chart_date"), NotNull("parent_group"), AcceptedValues("parent_group", ["A"]),
        Expression("share_range", "market_share_pct >= 0 AND market_share_pct <= 1", "market_share_pct IS NOT NULL"),
        Unique(["chart_date", "parent_group"])]).collect()}
    assert got == {("not_null", "chart_date"): 1, ("not_null", "parent_group"): 1,
                   ("accepted_values", "parent_group"): 1, ("expression_is_true", "share_range"): 1,
                   ("unique", "chart_date || parent_group"): 1}


def test_linkage_strict_vs_fanout(spark):
    meta = spark.createDataFrame([
        ("T1", "lab", "Lab One", dt.datetime(2024, 1, 1)), ("T1", "lab", "Lab Two", dt.datetime(2024, 1, 2)),
        ("T2", "", "Records", dt.datetime(2024, 1, 1))],
        "track_id string, normalized_label string, label string, updated_at timestamp")
    charts = spark.createDataFrame([("T1", 10), ("T2", 5), (None, 1)], "track_id string, s int")
    fan = track_labels(charts, meta, strict=False)
    assert fan.count() == 4
    strict = {r.track_id: r.original_label for r in track_labels(charts, meta).collect()}
    assert strict["T1"] == "Lab Two"
    dim = spark.createDataFrame([("", "G1", "P", "l1"), ("", "G2", "P", "l2"), ("lab", "G3", "P", "l3")],
                                "normalized_label string, market_share_group string, ultimate_parent_name string, "
                                "label_id string")
    j = hierarchy_groups(track_labels(charts, meta), dim)
    got = {r.track_id: r.hierarchy_group for r in j.collect()}
    assert got["T1"] == "G3" and got["T2"] is None            # '' key dropped in strict mode
    assert hierarchy_groups(track_labels(charts, meta), dim, strict=False).count() == 4


def test_missing_keys_include_null_labels(spark):
    charts = spark.createDataFrame([("t1", "a"), ("t2", "a"), ("t3", "b"), ("t3", "b")],
                                   "track_name string, artist_name string")
    meta = spark.createDataFrame([("t1", "a", "L"), ("t2", "a", None), ("t2", "a", "L2")],
                                 "track_name string, artist_name string, label string")
    got = sorted(tuple(r) for r in missing_keys(charts, meta).collect())
    assert got == [("t2", "a"), ("t3", "b")]     # t2 has a NULL-label row too
    assert [tuple(r) for r in missing_keys(charts, meta, limit=1).collect()] == [("t2", "a")]
    assert count_missing(charts, meta).first()[0] == 3
    counts = lookup_counts(missing_keys(charts, meta), meta.where("label is null")).first()
    assert tuple(counts) == (2, 0, 1, 1)
    df = spark.createDataFrame([("k", 1, 3), ("k", 2, 3), ("j", 1, None)], "k string, id int, ts int")
    assert [tuple(r) for r in latest_per_key(df, ["k"], "ts", ["id"]).orderBy("k").collect()] == [("j", 1, None), ("k", 1, 3)]


def test_load_dump_once_skips_unchanged(spark):
    from sharelens.sources.ndjson import load_dump_once
    d = _local(spark, "dump")
    _write_bytes(f"{d}/mbdump/label", b'{"id": "a", "name": "A"}\n{"id": "b", "name": "B"}\n')
    _write_bytes(f"{d}/REPLICATION_SEQUENCE", b"7\n")
    names = dict(name=f"lab_{uuid.uuid4().hex[:8]}", base_path=scratch_path(spark, "lab"),
                 ledger_name=f"led_{uuid.uuid4().hex[:8]}", ledger_base=scratch_path(spark, "led"),
                 dataset="label")
    assert load_dump_once(spark, f"{d}/mbdump/label", d, **names) is True
    assert load_dump_once(spark, f"{d}/mbdump/label", d, **names) is False     # same markers (ts NULL = NULL)
    _write_bytes(f"{d}/mbdump/label", b'{"id": "a", "name": "A"}\n{broken\n')
    _write_bytes(f"{d}/REPLICATION_SEQUENCE", b"8\n")
    with pytest.raises(Exception):
        load_dump_once(spark, f"{d}/mbdump/label", d, **names)
    assert spark.table(names["name"]).count() == 2                               # old version kept
    assert spark.table(names["ledger_name"]).count() == 1                        # failed load not recorded


def test_link_tracks_per_title_null_safe(spark):
    from sharelens.operators.linkage import link_tracks
    from sharelens.operators.staging import stage_metadata
    charts = spark.createDataFrame([("Song!", "Band", 1), ("song", "BAND ", 2), (None, "Band", 3), ("Other", None, 4)],
                                   "track_name string, artist_name string, s int")
    meta = stage_metadata(spark.createDataFrame(
        [("song", "band", "L", "T1", dt.datetime(2024, 1, 1)), ("SONG", "Band", "L", "T2", dt.datetime(2024, 2, 1))],
        "track_name string, artist_name string, label string, track_id string, updated_at timestamp"))
    got = {r.s: (r.normalized_track_name, r.normalized_artist_name, r.track_id)
           for r in link_tracks(charts, meta).collect()}
    assert got == {1: ("song", "band", "T2"), 2: ("song", "band", "T2"), 3: (None, "band", None),
                   4: ("other", None, None)}


def test_materialize_incremental(spark):
    from sharelens.sources.tables import materialize
    name, base = f"inc_{uuid.uuid4().hex[:8]}", scratch_path(spark, "inc-table")
    rows = [(dt.date(2024, 1, d), d) for d in range(1, 7)]
    src = spark.createDataFrame(rows, "chart_date date, v long")

    def build(data):
        return lambda since: data.where(F.col("chart_date") > since).groupBy("chart_date").agg(F.sum("v").alias("t"))

    assert materialize(build(src.where("chart_date <= date'2024-01-03'")), name, "incremental", base).count() == 3
    out = materialize(build(src), name, "incremental", base)
    assert sorted((r.chart_date.day, r.t) for r in out.collect()) == [(d, d) for d in range(1, 7)]
    view = materialize(src, f"v_{uuid.uuid4().hex[:8]}", "view")
    assert view.count() == 6


def test_stream_merges_late_file(spark):
    from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

    from sharelens.streaming.incremental import run_to_end, stream_daily_fact
    schema = StructType([StructField("g", StringType()), StructField("v", LongType()),
                         StructField("chart_date", DateType())])
    src, out, ckpt = scratch_path(spark, "s-src"), scratch_path(spark, "s-out"), scratch_path(spark, "s-ckpt")
    first = spark.createDataFrame([("x", 1, dt.date(2024, 1, d)) for d in (1, 2, 3)], schema)
    first.write.partitionBy("chart_date").parquet(src)

    def build(rows):
        return rows.groupBy("chart_date").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))

    run_to_end(stream_daily_fact(spark, src, schema, build, out, checkpoint=ckpt))
    late = spark.createDataFrame([("y", 10, dt.date(2024, 1, 2))], schema)
    late.write.mode("append").partitionBy("chart_date").parquet(src)
    run_to_end(stream_daily_fact(spark, src, schema, build, out, checkpoint=ckpt))
    got = {r.chart_date.day: (r.total, r.n) for r in spark.read.parquet(out).collect()}
    assert got == {1: (1, 1), 2: (11, 2), 3: (1, 1)}


def _partitioned(spark, values, kind, col="p"):
    """A table of one row for each partition value, v its place."""
    name, base = f"u_{uuid.uuid4().hex[:8]}", scratch_path(spark, "upsert")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"v int, {col} {kind}")
    replace_table(df, name, base, partition_by=[col])
    return name, base


@pytest.mark.parametrize("kind,values", [
    ("int", list(range(1, 13)) + [None]),
    ("int", [-12, -3, 0, 5, 100, 20, None]),
    ("bigint", [2, 10, 9, 100, 30]),
    ("date", [dt.date(2023, 12, 31), dt.date(2024, 1, 2), dt.date(2024, 1, 10), None]),
    ("string", ["2", "10", "a b", "it's", "x/y=z", "back\\slash", "é", "9", None]),
    ("decimal(6,2)", [Decimal(f"{x}.50") for x in (1, 2, 10, 9)]),
    ("boolean", [True, False, None]),
])
def test_upsert_compares_partitions_in_their_type(spark, kind, values):
    known = sorted((v for v in values if v is not None))
    for batch_values in ([known[0], known[1]], [known[-1]], [known[0], None], [None]):
        name, _ = _partitioned(spark, values, kind)
        before = {r["p"]: r["f"] for r in spark.table(name).select("p", F.input_file_name().alias("f")).collect()}
        upsert_range(spark.createDataFrame([(100 + i, v) for i, v in enumerate(batch_values)], f"v int, p {kind}"), name, "p")
        some = [v for v in batch_values if v is not None]
        gone = {v for v in known if some and min(some) <= v <= max(some)}
        want = [(i, v) for i, v in enumerate(values) if v not in gone] + [(100 + i, v) for i, v in enumerate(batch_values)]
        assert dict(spark.table(name).dtypes)["p"] == kind
        got = [(r["v"], r["p"]) for r in spark.table(name).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        after = {r["p"]: r["f"] for r in spark.table(name).select("p", F.input_file_name().alias("f")).collect()}
        assert all(after[v] == before[v] for v in before if v in after and v not in gone and v not in batch_values and v is not None)


def test_upsert_leaves_partitions_outside_the_batch(spark):
    name, _ = _partitioned(spark, range(1, 13), "int")
    upsert_range(spark.createDataFrame([(50, 1), (51, 2)], "v int, p int"), name, "p")
    assert sorted((r.p, r.v) for r in spark.table(name).collect()) == [(1, 50), (2, 51)] + [(p, p - 1) for p in range(3, 13)]


def test_upsert_that_dies_leaves_the_old_table(spark, monkeypatch):
    from sharelens.sources import tables

    batch = spark.createDataFrame([(50, 1), (51, 2)], "v int, p int")
    for step in ("_register_version", "partitions_of", "_add_partitions", "_point", "_new_version"):
        name, base = _partitioned(spark, range(1, 13), "int")
        before = sorted(map(tuple, spark.table(name).collect()))
        with monkeypatch.context() as m:
            m.setattr(tables, step, lambda *a: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(OSError, match="killed"):
                upsert_range(batch, name, "p")
        assert sorted(map(tuple, spark.table(name).collect())) == before
        upsert_range(batch, name, "p")                  # and the repeated batch succeeds
        upsert_range(batch, name, "p")
        assert sorted((r.p, r.v) for r in spark.table(name).collect())[:3] == [(1, 50), (2, 51), (3, 2)]
    bad = batch.withColumn("v", F.when(F.col("p") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="boom"):
        upsert_range(bad, name, "p")
    assert spark.table(name).count() == 12


def test_two_writers_do_not_lose_each_others_rows(spark, monkeypatch):
    from sharelens.sources import tables

    name, _ = _partitioned(spark, range(1, 5), "int")
    add = tables._add_partitions

    def slow(*args):
        monkeypatch.setattr(tables, "_add_partitions", add)
        upsert_range(spark.createDataFrame([(70, 4)], "v int, p int"), name, "p")      # the other writer
        add(*args)

    monkeypatch.setattr(tables, "_add_partitions", slow)
    with pytest.raises(RuntimeError, match="another writer"):
        upsert_range(spark.createDataFrame([(60, 1)], "v int, p int"), name, "p")
    assert sorted((r.p, r.v) for r in spark.table(name).collect()) == [(1, 0), (2, 1), (3, 2), (4, 70)]


def test_readers_of_a_partitioned_replace_see_whole_versions(spark):
    """A reader loop beside eight replaces and upserts: no error, and all rows of a read are of one version."""
    import threading

    name, base = f"r_{uuid.uuid4().hex[:8]}", scratch_path(spark, "readers")
    version = lambda n: spark.range(40).select(F.lit(n).alias("n"), (F.col("id") % 4).cast("int").alias("p"))
    replace_table(version(0), name, base, partition_by=["p"])
    seen, errors, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append({tuple(r) for r in spark.table(name).groupBy("n").count().collect()})
            except Exception as exc:  # noqa: BLE001
                errors.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 9):
        if n % 2:
            replace_table(version(n), name, base, partition_by=["p"])
        else:
            upsert_range(version(n), name, "p")
    done.set()
    reader.join()
    assert not errors
    assert seen and all(len(x) == 1 and next(iter(x))[1] == 40 for x in seen)
    assert len(set(map(frozenset, seen))) > 1


def test_old_versions_of_partitions_are_dropped(spark):
    name, base = _partitioned(spark, range(1, 7), "int")
    upsert_range(spark.createDataFrame([(60, 1)], "v int, p int"), name, "p")
    upsert_range(spark.createDataFrame([(61, 1), (62, 3)], "v int, p int"), name, "p")
    rows = sorted(map(tuple, spark.table(name).collect()))
    gone = drop_old_versions(spark, name, base)
    assert len(gone) == 4                                     # p=1..3 of the first version, the second version whole
    assert sorted(map(tuple, spark.table(name).collect())) == rows
    assert drop_old_versions(spark, name, base) == []
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect() if not r["isTemporary"]] != []
    append_rows(spark.createDataFrame([(9, 9)], "v int, p int"), name)
    assert (9, 9) in {tuple(r) for r in spark.table(name).collect()}
    with pytest.raises(ValueError, match="is partitioned"):
        replace_table(spark.range(3), name, base)


def test_range_replace_keeps_rows_without_a_date(spark):
    target = spark.createDataFrame([(None, "A", 1.0), (dt.date(2024, 1, 2), None, 2.0), (dt.date(2024, 1, 2), "B", 3.0)],
                                   "date date, ticker string, close double")
    batch = spark.createDataFrame([(dt.date(2024, 1, 2), None, 9.0), (None, "C", 8.0)], "date date, ticker string, close double")
    scoped = sorted(r.close for r in range_replace(target, batch, "date", ["ticker"]).collect())
    assert scoped == [1.0, 3.0, 8.0, 9.0]
    assert sorted(r.close for r in range_replace(target, batch, "date").collect()) == [1.0, 8.0, 9.0]
    assert sorted(r.close for r in range_replace(target, batch.where("date is null"), "date").collect()) == [1.0, 2.0, 3.0, 8.0]


def _grid(spark, table):
    """Rows of one page's table as lists of (column name, value)."""
    got = html_table_rows(spark.createDataFrame([(1, f"<p>x</p>{table}")], "k int, html string"), "html", ["k"]).collect()
    return [[(r.column_name, r.value) for r in sorted(got, key=lambda r: r.col_idx) if r.row_idx == i] for i in sorted({r.row_idx for r in got})]


def test_html_spans_fill_the_grid(spark):
    head = "<table><tr><th>a</th><th>b</th><th>c</th></tr>"
    named = lambda *rows: [list(zip("abc", r, strict=False)) for r in rows]
    cases = [
        ("<tr><td rowspan=2>x</td><td>1</td><td>p</td></tr><tr><td>2</td><td>q</td></tr>", named("x1p", "x2q")),
        ("<tr><td>1</td><td rowspan='3'>x</td><td>p</td></tr><tr><td>2</td><td>q</td></tr><tr><td>3</td><td>r</td></tr>",
         named("1xp", "2xq", "3xr")),
        ("<tr><td>1</td><td>2</td><td rowspan=\"2\">x</td></tr><tr><td>3</td><td>4</td></tr>", named("12x", "34x")),
        ("<tr><td colspan=2>w</td><td>1</td></tr><tr><td>2</td><td colspan=2>v</td></tr>", named("ww1", "2vv")),
        ("<tr><td colspan=2 rowspan=2>w</td><td>1</td></tr><tr><td>2</td></tr>", named("ww1", "ww2")),
        ("<tr><td rowspan=3>x</td><td>1</td><td>2</td></tr>", [*named("x12"), [("a", "x"), ("b", None), ("c", None)], [("a", "x"), ("b", None), ("c", None)]]),
        ("<tr><td rowspan=0>x</td><td colspan=0>gone</td><td>1</td><td>2</td></tr>", named("x12")),
        ("<tr><td>1<td>2<td>3<tr><td>4<td>5<td>6", named("123", "456")),
    ]
    for body, want in cases:
        for end in ("</table>", ""):
            assert _grid(spark, head + body + end) == want, body


def test_html_nested_tables_stay_in_their_cell(spark):
    page = ("<table><tr><th>a</th><th>b</th></tr><tr><td>1 <table><tr><td>in</td><td>ner</td></tr><tr><td><table><tr><td>deep</td></tr>"
            "</table></td></tr></table> end</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>"
            "<table><tr><td>second</td></tr></table>")
    assert _grid(spark, page) == [[("a", "1 innerdeep end"), ("b", "2")], [("a", "3"), ("b", "4")]]


def test_invalid_line_is_numbered_over_several_splits(spark):
    from sharelens.sources.ndjson import InvalidLine, invalid_lines, strict_load

    d = _local(spark, "bad")
    lines = [f'{{"id": "x{i}", "name": "{"n" * (i % 50)}"}}' for i in range(4000)]
    lines[17] = ""                                    # blank lines count, as in an editor
    for i in (2500, 2501, 3999):
        lines[i] = f'{{"id": "broken {i}"'
    _write_bytes(f"{d}/one", "\n".join(lines).encode())
    _write_bytes(f"{d}/two", ("\r\n".join(lines[:2600]) + "\n").encode())
    _write_bytes(f"{d}/fine", b'{"id": "a"}\n[1]\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(d).rdd.getNumPartitions() > 5
        got = sorted((r.file.rpartition("/")[2], r.line, r.text) for r in invalid_lines(spark, d).collect())
        assert got == [("one", 2501, lines[2500]), ("one", 2502, lines[2501]), ("one", 4000, lines[3999]),
                       ("two", 2501, lines[2500]), ("two", 2502, lines[2501])]
        with pytest.raises(InvalidLine, match="one, line 2501: .*broken 2500") as found:
            strict_load(spark, d, lambda df: df.count() and df.collect())
        assert (found.value.line, found.value.text) == (2501, lines[2500])
        assert strict_load(spark, f"{d}/fine", lambda df: df.count()) == 1
        with pytest.raises(ZeroDivisionError):
            strict_load(spark, d, lambda df: 1 / 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_of_two_loaders_at_once_one_loads(spark):
    import threading

    from sharelens.sources import tables
    from sharelens.sources.ndjson import load_dump_once

    d, base = _local(spark, "race"), scratch_path(spark, "race-tables")
    _write_bytes(f"{d}/dump/label", b'{"id": "a"}\n{"id": "b"}\n')
    _write_bytes(f"{d}/REPLICATION_SEQUENCE", b"7")
    name, ledger = f"l_{uuid.uuid4().hex[:8]}", f"g_{uuid.uuid4().hex[:8]}"
    args = (spark, f"{d}/dump", d, name, f"{base}/t", ledger, f"{base}/g", "labels")
    results, gate = [], threading.Barrier(4)

    def load():
        gate.wait()
        results.append(load_dump_once(*args))

    threads = [threading.Thread(target=load) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert results.count(True) == 1 and len(results) == 4
    assert spark.table(name).count() == 2 and spark.table(ledger).count() == 1
    assert load_dump_once(*args) is False
    _write_bytes(f"{d}/REPLICATION_SEQUENCE", b"8")
    with tables.claim(spark, f"{base}/g", "labels") as mine:      # another loader holds the dataset
        assert mine and load_dump_once(*args) is False
    assert load_dump_once(*args) is True
    _write_bytes(f"{d}/REPLICATION_SEQUENCE", b"9")
    _write_bytes(f"{d}/dump/label", b'{"id": "a"}\n{"id"\n')
    with pytest.raises(Exception, match="line 2"):
        load_dump_once(*args)
    assert spark.table(name).count() == 2                          # a failed load leaves table and claim as they were
    assert tables.drop_claim(spark, f"{base}/g", "labels") is False


def test_late_metadata_rebuilds_only_the_dates_it_touches(spark):
    from sharelens.plans.market_share import refresh_enriched, share_fact, touched_dates

    path = scratch_path(spark, "late")
    day = lambda d: dt.date(2024, 1, d)
    charts = spark.createDataFrame([("A - one", 10, day(1)), ("A - two", 20, day(2)), ("B - three", 30, day(3)), ("A - one", 5, day(3)),
                                    ("C - four", 7, day(4)), ("a -  TWO!", 2, day(5)), ("D - five", 1, day(6))],
                                   "artist_and_title string, streams long, chart_date date")
    schema = "track_name string, artist_name string, label string, track_id string, updated_at timestamp"
    stamp = dt.datetime(2024, 2, 1)
    meta = spark.createDataFrame([("one", "A", None, "t1", stamp), ("three", "B", "Kona", "t3", stamp), ("four", "C", "Kona", "t4", stamp)], schema)
    dim = spark.createDataFrame([("kona", "G", "P", "l1"), ("lima", "H", "Q", "l2")],
                                "normalized_label string, market_share_group string, ultimate_parent_name string, label_id string")
    fact = lambda m, c=charts: share_fact(c, m, dim, ())
    incremental_append(lambda since: fact(meta, charts.where(F.col("chart_date") > since).where("chart_date < date'2024-01-06'")), path)
    files = lambda: {r.d: r.f for r in spark.read.parquet(path).select(F.col("chart_date").alias("d"), F.input_file_name().alias("f")).collect()}
    before = files()
    # a title found, a label that changes by its track id, and a title that charts only after the high-water mark
    late = spark.createDataFrame([("two", "A", "Lima", "t2", stamp), ("other name", "C", "Lima", "t4", dt.datetime(2024, 3, 1)),
                                  ("five", "D", "Lima", "t5", stamp), ("absent", "Z", "Lima", "t9", stamp), ("no id", "B", "Lima", None, stamp)], schema)
    both = meta.unionByName(late)
    assert {r[0].day for r in touched_dates(charts, both, late).collect()} == {2, 4, 5, 6}
    days = refresh_enriched(charts, both, late, dim, path, ())
    assert {r[0].day for r in days.collect()} == {2, 4, 5}
    after = files()
    assert {d.day for d in before if before[d] != after[d]} == {2, 4, 5}
    want = sorted(map(tuple, fact(both, charts.where("chart_date < date'2024-01-06'")).collect()))
    got = sorted(map(tuple, spark.read.parquet(path).select(*fact(both).columns).collect()))
    assert got == want
    assert want != sorted(map(tuple, fact(meta, charts.where("chart_date < date'2024-01-06'")).collect()))


def test_a_cell_is_read_once(spark):
    """No expression of the cells stands twice in the plan (they are evaluated as often as they stand there)."""
    df = spark.createDataFrame([("k", "<table><tr><th>A B</th></tr><tr><td>x&nbsp; \n&#x3c;<i>y</i></td></tr></table>")], "k string, html string")
    out = html_table_rows(df, "html", ["k"])
    assert [(r.column_name, r.value) for r in out.collect()] == [("a_b", "x <y")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?s)<[^>]*>") == 2 and plan.count("(?=<t[hd]") == 1       # one for cells, one for inner tables


def test_metadata_with_keys_is_not_staged_again(spark):
    from sharelens.operators.staging import stage_metadata
    from sharelens.plans.market_share import staged_once
    raw = spark.createDataFrame([("A", "B", "L Inc", "T1", dt.datetime(2024, 1, 1)), ("A", "B", "L", None, dt.datetime(2024, 1, 1))],
                                "track_name string, artist_name string, label string, track_id string, updated_at timestamp")
    staged = staged_once(raw)
    assert staged_once(staged) is staged and staged.collect() == stage_metadata(raw).collect()
