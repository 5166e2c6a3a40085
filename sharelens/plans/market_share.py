"""End-to-end share fact (E1) and its incremental form.

charts -> (day, title) sums -> split title (P1) -> keys (P2) -> latest
metadata per key (W1, J1) -> label string (J2) -> label dimension (J3) ->
direct rules (P10) -> resolution (P11) -> day x group aggregate, share (A1, W3).

Chart rows are added up to (day, title) first, map-side combined; what follows
reads that result.  Every lookup depends only on the title, so all of them run
once for each distinct title.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import split_title
from ..functions.rules import LABEL_STRING_RULES, RuleTable, label_string_group, resolve_group
from ..operators.linkage import ARTIST_KEY, TRACK_KEY, hierarchy_groups, title_tracks, track_labels
from ..operators.share import share_of_total
from ..operators.staging import stage_metadata
from ..session import cut_lineage
from ..sources.tables import high_water_mark, write_partitions

FACT_COLUMNS = ["chart_date", "parent_group", "total_streams", "track_count", "row_count", "market_share_pct"]


def staged_once(metadata: DataFrame) -> DataFrame:
    """The metadata with its keys, computed once; metadata that has them already is taken as it is."""
    return metadata if TRACK_KEY in metadata.columns else cut_lineage(stage_metadata(metadata))


def title_groups(titles: DataFrame, metadata: DataFrame, labels: DataFrame, rules: RuleTable = LABEL_STRING_RULES,
                 strict: bool = True, title_col: str = "artist_and_title") -> DataFrame:
    """Each distinct title with its track, label, hierarchy group and parent
    group; ``matches`` counts the joined rows it stands for (always 1 in
    strict mode).  ``metadata`` is staged."""
    artist, track = split_title(title_col)
    named = titles.select(title_col, artist.alias("artist_name"), track.alias("track_name"))
    linked = title_tracks(named, metadata, strict=strict)
    joined = hierarchy_groups(track_labels(linked, metadata, strict=strict), labels, strict=strict)
    group = resolve_group(label_string_group("original_label", rules), "hierarchy_group")
    return joined.select(title_col, "track_id", F.col("original_label").alias("label"), "hierarchy_group",
                         group.alias("parent_group"), (F.col("label_matches") * F.col("group_matches")).alias("matches"))


def share_fact(charts: DataFrame, metadata: DataFrame, labels: DataFrame,
               rules: RuleTable = LABEL_STRING_RULES, strict: bool = True,
               since: Column | None = None) -> DataFrame:
    """``chart_date, parent_group, total_streams, track_count, row_count,
    market_share_pct``.  ``since`` filters chart dates at the chart scan;
    ``metadata`` may be staged already, so that several facts share its keys.

    ``strict=False`` reproduces the fan-out: a title's sums count once for
    each of its joined rows."""
    if since is not None:
        charts = charts.where(F.col("chart_date") > since)
    daily = cut_lineage(charts.groupBy("chart_date", "artist_and_title").agg(
        F.sum("streams").alias("_streams"), F.count(F.lit(1)).alias("_rows")))
    meta = staged_once(metadata)
    groups = title_groups(daily.select("artist_and_title").distinct(), meta, labels, rules, strict)
    groups = groups.groupBy(F.col("artist_and_title").alias("_title"), "track_id", "parent_group").agg(
        F.sum("matches").alias("_m"))
    x = daily.join(groups, daily["artist_and_title"].eqNullSafe(groups["_title"]), "left")
    fact = x.groupBy("chart_date", "parent_group").agg(
        F.sum(F.col("_streams") * F.col("_m")).alias("total_streams"), F.count_distinct("track_id").alias("track_count"),
        F.sum(F.col("_rows") * F.col("_m")).alias("row_count"))
    return fact.withColumn("market_share_pct", share_of_total("total_streams", ["chart_date"])).select(*FACT_COLUMNS)


def touched_dates(charts: DataFrame, metadata: DataFrame, appended: DataFrame,
                  title_col: str = "artist_and_title", date_col: str = "chart_date") -> DataFrame:
    """The dates whose fact rows can change because ``appended`` was added to the metadata.

    keys -> titles -> dates: a title is touched if a new row has its normalised
    keys, which can change its track, or its track's id, which can change the
    label.  ``metadata`` holds the new rows already.  Chart rows are reduced to
    distinct (title, date) before anything is joined."""
    days = cut_lineage(charts.select(title_col, date_col).distinct())
    artist, track = split_title(title_col)
    named = days.select(title_col).distinct().select(title_col, artist.alias("artist_name"), track.alias("track_name"))
    linked = cut_lineage(title_tracks(named, staged_once(metadata)))
    new = cut_lineage(staged_once(appended).select(TRACK_KEY, ARTIST_KEY, "track_id").distinct())
    by_key = linked.join(new.select(TRACK_KEY, ARTIST_KEY).distinct(), [TRACK_KEY, ARTIST_KEY], "left_semi")
    by_track = linked.join(new.select("track_id").distinct(), "track_id", "left_semi")
    titles = by_key.select(F.col(title_col).alias("_title")).unionByName(by_track.select(F.col(title_col).alias("_title"))).distinct()
    return days.join(titles, days[title_col].eqNullSafe(titles["_title"]), "left_semi").select(date_col).distinct()


def refresh_enriched(charts: DataFrame, metadata: DataFrame, appended: DataFrame, labels: DataFrame, path: str,
                     rules: RuleTable = LABEL_STRING_RULES, strict: bool = True) -> DataFrame:
    """Rebuild the dates of the fact at ``path`` that late metadata touches; returns these dates.

    Only their partitions are computed and written; dates after the fact's
    high-water mark are left to the next incremental run."""
    mark = high_water_mark(charts.sparkSession, path)
    past, metadata = charts.where(F.col("chart_date") <= F.lit(mark)), staged_once(metadata)
    days = cut_lineage(touched_dates(past, metadata, appended))
    write_partitions(share_fact(past.join(days, "chart_date", "left_semi"), metadata, labels, rules, strict), path, "chart_date")
    return days
