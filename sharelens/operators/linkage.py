"""Linking chart rows to track metadata and labels.

The reference joins on keys that are not unique on the right side, so one
chart row can fan out into several rows and inflate sums.  Every join here
takes ``strict``: ``True`` (default) first reduces the right side to one row
per key with a total order and sends no empty key into the match;
``False`` reproduces the fan-out, not by multiplying rows but by counting
them: equal right-hand rows are one row with its number of matches, which the
caller multiplies into its sums.

Column names are arguments; the defaults are the library's own names.

Scale: the metadata and label sides grow with the data, so nothing is
broadcast by hint; AQE turns a join into a broadcast only when the runtime
size of a side is below its threshold.  The empty key '' (names made only of
a suffix or non-Latin letters) would be one hot key holding a large share of
titles and labels: strict mode drops it before the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import normalize_label, normalize_text

TRACK_KEY, ARTIST_KEY, LABEL_KEY = "normalized_track_name", "normalized_artist_name", "normalized_label"


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the latest ``order_col``, ties by ``tiebreak``.

    ``row_number() = 1`` is planned as a WindowGroupLimit, so each task keeps
    one row per key before the shuffle."""
    order = [F.col(order_col).desc_nulls_last()]
    order += [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def title_tracks(titles: DataFrame, metadata: DataFrame, track: str = "track_name", artist: str = "artist_name",
                 track_id: str = "track_id", updated: str = "updated_at", strict: bool = True) -> DataFrame:
    """Distinct titles with their normalised keys and the track id of the latest
    metadata row of these keys (J1 + W1).  ``metadata`` is staged (it has the keys)."""
    keys = [TRACK_KEY, ARTIST_KEY]
    keyed = titles.withColumns({TRACK_KEY: normalize_text(track), ARTIST_KEY: normalize_text(artist)})
    m = metadata.select(*keys, track_id, updated)
    if strict:
        m = m.where((F.col(TRACK_KEY) != "") & (F.col(ARTIST_KEY) != ""))
    return keyed.join(latest_per_key(m, keys, updated, [track_id]).select(*keys, track_id), keys, "left")


def link_tracks(charts: DataFrame, metadata: DataFrame, track: str = "track_name", artist: str = "artist_name",
                track_id: str = "track_id", updated: str = "updated_at", strict: bool = True) -> DataFrame:
    """Charts with normalised keys, left-joined to the latest metadata row per
    key for its track id (J1 + W1).

    Keys depend only on the (track, artist) title, and a title repeats on
    every day it charts: the regex work and the metadata match run once per
    distinct title (map-side distinct first), then one null-safe join hangs
    the result on the chart rows -- still a single shuffle of chart rows, or
    none when AQE finds the title map small enough to broadcast.
    """
    title_map = title_tracks(charts.select(track, artist).distinct(), metadata, track, artist, track_id, updated, strict)
    title_map = title_map.select(F.col(track).alias("_t"), F.col(artist).alias("_a"), TRACK_KEY, ARTIST_KEY, track_id)
    on = charts[track].eqNullSafe(title_map["_t"]) & charts[artist].eqNullSafe(title_map["_a"])
    return charts.join(title_map, on, "left").drop("_t", "_a")


def track_labels(linked: DataFrame, metadata: DataFrame, track_id: str = "track_id", label: str = "label",
                 updated: str = "updated_at", strict: bool = True, out: str = "original_label") -> DataFrame:
    """Left join on track id to the label string and its key.

    ``label_matches`` is the number of metadata rows behind a result row (1
    in strict mode and without a match)."""
    m = metadata.select(track_id, LABEL_KEY, F.col(label).alias(out), updated)
    if strict:
        m = latest_per_key(m, [track_id], updated, [out]).drop(updated).withColumn("label_matches", F.lit(1).cast("long"))
    else:
        m = m.groupBy(track_id, LABEL_KEY, out).agg(F.count(F.lit(1)).alias("label_matches"))
    return linked.join(m, track_id, "left").withColumn("label_matches", F.coalesce("label_matches", F.lit(1).cast("long")))


def hierarchy_groups(joined: DataFrame, labels: DataFrame, group: str = "market_share_group", id_col: str = "label_id",
                     parent: str = "ultimate_parent_name", strict: bool = True, out: str = "hierarchy_group") -> DataFrame:
    """Left join on the normalised label key to the label dimension.

    ``group_matches`` is the number of labels behind a result row (1 in strict
    mode and without a match).  Strict mode takes one label per key, the
    smallest ``id_col``, and none for the empty key; otherwise the labels of a
    key count as one row for each (group, parent) among them."""
    lab = labels.select(F.col(LABEL_KEY).alias("_k"), F.col(group).alias(out), parent, id_col)
    if strict:
        w = Window.partitionBy("_k").orderBy(*[F.col(c).asc_nulls_last() for c in (id_col, out, parent)])
        lab = (lab.where(F.col("_k") != "").withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
               .drop("_rn", id_col).withColumn("group_matches", F.lit(1).cast("long")))
    else:
        lab = lab.groupBy("_k", out, parent).agg(F.count(F.lit(1)).alias("group_matches"))
    got = joined.join(lab, joined[LABEL_KEY] == lab["_k"], "left").drop("_k")
    return got.withColumn("group_matches", F.coalesce("group_matches", F.lit(1).cast("long")))


def _label_counts(charts: DataFrame, metadata: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """A row for each title: its chart rows, and how many rows without a label
    the exact-name left join gives it (1 where nothing matches).  Both sides
    are aggregated before they meet."""
    m = metadata.groupBy(*keys).agg((F.count(F.lit(1)) - F.count(label)).alias("_unlabelled"))
    c = charts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return c.join(m, list(keys), "left").withColumn("_unlabelled", F.coalesce("_unlabelled", F.lit(1).cast("long")))


def missing_keys(charts: DataFrame, metadata: DataFrame, keys: Sequence[str] = ("track_name", "artist_name"),
                 label: str = "label", limit: int | None = None) -> DataFrame:
    """Distinct titles whose exact-name metadata has no label -- unmatched, or
    matched to a row with a NULL label (J4).  ``limit`` keeps the first titles
    in key order (O2)."""
    x = _label_counts(charts, metadata, keys, label).where(F.col("_unlabelled") > 0).select(*keys)
    if limit is None:
        return x
    return x.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(limit)


def count_missing(charts: DataFrame, metadata: DataFrame, keys: Sequence[str] = ("track_name", "artist_name"),
                  label: str = "label") -> DataFrame:
    """Rows without a label in the exact-name left join of charts and metadata (J4 count)."""
    x = _label_counts(charts, metadata, keys, label)
    return x.agg(F.coalesce(F.sum(F.col("_rows") * F.col("_unlabelled")), F.lit(0).cast("long")).alias("missing_rows"))


def enrich_from_catalogue(missing: DataFrame, catalogue: DataFrame, as_of: Column | None = None,
                          keys: Sequence[str] = ("track_name", "artist_name"), label: str = "label",
                          track_id: str = "track_id", released: str = "released_at") -> DataFrame:
    """Look the missing keys up in a catalogue DataFrame (S14): the first hit
    per key -- latest catalogue row, ties by track id, label -- gives label and
    track id, stamped ``as_of`` (default: now).  No hit, no row."""
    hits = missing.select(*keys).join(catalogue.select(*keys, label, track_id, released), list(keys))
    first = latest_per_key(hits, keys, released, [track_id, label])
    stamp = as_of if as_of is not None else F.current_timestamp()
    return first.select(*keys, label, track_id, stamp.alias("updated_at"))


def lookup_counts(missing: DataFrame, catalogue: DataFrame, keys: Sequence[str] = ("track_name", "artist_name"),
                  label: str = "label") -> DataFrame:
    """One row: keys looked up, keys with a hit, without one (NULL keys never
    hit), and hits that fail because no catalogue row of the key has a label (S14)."""
    c = catalogue.groupBy(*keys).agg(F.count(label).alias("_labels"))
    x = missing.select(*keys).join(c, list(keys), "left")
    n = lambda cond: F.count(F.when(cond, 1))
    return x.agg(F.count(F.lit(1)).alias("n_keys"), n(F.col("_labels") > 0).alias("n_hits"),
                 n(F.col("_labels").isNull()).alias("n_misses"), n(F.col("_labels") == 0).alias("n_failed"))


def normalized_labels(dim: DataFrame, name_col: str = "label_name") -> DataFrame:
    """Label dimension with its normalised key."""
    return dim.withColumn(LABEL_KEY, normalize_label(name_col))
