"""Staging projections (P4, P5, P12, P13): rename, key columns, filters, key maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize_label, normalize_text, split_title


def rename(df: DataFrame, mapping: Mapping[str, str], keep_rest: bool = False) -> DataFrame:
    """Select-and-alias (P4); other columns are dropped unless ``keep_rest``."""
    cols = [F.col(src).alias(dst) for src, dst in mapping.items()]
    if keep_rest:
        cols += [F.col(c) for c in df.columns if c not in mapping]
    return df.select(*cols)


def map_keys(c: str | Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Literal key map as a native map lookup (P13); unmapped keys -> ``default``.

    By name, never by position, so a missing key cannot shift the others.
    """
    key = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    # element_at on a missing key raises under ANSI: guard with map_contains_key
    got = F.when(F.map_contains_key(m, key), F.element_at(m, key))
    return F.coalesce(got, F.lit(default)) if default is not None else got


def in_groups(c: str | Column, groups: Sequence[str]) -> Column:
    """IN-list filter."""
    return (F.col(c) if isinstance(c, str) else c).isin(list(groups))


def stage_charts(charts: DataFrame, title_col: str = "artist_and_title",
                 streams_col: str = "streams", date_col: str = "chart_date",
                 extracted_col: str = "extracted_at") -> DataFrame:
    """Chart rows -> chart_date, artist_name, track_name, daily_streams, extracted_at."""
    artist, track = split_title(title_col)
    return charts.select(
        F.col(date_col).alias("chart_date"),
        artist.alias("artist_name"),
        track.alias("track_name"),
        F.col(streams_col).alias("daily_streams"),
        F.col(extracted_col).alias("extracted_at"),
    )


def stage_metadata(meta: DataFrame, track: str = "track_name", artist: str = "artist_name",
                   track_id: str = "track_id", label: str = "label") -> DataFrame:
    """Track metadata with normalised keys, rows without a track id dropped (P5)."""
    return (meta.where(F.col(track_id).isNotNull())
            .withColumns({
                "normalized_track_name": normalize_text(track),
                "normalized_artist_name": normalize_text(artist),
                "normalized_label": normalize_label(label),
            }))
