"""Scored tables at track grain, artist figures, duplicates and instruments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.lists import joined
from cratewise.functions.moments import days_until, or_never
from cratewise.functions.text import normalize_label
from cratewise.operators.lists import assembled, ordered_elements
from cratewise.operators.skew import HOT_GROUP_ROWS, lookup, repeated_groups, splittable
from cratewise.plans import recordings, works

# Parts of the tracks over which an artist's figures are kept.
ARTIST_PARTS = 64

# Score weights, decimal so that rounding is exact.
FRESHNESS = "greatest(0, 100 - least(days_since_added, 100))"
FIT_SCORE = f"""
    round(popularity * 0.6 + {FRESHNESS} * 0.4
          + if(recording_mbid is not null, 5, 0)
          - if(explicit, 10, 0), 2)
"""
AUTO_SCORE = f"""
    round(popularity * 0.55 + {FRESHNESS} * 0.35
          + if(recording_mbid is not null, 4, 0)
          + if(has_single_release, 1.5, 0) + if(has_album_release, 1, 0)
          - if(explicit, 10, 0), 2)
"""

# Columns of the two track tables, in their published order.
READY_COLUMNS = [
    "id",
    "track_id",
    "track_name",
    "isrc",
    "artist_names",
    "album_name",
    "album_release_date",
    "added_at",
    "spotify_updated_at",
    "duration_ms",
    "explicit",
    "popularity",
    "recording_mbid",
    "musicbrainz_map_updated_at",
    "mb_recording_title",
    "mb_primary_artist_name",
    "mb_release_title",
    "mb_release_date",
    "mb_disambiguation",
    "musicbrainz_recording_updated_at",
    "top_genre",
    "top_style",
    "genre_list_json",
    "style_list_json",
    "instrument_list_json",
    "primary_work_mbid",
    "primary_work_title",
    "work_writer_list_json",
    "is_cover",
    "cover_of_recording_mbid",
    "cover_of_recording_title",
    "covered_by_recordings_json",
    "musicbrainz_metadata_updated_at",
    "updated_at",
    "days_since_added",
    "freshness_score",
    "playlist_fit_score",
]
CONTEXT_COLUMNS = [
    "id",
    "track_id",
    "track_name",
    "isrc",
    "artist_names",
    "spotify_primary_artist_name",
    "album_name",
    "album_release_date",
    "added_at",
    "spotify_updated_at",
    "explicit",
    "popularity",
    "recording_mbid",
    "musicbrainz_map_updated_at",
    "mb_recording_title",
    "mb_primary_artist_name",
    "mb_release_title",
    "mb_release_date",
    "mb_disambiguation",
    "musicbrainz_recording_updated_at",
    "top_genre",
    "top_style",
    "genre_list_json",
    "style_list_json",
    "instrument_list_json",
    "primary_work_mbid",
    "primary_work_title",
    "is_cover",
    "cover_of_recording_mbid",
    "cover_of_recording_title",
    "covered_by_recordings_json",
    "musicbrainz_metadata_updated_at",
    "first_release_date",
    "latest_release_date",
    "release_titles",
    "release_group_types",
    "has_single_release",
    "has_album_release",
    "releases_updated_at",
    "writer_names",
    "writer_roles",
    "writers_updated_at",
    "updated_at",
    "days_since_added",
    "freshness_score",
    "auto_playlist_score",
]


def credit_lines(credits: DataFrame) -> DataFrame:
    """Artist names of every track in credit order.

    The credits of a track come from one document and replace each other as a whole, so
    a track's list is as small as the document it was read from.
    """
    entries = "sort_array(collect_list(struct(isnull(artist_order), artist_order, artist_name)))"
    line = joined(f"{entries}.artist_name", ", ")
    return credits.groupBy("track_id").agg(F.expr(line).alias("credit_line"))


def matched_tracks(
    tracks: DataFrame, credits: DataFrame, matches: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """Saved tracks with their credit line and match; one row per saved track."""
    found = matches.select("track_id", "recording_mbid", "musicbrainz_map_updated_at")
    return (
        tracks.join(credit_lines(credits), "track_id", "left")
        .join(found, "track_id", "left")
        .withColumns(
            {
                "artist_names": F.coalesce("credit_line", "primary_artist_name"),
                "spotify_primary_artist_name": F.col("primary_artist_name"),
                "popularity": F.coalesce("popularity", F.lit(0)),
                "days_since_added": days_until(as_of, F.col("added_at")),
            }
        )
    )


def scored_tracks(
    tracks: DataFrame, credits: DataFrame, matches: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """Tracks with the score for picking playlists, without what only documents tell."""
    return _scored(matched_tracks(tracks, credits, matches, as_of), "playlist_fit_score", FIT_SCORE)


def profiles(documents: DataFrame, work_documents: DataFrame) -> DataFrame:
    """Every recording with the figures of its work: what the track tables tell of it."""
    figures = works.writer_figures(work_documents)
    return lookup(
        recordings.profiles(documents),
        splittable(figures.withColumnRenamed("work_mbid", "primary_work_mbid")),
        "primary_work_mbid",
        spread_by="recording_mbid",
    )


def track_context(
    tracks: DataFrame,
    credits: DataFrame,
    matches: DataFrame,
    profiled: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """Saved tracks with all that is known of their match; one row per saved track.

    Three inputs meet on the track, then the profiles on the recording. Work figures have
    joined the recordings, of which there are fewer, before those meet the tracks.
    """
    matched = matched_tracks(tracks, credits, matches, as_of)
    return lookup(matched, profiled, "recording_mbid", spread_by="track_id")


def aged(context: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Stored track rows as of another day."""
    return context.withColumn("days_since_added", days_until(as_of, F.col("added_at")))


def ready_tracks(context: DataFrame) -> DataFrame:
    """Tracks with the score for picking playlists."""
    latest = _latest_update("named_writers_updated_at")
    return _scored(context.withColumn("updated_at", latest), "playlist_fit_score", FIT_SCORE).select(
        *READY_COLUMNS
    )


def entity_context(context: DataFrame) -> DataFrame:
    """Tracks with releases, writers and the score for automatic playlists."""
    latest = _latest_update("releases_updated_at", "writers_updated_at")
    return _scored(
        context.withColumn("updated_at", latest), "auto_playlist_score", AUTO_SCORE
    ).select(*CONTEXT_COLUMNS)


def track_instruments(
    matches: DataFrame, latest_recordings: DataFrame, strip_wrappers: bool = False
) -> DataFrame:
    """Normalised instrument names per track, one row each."""
    lists = instrument_lists(matches, latest_recordings, strip_wrappers)
    return lists.select(
        "track_id", F.explode_outer("instrument_names").alias("instrument_name")
    ).where("instrument_name is not null")


def instrument_lists(
    matches: DataFrame, latest_recordings: DataFrame, strip_wrappers: bool = False
) -> DataFrame:
    """Distinct normalised instrument names of every matched track, in order, maybe none.

    Names are cleaned once per recording; a track has one match, so the list is whole.
    """
    cleaned = F.transform("instruments", lambda name: normalize_label(name, strip_wrappers))
    names = F.array_sort(F.array_distinct(F.filter(cleaned, lambda name: name != "")))
    listed = recordings.instruments(latest_recordings).select(
        "recording_mbid", names.alias("instrument_names")
    )
    named = matches.select("track_id", "recording_mbid")
    return named.join(splittable(listed), "recording_mbid").select("track_id", "instrument_names")


def artist_stats(credits: DataFrame, tracks: DataFrame) -> DataFrame:
    """Saved tracks, popularity and saving period of every artist."""
    facts = tracks.select("track_id", "popularity", "added_at")
    return (
        credits.select("artist_id", "artist_name", "track_id")
        .join(facts, "track_id", "left")
        .groupBy("artist_id", "artist_name")
        .agg(
            F.countDistinct("track_id").alias("saved_track_count"),
            F.avg(F.col("popularity").cast("double")).alias("avg_popularity"),
            F.min("added_at").alias("first_saved_at"),
            F.max("added_at").alias("last_saved_at"),
        )
        .select(F.col("artist_id").alias("id"), "*")
    )


def artist_parts(credits: DataFrame, tracks: DataFrame, parts: int = ARTIST_PARTS) -> DataFrame:
    """Figures of every artist over parts of the tracks, which add up to ``artist_stats``.

    A track lies in one part, so counts of distinct tracks can be summed.
    """
    facts = tracks.select("track_id", "popularity", "added_at")
    popularity = F.col("popularity").cast("double")
    return (
        credits.select("artist_id", "artist_name", "track_id", part_of("track_id", parts))
        .join(facts, "track_id", "left")
        .groupBy("artist_id", "artist_name", "part")
        .agg(
            F.countDistinct("track_id").alias("tracks"),
            F.sum(popularity).alias("popularity"),
            F.count(popularity).alias("rated"),
            F.min("added_at").alias("first_saved_at"),
            F.max("added_at").alias("last_saved_at"),
        )
    )


def part_of(key: str, parts: int = ARTIST_PARTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part")


def merged_artist_stats(parts: DataFrame) -> DataFrame:
    """``artist_stats`` from stored parts."""
    return (
        parts.groupBy("artist_id", "artist_name")
        .agg(
            F.sum("tracks").alias("saved_track_count"),
            (F.sum("popularity") / F.sum(F.nullif("rated", F.lit(0)))).alias("avg_popularity"),
            F.min("first_saved_at").alias("first_saved_at"),
            F.max("last_saved_at").alias("last_saved_at"),
        )
        .select(F.col("artist_id").alias("id"), "*")
    )


def favorite_artist(stats: DataFrame) -> DataFrame:
    """The artist with the most saved tracks."""
    return stats.orderBy(
        F.col("saved_track_count").desc(),
        F.col("avg_popularity").desc_nulls_last(),
        F.col("artist_id").asc_nulls_last(),
        F.col("artist_name").asc_nulls_last(),
    ).limit(1)


def isrc_duplicates(tracks: DataFrame) -> DataFrame:
    """Codes saved more than once, with their number of tracks; one row per code.

    Tracks without a code form one group, as published.
    """
    counts = tracks.groupBy("isrc").agg(F.count(F.lit(1)).alias("duplicate_occurrences"))
    return counts.where("duplicate_occurrences > 1").select(
        F.col("isrc").alias("id"), "isrc", "duplicate_occurrences"
    )


def isrc_duplicate_albums(tracks: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Albums of the codes saved more than once, newest first; one row per track.

    The group without a code can hold much of the library, so no list is put in a cell.
    """
    # Two columns without NULL stand for the code, so that join and order share a shuffle.
    rows = tracks.select(
        F.coalesce("isrc", F.lit("")).alias("code"),
        F.col("isrc").isNotNull().alias("is_coded"),
        "added_at",
        "track_id",
        "album_name",
        "album_release_date",
    )
    repeated, hot = repeated_groups(rows, ["code", "is_coded"], "duplicate_occurrences", hot_rows)
    listed = ordered_elements(
        repeated,
        ["code", "is_coded"],
        [F.col("added_at").desc_nulls_last(), F.col("track_id").asc()],
        {
            "album_name": F.col("album_name"),
            "album_release_date": F.col("album_release_date"),
        },
        hot,
        hot_rows,
    )
    code = F.when(F.col("is_coded"), F.col("code"))
    return listed.select(
        code.alias("isrc"), "position", "album_name", "album_release_date"
    )


def isrc_duplicate_arrays(albums: DataFrame) -> DataFrame:
    """Codes saved more than once in the published shape, their albums as arrays, newest first.

    ``albums`` is the table above. A group too large for a cell stops the query by name.
    """
    values = ["album_name", "album_release_date"]
    lists = assembled(albums, ["isrc"], values)
    return lists.select(
        F.col("isrc").alias("id"),
        "isrc",
        F.col("elements.album_name").alias("album_names"),
        F.col("elements.album_release_date").alias("album_release_dates"),
        F.size("elements").cast("bigint").alias("duplicate_occurrences"),
    )


def _latest_update(*more: str) -> Column:
    times = [
        "spotify_updated_at",
        "musicbrainz_map_updated_at",
        "musicbrainz_recording_updated_at",
        "musicbrainz_metadata_updated_at",
        *more,
    ]
    return F.greatest(*[or_never(F.col(name)) for name in times])


def _scored(df: DataFrame, name: str, score: str) -> DataFrame:
    return df.withColumns(
        {"freshness_score": F.expr(FRESHNESS), name: F.expr(score).cast("double")}
    )
