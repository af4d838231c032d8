"""Which columns must be filled and which must be unique."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from cratewise.operators import quality

# Checks by published table.
NOT_NULL = {
    "stg_spotify_saved_tracks": ["track_id", "added_at"],
    "stg_spotify_track_artists": ["id", "track_id", "artist_id"],
    "stg_spotify_musicbrainz_map": ["track_id"],
    "stg_musicbrainz_enrichment_queue": ["track_id", "isrc"],
    "stg_musicbrainz_recordings": ["recording_mbid"],
    "stg_musicbrainz_recording_metadata": ["recording_mbid"],
    "stg_musicbrainz_artists": ["artist_mbid"],
    "stg_musicbrainz_releases": ["release_mbid"],
    "stg_musicbrainz_works": ["work_mbid"],
    "stg_musicbrainz_work_writers": ["work_mbid"],
    "int_playlist_ready_tracks_base": ["id", "track_id"],
    "int_playlist_entity_context_base": ["id", "track_id"],
    "int_track_instrument": ["track_id", "instrument_name"],
    "fct_playlist_ready_tracks": ["id", "track_id", "updated_at"],
    "fct_playlist_entity_context": ["id", "track_id", "updated_at"],
    "fct_artist_stats": ["id", "artist_id"],
    "dim_favorite_artist": ["id"],
    "fct_track_duplicates": ["id", "isrc", "duplicate_occurrences"],
}
UNIQUE = {
    "stg_spotify_saved_tracks": ["track_id"],
    "stg_spotify_track_artists": ["id"],
    "stg_spotify_musicbrainz_map": ["track_id"],
    "stg_musicbrainz_enrichment_queue": ["track_id"],
    "stg_musicbrainz_recordings": ["recording_mbid"],
    "int_playlist_ready_tracks_base": ["id"],
    "int_playlist_entity_context_base": ["id"],
    "fct_playlist_ready_tracks": ["id", "track_id"],
    "fct_playlist_entity_context": ["id", "track_id"],
    "fct_artist_stats": ["id"],
    "dim_favorite_artist": ["id"],
    "fct_track_duplicates": ["id", "isrc"],
}


def not_null_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows without a value, per checked table and column."""
    reports = [
        quality.not_null(tables[table], table, columns)
        for table, columns in NOT_NULL.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def unique_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated values, per checked table and column."""
    reports = [
        quality.unique(tables[table], table, columns) for table, columns in UNIQUE.items()
    ]
    return reduce(DataFrame.unionByName, reports)

