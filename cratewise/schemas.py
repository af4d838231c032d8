"""Column layout of the landing tables and of the JSON documents they carry."""

from __future__ import annotations

# Landing tables, column names and types in landing order.
SAVED_TRACKS = """
    track_id STRING, added_at STRING, track_name STRING, isrc STRING,
    album_id STRING, album_name STRING, album_release_date STRING,
    album_total_tracks INT, track_number INT, disc_number INT, duration_ms INT,
    explicit BOOLEAN, popularity INT, is_local BOOLEAN,
    primary_artist_id STRING, primary_artist_name STRING,
    spotify_track_url STRING, ingest_run_at STRING
"""

TRACK_ARTISTS = """
    track_id STRING, artist_id STRING, artist_name STRING, artist_order INT,
    ingest_run_at STRING
"""

ISRC_CANDIDATES = """
    track_id STRING, isrc STRING, recording_mbid STRING, match_rank INT,
    matched_at STRING, isrc_response_json STRING
"""

RECORDING_PAYLOADS = "recording_mbid STRING, payload_json STRING, last_seen_at STRING"

WORK_PAYLOADS = "work_mbid STRING, payload_json STRING, last_seen_at STRING"

ISRC_FAILURES = """
    isrc STRING, error_status_code STRING, error_message STRING,
    last_failed_at STRING, error_404_count INT
"""

LANDING = {
    "saved_tracks": SAVED_TRACKS,
    "track_artists": TRACK_ARTISTS,
    "isrc_candidates": ISRC_CANDIDATES,
    "recording_payloads": RECORDING_PAYLOADS,
    "work_payloads": WORK_PAYLOADS,
    "isrc_failures": ISRC_FAILURES,
}

# Result files, read and written as text with a header line.
QUEUE_FILE = "track_id STRING, isrc STRING, isrc_queue_rank BIGINT, isrc_track_rank BIGINT"

RESULT_FILES = {
    "isrc_candidates": (
        "track_id STRING, isrc STRING, recording_mbid STRING, match_rank STRING, "
        "matched_at STRING, isrc_response_json STRING"
    ),
    "recording_payloads": RECORDING_PAYLOADS,
    "work_payloads": WORK_PAYLOADS,
    "isrc_failures": (
        "isrc STRING, error_status_code STRING, error_message STRING, last_failed_at STRING"
    ),
}

# JSON keys read from the documents.
#
# Every scalar is text, because the documents mix numbers and numerals. A credit list
# alternates objects and bare join phrases, so its elements stay text and are parsed
# one by one; a typed array would lose the whole list to the first phrase.
CREDITED_ARTIST = """
    artist STRUCT<id: STRING, name: STRING, `sort-name`: STRING, disambiguation: STRING,
                  type: STRING, country: STRING, gender: STRING>
"""

RELATION = """
    type: STRING,
    work: STRUCT<id: STRING, title: STRING>,
    recording: STRUCT<id: STRING, title: STRING>,
    artist: STRUCT<id: STRING, name: STRING>,
    `attribute-list`: ARRAY<STRING>,
    attributes: ARRAY<STRING>
"""

RECORDING_DOCUMENT = f"""
    title STRING, length STRING, disambiguation STRING,
    `artist-credit` ARRAY<STRING>,
    `release-list` ARRAY<STRUCT<
        id: STRING, title: STRING, date: STRING, country: STRING, status: STRING,
        `release-group`: STRUCT<id: STRING, title: STRING, `primary-type`: STRING,
                                type: STRING, `secondary-type-list`: STRING>>>,
    `tag-list` ARRAY<STRUCT<name: STRING, count: STRING>>,
    `relation-list` ARRAY<STRUCT<`target-type`: STRING, relation: ARRAY<STRUCT<{RELATION}>>>>,
    `artist-relation-list` ARRAY<STRUCT<{RELATION}>>
"""

WORK_DOCUMENT = """
    title STRING, type STRING, language STRING, disambiguation STRING,
    `relation-list` ARRAY<STRUCT<`target-type`: STRING, relation: ARRAY<STRUCT<
        type: STRING, artist: STRUCT<id: STRING, name: STRING>,
        `attribute-list`: STRING>>>>
"""

SAVED_TRACK_PAGE = """
    items ARRAY<STRUCT<
        added_at: STRING,
        track: STRUCT<
            id: STRING, name: STRING, external_ids: STRUCT<isrc: STRING>,
            album: STRUCT<id: STRING, name: STRING, release_date: STRING,
                          release_date_precision: STRING, total_tracks: INT>,
            track_number: INT, disc_number: INT, duration_ms: INT,
            explicit: BOOLEAN, popularity: INT, is_local: BOOLEAN,
            artists: ARRAY<STRUCT<id: STRING, name: STRING>>,
            external_urls: STRUCT<spotify: STRING>>>>
"""

ISRC_RESPONSE = "isrc STRUCT<`recording-list`: ARRAY<STRING>>"
