"""Landing rows made typed: saved tracks, credits, matches and latest payloads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.functions.moments import strict_timestamp
from cratewise.functions.text import tidy_code
from cratewise.operators.ranking import best_match, latest_per_key, newest_documents


def saved_tracks(raw: DataFrame) -> DataFrame:
    """Saved tracks, one row per landing row; a bad value stops the query."""
    return raw.selectExpr(
        "track_id as id",
        "track_id",
        "timestamp(added_at) as added_at",
        "track_name",
        "upper(trim(isrc)) as isrc",
        "album_id",
        "album_name",
        "date(album_release_date) as album_release_date",
        "int(album_total_tracks) as album_total_tracks",
        "int(track_number) as track_number",
        "int(disc_number) as disc_number",
        "int(duration_ms) as duration_ms",
        "boolean(explicit) as explicit",
        "int(popularity) as popularity",
        "boolean(is_local) as is_local",
        "primary_artist_id",
        "primary_artist_name",
        "spotify_track_url",
        "timestamp(ingest_run_at) as ingest_run_at",
        "coalesce(timestamp(ingest_run_at), timestamp(added_at)) as spotify_updated_at",
    )


def track_artists(raw: DataFrame) -> DataFrame:
    """Credits, keyed by track and place in the credit list."""
    return raw.selectExpr(
        "concat_ws('', track_id, ':', artist_order) as id",
        "track_id",
        "artist_id",
        "artist_name",
        "int(artist_order) as artist_order",
        "timestamp(ingest_run_at) as ingest_run_at",
    )


def match_map(candidates: DataFrame) -> DataFrame:
    """The best recording of every track: lowest rank, then the newest match."""
    rows = candidates.select(
        "track_id",
        tidy_code(F.col("isrc")).alias("isrc"),
        "recording_mbid",
        "match_rank",
        strict_timestamp(F.col("matched_at")).alias("matched_at"),
        # An unranked candidate counts as the last; where matches come from.
        F.coalesce("match_rank", F.lit(999999)).alias("effective_rank"),
        F.lit("isrc").alias("match_source"),
    )
    ties = [F.col("recording_mbid").asc_nulls_last(), F.col("isrc").asc_nulls_last()]
    best = best_match(rows, ["track_id"], "effective_rank", "matched_at", ties)
    return best.select(
        F.col("track_id").alias("id"),
        "track_id",
        "isrc",
        "recording_mbid",
        "match_source",
        "match_rank",
        "matched_at",
        F.col("matched_at").alias("musicbrainz_map_updated_at"),
    )


def latest_payloads(payloads: DataFrame, key: str) -> DataFrame:
    """The newest snapshot of every document; of equal times the greatest digest."""
    rows = payloads.select(
        key, "payload_json", strict_timestamp(F.col("last_seen_at")).alias("last_seen_at")
    )
    digest = F.md5(F.col("payload_json").cast("binary"))
    return latest_per_key(rows, [key], "last_seen_at", [digest.desc_nulls_last()])


def stored_latest_payloads(payloads: DataFrame, key: str) -> DataFrame:
    """The same rows; those of a table read from files are chosen without moving a document."""
    try:
        payloads.select("_metadata.row_index")
    except AnalysisException:
        return latest_payloads(payloads, key)
    rows = payloads.select(
        key,
        "payload_json",
        strict_timestamp(F.col("last_seen_at")).alias("last_seen_at"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    return newest_documents(
        rows, [key], "last_seen_at", "payload_json", ["file_path", "row_index"]
    )
