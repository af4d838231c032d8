"""Questions asked of the finished tables. Each returns an ordered DataFrame."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.moments import RETRY_AFTER, moment, safe_timestamp
from cratewise.functions.text import first_listed, has_word, is_filled, join_parts, tidy_code
from cratewise.operators.clusters import gap_clusters
from cratewise.operators.lists import assembled, filled_elements, newest_filled
from cratewise.operators.ranking import keep_first, number_within
from cratewise.operators.skew import HOT_GROUP_ROWS, repeated_groups
from cratewise.plans.queue import MAX_NOT_FOUND


# Stand-ins for missing names, closeness of durations in milliseconds, and how
# many rows the published reports show.
UNKNOWN_TRACK = "<unknown track>"
UNKNOWN_ARTIST = "<unknown artist>"
UNKNOWN_ALBUM = "<unknown album>"
CLOSE_MS = 3000
TOP_ARTISTS = 10
TOP_TRACKS = 50
PER_ARTIST = 3


def top_artists(stats: DataFrame, n: int = TOP_ARTISTS) -> DataFrame:
    """Artists with the most saved tracks."""
    return (
        stats.orderBy(
            F.col("saved_track_count").desc(),
            F.col("artist_name").asc_nulls_last(),
            F.col("artist_id").asc_nulls_last(),
        )
        .limit(n)
        .drop("id")
    )


def top_ready_tracks(ready: DataFrame, n: int = TOP_TRACKS) -> DataFrame:
    """Tracks with the best fit score."""
    return (
        ready.orderBy(F.col("playlist_fit_score").desc_nulls_last(), F.col("track_id").asc())
        .limit(n)
        .select(
            "track_name", "artist_names", "popularity", "freshness_score", "playlist_fit_score"
        )
    )


def top_entity_context(context: DataFrame, n: int = TOP_TRACKS) -> DataFrame:
    """Tracks with the best automatic score."""
    return (
        context.orderBy(F.col("auto_playlist_score").desc_nulls_last(), F.col("track_id").asc())
        .limit(n)
        .select(
            "track_name",
            "artist_names",
            "top_genre",
            "top_style",
            "writer_names",
            "release_group_types",
            "is_cover",
            "auto_playlist_score",
        )
    )


def playlist_candidates(scored: DataFrame, per_artist: int = PER_ARTIST) -> DataFrame:
    """The best few tracks of every first artist, local files left out."""
    eligible = scored.where(~F.col("is_local")).select(
        "track_id",
        "track_name",
        "artist_names",
        "album_name",
        "popularity",
        "playlist_fit_score",
        "added_at",
    )
    best = [
        F.col("playlist_fit_score").desc_nulls_last(),
        F.col("popularity").desc_nulls_last(),
        F.col("track_id").asc(),
    ]
    named = eligible.withColumn("first_artist", first_listed(F.col("artist_names")))
    return (
        keep_first(named, ["first_artist"], best, per_artist)
        .drop("first_artist")
        .orderBy(F.col("playlist_fit_score").desc_nulls_last(), F.col("track_id").asc())
    )


def instrument_playlist(ready: DataFrame, instruments: DataFrame, word: str) -> DataFrame:
    """Tracks with an instrument whose name has the word; ``instruments`` are lists."""
    played = instruments.where(F.exists("instrument_names", lambda name: has_word(name, word)))
    return (
        ready.join(played.select("track_id"), "track_id", "left_semi")
        .select(
            "track_id", "track_name", first_listed(F.col("artist_names")).alias("primary_artist_name")
        )
        .distinct()
        .orderBy(
            F.col("primary_artist_name").asc_nulls_last(),
            F.col("track_name").asc_nulls_last(),
            "track_id",
        )
    )


def artist_instrument_playlist(
    ready: DataFrame, instruments: DataFrame, artist: str, names: list[str] | None = None
) -> DataFrame:
    """Tracks of one first artist that have instruments, with all of them.

    ``names`` keeps the tracks that have one of these instruments.
    """
    if names:
        wanted = F.array(*[F.lit(name) for name in names])
        instruments = instruments.where(F.arrays_overlap("instrument_names", wanted))
    first = first_listed(F.col("artist_names"))
    return (
        ready.where(first == artist)
        .join(instruments.where(F.size("instrument_names") > 0), "track_id")
        .select(
            "track_id",
            "track_name",
            first.alias("primary_artist_name"),
            "playlist_fit_score",
            "instrument_names",
        )
        .distinct()
        .orderBy(
            F.col("playlist_fit_score").desc_nulls_last(),
            F.col("track_name").asc_nulls_last(),
            "track_id",
        )
    )


def title_duration_duplicates(
    tracks: DataFrame, tolerance_ms: int = CLOSE_MS, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Tracks of one artist and title whose durations lie close together."""
    rows = tracks.where(
        is_filled(F.col("primary_artist_name"))
        & is_filled(F.col("track_name"))
        & F.col("duration_ms").isNotNull()
    ).select(
        "primary_artist_name",
        "track_name",
        "duration_ms",
        "album_name",
        "album_release_date",
        "added_at",
        "track_id",
        F.lower(F.trim("primary_artist_name")).alias("artist_key"),
        F.lower(F.trim("track_name")).alias("title_key"),
    )
    clustered = gap_clusters(
        rows,
        ["artist_key", "title_key"],
        "duration_ms",
        tolerance_ms,
        cluster="duration_cluster",
        size="duplicate_occurrences",
        min_size=2,
        hot_rows=hot_rows,
    )
    return clustered.drop("artist_key", "title_key", "duration_cluster").orderBy(
        F.col("duplicate_occurrences").desc(),
        "primary_artist_name",
        "track_name",
        "duration_ms",
        F.col("added_at").desc_nulls_last(),
        "track_id",
    )


def isrc_duplicate_detail(tracks: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Every track of the codes saved more than once, numbered newest first."""
    rows, hot = _repeated_codes(tracks, hot_rows)
    newest_first = [F.col("added_at").desc_nulls_last(), F.col("track_id").asc()]
    numbered = number_within(
        rows, ["isrc"], newest_first, "duplicate_rank_in_isrc", hot=hot, hot_rows=hot_rows
    )
    return numbered.select(
        "isrc",
        "duplicate_count",
        "track_id",
        "track_name",
        "primary_artist_name",
        "album_name",
        "album_release_date",
        "added_at",
        "duplicate_rank_in_isrc",
        "first_added_at",
        "latest_added_at",
    ).orderBy(F.col("duplicate_count").desc(), "isrc", "duplicate_rank_in_isrc")


def isrc_duplicate_summary(tracks: DataFrame) -> DataFrame:
    """Codes saved more than once, with their figures; one row per code."""
    counted = tracks.where(F.col("isrc").isNotNull()).groupBy("isrc").agg(
        F.count(F.lit(1)).alias("duplicate_count"),
        F.min("added_at").alias("first_added_at"),
        F.max("added_at").alias("latest_added_at"),
    )
    return counted.where("duplicate_count > 1").orderBy(
        F.col("duplicate_count").desc(), F.col("latest_added_at").desc_nulls_last(), "isrc"
    )


def isrc_duplicate_lines(tracks: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """The tracks of the codes saved more than once as lines of text, newest first."""
    rows, hot = _repeated_codes(tracks, hot_rows)
    line = join_parts(
        F.coalesce("track_name", F.lit(UNKNOWN_TRACK)),
        F.lit(" - "),
        F.coalesce("primary_artist_name", F.lit(UNKNOWN_ARTIST)),
        F.lit(" ("),
        F.coalesce("album_name", F.lit(UNKNOWN_ALBUM)),
        F.lit(", added "),
        F.col("added_at"),
        F.lit(")"),
    )
    order = [F.col("added_at").desc_nulls_last(), F.col("track_line"), F.col("track_id")]
    lines = filled_elements(rows, ["isrc"], order, line, "track_line", hot, hot_rows)
    return lines.orderBy("isrc", "position")


def isrc_duplicate_text(tracks: DataFrame) -> DataFrame:
    """The codes saved more than once in the published shape: a line of text for each.

    A text too large for a cell stops the query by its code.
    """
    lines = assembled(isrc_duplicate_lines(tracks), ["isrc"], ["track_line"])
    text = F.array_join(F.col("elements.track_line"), " | ").alias("duplicate_track_list")
    return isrc_duplicate_summary(tracks).join(lines.select("isrc", text), "isrc").select(
        "isrc", "duplicate_count", "duplicate_track_list", "first_added_at", "latest_added_at"
    )


def request_metrics(
    tracks: DataFrame,
    queued: DataFrame,
    failures: DataFrame,
    matches: DataFrame,
    recording_payloads: DataFrame,
) -> DataFrame:
    """One row: tracks with a code, queued, queued after an error, and matched."""
    coded = tracks.where(is_filled(F.col("isrc"))).select("track_id", "isrc").distinct()
    failed = failures.where(is_filled(F.col("isrc"))).select(
        tidy_code(F.col("isrc")).alias("isrc"), F.lit(True).alias("failed")
    )
    # Counted per code first: the join then meets each code once, however many tracks it has.
    waiting = (
        queued.select("track_id", "isrc")
        .distinct()
        .groupBy("isrc")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(failed.distinct(), "isrc", "left")
    )
    matched = (
        matches.join(recording_payloads.select("recording_mbid"), "recording_mbid", "left_semi")
        .select("track_id")
        .distinct()
    )
    row = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            coded.agg(F.count(F.lit(1)).alias("total_tracks_with_isrc")),
            waiting.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("pending_queue_tracks"),
                F.coalesce(F.sum(F.when(F.col("failed"), F.col("n"))), F.lit(0)).alias(
                    "pending_queue_with_errors_tracks"
                ),
            ),
            matched.agg(F.count(F.lit(1)).alias("succeeded_tracks")),
        ],
    )
    # One row out of three, each with some of the columns.
    row = row.agg(*[F.max(name).alias(name) for name in row.columns])
    return row.select(
        "total_tracks_with_isrc",
        "pending_queue_tracks",
        "pending_queue_with_errors_tracks",
        (
            F.col("pending_queue_tracks") - F.col("pending_queue_with_errors_tracks")
        ).alias("pending_queue_without_errors_tracks"),
        "succeeded_tracks",
        _percent("succeeded_tracks").alias("succeeded_pct_of_tracks_with_isrc"),
        _percent("pending_queue_tracks").alias("pending_pct_of_tracks_with_isrc"),
    )


def retry_error_state(failures: DataFrame, ranks: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Failures by code, when they may be retried, and their place in the queue."""
    time = F.expr(safe_timestamp("last_failed_at"))
    state = (
        failures.where(is_filled(F.col("isrc")))
        .groupBy(tidy_code(F.col("isrc")).alias("isrc"))
        .agg(
            F.max(F.coalesce("error_404_count", F.lit(0))).alias("error_404_count"),
            newest_filled(F.col("error_status_code"), time).alias("latest_error_status_code"),
            F.max(time).alias("last_failed_at"),
            newest_filled(F.col("error_message"), time).alias("latest_error_message"),
        )
    )
    placed = state.join(
        ranks.select("isrc", F.col("isrc_queue_rank").alias("queue_rank")), "isrc", "left"
    )
    failed_at = F.col("last_failed_at")
    rested = F.coalesce(failed_at <= moment(as_of) - F.expr(RETRY_AFTER), F.lit(False))
    return placed.select(
        "isrc",
        "error_404_count",
        "latest_error_status_code",
        "last_failed_at",
        (failed_at + F.expr(RETRY_AFTER)).alias("next_retry_at"),
        ((F.col("error_404_count") < MAX_NOT_FOUND) & rested).alias("eligible_now"),
        F.col("queue_rank").isNotNull().alias("currently_in_queue"),
        "queue_rank",
        "latest_error_message",
    ).orderBy(
        F.col("currently_in_queue").desc(),
        F.col("eligible_now").desc(),
        F.col("error_404_count").asc(),
        F.col("queue_rank").asc_nulls_last(),
        F.col("last_failed_at").desc_nulls_last(),
        "isrc",
    )


def _repeated_codes(tracks: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Tracks of the codes saved more than once, with figures of the code."""
    return repeated_groups(
        tracks.where(F.col("isrc").isNotNull()),
        ["isrc"],
        "duplicate_count",
        hot_rows,
        F.min("added_at").alias("first_added_at"),
        F.max("added_at").alias("latest_added_at"),
    )


def _percent(part: str) -> Column:
    whole = F.nullif(F.col("total_tracks_with_isrc"), F.lit(0))
    return F.round(F.lit(100.0) * F.col(part) / whole, 2)
