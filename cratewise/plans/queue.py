"""Which tracks to look up next, and in what order."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.functions.moments import RETRY_AFTER, moment, safe_timestamp
from cratewise.functions.text import is_filled, tidy_code
from cratewise.operators.lists import ordered_elements
from cratewise.operators.ranking import first_rows, number_within
from cratewise.operators.skew import (
    GROUP_SIZE,
    HOT_GROUP_ROWS,
    attach,
    group_sizes,
    hot_groups,
    splittable,
)
from cratewise.session import stored
from cratewise.sources.documents import queued_tracks, work_links

# Fixed value: a code is given up after this many 404 answers.
MAX_NOT_FOUND = 10


def failure_state(failures: DataFrame) -> DataFrame:
    """Failures by code: most 404 answers, latest failure."""
    return (
        failures.where(is_filled(F.col("isrc")))
        .groupBy(tidy_code(F.col("isrc")).alias("isrc"))
        .agg(
            F.coalesce(F.max("error_404_count"), F.lit(0)).alias("error_404_count"),
            F.max(F.expr(safe_timestamp("last_failed_at"))).alias("last_failed_at"),
        )
    )


def pending_tracks(
    saved_tracks: DataFrame, candidates: DataFrame, recording_payloads: DataFrame
) -> DataFrame:
    """Coded tracks without candidates, or with a candidate that lacks its payload."""
    have = recording_payloads.select("recording_mbid").distinct().withColumn("has", F.lit(True))
    # A recording matched by many tracks is a hot key, which Spark cuts; the flags are then
    # combined per track before their shuffle.
    known = (
        candidates.select("track_id", "recording_mbid")
        .join(splittable(have), "recording_mbid", "left")
        .groupBy("track_id")
        .agg(F.bool_and(F.coalesce("has", F.lit(False))).alias("complete"))
        .where("complete")
    )
    return (
        saved_tracks.where(is_filled(F.col("isrc")))
        .select(
            "track_id",
            tidy_code(F.col("isrc")).alias("isrc"),
            F.expr(safe_timestamp("added_at")).alias("added_at"),
        )
        .join(known.select("track_id"), "track_id", "left_anti")
    )


def retry_tracks(
    saved_tracks: DataFrame,
    candidates: DataFrame,
    recordings: DataFrame,
    work_payloads: DataFrame,
) -> DataFrame:
    """Tracks with a candidate that links a work whose payload is missing."""
    incomplete = (
        work_links(recordings)
        .join(splittable(work_payloads.select("work_mbid").distinct()), "work_mbid", "left_anti")
        .select("recording_mbid")
        .distinct()
    )
    added = saved_tracks.select(
        "track_id", F.expr(safe_timestamp("added_at")).alias("added_at")
    )
    return (
        candidates.where(is_filled(F.col("isrc")))
        .select("track_id", "recording_mbid", tidy_code(F.col("isrc")).alias("isrc"))
        .join(splittable(incomplete), "recording_mbid", "left_semi")
        .select("track_id", "isrc")
        .distinct()
        .join(added, "track_id")
        .select("track_id", "isrc", "added_at")
        .distinct()
    )


def eligible_codes(tracks: DataFrame, failures: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Codes of the tracks that may be asked now, with what their priority depends on."""
    codes = group_sizes(tracks, ["isrc"], F.max("added_at").alias("newest_added_at"))
    state = codes.join(failure_state(failures), "isrc", "left").withColumn(
        "error_404_count", F.coalesce("error_404_count", F.lit(0))
    )
    rested = F.col("last_failed_at") <= moment(as_of) - F.expr(RETRY_AFTER)
    return state.where(
        (F.col("error_404_count") < MAX_NOT_FOUND) & (F.col("last_failed_at").isNull() | rested)
    ).drop("last_failed_at")


@dataclass(frozen=True)
class Queue:
    """What is due: ``tracks`` of all candidates for the queue, ``codes`` that are in it."""

    tracks: DataFrame
    codes: DataFrame

    def queued(self) -> DataFrame:
        """Tracks whose code is in the queue."""
        return self.tracks.join(self.codes.select("isrc"), "isrc", "left_semi")


def asked(tracks: DataFrame, failures: DataFrame, as_of: dt.datetime) -> Queue:
    """The queue of some tracks: those whose code may be asked now."""
    tracks = stored(tracks)
    return Queue(tracks, stored(eligible_codes(tracks, failures, as_of)))


def due(
    saved_tracks: DataFrame,
    candidates: DataFrame,
    recording_payloads: DataFrame,
    work_payloads: DataFrame,
    recordings: DataFrame,
    failures: DataFrame,
    as_of: dt.datetime,
) -> Queue:
    """Pending tracks make the queue; retry tracks do only if no pending one may be asked.

    Tracks and codes are stored, because ranking, sizing and joining all read them; the
    retry side, which opens every recording document, is not even planned unless needed.
    """

    pending = asked(pending_tracks(saved_tracks, candidates, recording_payloads), failures, as_of)
    if not pending.codes.isEmpty():
        return pending
    retries = retry_tracks(saved_tracks, candidates, recordings, work_payloads)
    return asked(retries, failures, as_of)


def ranked_codes(
    queue: Queue, max_codes: int | None = None, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Position of every code: fewest 404 answers, newest track, code.

    Each code occurs once here, so its row number is the dense rank of its tracks. With
    ``max_codes`` only the first codes are kept, and the rest is never sorted.
    """
    order = [
        F.col("error_404_count").asc(),
        F.col("newest_added_at").desc_nulls_last(),
        F.col("isrc").asc(),
    ]
    if max_codes is None:
        return number_within(queue.codes, [], order, "isrc_queue_rank", hot_rows=hot_rows)
    return first_rows(queue.codes, order, max_codes, "isrc_queue_rank", hot_rows)


def enrichment_queue(
    queue: Queue, max_codes: int | None = None, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Queued tracks with the rank of their code and, newest first, their rank within it."""
    ranks = ranked_codes(queue, max_codes, hot_rows).select("isrc", "isrc_queue_rank")
    hot = hot_groups(queue.codes.select("isrc", GROUP_SIZE), hot_rows)
    ranked = attach(queue.tracks, ranks, ["isrc"], hot)
    newest_first = [F.col("added_at").desc_nulls_last(), F.col("track_id").asc()]
    return number_within(
        ranked, ["isrc"], newest_first, "isrc_track_rank", hot=hot, hot_rows=hot_rows
    ).select(
        F.col("track_id").alias("id"), "track_id", "isrc", "isrc_queue_rank", "isrc_track_rank"
    )


def queue_groups(rows: DataFrame, position: list[str], max_codes: int | None = None) -> DataFrame:
    """Tracks of every code in file order, a row each, for the first ``max_codes`` codes."""
    named = queued_tracks(rows)
    if max_codes:
        firsts = named.groupBy("isrc").agg(F.min(F.struct(*position)).alias("first_at"))
        wanted = first_rows(firsts, [F.col("first_at").asc()], max_codes, "place")
        named = named.join(wanted.select("isrc"), "isrc", "left_semi")
    order = [F.col(column).asc() for column in position]
    return ordered_elements(named, ["isrc"], order, {"track_id": F.col("track_id")})
