"""Raw JSON documents from the services, flattened into landing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.functions.documents import parsed, parsed_strictly
from cratewise.functions.lists import filled, relations_to
from cratewise.functions.moments import pad_release_date
from cratewise.functions.text import status_code, tidy_code
from cratewise.operators.ranking import last_wins

POSITION = ["page_no", "item_no"]


def page_items(pages: DataFrame) -> DataFrame:
    """Saved items of the pages (``page_no``, ``body``), with their place in the input.

    Items without a track or a track id are dropped; an item added_at is kept as text.
    """
    page = parsed_strictly("body", schemas.SAVED_TRACK_PAGE)
    items = pages.select("page_no", F.posexplode_outer(page["items"]).alias("item_no", "item"))
    track = F.col("item.track")
    return items.where(F.coalesce(track["id"], F.lit("")) != "").select(
        *POSITION,
        F.col("item.added_at").alias("added_at"),
        track["id"].alias("track_id"),
        track.alias("track"),
    )


def flatten_tracks(items: DataFrame, ingest_run_at: str) -> DataFrame:
    """One landing row per track; of repeated items the last one counts."""
    track = F.col("track")
    lead = F.get(track["artists"], F.lit(0))
    rows = items.select(
        *POSITION,
        "track_id",
        "added_at",
        track["name"].alias("track_name"),
        track["external_ids"]["isrc"].alias("isrc"),
        track["album"]["id"].alias("album_id"),
        track["album"]["name"].alias("album_name"),
        pad_release_date(
            track["album"]["release_date"], track["album"]["release_date_precision"]
        ).alias("album_release_date"),
        track["album"]["total_tracks"].alias("album_total_tracks"),
        track["track_number"].alias("track_number"),
        track["disc_number"].alias("disc_number"),
        track["duration_ms"].alias("duration_ms"),
        F.coalesce(track["explicit"], F.lit(False)).alias("explicit"),
        track["popularity"].alias("popularity"),
        F.coalesce(track["is_local"], F.lit(False)).alias("is_local"),
        lead["id"].alias("primary_artist_id"),
        lead["name"].alias("primary_artist_name"),
        track["external_urls"]["spotify"].alias("spotify_track_url"),
        F.lit(ingest_run_at).alias("ingest_run_at"),
    )
    return last_wins(rows, ["track_id"], POSITION).drop(*POSITION)


def flatten_track_artists(items: DataFrame, ingest_run_at: str) -> DataFrame:
    """Credited artists of every item, numbered from 1; repeated items repeat theirs."""
    listed = items.select(
        "track_id", F.posexplode_outer("track.artists").alias("position", "artist")
    )
    return listed.where("position is not null").select(
        "track_id",
        F.col("artist.id").alias("artist_id"),
        F.col("artist.name").alias("artist_name"),
        (F.col("position") + 1).alias("artist_order"),
        F.lit(ingest_run_at).alias("ingest_run_at"),
    )


def response_recordings(responses: DataFrame) -> DataFrame:
    """Recordings of the lookup responses (``isrc``, ``body``), ranked by list position.

    Entries without an id are dropped but keep their place in the ranking.
    """
    answer = parsed("body", schemas.ISRC_RESPONSE)
    listed = responses.select(
        tidy_code(F.col("isrc")).alias("isrc"),
        F.posexplode_outer(answer["isrc"]["recording-list"]).alias("position", "recording"),
    )
    identified = listed.select(
        "isrc",
        parsed("recording", "id STRING")["id"].alias("recording_mbid"),
        (F.col("position") + 1).alias("match_rank"),
        "recording",
    )
    return identified.where(F.coalesce("recording_mbid", F.lit("")) != "")


def queued_tracks(queue: DataFrame) -> DataFrame:
    """Rows of the queue file with both values, trimmed and the code in upper case."""
    tidy = queue.withColumns({"track_id": F.trim("track_id"), "isrc": tidy_code(F.col("isrc"))})
    return tidy.where((F.col("track_id") != "") & (F.col("isrc") != ""))


def flatten_candidates(responses: DataFrame, queue: DataFrame, matched_at: str) -> DataFrame:
    """Every recording of a code as a candidate for every queued track of that code."""
    rows = queued_tracks(queue).join(response_recordings(responses), "isrc").select(
        "track_id",
        "isrc",
        "recording_mbid",
        "match_rank",
        F.lit(matched_at).alias("matched_at"),
        F.col("recording").alias("isrc_response_json"),
    )
    return last_wins(rows, ["track_id", "recording_mbid", "match_rank"], ["isrc"])


def recording_payloads(details: DataFrame, responses: DataFrame, seen_at: str) -> DataFrame:
    """One payload per recording whose detail lookup (``recording_mbid``, ``body``) succeeded.

    A detail answer without a recording falls back to the entry of the code lookup; one
    that has no entry either gives nothing.
    """
    detail = parsed("body", "recording STRING")["recording"]
    found = details.where(F.col("body").isNotNull()).select(
        "recording_mbid", F.when(~detail.isin("", "{}"), detail).alias("detail")
    )
    entries = response_recordings(responses).select("recording_mbid", "isrc", "recording")
    fallback = entries.groupBy("recording_mbid").agg(
        F.min(F.struct("isrc", "recording"))["recording"].alias("entry")
    )
    rows = found.join(fallback, "recording_mbid", "left").select(
        "recording_mbid",
        F.coalesce("detail", "entry").alias("payload_json"),
        F.lit(seen_at).alias("last_seen_at"),
    )
    found = rows.where(F.col("payload_json").isNotNull())
    return last_wins(found, ["recording_mbid"], ["payload_json"])


def results(
    codes: DataFrame,
    recordings: DataFrame,
    works: DataFrame,
    queue: DataFrame,
    stamp: str,
) -> dict[str, DataFrame]:
    """The result tables of a batch of answers, of which only what was asked for counts.

    Codes are asked for by the queue, recordings by the answers to those codes, works by the
    recordings' payloads.
    """
    asked = queued_tracks(queue).select("isrc").distinct()
    codes = codes.withColumn("isrc", tidy_code(F.col("isrc"))).join(asked, "isrc", "left_semi")
    listed = response_recordings(codes).select("recording_mbid").distinct()
    payloads = recording_payloads(
        recordings.join(listed, "recording_mbid", "left_semi"), codes, stamp
    )
    linked = work_links(payloads).select("work_mbid").distinct()
    return {
        "isrc_candidates": flatten_candidates(codes, queue, stamp),
        "recording_payloads": payloads,
        "work_payloads": work_payloads(works.join(linked, "work_mbid", "left_semi"), stamp),
        "isrc_failures": lookup_failures(codes, stamp),
    }


def work_payloads(details: DataFrame, seen_at: str) -> DataFrame:
    """One payload per work whose lookup (``work_mbid``, ``body``) gave something."""
    work = parsed("body", "work STRING")["work"]
    rows = details.select(
        "work_mbid", work.alias("payload_json"), F.lit(seen_at).alias("last_seen_at")
    ).where(F.coalesce("payload_json", F.lit("{}")) != "{}")
    return last_wins(rows, ["work_mbid"], ["payload_json"])


def lookup_failures(responses: DataFrame, failed_at: str) -> DataFrame:
    """Codes whose lookup (``isrc``, ``error``) failed, with the HTTP status if any."""
    rows = responses.where(F.col("error").isNotNull()).select(
        tidy_code(F.col("isrc")).alias("isrc"),
        status_code(F.col("error")).alias("error_status_code"),
        F.col("error").alias("error_message"),
        F.lit(failed_at).alias("last_failed_at"),
    )
    return last_wins(rows, ["isrc"], ["error_message"])


def work_links(payloads: DataFrame) -> DataFrame:
    """Works linked from recording payloads, one row per link that carries an id.

    Payloads may come as stored documents, whose works are cut out.
    """
    if "payload_json" not in payloads.columns:
        return payloads.selectExpr("recording_mbid", "explode(works.id) as work_mbid")
    document = parsed("payload_json", schemas.RECORDING_DOCUMENT).alias("doc")
    relations = filled(relations_to("doc.`relation-list`", "work"), "x.work.id")
    return payloads.select("recording_mbid", document).selectExpr(
        "recording_mbid", f"explode(transform({relations}, x -> x.work.id)) as work_mbid"
    )
