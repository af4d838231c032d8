"""All tables of the library from its six landing tables, each built once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from cratewise.operators.skew import splittable
from cratewise.plans import marts, queue, recordings, staging, works

# The names under which finished tables are queried, and where they are
# made. Feeder tables first, then staging, refinement and marts.
PUBLISHED = {
    "stg_musicbrainz_enrichment_queue": "enrichment_queue",
    "stg_spotify_saved_tracks": "tracks",
    "stg_spotify_track_artists": "credits",
    "stg_spotify_musicbrainz_map": "matches",
    "stg_musicbrainz_recordings": "recordings",
    "stg_musicbrainz_artists": "recording_artists",
    "stg_musicbrainz_releases": "releases",
    "stg_musicbrainz_works": "works",
    "stg_musicbrainz_work_writers": "work_writers",
    "stg_musicbrainz_recording_metadata": "metadata",
    "int_track_instrument": "track_instruments",
    "int_playlist_ready_tracks_base": "ready_tracks_base",
    "int_playlist_entity_context_base": "entity_context_base",
    "fct_playlist_ready_tracks": "ready_tracks",
    "fct_playlist_entity_context": "entity_context",
    "fct_artist_stats": "artist_stats",
    "dim_favorite_artist": "favorite_artist",
    "fct_track_duplicates": "isrc_duplicates",
    "fct_track_duplicate_albums": "isrc_duplicate_albums",
}


class Models:
    """``landing`` maps landing names to DataFrames; ``as_of`` is the run's 'now'.

    ``keep`` receives the tables that others, or the next update, read (documents cut out of
    the latest payloads, profiles, matches, the joined track rows) and returns the stored copy
    to read instead. With it every payload is parsed once, and the latest one is chosen from
    landing tables read from files without moving a document. Without it nothing is stored.
    """

    def __init__(
        self,
        landing: dict[str, DataFrame],
        as_of: dt.datetime,
        keep: Callable[[str, DataFrame], DataFrame] | None = None,
    ):
        self.landing = landing
        self.as_of = as_of
        self.stores = keep is not None
        self.keep = keep or (lambda name, df: df)

    @cached_property
    def tracks(self) -> DataFrame:
        return self.keep("tracks", staging.saved_tracks(self.landing["saved_tracks"]))

    @cached_property
    def credits(self) -> DataFrame:
        return self.keep("credits", staging.track_artists(self.landing["track_artists"]))

    @cached_property
    def matches(self) -> DataFrame:
        return self.keep("matches", staging.match_map(self.landing["isrc_candidates"]))

    def _latest(self, table: str, key: str) -> DataFrame:
        if self.stores:
            return staging.stored_latest_payloads(self.landing[table], key)
        return staging.latest_payloads(self.landing[table], key)

    @cached_property
    def recording_documents(self) -> DataFrame:
        """The lists of the newest recording payloads, the one place that parses them."""
        latest = self._latest("recording_payloads", "recording_mbid")
        return self.keep("recording_documents", recordings.prepared(latest))

    @cached_property
    def work_documents(self) -> DataFrame:
        latest = self._latest("work_payloads", "work_mbid")
        return self.keep("work_documents", works.prepared(latest))

    @cached_property
    def profiles(self) -> DataFrame:
        rows = marts.profiles(self.recording_documents, self.work_documents)
        return self.keep("profiles", rows) if self.stores else splittable(rows)

    @cached_property
    def recordings(self) -> DataFrame:
        return recordings.recordings(self.recording_documents)

    @cached_property
    def recording_artists(self) -> DataFrame:
        return recordings.recording_artists(self.recording_documents)

    @cached_property
    def releases(self) -> DataFrame:
        return recordings.releases(self.recording_documents)

    @cached_property
    def metadata(self) -> DataFrame:
        return recordings.metadata(self.recording_documents)

    @cached_property
    def works(self) -> DataFrame:
        return works.works(self.work_documents)

    @cached_property
    def work_writers(self) -> DataFrame:
        return works.work_writers(self.work_documents)

    @cached_property
    def due(self) -> queue.Queue:
        return queue.due(
            self.landing["saved_tracks"],
            self.landing["isrc_candidates"],
            self.landing["recording_payloads"],
            self.landing["work_payloads"],
            self.recording_documents,
            self.landing["isrc_failures"],
            self.as_of,
        )

    @cached_property
    def retries(self) -> queue.Queue:
        """Tracks whose works are missing, whether or not others wait."""
        tracks = queue.retry_tracks(
            self.landing["saved_tracks"],
            self.landing["isrc_candidates"],
            self.recording_documents,
            self.landing["work_payloads"],
        )
        return queue.asked(tracks, self.landing["isrc_failures"], self.as_of)

    @cached_property
    def enrichment_queue(self) -> DataFrame:
        return queue.enrichment_queue(self.due)

    @cached_property
    def track_context(self) -> DataFrame:
        return self.keep(
            "track_context",
            marts.track_context(
                self.tracks, self.credits, self.matches, self.profiles, self.as_of
            ),
        )

    @cached_property
    def ready_tracks_base(self) -> DataFrame:
        return self.keep("ready_tracks_base", marts.ready_tracks(self.track_context))

    @cached_property
    def entity_context_base(self) -> DataFrame:
        return self.keep("entity_context_base", marts.entity_context(self.track_context))

    @cached_property
    def ready_tracks(self) -> DataFrame:
        return self.ready_tracks_base.select(marts.READY_COLUMNS)

    @cached_property
    def entity_context(self) -> DataFrame:
        return self.entity_context_base.select(marts.CONTEXT_COLUMNS)

    @cached_property
    def scored_tracks(self) -> DataFrame:
        """Track scores for reports that need nothing from the documents."""
        return marts.scored_tracks(self.tracks, self.credits, self.matches, self.as_of)

    @cached_property
    def instrument_lists(self) -> DataFrame:
        return marts.instrument_lists(self.matches, self.recording_documents)

    @cached_property
    def track_instruments(self) -> DataFrame:
        rows = marts.track_instruments(self.matches, self.recording_documents)
        return self.keep("track_instruments", rows)

    @cached_property
    def artist_parts(self) -> DataFrame:
        """What the next update starts from to know the artists."""
        return self.keep("artist_parts", marts.artist_parts(self.credits, self.tracks))

    @cached_property
    def artist_stats(self) -> DataFrame:
        return marts.artist_stats(self.credits, self.tracks)

    @cached_property
    def favorite_artist(self) -> DataFrame:
        return marts.favorite_artist(self.artist_stats)

    @cached_property
    def isrc_duplicates(self) -> DataFrame:
        return self.keep("isrc_duplicates", marts.isrc_duplicates(self.tracks))

    @cached_property
    def isrc_duplicate_albums(self) -> DataFrame:
        return self.keep("isrc_duplicate_albums", marts.isrc_duplicate_albums(self.tracks))

    def published(self, name: str) -> DataFrame:
        """A finished table by its published name."""
        return getattr(self, PUBLISHED[name])
