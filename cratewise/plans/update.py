"""A build brought up to date: only rows of the keys that a batch touched are made anew.

Every stored table is replaced by key: its rows of other keys are copied as they are, without
a shuffle while the touched keys are few. A touched key is carried on to what depends on it:
from a work to the recordings that name it, from a recording to the tracks matched to it,
from a track to the codes and artists it had and has. What depends on the day (scores, the
queue) is computed anew from stored rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.operators.skew import BROADCAST_ROWS
from cratewise.operators.state import BROADCAST_MARKS, replace_children
from cratewise.plans import marts
from cratewise.plans.models import Models
from cratewise.session import checkpointed, discard, stored

# Tables of a build that the next update starts from, beside those it publishes.
KEPT = [
    "matches",
    "recording_documents",
    "work_documents",
    "profiles",
    "track_context",
    "artist_parts",
    "tracks",
    "credits",
    "track_instruments",
    "isrc_duplicates",
    "isrc_duplicate_albums",
]


@dataclass(frozen=True)
class Touched:
    """Keys that came, changed or went in the landing tables since the last build."""

    tracks: DataFrame
    recordings: DataFrame
    works: DataFrame


def only(
    rows: DataFrame,
    keys: DataFrame,
    key: str,
    few: int = BROADCAST_ROWS,
    marks: int = BROADCAST_MARKS,
) -> DataFrame:
    """Rows of the given keys; few keys, or the marks of more, meet the rows where these lie."""
    n = keys.count()
    if n <= few:
        return rows.join(F.broadcast(keys), key, "left_semi").select(rows.columns)
    found = rows
    if n <= marks:
        # Rows whose mark does not occur stay where they are.
        known = F.broadcast(keys.select(F.xxhash64(key).alias("__mark")))
        found = rows.withColumn("__mark", F.xxhash64(key)).join(known, "__mark", "left_semi")
    return found.join(keys, key, "left_semi").select(rows.columns)


def _keys(*columns: DataFrame) -> DataFrame:
    """Distinct values of one column of several tables, stored."""
    first, *rest = columns
    for other in rest:
        first = first.unionByName(other)
    return checkpointed(first.distinct())


class _Part(dict):
    """Landing tables; those with keys hold the rows of these, stored when first asked for."""

    def __init__(self, landing: dict[str, DataFrame], keys: dict[str, tuple[str, DataFrame]]):
        super().__init__({name: df for name, df in landing.items() if name not in keys})
        self._landing, self._keys = landing, keys

    def __missing__(self, name: str) -> DataFrame:
        key, of = self._keys[name]
        self[name] = stored(only(self._landing[name], of, key))
        return self[name]


class Update:
    """Tables after a batch, from those of the last build.

    ``built`` reads a stored table by its name in ``KEPT``, ``landing`` has the present
    landing tables, ``keep`` stores a new table and returns its stored copy.
    """

    def __init__(
        self,
        built: Callable[[str], DataFrame],
        landing: dict[str, DataFrame],
        touched: Touched,
        as_of: dt.datetime,
        keep: Callable[[str, DataFrame], DataFrame],
    ):
        self.built = built
        self.as_of = as_of
        self.keep = keep
        self.track_keys = _keys(touched.tracks.select("track_id"))
        self.recording_keys = _keys(touched.recordings.select("recording_mbid"))
        self.work_keys = _keys(touched.works.select("work_mbid"))
        self.landing = landing
        # Landing rows of touched keys, through the same staging as a whole build.
        keys = {
            "saved_tracks": ("track_id", self.track_keys),
            "track_artists": ("track_id", self.track_keys),
            "isrc_candidates": ("track_id", self.track_keys),
            "recording_payloads": ("recording_mbid", self.recording_keys),
            "work_payloads": ("work_mbid", self.work_keys),
        }
        self.part = Models(_Part(landing, keys), as_of)

    def _replaced(self, name: str, keys: DataFrame, key: str, rows: DataFrame) -> DataFrame:
        return self.keep(name, replace_children(self.built(name), keys, rows, key))

    @cached_property
    def tracks(self) -> DataFrame:
        return self._replaced("tracks", self.track_keys, "track_id", self.part.tracks)

    @cached_property
    def credits(self) -> DataFrame:
        return self._replaced("credits", self.track_keys, "track_id", self.part.credits)

    @cached_property
    def matches(self) -> DataFrame:
        return self._replaced("matches", self.track_keys, "track_id", self.part.matches)

    @cached_property
    def recording_documents(self) -> DataFrame:
        rows = self.part.recording_documents
        return self._replaced("recording_documents", self.recording_keys, "recording_mbid", rows)

    @cached_property
    def work_documents(self) -> DataFrame:
        rows = self.part.work_documents
        return self._replaced("work_documents", self.work_keys, "work_mbid", rows)

    @cached_property
    def profiled(self) -> DataFrame:
        """Recordings whose profile changes: their own document, or that of their work."""
        named = self.recording_documents.selectExpr("recording_mbid", "get(works, 0).id as work_mbid")
        by_work = only(named, self.work_keys, "work_mbid").select("recording_mbid")
        return _keys(self.recording_keys, by_work)

    @cached_property
    def profiles(self) -> DataFrame:
        documents = stored(only(self.recording_documents, self.profiled, "recording_mbid"))
        works = _keys(documents.selectExpr("get(works, 0).id as work_mbid"))
        rows = marts.profiles(documents, only(self.work_documents, works, "work_mbid"))
        profiles = self._replaced("profiles", self.profiled, "recording_mbid", rows)
        discard(documents)
        return profiles

    @cached_property
    def matched(self) -> DataFrame:
        """Tracks whose row changes: their own rows, or the profile of their match."""
        by_match = only(self.matches, self.profiled, "recording_mbid").select("track_id")
        return _keys(self.track_keys, by_match)

    @cached_property
    def track_context(self) -> DataFrame:
        matches = stored(only(self.matches, self.matched, "track_id"))
        recordings = _keys(matches.select("recording_mbid"))
        rows = marts.track_context(
            only(self.tracks, self.matched, "track_id"),
            only(self.credits, self.matched, "track_id"),
            matches,
            only(self.profiles, recordings, "recording_mbid"),
            self.as_of,
        )
        context = self._replaced("track_context", self.matched, "track_id", rows)
        discard(matches)
        return context

    @cached_property
    def track_instruments(self) -> DataFrame:
        matches = checkpointed(only(self.matches, self.matched, "track_id"))
        recordings = _keys(matches.select("recording_mbid"))
        documents = only(self.recording_documents, recordings, "recording_mbid")
        rows = marts.track_instruments(matches, documents)
        return self._replaced("track_instruments", self.matched, "track_id", rows)

    @cached_property
    def artist_parts(self) -> DataFrame:
        """Figures of the artists that touched tracks had or have, in the parts of these."""
        group = F.to_json(F.struct("artist_id", "artist_name", marts.part_of("track_id"))).alias("of")
        now = self.credits.withColumn("of", group)
        before = self.built("credits").withColumn("of", group)
        touched = _keys(*[only(x, self.track_keys, "track_id").select("of") for x in (before, now)])
        credits = checkpointed(only(now, touched, "of").drop("of"))
        tracks = only(self.tracks, _keys(credits.select("track_id")), "track_id")
        # A JSON text tells missing ids and names apart, and is never missing itself.
        of = F.to_json(F.struct("artist_id", "artist_name", "part")).alias("of")
        rows = marts.artist_parts(credits, tracks).withColumn("of", of)
        kept = replace_children(self.built("artist_parts").withColumn("of", of), touched, rows, "of")
        return self.keep("artist_parts", kept.drop("of"))

    @cached_property
    def codes(self) -> DataFrame:
        """Codes that touched tracks had or have; a missing one as a blank."""
        code = F.coalesce("isrc", F.lit("")).alias("code")
        sides = [self.built("tracks"), self.tracks]
        return _keys(*[only(x, self.track_keys, "track_id").select(code) for x in sides])

    def _by_code(self, name: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        code = F.coalesce("isrc", F.lit("")).alias("code")
        tracks = only(self.tracks.withColumn("code", code), self.codes, "code").drop("code")
        rows = make(tracks).withColumn("code", code)
        kept = replace_children(self.built(name).withColumn("code", code), self.codes, rows, "code")
        return self.keep(name, kept.drop("code"))

    @cached_property
    def isrc_duplicates(self) -> DataFrame:
        return self._by_code("isrc_duplicates", marts.isrc_duplicates)

    @cached_property
    def isrc_duplicate_albums(self) -> DataFrame:
        return self._by_code("isrc_duplicate_albums", marts.isrc_duplicate_albums)

    @property
    def models(self) -> Models:
        """All tables, the ones above taken from here when they are asked for."""
        return _Updated(self)


def _taken(name: str) -> property:
    return property(lambda self: getattr(self.update, name))


class _Updated(Models):
    """The tables of an update; what it does not know follows from what it does."""

    def __init__(self, update: Update):
        super().__init__(update.landing, update.as_of, update.keep)
        self.update = update

    tracks = _taken("tracks")
    credits = _taken("credits")
    matches = _taken("matches")
    recording_documents = _taken("recording_documents")
    work_documents = _taken("work_documents")
    profiles = _taken("profiles")
    track_instruments = _taken("track_instruments")
    artist_parts = _taken("artist_parts")
    isrc_duplicates = _taken("isrc_duplicates")
    isrc_duplicate_albums = _taken("isrc_duplicate_albums")

    @cached_property
    def track_context(self) -> DataFrame:
        return marts.aged(self.update.track_context, self.as_of)

    @cached_property
    def artist_stats(self) -> DataFrame:
        return marts.merged_artist_stats(self.artist_parts)
