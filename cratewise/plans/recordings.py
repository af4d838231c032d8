"""Recording documents: one parse, then lists worked on inside the row.

A document holds all that is known of its recording, so after the latest snapshot is
picked nothing here groups, joins or shuffles. ``profiles`` carries every per-recording
column of the track tables; other tables explode one list each.

Lists are exploded with ``_outer`` and the empty rows dropped afterwards: for a plain
explode Spark adds a size filter below it, and evaluating that parses each document again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.functions.documents import parsed
from cratewise.functions.lists import (
    EMPTY_LIST,
    by_lower,
    filled,
    first_of_each,
    join_sorted,
    joined,
    json_text,
    relations_to,
    sort_by,
)
from cratewise.functions.moments import safe_date, safe_int

_RELEASE_TYPE = "coalesce(x.`release-group`.`primary-type`, x.`release-group`.type)"

_TITLES = [
    "title as mb_recording_title",
    f"{safe_int('length')} as mb_length_ms",
    "get(credits, 0).name as mb_primary_artist_name",
    f"{joined('credits_by_name.name', ', ')} as mb_artist_credit_text",
    "first_release.title as mb_release_title",
    f"{safe_date('first_release.date')} as mb_release_date",
    "disambiguation as mb_disambiguation",
]

_METADATA = [
    "get(tag_names, 0) as top_genre",
    "get(tag_names, 1) as top_style",
    f"{json_text('tag_names')} as genre_list_json",
    f"{json_text('tag_names')} as style_list_json",
    f"coalesce({json_text('instruments')}, '{EMPTY_LIST}') as instrument_list_json",
    "get(works, 0).id as primary_work_mbid",
    "get(works, 0).title as primary_work_title",
    "coalesce(size(originals) > 0, false) as is_cover",
    "array_max(originals.id) as cover_of_recording_mbid",
    "array_max(originals.title) as cover_of_recording_title",
    f"coalesce({json_text('covered_by')}, '{EMPTY_LIST}') as covered_by_recordings_json",
]

# Over the releases of a recording; NULL without any.
_RELEASES = [
    "array_min(releases.released) as first_release_date",
    "array_max(releases.released) as latest_release_date",
    f"{join_sorted('releases.title', ' | ')} as release_titles",
    f"{join_sorted('releases.kind', ', ')} as release_group_types",
    "if(size(releases) > 0, exists(releases, x -> coalesce(lower(x.kind) = 'single', false)), "
    "null) as has_single_release",
    "if(size(releases) > 0, exists(releases, x -> coalesce(lower(x.kind) = 'album', false)), "
    "null) as has_album_release",
    "if(size(releases) > 0, last_seen_at, null) as releases_updated_at",
]


def prepared(latest: DataFrame, attribute_fallback: bool = False) -> DataFrame:
    """Latest payloads with their document's lists cut out, cleaned and ordered.

    Every table below selects from this one; what a table does not use is not computed. Rows
    that were cut out already, and stored, are taken as they are: then no document is parsed
    and only the nested columns that a table uses are read.
    Instruments are the distinct attributes of artist relations, in the present and the
    older layout. As published, only ``attribute-list`` is read and an attribute that is an
    object stays JSON text; ``attribute_fallback`` reads ``attributes`` where a relation
    has no list, and the name inside an object.
    """
    if "payload_json" not in latest.columns:
        return latest
    releases = f"""
        transform({filled("doc.`release-list`", "x.id")}, x -> struct(
            x.id, x.title, {safe_date("x.date")} as released, x.country, x.status,
            x.`release-group`.id as group_id, x.`release-group`.title as group_title,
            {_RELEASE_TYPE} as kind,
            coalesce(x.`release-group`.`secondary-type-list`, '{EMPTY_LIST}') as secondary_types))
    """
    # A count that is no number is 0.
    tags = f"""
        transform({filled("doc.`tag-list`", "x.name")},
                  x -> struct(x.name, coalesce({safe_int("x.count")}, 0) as votes))
    """
    works = filled(relations_to("doc.`relation-list`", "work"), "x.work.id")
    related = f"""
        transform({relations_to("doc.`relation-list`", "recording")}, x -> struct(
            lower(coalesce(x.type, '')) as kind, x.recording.id, x.recording.title))
    """
    artists = f"""
        concat(coalesce(doc.`artist-relation-list`, array()),
               coalesce({relations_to("doc.`relation-list`", "artist")}, array()))
    """
    if attribute_fallback:
        lists = f"transform({artists}, x -> coalesce(x.`attribute-list`, x.attributes))"
        name = "coalesce(get_json_object(x, '$.attribute'), x)"
    else:
        lists, name = f"({artists}).`attribute-list`", "x"
    attributes = f"transform(flatten(filter({lists}, x -> x is not null)), x -> {name})"
    instruments = by_lower(f"array_distinct({filled(attributes)})")
    document = latest.select(
        "recording_mbid",
        "last_seen_at",
        parsed("payload_json", schemas.RECORDING_DOCUMENT).alias("doc"),
    )
    cut = document.selectExpr(
        "recording_mbid",
        "last_seen_at",
        "doc.title",
        "doc.length",
        "doc.disambiguation",
        "get(doc.`release-list`, 0) as first_release",
        # NULL for a join phrase.
        f"transform(doc.`artist-credit`, x -> from_json(x, '{schemas.CREDITED_ARTIST}').artist) "
        "as credits",
        f"{releases} as releases",
        f"{sort_by(tags, '-x.votes', 'lower(x.name)', 'x.name')}.name as tag_names",
        f"{sort_by(f'{works}.work', 'lower(x.id)', 'x.id')} as works",
        f"{related} as related",
        f"{instruments} as instruments",
    )
    return cut.selectExpr(
        "*",
        f"{sort_by('credits', 'lower(x.name)', 'x.name')} as credits_by_name",
        "filter(related, x -> x.kind = 'cover of') as originals",
        "transform(filter(related, x -> x.kind = 'covers' and trim(x.id) <> ''), "
        "x -> struct(x.id as recording_mbid, x.title)) as covered_by",
    ).withColumns({"releases": F.expr(first_of_each("releases", "id"))})


def profiles(latest: DataFrame, attribute_fallback: bool = False) -> DataFrame:
    """Every per-recording column of the track tables, from one pass."""
    return prepared(latest, attribute_fallback).selectExpr(
        "recording_mbid",
        *_TITLES,
        "last_seen_at as musicbrainz_recording_updated_at",
        *_METADATA,
        "last_seen_at as musicbrainz_metadata_updated_at",
        *_RELEASES,
    )


def recordings(latest: DataFrame) -> DataFrame:
    """Title, length, credit and first release of every recording."""
    return prepared(latest).selectExpr(
        "recording_mbid as id",
        "recording_mbid",
        *_TITLES,
        "last_seen_at",
        "last_seen_at as musicbrainz_recording_updated_at",
    )


def metadata(latest: DataFrame, attribute_fallback: bool = False) -> DataFrame:
    """Tags, works, covers and instruments of every recording."""
    return prepared(latest, attribute_fallback).selectExpr(
        "recording_mbid as id",
        "recording_mbid",
        *_METADATA,
        # Fixed value: the source name the tables carry.
        "'musicbrainz_api' as metadata_source",
        "last_seen_at",
        "last_seen_at as musicbrainz_metadata_updated_at",
    )


def recording_artists(latest: DataFrame) -> DataFrame:
    """Credited artists, numbered by name within their recording."""
    rows = prepared(latest).selectExpr(
        "recording_mbid", "last_seen_at", "posexplode_outer(credits_by_name) as (place, artist)"
    )
    return rows.where("trim(artist.id) <> ''").selectExpr(
        "concat(artist.id, ':', recording_mbid, ':', place + 1) as id",
        "artist.id as artist_mbid",
        "artist.name as artist_name",
        "artist.`sort-name` as sort_name",
        "artist.disambiguation",
        "artist.type as artist_type",
        "artist.country as artist_country",
        "artist.gender as artist_gender",
        "bigint(place + 1) as credit_order",
        "recording_mbid as source_recording_mbid",
        "last_seen_at",
    )


def releases(latest: DataFrame) -> DataFrame:
    """Releases of every recording, the first entry where an id repeats."""
    rows = prepared(latest).selectExpr(
        "recording_mbid", "last_seen_at", "explode_outer(releases) as release"
    )
    return rows.where("release is not null").selectExpr(
        "concat(release.id, ':', recording_mbid) as id",
        "release.id as release_mbid",
        "release.title as release_title",
        "release.released as release_date",
        "release.country as release_country",
        "release.status as release_status",
        "release.group_id as release_group_mbid",
        "release.group_title as release_group_title",
        "release.kind as release_group_primary_type",
        "release.secondary_types as release_group_secondary_types_json",
        "recording_mbid as source_recording_mbid",
        "last_seen_at",
    )


def instruments(latest: DataFrame, attribute_fallback: bool = False) -> DataFrame:
    """Instrument names of every recording as a list."""
    return prepared(latest, attribute_fallback).select("recording_mbid", "instruments")
