"""Work documents: titles and writers."""

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
    json_text,
    relations_to,
)

# Relation types that make an artist a writer.
WRITER_ROLES = ["writer", "composer", "lyricist", "librettist"]


def prepared(latest: DataFrame) -> DataFrame:
    """Latest payloads with their document's fields and its writers, each role once.

    Rows that were cut out already, and stored, are taken as they are.
    """
    if "payload_json" not in latest.columns:
        return latest
    roles = ", ".join(f"'{role}'" for role in WRITER_ROLES)
    artists = filled(relations_to("doc.`relation-list`", "artist"), "x.artist.id")
    writers = f"""
        transform(filter({artists}, x -> lower(x.type) in ({roles})), x -> struct(
            struct(x.artist.id, lower(x.type) as role) as key, x.artist.name,
            coalesce(x.`attribute-list`, '{EMPTY_LIST}') as attributes))
    """
    document = latest.select(
        "work_mbid",
        "last_seen_at",
        parsed("payload_json", schemas.WORK_DOCUMENT).alias("doc"),
    )
    return document.selectExpr(
        "work_mbid",
        "last_seen_at",
        "doc.title",
        "doc.type",
        "doc.language",
        "doc.disambiguation",
        f"if(trim(work_mbid) <> '', {writers}, null) as writers",
    ).withColumns({"writers": F.expr(first_of_each("writers", "key"))})


def works(latest: DataFrame) -> DataFrame:
    """Title, type and language of every work."""
    return prepared(latest).selectExpr(
        "work_mbid as id",
        "work_mbid",
        "title as work_title",
        "type as work_type",
        "language as work_language",
        "disambiguation",
        "last_seen_at",
    )


def work_writers(latest: DataFrame) -> DataFrame:
    """Writers of every work, one row per artist and role."""
    rows = prepared(latest).selectExpr(
        "work_mbid", "last_seen_at", "explode_outer(writers) as writer"
    )
    return rows.where("writer is not null").selectExpr(
        "concat(work_mbid, ':', writer.key.id, ':', writer.key.role) as id",
        "work_mbid",
        "writer.key.id as artist_mbid",
        "writer.name as artist_name",
        "writer.key.role as writer_role",
        "writer.attributes as attributes_json",
        "last_seen_at",
    )


def writer_figures(latest: DataFrame) -> DataFrame:
    """Writer names and roles of every work; NULL for a work without writers."""
    named = by_lower(f"array_distinct({filled('writers.name')})")
    listed = prepared(latest).selectExpr(
        "work_mbid", "last_seen_at", "writers", f"{named} as named"
    )
    return listed.selectExpr(
        "work_mbid",
        f"{join_sorted('writers.name', ', ')} as writer_names",
        f"{join_sorted('writers.key.role', ', ')} as writer_roles",
        "if(size(writers) > 0, last_seen_at, null) as writers_updated_at",
        f"{json_text('named')} as work_writer_list_json",
        "if(size(named) > 0, last_seen_at, null) as named_writers_updated_at",
    )
