"""DuckDB SQL with the results the registered queries must give.

``CTES`` holds named building blocks: the landing tables, then one block per table. A
query lists its final SELECT; the blocks it needs are put in front of it.
"""

from __future__ import annotations

import re

from cratewise.fixtures import LANDING_SQL

AS_OF = "TIMESTAMP '2001-08-10 00:00:00'"
LATE = "'2001-08-09T00:00:00+00:00'"

CTES: dict[str, str] = {f"raw_{name}": text for name, text in LANDING_SQL.items()}

CTES["tracks"] = """
select track_id as id, track_id, added_at::timestamp as added_at, track_name,
  upper(trim(isrc)) as isrc, album_id, album_name,
  album_release_date::date as album_release_date, album_total_tracks, track_number,
  disc_number, duration_ms, explicit, popularity, is_local, primary_artist_id,
  primary_artist_name, spotify_track_url, ingest_run_at::timestamp as ingest_run_at,
  ifnull(ingest_run_at::timestamp, added_at::timestamp) as spotify_updated_at
from raw_saved_tracks
"""
CTES["credits"] = """
select track_id || ':' || artist_order as id, track_id, artist_id, artist_name,
  artist_order, ingest_run_at::timestamp as ingest_run_at
from raw_track_artists
"""
CTES["matches"] = """
select track_id as id, track_id, upper(trim(isrc)) as isrc, recording_mbid,
  'isrc' as match_source, match_rank, matched_at::timestamp as matched_at,
  matched_at::timestamp as musicbrainz_map_updated_at
from raw_isrc_candidates c
qualify 1 = row_number() over (partition by c.track_id
  order by ifnull(c.match_rank, 999999), c.matched_at::timestamp desc, c.recording_mbid, c.isrc)
"""
CTES["docs"] = """
select recording_mbid, best.at as last_seen_at, best.body as j
from (select recording_mbid, max({'at': last_seen_at::timestamp, 'digest': md5(payload_json), 'body': payload_json}) as best
      from raw_recording_payloads group by all)
"""
CTES["work_docs"] = """
select work_mbid, best.at as last_seen_at, best.body as j
from (select work_mbid, max({'at': last_seen_at::timestamp, 'digest': md5(payload_json), 'body': payload_json}) as best
      from raw_work_payloads group by all)
"""
CTES["credit_rows"] = """
select recording_mbid, last_seen_at, c,
  row_number() over (partition by recording_mbid
                     order by lower(c->>'$.artist.name'), c->>'$.artist.name', place) as n
from (select recording_mbid, last_seen_at, unnest(list) as c,
        generate_subscripts(list, 1) as place
      from (select *, (j->'$."artist-credit"')::json[] as list from docs))
"""
CTES["recordings"] = """
select d.recording_mbid as id, d.recording_mbid, d.j->>'$.title' as mb_recording_title,
  try_cast(d.j->>'$.length' as integer) as mb_length_ms,
  d.j->>'$."artist-credit"[0].artist.name' as mb_primary_artist_name,
  t.names as mb_artist_credit_text,
  d.j->>'$."release-list"[0].title' as mb_release_title,
  try_cast(d.j->>'$."release-list"[0].date' as date) as mb_release_date,
  d.j->>'$.disambiguation' as mb_disambiguation,
  d.last_seen_at, d.last_seen_at as musicbrainz_recording_updated_at
from docs d left join (
  select recording_mbid, string_agg(c->>'$.artist.name', ', ' order by n) as names
  from credit_rows group by all) t using (recording_mbid)
"""
CTES["release_rows"] = """
select recording_mbid, last_seen_at, r, r->>'$.id' as release_mbid,
  ifnull(r->>'$."release-group"."primary-type"', r->>'$."release-group".type') as kind,
  try_cast(r->>'$.date' as date) as released
from (select recording_mbid, last_seen_at, unnest(list) as r,
        generate_subscripts(list, 1) as place
      from (select *, (j->'$."release-list"')::json[] as list from docs))
where trim(release_mbid) <> ''
qualify 1 = row_number() over (partition by recording_mbid, release_mbid order by place)
"""
CTES["blocks"] = """
select recording_mbid, last_seen_at, unnest((j->'$."relation-list"')::json[]) as b from docs
"""
CTES["relations"] = """
select recording_mbid, last_seen_at, b->>'$."target-type"' as target,
  unnest((b->'$.relation')::json[]) as rel
from blocks
"""
CTES["links"] = """
select recording_mbid, rel->>'$.work.id' as work_mbid, rel->>'$.work.title' as title
from relations where target = 'work' and trim(rel->>'$.work.id') <> ''
"""
CTES["tag_figures"] = """
select recording_mbid, list(name order by votes desc, lower(name), name) as names
from (select recording_mbid, t->>'$.name' as name,
        ifnull(try_cast(t->>'$.count' as integer), 0) as votes
      from (select recording_mbid, unnest((j->'$."tag-list"')::json[]) as t from docs))
where trim(name) <> '' group by all
"""
CTES["cover_figures"] = """
select recording_mbid, bool_or(kind = 'cover of') as is_cover,
  max(other) filter (kind = 'cover of') as cover_of_recording_mbid,
  max(title) filter (kind = 'cover of') as cover_of_recording_title,
  list({'recording_mbid': other, 'title': title})
    filter (kind = 'covers' and trim(other) <> '') as covered_by
from (select recording_mbid, lower(ifnull(rel->>'$.type', '')) as kind,
        rel->>'$.recording.id' as other, rel->>'$.recording.title' as title
      from relations where target = 'recording')
group by all
"""
CTES["instrument_rows"] = """
select distinct recording_mbid, a->>'$' as name
from (select recording_mbid, unnest((rel->'$."attribute-list"')::json[]) as a
      from (select recording_mbid, rel from relations where target = 'artist'
            union all
            select recording_mbid, unnest((j->'$."artist-relation-list"')::json[]) from docs))
where trim(a->>'$') <> ''
"""
CTES["metadata"] = """
select d.recording_mbid as id, d.recording_mbid, t.names[1] as top_genre,
  t.names[2] as top_style, to_json(t.names)::varchar as genre_list_json,
  to_json(t.names)::varchar as style_list_json,
  ifnull(to_json(i.names)::varchar, '[]') as instrument_list_json,
  w.first_work.id as primary_work_mbid, w.first_work.title as primary_work_title,
  ifnull(c.is_cover, false) as is_cover, c.cover_of_recording_mbid,
  c.cover_of_recording_title,
  ifnull(to_json(c.covered_by)::varchar, '[]') as covered_by_recordings_json,
  'musicbrainz_api' as metadata_source, d.last_seen_at,
  d.last_seen_at as musicbrainz_metadata_updated_at
from docs d
left join tag_figures t using (recording_mbid)
left join (select recording_mbid, list(name order by lower(name), name) as names
           from instrument_rows group by all) i using (recording_mbid)
left join (select recording_mbid,
             min({'l': lower(work_mbid), 'id': work_mbid, 'title': title}) as first_work
           from links group by all) w using (recording_mbid)
left join cover_figures c using (recording_mbid)
"""
CTES["writers"] = """
select work_mbid || ':' || artist_mbid || ':' || writer_role as id, work_mbid, artist_mbid,
  rel->>'$.artist.name' as artist_name, writer_role,
  ifnull(rel->>'$."attribute-list"', '[]') as attributes_json, last_seen_at
from (select work_mbid, last_seen_at, rel, place, rel->>'$.artist.id' as artist_mbid,
        lower(rel->>'$.type') as writer_role
      from (select work_mbid, last_seen_at, unnest(list) as rel,
              generate_subscripts(list, 1) as place
            from (select work_mbid, last_seen_at, (b->'$.relation')::json[] as list
                  from (select work_mbid, last_seen_at,
                          unnest((j->'$."relation-list"')::json[]) as b from work_docs)
                  where b->>'$."target-type"' = 'artist')))
where writer_role in ('writer', 'composer', 'lyricist', 'librettist')
  and trim(artist_mbid) <> '' and trim(work_mbid) <> ''
qualify 1 = row_number() over (partition by work_mbid, artist_mbid, writer_role order by place)
"""
CTES["failures"] = """
select upper(trim(isrc)) as isrc, ifnull(max(error_404_count), 0) as misses,
  max(try_cast(last_failed_at as timestamp)) as failed_at
from raw_isrc_failures where trim(isrc) <> '' group by all
"""
CTES["pending_all"] = """
select track_id, upper(trim(isrc)) as isrc, try_cast(added_at as timestamp) as added
from raw_saved_tracks s
where trim(isrc) <> '' and not ifnull((
  select bool_and(c.recording_mbid in (select recording_mbid from raw_recording_payloads))
  from raw_isrc_candidates c where c.track_id = s.track_id), false)
"""
CTES["retry_all"] = """
select distinct c.track_id, upper(trim(c.isrc)) as isrc,
  try_cast(s.added_at as timestamp) as added
from raw_isrc_candidates c join raw_saved_tracks s using (track_id)
where trim(c.isrc) <> '' and c.recording_mbid in (
  select recording_mbid from links
  where work_mbid not in (select work_mbid from raw_work_payloads))
"""
_DUE = f"""
select p.*, ifnull(f.misses, 0) as misses
from {{source}} p left join failures f using (isrc)
where ifnull(f.misses, 0) < 10
  and ifnull(f.failed_at <= {AS_OF} - interval 7 days, true)
"""
CTES["pending"] = _DUE.format(source="pending_all")
CTES["retry"] = _DUE.format(source="retry_all")
CTES["due"] = """
select * from pending union all
select * from retry where (select count(*) from pending) = 0
"""
CTES["codes"] = """
select isrc, misses as error_404_count, newest_added_at,
  row_number() over (order by misses, newest_added_at desc nulls last, isrc) as isrc_queue_rank
from (select isrc, max(misses) as misses, max(added) as newest_added_at from due group by isrc)
"""
CTES["queue"] = """
select track_id as id, track_id, isrc, isrc_queue_rank,
  row_number() over (partition by isrc order by added desc nulls last, track_id)
    as isrc_track_rank
from due join codes using (isrc)
"""
CTES["context"] = f"""
select s.track_id as id, s.track_id, s.track_name, s.isrc,
  ifnull(a.names, s.primary_artist_name) as artist_names,
  s.primary_artist_name as spotify_primary_artist_name, s.album_name,
  s.album_release_date, s.added_at, s.spotify_updated_at, s.duration_ms, s.explicit,
  ifnull(s.popularity, 0) as popularity, m.recording_mbid, m.musicbrainz_map_updated_at,
  r.mb_recording_title, r.mb_primary_artist_name, r.mb_release_title, r.mb_release_date,
  r.mb_disambiguation, r.musicbrainz_recording_updated_at, d.top_genre, d.top_style,
  d.genre_list_json, d.style_list_json, d.instrument_list_json, d.primary_work_mbid,
  d.primary_work_title, d.is_cover, d.cover_of_recording_mbid,
  d.cover_of_recording_title, d.covered_by_recordings_json,
  d.musicbrainz_metadata_updated_at, l.first_release_date, l.latest_release_date,
  l.release_titles, l.release_group_types, l.has_single_release, l.has_album_release,
  l.releases_updated_at, w.writer_names, w.writer_roles, w.writers_updated_at,
  w.work_writer_list_json, w.named_updated_at,
  datediff('day', s.added_at::date, {AS_OF}::date) as days_since_added,
  case when days_since_added is null then 0
       else greatest(0, 100 - least(days_since_added, 100)) end as freshness_score
from tracks s
left join (select track_id, string_agg(artist_name, ', ' order by artist_order) as names
           from credits group by all) a using (track_id)
left join matches m using (track_id)
left join recordings r on r.recording_mbid = m.recording_mbid
left join metadata d on d.recording_mbid = m.recording_mbid
left join (
  select recording_mbid, min(released) as first_release_date,
    max(released) as latest_release_date,
    array_to_string(list_sort(list(distinct r->>'$.title')), ' | ') as release_titles,
    array_to_string(list_sort(list(distinct kind)), ', ') as release_group_types,
    bool_or(ifnull(lower(kind) = 'single', false)) as has_single_release,
    bool_or(ifnull(lower(kind) = 'album', false)) as has_album_release,
    max(last_seen_at) as releases_updated_at
  from release_rows group by all) l on l.recording_mbid = m.recording_mbid
left join (
  select work_mbid, array_to_string(list_sort(list(distinct artist_name)), ', ') as writer_names,
    array_to_string(list_sort(list(distinct writer_role)), ', ') as writer_roles,
    max(last_seen_at) as writers_updated_at,
    max(last_seen_at) filter (trim(artist_name) <> '') as named_updated_at,
    to_json(list_transform(list_sort(list(distinct {{'l': lower(artist_name), 'n': artist_name}})
      filter (trim(artist_name) <> '')), lambda x: x.n))::varchar as work_writer_list_json
  from writers group by all) w on w.work_mbid = d.primary_work_mbid
"""
_LATEST = """greatest(
  ifnull(spotify_updated_at, '1900-01-01'::timestamp),
  ifnull(musicbrainz_map_updated_at, '1900-01-01'::timestamp),
  ifnull(musicbrainz_recording_updated_at, '1900-01-01'::timestamp),
  ifnull(musicbrainz_metadata_updated_at, '1900-01-01'::timestamp)"""
CTES["ready"] = f"""
select * exclude (spotify_primary_artist_name, first_release_date, latest_release_date,
    release_titles, release_group_types, has_single_release, has_album_release,
    releases_updated_at, writer_names, writer_roles, writers_updated_at, named_updated_at),
  {_LATEST}, ifnull(named_updated_at, '1900-01-01'::timestamp)) as updated_at,
  round(0.6 * popularity + 0.4 * freshness_score
    + case when recording_mbid is null then 0 else 5 end
    - case when explicit then 10 else 0 end, 2)::double as playlist_fit_score
from context
"""
CTES["entity"] = f"""
select * exclude (duration_ms, work_writer_list_json, named_updated_at),
  {_LATEST}, ifnull(releases_updated_at, '1900-01-01'::timestamp),
    ifnull(writers_updated_at, '1900-01-01'::timestamp)) as updated_at,
  round(0.55 * popularity + 0.35 * freshness_score
    + case when recording_mbid is null then 0 else 4 end
    + case when has_single_release then 1.5 else 0 end
    + case when has_album_release then 1 else 0 end
    - case when explicit then 10 else 0 end, 2)::double as auto_playlist_score
from context
"""
# The published clean-up patterns, as they act there.
_LABEL = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  lower(coalesce({x}, '')), '<[^>]*>', '', 'g'), '\\[[^\\]]*\\]|\\([^\\)]*\\)', '', 'g'),
  '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"""
_STRIPPED = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  lower(coalesce({x}, '')), '<[^>]*>', '', 'g'), '\[[^\]]*\]|\([^)]*\)', '', 'g'),
  '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"""
CTES["track_instruments"] = f"""
select distinct track_id, {_LABEL.format(x="name")} as instrument_name
from matches join instrument_rows using (recording_mbid) where instrument_name <> ''
"""
CTES["stats"] = """
select artist_id as id, artist_id, artist_name,
  count(distinct track_id) as saved_track_count,
  avg(popularity::double) as avg_popularity, min(added_at) as first_saved_at,
  max(added_at) as last_saved_at
from credits left join (select track_id, popularity, added_at from tracks) using (track_id)
group by all
"""
CTES["duplicates"] = """
select isrc as id, isrc, count(*) as duplicate_occurrences
from tracks group by isrc having count(*) > 1
"""
CTES["clusters"] = """
select *, count(*) over (partition by a, t, cluster) as duplicate_occurrences
from (select *, sum(jump) over (partition by a, t order by duration_ms, track_id
               rows unbounded preceding) as cluster
      from (select *, lower(trim(primary_artist_name)) as a, lower(trim(track_name)) as t,
              case when duration_ms - lag(duration_ms) over (partition by
                lower(trim(primary_artist_name)), lower(trim(track_name))
                order by duration_ms, track_id) <= 3000 then 0 else 1 end as jump
            from tracks where duration_ms is not null
              and trim(primary_artist_name) <> '' and trim(track_name) <> ''))
"""
# Intake: what the synthesised pages and answers hold.
CTES["lines"] = """
select l_orderkey, l_linenumber, min(l_suppkey) as supplier from lineitem group by all
"""
CTES["answers"] = """
select 'US' || lpad(p_partkey::varchar, 6, '0') as isrc, * from part
"""
CTES["queue_rows"] = """
select 't' || o_orderkey as track_id, 'US' || lpad(o_custkey::varchar, 6, '0') as isrc
from orders where o_orderstatus <> 'P'
"""
CTES["incoming"] = f"""
select * replace ('again' as track_name, {LATE} as ingest_run_at)
from raw_saved_tracks
where track_id in (select 't' || o_orderkey from orders where o_orderstatus = 'O')
union all by name
select 'c' || c_custkey as track_id, c_mktsegment as track_name, {LATE} as ingest_run_at
from customer
"""

CTES["new_candidates"] = f"""
select track_id, isrc, id as recording_mbid, match_rank, {LATE} as matched_at,
  '{{"id":"' || id || '","title":"' || title || '"}}' as isrc_response_json
from queue_rows join (
  select isrc, 'r' || p_partkey as id, p_name as title, 1 as match_rank from answers
  where p_size <= 45
  union all
  select isrc, 's' || p_size, 'other', 3 from answers where p_size <= 45) using (isrc)
"""
# A recording without details has the title of its code's entry.
CTES["new_payloads"] = f"""
select 'r' || p_partkey as recording_mbid,
  '{{"id":"r' || p_partkey || '","title":"'
    || case when p_size <= 15 then p_type else p_name end || '"}}' as payload_json,
  {LATE} as last_seen_at
from part where p_size <= 30
"""
# What the answers to queued codes list; their documents link no works.
CTES["asked_payloads"] = """
select * from new_payloads where recording_mbid in (
  select 'r' || p_partkey from answers where p_size <= 45 and isrc in (select isrc from queue_rows)
  union all
  select 's' || p_size from answers where p_size <= 45 and isrc in (select isrc from queue_rows))
"""

QUERIES: dict[str, str] = {
    "saved_tracks": "select * from tracks",
    "track_artists": "select * from credits",
    "match_map": "select * from matches",
    "recordings": "select * from recordings",
    "recording_artists": """
select (c->>'$.artist.id') || ':' || recording_mbid || ':' || n as id,
  c->>'$.artist.id' as artist_mbid, c->>'$.artist.name' as artist_name,
  c->>'$.artist."sort-name"' as sort_name, c->>'$.artist.disambiguation' as disambiguation,
  c->>'$.artist.type' as artist_type, c->>'$.artist.country' as artist_country,
  c->>'$.artist.gender' as artist_gender, n as credit_order,
  recording_mbid as source_recording_mbid, last_seen_at
from credit_rows where trim(c->>'$.artist.id') <> ''
""",
    "releases": """
select release_mbid || ':' || recording_mbid as id, release_mbid,
  r->>'$.title' as release_title, released as release_date, r->>'$.country' as release_country,
  r->>'$.status' as release_status, r->>'$."release-group".id' as release_group_mbid,
  r->>'$."release-group".title' as release_group_title, kind as release_group_primary_type,
  ifnull(r->>'$."release-group"."secondary-type-list"', '[]')
    as release_group_secondary_types_json,
  recording_mbid as source_recording_mbid, last_seen_at
from release_rows
""",
    "works": """
select work_mbid as id, work_mbid, j->>'$.title' as work_title, j->>'$.type' as work_type,
  j->>'$.language' as work_language, j->>'$.disambiguation' as disambiguation, last_seen_at
from work_docs
""",
    "work_writers": "select * from writers",
    "recording_metadata": "select * from metadata",
    "enrichment_queue": "select * from queue",
    "queue_export": """
select * exclude (id) from queue where isrc_queue_rank <= 1000
""",
    "queue_export_all": "select * exclude (id) from queue",
    "queue_rank": "select * from codes",
    "ready_tracks_base": "select * from ready",
    "entity_context_base": "select * from entity",
    "ready_tracks": "select * from ready",
    "entity_context": "select * from entity",
    "track_instrument": "select * from track_instruments",
    "artist_stats": "select * from stats",
    "favorite_artist": """
select * from stats order by saved_track_count desc, avg_popularity desc nulls last,
  artist_id, artist_name limit 1
""",
    "isrc_duplicates": "select * from duplicates",
    "isrc_duplicate_albums": """
select isrc, row_number() over (partition by isrc
    order by added_at desc nulls last, track_id) as position, album_name, album_release_date
from tracks qualify count(*) over (partition by isrc) > 1
""",
    "top_artists": """
select * exclude (id) from stats order by saved_track_count desc, artist_name, artist_id limit 10
""",
    "top_ready_tracks": """
select track_name, artist_names, popularity, freshness_score, playlist_fit_score
from ready order by playlist_fit_score desc, track_id limit 50
""",
    "top_entity_context": """
select track_name, artist_names, top_genre, top_style, writer_names, release_group_types,
  is_cover, auto_playlist_score
from entity order by auto_playlist_score desc, track_id limit 50
""",
    "artist_sample": "select * from stats order by artist_id, artist_name limit 50",
    "playlist_candidates": """
select track_id, track_name, artist_names, album_name, popularity, playlist_fit_score, added_at
from ready where track_id in (select track_id from tracks where not is_local)
qualify 3 >= row_number() over (partition by split_part(artist_names, ', ', 1)
  order by playlist_fit_score desc, popularity desc, track_id)
""",
    "instrument_playlist": r"""
select distinct track_id, track_name, split_part(artist_names, ', ', 1) as primary_artist_name
from ready where track_id in (select track_id from track_instruments
  where regexp_matches(instrument_name, '\bharp\b'))
""",
    "artist_instrument_playlist": """
select track_id, track_name, split_part(artist_names, ', ', 1) as primary_artist_name,
  playlist_fit_score, to_json(names)::varchar as instrument_names
from ready join (select track_id, list(instrument_name order by instrument_name) as names
                 from track_instruments group by all) using (track_id)
where primary_artist_name = 'Artist 1'
""",
    "title_duration_duplicates": """
select primary_artist_name, track_name, duration_ms, album_name, album_release_date, added_at,
  track_id, duplicate_occurrences
from clusters where duplicate_occurrences > 1
""",
    "isrc_duplicate_detail": """
select isrc, count(*) over same as duplicate_count, track_id, track_name, primary_artist_name,
  album_name, album_release_date, added_at,
  row_number() over (partition by isrc order by added_at desc nulls last, track_id)
    as duplicate_rank_in_isrc,
  min(added_at) over same as first_added_at, max(added_at) over same as latest_added_at
from tracks where isrc is not null
window same as (partition by isrc)
qualify duplicate_count > 1
""",
    "isrc_duplicate_summary": """
select isrc, count(*) as duplicate_count, min(added_at) as first_added_at,
  max(added_at) as latest_added_at
from tracks where isrc is not null group by isrc having count(*) > 1
""",
    "isrc_duplicates_arrays": """
select isrc as id, isrc,
  to_json(list(album_name order by added_at desc nulls last, track_id))::varchar as album_names,
  to_json(list(album_release_date order by added_at desc nulls last, track_id))::varchar
    as album_release_dates,
  count(*) as duplicate_occurrences
from tracks group by isrc having count(*) > 1
""",
    "isrc_duplicate_text": """
select isrc, count(*) as duplicate_count,
  string_agg(concat(ifnull(track_name, '<unknown track>'), ' - ',
    ifnull(primary_artist_name, '<unknown artist>'), ' (',
    ifnull(album_name, '<unknown album>'), ', added ', added_at::varchar, ')'),
    ' | ' order by added_at desc nulls last, concat(ifnull(track_name, '<unknown track>'), ' - ',
    ifnull(primary_artist_name, '<unknown artist>'), ' (',
    ifnull(album_name, '<unknown album>'), ', added ', added_at::varchar, ')'))
    as duplicate_track_list,
  min(added_at) as first_added_at, max(added_at) as latest_added_at
from tracks where isrc is not null group by isrc having count(*) > 1
""",
    "isrc_duplicate_lines": """
select isrc, row_number() over (partition by isrc
    order by added_at desc nulls last, track_line, track_id) as position, track_line
from (select *, count(*) over (partition by isrc) as size,
        concat(ifnull(track_name, '<unknown track>'), ' - ',
          ifnull(primary_artist_name, '<unknown artist>'), ' (',
          ifnull(album_name, '<unknown album>'), ', added ', added_at::varchar, ')') as track_line
      from tracks where isrc is not null)
where size > 1
""",
    "request_metrics": """
select total as total_tracks_with_isrc, waiting as pending_queue_tracks,
  failed as pending_queue_with_errors_tracks,
  waiting - failed as pending_queue_without_errors_tracks, done as succeeded_tracks,
  round(100.0::double * done / nullif(total, 0), 2) as succeeded_pct_of_tracks_with_isrc,
  round(100.0::double * waiting / nullif(total, 0), 2) as pending_pct_of_tracks_with_isrc
from (select
  (select count(distinct (track_id, isrc)) from tracks where trim(isrc) <> '') as total,
  (select count(distinct (track_id, isrc)) from queue) as waiting,
  (select count(distinct (track_id, isrc)) from queue
   where isrc in (select isrc from failures)) as failed,
  (select count(distinct track_id) from matches
   where recording_mbid in (select recording_mbid from docs)) as done)
""",
    "retry_error_state": f"""
select f.isrc, f.misses as error_404_count, f.status.v as latest_error_status_code,
  f.failed_at as last_failed_at, f.failed_at + interval 7 days as next_retry_at,
  f.misses < 10 and ifnull(f.failed_at <= {AS_OF} - interval 7 days, false) as eligible_now,
  c.isrc is not null as currently_in_queue, c.isrc_queue_rank as queue_rank,
  f.message.v as latest_error_message
from (
  select upper(trim(isrc)) as isrc, max(ifnull(error_404_count, 0)) as misses,
    max(moment) as failed_at,
    max({{'at': moment, 'v': error_status_code}})
      filter (moment is not null and error_status_code is not null) as status,
    max({{'at': moment, 'v': error_message}})
      filter (moment is not null and error_message is not null) as message
  from (select *, try_cast(last_failed_at as timestamp) as moment from raw_isrc_failures)
  where trim(isrc) <> '' group by 1) f
left join codes c using (isrc)
""",
    "latest_per_key": """
select * exclude (props) from events
qualify 1 = row_number() over (partition by user_id order by ts desc, event_id desc)
""",
    "best_match": """
select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey from lineitem
qualify 1 = row_number() over (partition by l_orderkey
  order by l_linenumber, l_shipdate desc, l_partkey, l_suppkey)
""",
    "rank_cap": """
select o_custkey, o_orderkey, o_totalprice from orders
qualify 3 >= row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey)
""",
    "gap_clusters": """
select event_id, user_id, micros, session::bigint as session,
  count(*) over (partition by user_id, session) as session_events
from (select *, sum(jump) over (partition by user_id order by micros, event_id
               rows unbounded preceding) as session
      from (select event_id, user_id, epoch_us(ts) as micros,
              case when micros - lag(micros) over (partition by user_id order by epoch_us(ts), event_id)
                <= 1800000000 then 0 else 1 end as jump
            from events))
""",
    "ordered_array_agg": """
select l_orderkey, row_number() over (partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_returnflag) as position,
  case when l_returnflag <> 'R' then l_partkey end as part
from lineitem
""",
    "ordered_string_agg": """
select l_orderkey, row_number() over (partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_returnflag) as position,
  l_partkey::varchar as part
from lineitem where l_returnflag <> 'R'
""",
    "distinct_list_json": """
select o_custkey, row_number() over (partition by o_custkey
    order by lower(o_orderpriority), o_orderpriority) as position, o_orderpriority
from (select distinct o_custkey, o_orderpriority from orders where o_orderpriority is not null)
""",
    "arg_max_non_null": """
select user_id, max({'at': ts, 'kind': event_type}) filter (event_type <> 'error').kind
  as last_event_type
from events group by all
""",
    "normalize_label": f"""
select page_id, {_LABEL.format(x="html")} as label, {_STRIPPED.format(x="html")}
  as stripped_label
from pages
""",
    "status_code": r"""
select doc_id, regexp_extract(text, '\b([1-5]\d\d)\b', 1) as status_code from documents
""",
    "release_date_pad": """
select o_orderkey, case
    when o_orderstatus = 'F' then strftime(o_orderdate, '%Y') || '-01-01'
    when o_orderstatus = 'O' then strftime(o_orderdate, '%Y-%m') || '-01'
    when o_orderpriority in ('5-LOW', '1-URGENT') then '1900-01-01'
    else strftime(o_orderdate, '%Y-%m-%d') end as release_date
from orders
""",
    "fallback_union": """
select o_orderkey, o_orderpriority, o_totalprice, 'free' as case_name from orders
union all
select o_orderkey, o_orderpriority, o_totalprice, 'urgent' from orders
where o_orderpriority = '1-URGENT'
""",
    "last_wins": """
select * exclude (props) from events
qualify 1 = row_number() over (partition by user_id, event_type order by event_id desc)
""",
    "flatten_tracks": f"""
select 't' || o_orderkey as track_id, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') as added_at,
  case when o_orderpriority = '1-URGENT' then 'renamed' else o_orderpriority end as track_name,
  'us' || o_orderkey as isrc, 'al' || o_custkey as album_id,
  'Album "' || o_custkey || '"' as album_name,
  case o_orderstatus when 'F' then strftime(o_orderdate, '%Y-01-01')
    when 'O' then strftime(o_orderdate, '%Y-%m-01')
    else strftime(o_orderdate, '%Y-%m-%d') end as album_release_date,
  12 as album_total_tracks, 3 as track_number, 1 as disc_number,
  trunc(o_totalprice)::integer as duration_ms, o_orderstatus = 'F' as explicit,
  50 as popularity, false as is_local, 'a' || f.supplier as primary_artist_id,
  'Artist ' || f.supplier as primary_artist_name, 'u/' || o_orderkey as spotify_track_url,
  {LATE} as ingest_run_at
from orders left join (select l_orderkey, arg_min(supplier, l_linenumber) as supplier
                       from lines group by all) f on o_orderkey = l_orderkey
""",
    "flatten_track_artists": f"""
select 't' || o_orderkey as track_id, 'a' || supplier as artist_id,
  'Artist ' || supplier as artist_name,
  row_number() over (partition by o_orderkey, copy order by l_linenumber)::integer
    as artist_order, {LATE} as ingest_run_at
from lines join (select o_orderkey, 1 as copy from orders
                 union all
                 select o_orderkey, 2 from orders where o_orderpriority = '1-URGENT')
  on o_orderkey = l_orderkey
""",
    "flatten_candidates": "select * from new_candidates",
    "recording_results": "select * from new_payloads",
    "work_results": f"""
select 'w' || p_partkey as work_mbid, '{{"title":"' || p_name || '"}}' as payload_json,
  {LATE} as last_seen_at
from part where p_size <= 15
""",
    "load_candidates": """
select * from raw_isrc_candidates where track_id not in (select track_id from new_candidates)
union all by name select * from new_candidates
""",
    "load_payloads": """
select * from raw_recording_payloads
where recording_mbid not in (select recording_mbid from new_payloads)
union all by name select * from new_payloads
""",
    "schema_evolution": """
select isrc, error_status_code, null::varchar as error_message, last_failed_at,
  0 as error_404_count
from raw_isrc_failures
""",
    "stored_table": "select * from incoming",
    "missing_file": "select * from raw_saved_tracks",
    "collected_results": """
select 'isrc_candidates' as output_name, track_id as key, recording_mbid as value
from new_candidates
union all
select 'recording_payloads', recording_mbid, payload_json from asked_payloads
union all
select 'isrc_failures', isrc, case when p_size > 48 then '404' else '503' end
from answers where p_size > 45 and isrc in (select isrc from queue_rows)
""",
    "lookup_failures": f"""
select isrc, case when p_size > 48 then '404' else '503' end as error_status_code,
  'caused by: HTTP Error ' || case when p_size > 48 then '404' else '503: busy' end
    as error_message, {LATE} as last_failed_at
from answers where p_size > 45
""",
    "work_links": "select recording_mbid, work_mbid from links",
    "incremental_cutoff": """
select o_orderkey as item_no, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as added_at
from orders where o_orderpriority <> '5-LOW' and o_orderdate >= timestamp '2000-08-10'
union all
select o_orderkey, null from orders o where o_orderpriority = '5-LOW' and (
  o_orderdate >= timestamp '2000-08-10' or (o_orderdate, -o_orderkey) > (
    select max((x.o_orderdate, -x.o_orderkey)) from orders x
    where x.o_orderpriority <> '5-LOW' and x.o_orderdate < timestamp '2000-08-10'))
""",
    "capped_intake": """
select event_id, user_id from events
where (select count(distinct user_id) from events) < 100 or event_id <= (
  select max(first_id) from (select min(event_id) as first_id from events
                             group by user_id order by first_id limit 100))
""",
    "queue_groups": """
select isrc, row_number() over (partition by isrc order by track_id) as position, track_id
from queue_rows
""",
    "upsert_by_key": """
select * from raw_saved_tracks where track_id not in (select track_id from incoming)
union all by name select * from incoming
""",
    "replace_children": """
select * from raw_track_artists where track_id not in (select track_id from incoming)
union all
select track_id, primary_artist_id, primary_artist_name, 1, ingest_run_at
from incoming where primary_artist_id is not null
""",
    "failure_ledger_merge": f"""
select ifnull(k.isrc, n.code) as isrc,
  case when n.code is null then k.error_status_code else n.status end as error_status_code,
  case when n.code is null then k.error_message else n.message end as error_message,
  case when n.code is null then k.last_failed_at else {LATE} end as last_failed_at,
  case when n.code is null then k.error_404_count
       else ifnull(k.error_404_count, 0) + ifnull((n.status = '404')::integer, 0) end
    as error_404_count
from raw_isrc_failures k full join (
  select 'US' || lpad((c_custkey * 2)::varchar, 6, '0') as code,
    case when c_acctbal < 3000 then '404' when c_mktsegment <> 'BUILDING' then '503' end as status,
    case when c_acctbal < 3000 then 'not found' end as message
  from customer) n on n.code = upper(trim(k.isrc))
""",
    "high_water_mark": "select ifnull(max(added_at)::varchar, '') as max_added_at from tracks",
    "row_count": "select count(*) as row_count from raw_saved_tracks",
    "csv_roundtrip": "select * from raw_recording_payloads",
    "run_summary": "\nunion all\n".join(
        f"select '{name}' as output_name, count(*) as row_count, "
        f"'2001-08-10T00:00:00' as generated_at, "
        f"(select count(distinct isrc) from queue_rows) as processed_isrcs from raw_{name}"
        for name in LANDING_SQL
    ),
    "dq_freshness": "\nunion all\n".join(
        f"""select '{name}' as table_name, max(ingest_run_at::timestamp) as max_loaded_at,
  case when count(ingest_run_at) = 0
         or max(ingest_run_at::timestamp) < {AS_OF} - interval 168 hours then 'error'
       when max(ingest_run_at::timestamp) < {AS_OF} - interval 48 hours then 'warn'
       else 'pass' end as status
from raw_{name}"""
        for name in ("saved_tracks", "track_artists")
    ),
}

# Checked tables as (report name, block or select).
_CHECKED = {
    "stg_spotify_saved_tracks": "tracks",
    "stg_spotify_track_artists": "credits",
    "stg_spotify_musicbrainz_map": "matches",
    "stg_musicbrainz_enrichment_queue": "queue",
    "stg_musicbrainz_recordings": "recordings",
    "stg_musicbrainz_recording_metadata": "metadata",
    "stg_musicbrainz_artists": "credit_rows",
    "stg_musicbrainz_releases": "release_rows",
    "stg_musicbrainz_works": "work_docs",
    "stg_musicbrainz_work_writers": "writers",
    "int_playlist_ready_tracks_base": "ready",
    "int_playlist_entity_context_base": "entity",
    "int_track_instrument": "track_instruments",
    "fct_playlist_ready_tracks": "ready",
    "fct_playlist_entity_context": "entity",
    "fct_artist_stats": "stats",
    "dim_favorite_artist": "(select id from stats limit 1)",
    "fct_track_duplicates": "duplicates",
}


def _not_null_report() -> str:
    from cratewise.plans.checks import NOT_NULL

    parts = []
    for table, columns in NOT_NULL.items():
        for column in columns:
            value = "c->>'$.artist.id'" if (table, column) == (
                "stg_musicbrainz_artists", "artist_mbid") else column
            where = "where trim(c->>'$.artist.id') <> ''" if value != column else ""
            parts.append(
                f"select '{table}' as table_name, '{column}' as column_name, "
                f"count(*) filter (({value}) is null) as failing_rows "
                f"from {_CHECKED[table]} {where}"
            )
    return "\nunion all\n".join(parts)


def _unique_report() -> str:
    from cratewise.plans.checks import UNIQUE

    return "\nunion all\n".join(
        f"select '{table}' as table_name, '{column}' as column_name, count(*) as repeated_values "
        f"from (select {column} from {_CHECKED[table]} where {column} is not null "
        f"group by {column} having count(*) > 1)"
        for table, columns in UNIQUE.items()
        for column in columns
    )


QUERIES["dq_not_null"] = _not_null_report()
QUERIES["dq_unique"] = _unique_report()


def _needed(text: str, blocks: dict[str, str], found: list[str]) -> list[str]:
    """Blocks ``text`` refers to, each after the ones it needs itself."""
    for name in blocks:
        if name not in found and re.search(rf"(?:from|join)\s+{name}\b", text):
            _needed(blocks[name], {k: v for k, v in blocks.items() if k != name}, found)
            found.append(name)
    return found


def with_blocks(text: str, blocks: dict[str, str]) -> str:
    names = _needed(text, blocks, [])
    if not names:
        return text.strip()
    ctes = ",\n".join(f"{name} as materialized ({blocks[name].strip()})" for name in names)
    return f"with {ctes}\n{text.strip()}"


def oracle_sql(stored: str | None = None) -> dict[str, str]:
    """DuckDB SQL per registered query, over landing tables stored in a folder if one is given."""
    blocks = dict(CTES)
    if stored:
        for name in LANDING_SQL:
            blocks[f"raw_{name}"] = f"select * from read_parquet('{stored}/{name}/*.parquet')"
    texts = {name: with_blocks(text, blocks) for name, text in QUERIES.items()}
    # The queue of the tracks with missing works, whether or not others wait.
    retries = blocks | {"due": "select * from retry"}
    texts["retry_queue"] = with_blocks(QUERIES["enrichment_queue"], retries)
    # Other ways to the same rows.
    same = {
        "intake_resumed": "flatten_tracks",
        "built_recordings": "recordings",
        "built_entity_context": "entity_context",
        "refresh_delta": "entity_context",
        "refresh_delta_artists": "artist_stats",
        "refresh_delta_albums": "isrc_duplicate_albums",
    }
    texts.update({name: texts[other] for name, other in same.items()})
    return texts
