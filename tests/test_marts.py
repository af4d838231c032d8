"""Track tables, figures and reports on hand-made rows."""

import datetime as dt
import json

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.fixtures import landing
from cratewise.plans import marts, reports
from cratewise.plans.models import Models

DAY = "2001-08-01T00:00:00+00:00"


@pytest.fixture
def models(rows, as_of):
    def make(**data):
        raw = {}
        for name, ddl in schemas.LANDING.items():
            fields = rows([], ddl).schema.names
            raw[name] = rows(
                [tuple(row.get(f) for f in fields) for row in data.get(name, [])], ddl
            )
        return Models(raw, as_of)

    return make


def track(track_id, **more):
    return {"track_id": track_id, "added_at": DAY, "popularity": 50, **more}


def recording(mbid, **doc):
    return {"recording_mbid": mbid, "payload_json": json.dumps(doc), "last_seen_at": DAY}


def candidate(track_id, mbid, rank=1, at=DAY):
    return {"track_id": track_id, "isrc": "us1", "recording_mbid": mbid, "match_rank": rank,
            "matched_at": at}


def test_typed_tracks(models):
    m = models(saved_tracks=[track("t", isrc=" us1 ", album_release_date="2001-02-03")])
    row = m.tracks.first()
    assert row["isrc"] == "US1" and row["album_release_date"] == dt.date(2001, 2, 3)
    assert row["spotify_updated_at"] == dt.datetime(2001, 8, 1)  # no ingest time: added_at
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        models(saved_tracks=[track("t", album_release_date="soon")]).tracks.collect()


def test_match_map_prefers_rank_then_newest(models):
    m = models(
        isrc_candidates=[
            candidate("t", "r1", 2),
            candidate("t", "r2", 1, "2001-07-01T00:00:00+00:00"),
            candidate("t", "r3", 1),
            candidate("u", "r4", None),
        ]
    )
    assert as_set(m.matches.select("track_id", "recording_mbid")) == [("t", "r3"), ("u", "r4")]


@pytest.mark.parametrize(
    ("added_at", "freshness"),
    [
        (None, 0),
        ("2001-08-10T23:00:00Z", 100),
        ("2001-08-05T00:00:00Z", 95),
        ("2001-01-01T00:00:00Z", 0),
        ("2001-08-12T00:00:00Z", 102),  # added in the future
    ],
)
def test_freshness(models, added_at, freshness):
    row = models(saved_tracks=[track("t", added_at=added_at)]).ready_tracks.first()
    assert row["freshness_score"] == freshness
    assert row["playlist_fit_score"] == pytest.approx(30 + 0.4 * freshness)


def test_scores(models):
    m = models(
        saved_tracks=[
            track("plain", added_at=None),
            track("explicit", added_at=None, explicit=True),
            track("matched", added_at=None, popularity=None),
        ],
        isrc_candidates=[candidate("matched", "r1")],
        recording_payloads=[
            recording("r1", **{"release-list": [
                {"id": "a", "release-group": {"type": "Single"}},
                {"id": "b", "release-group": {"primary-type": "ALBUM"}}]})
        ],
    )
    fit = {row["track_id"]: row["playlist_fit_score"] for row in m.ready_tracks.collect()}
    assert fit == {"plain": 30.0, "explicit": 20.0, "matched": 5.0}
    auto = {row["track_id"]: row["auto_playlist_score"] for row in m.entity_context.collect()}
    assert auto == {"plain": 27.5, "explicit": 17.5, "matched": 6.5}


def test_update_time_is_the_latest_of_all_sources(models):
    m = models(
        saved_tracks=[track("t"), track("never", added_at=None)],
        isrc_candidates=[candidate("t", "r1", at="2001-08-03T00:00:00+00:00")],
        recording_payloads=[recording("r1", title="x")],
    )
    got = {row["track_id"]: row["updated_at"] for row in m.ready_tracks.collect()}
    assert got == {"t": dt.datetime(2001, 8, 3), "never": dt.datetime(1900, 1, 1)}


def test_artist_names_in_credit_order(models):
    m = models(
        saved_tracks=[track("t"), track("u", primary_artist_name="Solo")],
        track_artists=[
            {"track_id": "t", "artist_name": "Second", "artist_order": 2},
            {"track_id": "t", "artist_name": None, "artist_order": 3},
            {"track_id": "t", "artist_name": "First", "artist_order": 1},
        ],
    )
    got = {row["track_id"]: row["artist_names"] for row in m.ready_tracks.collect()}
    assert got == {"t": "First, Second", "u": "Solo"}


def test_track_grain_is_kept(spark, sf_dir, as_of):
    m = Models(landing(spark, sf_dir), as_of)
    saved = m.tracks.count()
    assert m.ready_tracks.count() == saved and m.entity_context.count() == saved
    assert m.matches.groupBy("track_id").count().where("count > 1").isEmpty()


def test_artist_stats(models):
    m = models(
        saved_tracks=[track("t", popularity=10), track("u", popularity=None), track("v")],
        track_artists=[
            {"track_id": "t", "artist_id": "a", "artist_name": "Old", "artist_order": 1},
            {"track_id": "t", "artist_id": "a", "artist_name": "Old", "artist_order": 2},
            {"track_id": "u", "artist_id": "a", "artist_name": "Old", "artist_order": 1},
            {"track_id": "v", "artist_id": "a", "artist_name": "New", "artist_order": 1},
            {"track_id": "lost", "artist_id": "b", "artist_name": "B", "artist_order": 1},
        ],
    )
    got = m.artist_stats.select("artist_id", "artist_name", "saved_track_count", "avg_popularity")
    assert sorted(map(str, got.collect())) == sorted(
        map(str, [*rows_of(("a", "Old", 2, 10.0), ("a", "New", 1, 50.0), ("b", "B", 1, None))])
    )
    assert m.favorite_artist.first()["artist_name"] == "Old"


def rows_of(*data):
    from pyspark.sql import Row

    make = Row("artist_id", "artist_name", "saved_track_count", "avg_popularity")
    return [make(*values) for values in data]


def test_instruments_are_cleaned_and_distinct(models):
    m = models(
        saved_tracks=[track("t", primary_artist_name="X"), track("u", primary_artist_name="Y")],
        isrc_candidates=[candidate("t", "r1"), candidate("u", "r1")],
        recording_payloads=[
            recording("r1", **{"artist-relation-list": [
                {"attribute-list": ["<b>Harp</b>", "harp", "()", {"attribute": "harp"}, "harpsichord"]}
            ]})
        ],
    )
    got = m.track_instruments.where("track_id = 't'").select("instrument_name")
    assert as_set(got) == [("attribute   harp",), ("harp",), ("harpsichord",)]
    found = reports.instrument_playlist(m.ready_tracks, m.instrument_lists, "harp")
    assert [row["track_id"] for row in found.collect()] == ["t", "u"]
    mine = reports.artist_instrument_playlist(m.ready_tracks, m.instrument_lists, "X")
    assert mine.first()["instrument_names"] == ["attribute   harp", "harp", "harpsichord"]
    none = reports.artist_instrument_playlist(m.ready_tracks, m.instrument_lists, "X", ["organ"])
    assert none.isEmpty()


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_duplicates(models, hot_rows):
    saved = [
        track("a", isrc="us1", album_name="A", added_at="2001-08-01T00:00:00Z"),
        track("b", isrc=" US1", album_name=None, added_at="2001-08-02T00:00:00Z"),
        track("c", isrc="us1", album_name="C", added_at=None),
        track("d", isrc="us2"),
        track("e", isrc=None, album_name="E"),
        track("f", isrc=None, album_name="F"),
    ]
    tracks = models(saved_tracks=saved).tracks
    got = marts.isrc_duplicates(tracks).collect()
    assert {row["isrc"]: row["duplicate_occurrences"] for row in got} == {"US1": 3, None: 2}
    albums = marts.isrc_duplicate_albums(tracks, hot_rows=hot_rows).orderBy("position").collect()
    names = {code: [r["album_name"] for r in albums if r["isrc"] == code] for code in ("US1", None)}
    assert names == {"US1": [None, "A", "C"], None: ["E", "F"]} and len(albums) == 5
    detail = reports.isrc_duplicate_detail(tracks, hot_rows=hot_rows)
    assert [(r["track_id"], r["duplicate_rank_in_isrc"]) for r in detail.collect()] == [
        ("b", 1), ("a", 2), ("c", 3)
    ]
    assert detail.first()["first_added_at"] == dt.datetime(2001, 8, 1)
    summary = reports.isrc_duplicate_summary(tracks).collect()
    assert [(r["isrc"], r["duplicate_count"]) for r in summary] == [("US1", 3)]
    lines = reports.isrc_duplicate_lines(tracks, hot_rows=hot_rows).collect()
    assert [r["position"] for r in lines] == [1, 2, 3]
    assert lines[0]["track_line"] == (
        "<unknown track> - <unknown artist> (<unknown album>, added 2001-08-02 00:00:00)"
    )


def test_a_code_has_one_row_whatever_its_size(spark, models):
    saved = spark.range(10_001).selectExpr(
        "concat('t', id) as track_id", "'us1' as isrc", "'2001-08-01T00:00:00Z' as added_at"
    )
    m = models()
    m.landing["saved_tracks"] = m.landing["saved_tracks"].unionByName(saved, allowMissingColumns=True)
    assert [r["duplicate_occurrences"] for r in m.isrc_duplicates.collect()] == [10_001]
    assert [r["duplicate_count"] for r in reports.isrc_duplicate_summary(m.tracks).collect()] == [10_001]
    assert m.isrc_duplicate_albums.count() == reports.isrc_duplicate_lines(m.tracks).count() == 10_001


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_title_duration_duplicates(models, hot_rows):
    def named(track_id, duration, artist=" Ann ", title="Song"):
        return track(
            track_id, duration_ms=duration, primary_artist_name=artist, track_name=title
        )

    saved = [
        named("a", 1000), named("b", 3999, "ANN"), named("c", 7000), named("d", 10001),
        named("e", None), named("f", 1000, "  "), named("g", 1000, "Ann", " "),
        named("h", 5000, "Bob"), named("i", 5000, "bob", "song "), named("j", 5000, "Bob", "Other"),
    ]
    got = reports.title_duration_duplicates(models(saved_tracks=saved).tracks, hot_rows=hot_rows)
    assert as_set(got.select("track_id", "duplicate_occurrences")) == [
        ("a", 2), ("b", 2), ("h", 2), ("i", 2)
    ]


def test_playlist_candidates(models):
    saved = [
        track(f"t{n}", popularity=n, primary_artist_name="A, B" if n % 2 else "A", is_local=n == 9)
        for n in range(10)
    ]
    m = models(saved_tracks=saved)
    got = reports.playlist_candidates(m.scored_tracks)
    assert [row["track_id"] for row in got.collect()] == ["t8", "t7", "t6"]


def test_retry_error_state(models, as_of):
    m = models(
        saved_tracks=[track("t", isrc="us1")],
        isrc_failures=[
            {"isrc": "us1", "error_status_code": "503", "error_message": "busy",
             "last_failed_at": "2001-07-01T00:00:00Z", "error_404_count": 1},
            {"isrc": "US1", "error_status_code": "404", "error_message": None,
             "last_failed_at": "2001-08-03T00:00:00Z", "error_404_count": None},
            {"isrc": "us2", "error_status_code": "404", "last_failed_at": "bad",
             "error_404_count": 10},
        ],
    )
    from cratewise.plans import queue

    ranks = queue.ranked_codes(m.due)
    first, second = reports.retry_error_state(m.landing["isrc_failures"], ranks, as_of).collect()
    assert (first["isrc"], first["latest_error_status_code"]) == ("US1", "404")
    assert first["latest_error_message"] == "busy"  # the newest that has one
    assert first["eligible_now"] and first["currently_in_queue"] and first["queue_rank"] == 1
    assert first["next_retry_at"] == dt.datetime(2001, 8, 10)
    assert not second["eligible_now"] and second["queue_rank"] is None
    assert second["latest_error_status_code"] is None


def test_request_metrics_of_an_empty_library(models):
    m = models()
    row = reports.request_metrics(
        m.tracks, m.due.queued(), m.landing["isrc_failures"], m.matches,
        m.landing["recording_payloads"],
    ).first()
    assert row["total_tracks_with_isrc"] == 0 and row["succeeded_pct_of_tracks_with_isrc"] is None


def test_plans_shuffle_tracks_no_more_than_needed(spark, sf_dir, as_of, plan_of):
    m = Models(landing(spark, sf_dir), as_of)
    plan = plan_of(m.ready_tracks)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "SinglePartition" not in plan
    top = plan_of(reports.top_artists(m.artist_stats))
    assert "TakeOrderedAndProject" in top
    # Only the columns in use are read.
    assert "o_totalprice" not in plan and "l_extendedprice" not in plan


def test_reports_read_what_they_show(spark, sf_dir, as_of, plan_of):
    m = Models(landing(spark, sf_dir), as_of)
    for df in (reports.top_ready_tracks(m.scored_tracks), reports.playlist_candidates(m.scored_tracks)):
        plan = plan_of(df)
        # Payloads are made from the parts, saved tracks from the orders.
        assert "part.parquet" not in plan and plan.count("orders.parquet") == 1
    metrics = reports.request_metrics(
        m.tracks, m.due.queued(), m.landing["isrc_failures"], m.matches,
        m.landing["recording_payloads"],
    )
    assert "payload_json" not in plan_of(metrics)


def test_scan_reads_and_filters_what_a_query_needs(spark, sf_dir, plan_of):
    from cratewise.fixtures import sample

    df = sample(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    assert df.agg(F.count("*")).first()[0] > 0
