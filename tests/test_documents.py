"""Recording and work documents, with the odd shapes they come in."""

import json

import pytest
from conftest import as_set

from cratewise import schemas
from cratewise.plans import recordings, staging, works
from cratewise.sources import documents

SEEN = "2001-08-01T00:00:00+00:00"

FULL = {
    "title": "T",
    "length": 180000,
    "artist-credit": [
        {"artist": {"id": "m2", "name": "Zed", "sort-name": "Z", "type": "Person"}},
        " feat. ",
        {"artist": {"id": "m1", "name": "abe"}},
        {"artist": {"id": " ", "name": "nobody"}},
    ],
    "release-list": [
        {"id": "l1", "title": "One", "date": "2001", "release-group": {"type": "Single"}},
        {
            "id": "l2",
            "title": "Two",
            "date": "2001-05-06",
            "release-group": {
                "id": "g",
                "primary-type": "Album",
                "type": "x",
                "secondary-type-list": ["Live", "Demo"],
            },
        },
        {"id": "l2", "title": "Two again", "date": "1999-01-01"},
        {"title": "no id"},
        {"id": "l3", "release-group": "text instead of an object"},
    ],
    "tag-list": [
        {"name": "rock", "count": "2"},
        {"name": "Jazz", "count": 2},
        {"name": "  ", "count": "9"},
        {"name": "folk", "count": "many"},
    ],
    "relation-list": [
        {"target-type": "work", "relation": [
            {"type": "performance", "work": {"id": "W9", "title": "Nine"}},
            {"type": "performance", "work": {"id": "w1", "title": "First"}},
            {"work": {"id": " "}}]},
        {"target-type": "recording", "relation": [
            {"type": "Cover of", "recording": {"id": "r7", "title": "Seven"}},
            {"type": "covers", "recording": {"id": "r8"}},
            {"type": "covers", "recording": {"id": "  ", "title": "blank"}}]},
        {"target-type": "artist", "relation": [
            {"type": "instrument", "attributes": ["piano"]},
            {"type": "vocal", "attribute-list": ["lead vocals"]}]},
        {"target-type": "place"},
    ],
    "artist-relation-list": [
        {"type": "instrument", "attribute-list": ["Harp", "harp", " ", None, {"attribute": "organ"}]},
        {"type": "instrument"},
    ],
}


@pytest.fixture
def latest(rows):
    def make(*payloads):
        data = [
            (f"r{n}", p if p is None or isinstance(p, str) else json.dumps(p), SEEN)
            for n, p in enumerate(payloads)
        ]
        raw = rows(data, schemas.RECORDING_PAYLOADS)
        return staging.latest_payloads(raw, "recording_mbid")

    return make


def test_recordings(latest):
    row = recordings.recordings(latest(FULL)).first()
    assert row["mb_recording_title"] == "T"
    assert row["mb_length_ms"] == 180000
    assert row["mb_primary_artist_name"] == "Zed"
    assert row["mb_artist_credit_text"] == "abe, nobody, Zed"
    assert row["mb_release_title"] == "One"
    assert row["mb_release_date"] is None  # a year alone is no date


@pytest.mark.parametrize("payload", [{}, None, {"artist-credit": []}, {"tag-list": None}])
def test_empty_documents_keep_their_row(latest, payload):
    rows = latest(payload)
    row = recordings.recordings(rows).first()
    assert row["recording_mbid"] == "r0" and row["mb_artist_credit_text"] is None
    meta = recordings.metadata(rows).first()
    assert meta["genre_list_json"] is None and meta["is_cover"] is False
    assert meta["instrument_list_json"] == "[]" and meta["covered_by_recordings_json"] == "[]"
    profile = recordings.profiles(rows).first()
    assert profile["has_single_release"] is None and profile["releases_updated_at"] is None
    assert recordings.recording_artists(rows).count() == 0
    assert recordings.releases(rows).count() == 0


def test_credits_are_numbered_by_name(latest):
    got = recordings.recording_artists(latest(FULL)).select("id", "artist_name", "credit_order")
    assert as_set(got) == [("m1:r0:1", "abe", 1), ("m2:r0:3", "Zed", 3)]


def test_releases_keep_the_first_of_an_id(latest):
    got = recordings.releases(latest(FULL)).collect()
    by_id = {row["release_mbid"]: row for row in got}
    assert sorted(by_id) == ["l1", "l2", "l3"]
    assert by_id["l2"]["release_title"] == "Two"
    assert by_id["l2"]["release_date"].isoformat() == "2001-05-06"
    assert by_id["l2"]["release_group_primary_type"] == "Album"
    assert by_id["l2"]["release_group_secondary_types_json"] == '["Live","Demo"]'
    assert by_id["l1"]["release_group_primary_type"] == "Single"
    assert by_id["l1"]["release_group_secondary_types_json"] == "[]"
    assert by_id["l3"]["release_group_primary_type"] is None


def test_metadata(latest):
    row = recordings.metadata(latest(FULL)).first()
    assert row["genre_list_json"] == '["Jazz","rock","folk"]'
    assert (row["top_genre"], row["top_style"]) == ("Jazz", "rock")
    assert (row["primary_work_mbid"], row["primary_work_title"]) == ("w1", "First")
    assert row["is_cover"] is True
    assert row["cover_of_recording_mbid"] == "r7"
    assert row["covered_by_recordings_json"] == '[{"recording_mbid":"r8","title":null}]'
    assert row["instrument_list_json"] == (
        '["Harp","harp","lead vocals","{\\"attribute\\":\\"organ\\"}"]'
    )


def test_attribute_fallback(latest):
    row = recordings.metadata(latest(FULL), attribute_fallback=True).first()
    assert row["instrument_list_json"] == '["Harp","harp","lead vocals","organ","piano"]'


def test_a_single_tag_has_no_second_rank(latest):
    row = recordings.metadata(latest({"tag-list": [{"name": "solo"}]})).first()
    assert (row["top_genre"], row["top_style"]) == ("solo", None)


def test_profile_release_figures(latest):
    row = recordings.profiles(latest(FULL)).first()
    assert row["first_release_date"].isoformat() == "2001-05-06"
    assert row["release_titles"] == "One | Two"
    assert row["release_group_types"] == "Album, Single"
    assert row["has_single_release"] and row["has_album_release"]


def test_the_newest_snapshot_counts_and_ties_are_settled(rows):
    data = [
        ("a", '{"title":"old"}', "2001-08-01T00:00:00+00:00"),
        ("a", '{"title":"new"}', "2001-08-02T00:00:00+00:00"),
        ("b", '{"title":"1"}', SEEN),
        ("b", '{"title":"2"}', SEEN),
    ]
    latest = staging.latest_payloads(rows(data, schemas.RECORDING_PAYLOADS), "recording_mbid")
    got = recordings.recordings(latest).select("recording_mbid", "mb_recording_title")
    assert as_set(got) == [("a", "new"), ("b", "2")]


def test_documents_are_parsed_once_and_never_joined(latest, plan_of):
    plan = plan_of(recordings.profiles(latest(FULL)))
    assert plan.count("from_json(StructField(title") == 1
    assert plan.count("Exchange") == 1 and "Join" not in plan
    # Exploding a list must not parse its document again for a size filter.
    for exploded, parses in ((recordings.releases, 1), (recordings.recording_artists, 2)):
        assert plan_of(exploded(latest(FULL))).count("from_json(") == parses


def test_writers(rows):
    doc = {
        "title": "W",
        "relation-list": [
            {"target-type": "artist", "relation": [
                {"type": "Composer", "artist": {"id": "a", "name": "Ann"},
                 "attribute-list": ["additional"]},
                {"type": "composer", "artist": {"id": "a", "name": "Ann again"}},
                {"type": "lyricist", "artist": {"id": "b", "name": "ann"}},
                {"type": "writer", "artist": {"id": "c", "name": " "}},
                {"type": "writer", "artist": {"id": "", "name": "no id"}},
                {"type": "publisher", "artist": {"id": "d", "name": "P"}}]},
            {"target-type": "work", "relation": [{"type": "writer", "artist": {"id": "e"}}]},
        ],
    }
    raw = rows(
        [("w1", json.dumps(doc), SEEN), ("w2", "{}", SEEN), (" ", json.dumps(doc), SEEN)],
        schemas.WORK_PAYLOADS,
    )
    latest = staging.latest_payloads(raw, "work_mbid")
    assert works.works(latest).count() == 3
    got = works.work_writers(latest).select("id", "artist_name", "attributes_json")
    assert as_set(got) == [
        ("w1:a:composer", "Ann", '["additional"]'),
        ("w1:b:lyricist", "ann", "[]"),
        ("w1:c:writer", " ", "[]"),
    ]
    figures = {row["work_mbid"]: row for row in works.writer_figures(latest).collect()}
    assert figures["w1"]["writer_names"] == " , Ann, ann"
    assert figures["w1"]["writer_roles"] == "composer, lyricist, writer"
    assert figures["w1"]["work_writer_list_json"] == '["Ann","ann"]'
    assert figures["w2"]["writer_names"] is None
    assert figures["w2"]["writers_updated_at"] is None


PAGES = [
    (1, {"items": [
        {"added_at": "2001-08-09T00:00:00Z", "track": {
            "id": "t1", "name": "One", "external_ids": {"isrc": "us1"},
            "album": {"id": "al", "name": "A", "release_date": "2001",
                      "release_date_precision": "year", "total_tracks": 9},
            "track_number": 1, "disc_number": 1, "duration_ms": 1000, "explicit": True,
            "popularity": 5, "is_local": False,
            "artists": [{"id": "a1", "name": "X"}, {"id": "a2", "name": "Y"}],
            "external_urls": {"spotify": "u/1"}}},
        {"added_at": "2001-08-08T00:00:00Z", "track": None},
        {"added_at": "2001-08-08T00:00:00Z", "track": {"id": None, "name": "local"}},
        {"added_at": None, "track": {"id": "t2", "name": "bare"}}]}),
    (2, {"items": [
        {"added_at": "2001-08-07T00:00:00Z", "track": {
            "id": "t1", "name": "One again", "artists": [{"id": "a1", "name": "X"}]}}]}),
    (3, {"items": []}),
    (4, {}),
]


@pytest.fixture
def items(rows):
    data = [(number, json.dumps(page)) for number, page in PAGES]
    return documents.page_items(rows(data, "page_no bigint, body string"))


def test_flatten_tracks(items):
    got = {row["track_id"]: row for row in documents.flatten_tracks(items, "now").collect()}
    assert sorted(got) == ["t1", "t2"]
    assert got["t1"]["track_name"] == "One again"  # the last occurrence counts
    assert got["t1"]["album_release_date"] == "1900-01-01"
    assert got["t2"]["explicit"] is False and got["t2"]["is_local"] is False
    assert got["t2"]["primary_artist_id"] is None
    assert list(got["t1"].asDict()) == [
        part.split()[0] for part in schemas.SAVED_TRACKS.replace("\n", " ").split(",")
    ]


def test_flatten_track_artists_repeats_with_the_items(items):
    got = documents.flatten_track_artists(items, "now").select(
        "track_id", "artist_id", "artist_order"
    )
    assert as_set(got) == [("t1", "a1", 1), ("t1", "a1", 1), ("t1", "a2", 2)]


def answers(rows, *data):
    return rows(list(data), "isrc string, body string, error string")


def test_flatten_candidates_rank_by_list_position(rows):
    body = {"isrc": {"recording-list": [{"id": "r1"}, {"title": "no id"}, {"id": "r3"}]}}
    codes = answers(
        rows, (" us1", json.dumps(body), None), ("us2", '{"isrc":{}}', None), ("us3", "{}", None)
    )
    queue = rows(
        [(" t1 ", "US1"), ("t2", "us1 "), ("t3", "us2"), (" ", "us1"), ("t4", None)],
        "track_id string, isrc string",
    )
    got = documents.flatten_candidates(codes, queue, "now").select(
        "track_id", "isrc", "recording_mbid", "match_rank"
    )
    assert as_set(got) == [
        ("t1", "US1", "r1", 1), ("t1", "US1", "r3", 3),
        ("t2", "US1", "r1", 1), ("t2", "US1", "r3", 3),
    ]


def test_payloads_need_a_successful_lookup(rows):
    body = json.dumps({"isrc": {"recording-list": [{"id": "r1", "title": "short"}]}})
    codes = answers(rows, ("us1", body, None))
    details = rows(
        [("r1", "{}", None), ("r2", '{"recording":{"id":"r2"}}', None), ("r3", None, "HTTP 500")],
        "recording_mbid string, body string, error string",
    )
    got = documents.recording_payloads(details, codes, "now").select(
        "recording_mbid", "payload_json"
    )
    assert as_set(got) == [("r1", '{"id":"r1","title":"short"}'), ("r2", '{"id":"r2"}')]
    found = rows(
        [("w1", '{"work":{"title":"W"}}', None), ("w2", '{"work":{}}', None), ("w3", None, "x")],
        "work_mbid string, body string, error string",
    )
    works_got = documents.work_payloads(found, "now").select("work_mbid", "payload_json")
    assert as_set(works_got) == [("w1", '{"title":"W"}')]


def test_lookup_failures(rows):
    codes = answers(rows, ("us1", None, "HTTP Error 404: gone"), ("us2", "{}", None), ("us3", None, "?"))
    got = documents.lookup_failures(codes, "now").select("isrc", "error_status_code")
    assert as_set(got) == [("US1", "404"), ("US3", "")]


def test_work_links(rows):
    raw = rows([("r1", json.dumps(FULL), SEEN), ("r2", "{}", SEEN)], schemas.RECORDING_PAYLOADS)
    assert as_set(documents.work_links(raw)) == [("r1", "W9"), ("r1", "w1")]
