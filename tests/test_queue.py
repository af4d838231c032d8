"""The lookup queue: who is pending, who is retried, and in what order."""

import json

import pytest
from conftest import as_set

from cratewise import schemas
from cratewise.plans import queue, staging

EMPTY = {name: [] for name in schemas.LANDING}


@pytest.fixture
def due(spark, rows, as_of):
    def make(**data):
        raw = {}
        for name, ddl in schemas.LANDING.items():
            fields = rows([], ddl).schema.names
            given = [tuple(row.get(f) for f in fields) for row in data.get(name, [])]
            raw[name] = rows(given, ddl)
        return queue.due(
            raw["saved_tracks"],
            raw["isrc_candidates"],
            raw["recording_payloads"],
            raw["work_payloads"],
            staging.latest_payloads(raw["recording_payloads"], "recording_mbid"),
            raw["isrc_failures"],
            as_of,
        )

    return make


def track(track_id, isrc, added_at="2001-08-01T00:00:00Z"):
    return {"track_id": track_id, "isrc": isrc, "added_at": added_at}


def failure(isrc, count, at):
    return {"isrc": isrc, "error_404_count": count, "last_failed_at": at}


def ranks(q, **options):
    got = queue.enrichment_queue(q, **options)
    return as_set(got.select("isrc_queue_rank", "isrc_track_rank", "track_id", "isrc"))


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_order_within_and_between_codes(due, hot_rows):
    q = due(
        saved_tracks=[
            track("a1", " us1 ", "2001-08-01T00:00:00Z"),
            track("a2", "US1", "2001-08-03T00:00:00Z"),
            track("a3", "Us1", None),
            track("b1", "us2", "2001-08-04T00:00:00Z"),
            track("c1", "us3", "2001-08-04T00:00:00Z"),
            track("d1", "us4", None),
            track("e1", "us5", "bad"),
            track("f1", "  "),
            track("g1", None),
            track("h1", "us6", "2001-08-09T00:00:00Z"),
        ],
        isrc_failures=[failure("us6", 1, "2001-01-01T00:00:00+00:00")],
    )
    assert ranks(q, hot_rows=hot_rows) == [
        (1, 1, "b1", "US2"),
        (2, 1, "c1", "US3"),
        (3, 1, "a2", "US1"),
        (3, 2, "a1", "US1"),
        (3, 3, "a3", "US1"),
        (4, 1, "d1", "US4"),
        (5, 1, "e1", "US5"),
        (6, 1, "h1", "US6"),
    ]


def test_cap_keeps_whole_codes(due):
    q = due(saved_tracks=[track("a", "us1"), track("b", "us1"), track("c", "us2"), track("d", "us3")])
    assert ranks(q, max_codes=2) == [(1, 1, "a", "US1"), (1, 2, "b", "US1"), (2, 1, "c", "US2")]


def test_given_up_and_resting_codes_stay_out(due):
    exactly = "2001-08-03T00:00:00+00:00"  # seven days before
    later = "2001-08-03T00:00:01+00:00"
    q = due(
        saved_tracks=[track(f"t{n}", f"us{n}") for n in range(1, 8)],
        isrc_failures=[
            failure("us1", 9, exactly),
            failure("us2", 10, exactly),
            failure("us3", 0, later),
            failure(" US4 ", None, "unknown"),
            failure("us5", 3, exactly),
            failure("US5", 12, exactly),
            failure("us6", 0, exactly),
            failure("us6", 0, later),
        ],
    )
    assert [row[3] for row in ranks(q)] == ["US4", "US7", "US1"]


def test_a_track_is_pending_until_all_candidates_have_payloads(due):
    q = due(
        saved_tracks=[track("a", "us1"), track("b", "us2"), track("c", "us3"), track("d", "us4")],
        isrc_candidates=[
            {"track_id": "a", "isrc": "us1", "recording_mbid": "r1"},
            {"track_id": "b", "isrc": "us2", "recording_mbid": "r1"},
            {"track_id": "b", "isrc": "us2", "recording_mbid": "r2"},
            {"track_id": "c", "isrc": "us3", "recording_mbid": None},
        ],
        recording_payloads=[
            {"recording_mbid": "r1", "payload_json": "{}", "last_seen_at": "2001-08-01T00:00:00Z"}
        ],
    )
    assert [row[2] for row in ranks(q)] == ["b", "c", "d"]


def linking(work):
    return json.dumps(
        {"relation-list": [{"target-type": "work", "relation": [{"work": {"id": work}}]}]}
    )


RETRY = {
    "isrc_candidates": [
        {"track_id": "a", "isrc": " us1", "recording_mbid": "r1"},
        {"track_id": "a", "isrc": "US1", "recording_mbid": "r1"},
        {"track_id": "b", "isrc": "us2", "recording_mbid": "r2"},
        {"track_id": "c", "isrc": "us3", "recording_mbid": "r3"},
        {"track_id": "x", "isrc": "us4", "recording_mbid": "r1"},
    ],
    "recording_payloads": [
        {"recording_mbid": r, "payload_json": p, "last_seen_at": at}
        for r, p, at in [
            ("r1", linking("w1"), "2001-08-01T00:00:00Z"),
            ("r2", linking("w2"), "2001-08-01T00:00:00Z"),
            # Only the newest payload's links count.
            ("r3", linking("w1"), "2001-08-01T00:00:00Z"),
            ("r3", linking("w2"), "2001-08-02T00:00:00Z"),
        ]
    ],
    "work_payloads": [
        {"work_mbid": "w2", "payload_json": "{}", "last_seen_at": "2001-08-01T00:00:00Z"}
    ],
}


def test_retry_only_when_nothing_is_pending(due):
    known = [track("a", "us1"), track("b", "us2"), track("c", "us3")]
    assert ranks(due(saved_tracks=known, **RETRY)) == [(1, 1, "a", "US1")]
    pending = [*known, track("n", "us9")]
    assert [row[2] for row in ranks(due(saved_tracks=pending, **RETRY))] == ["n"]


def test_retry_also_rests_and_gives_up(due):
    known = [track("a", "us1"), track("b", "us2"), track("c", "us3")]
    tired = [failure("us1", 10, None)]
    assert ranks(due(saved_tracks=known, isrc_failures=tired, **RETRY)) == []


def test_empty_library(due):
    assert ranks(due()) == []


def test_queue_groups_keep_file_order(rows):
    data = [(" t2 ", "us2", 1), ("t1", "us1", 2), ("t9", "US2", 3), ("", "us3", 4), ("t4", " ", 5),
            ("t5", "us5", 6)]
    df = rows(data, "track_id string, isrc string, line int")
    got = queue.queue_groups(df, ["line"], max_codes=2)
    assert as_set(got.select("isrc", "position", "track_id")) == [
        ("US1", 1, "t1"), ("US2", 1, "t2"), ("US2", 2, "t9")
    ]
    assert queue.queue_groups(df, ["line"]).count() == 4


def test_pending_tracks_need_four_shuffles(spark, rows, plan_of):
    from cratewise import schemas

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        empty = {name: rows([], ddl) for name, ddl in schemas.LANDING.items()}
        pending = queue.pending_tracks(
            empty["saved_tracks"].repartition(2), empty["isrc_candidates"].repartition(2),
            empty["recording_payloads"].repartition(2),
        )
        text = pending._jdf.queryExecution().sparkPlan().toString()
        assert "payload_json" not in text.split("Scan")[0]
        assert plan_of(pending).count("Exchange hashpartitioning") <= 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
