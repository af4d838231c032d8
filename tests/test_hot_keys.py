"""A key that a third of all rows share, in joins to a side with one row per key."""

import pytest
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.operators.skew import lookup, splittable
from cratewise.plans import marts, queue, recordings
from cratewise.plans.models import Models

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
TRACKS = 30_000
# A third of the tracks share the first recording, which links the first work, as do a third
# of the others.
HOT = "if(id % 3 = 0, 0, id % 2000)"


@pytest.fixture
def no_broadcast(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def landing(spark):
    ids = spark.range(0, TRACKS, 1, 8)
    track = F.concat(F.lit("t"), F.col("id").cast("string"))
    recording = F.concat(F.lit("r"), F.expr(HOT).cast("string"))
    load = F.sha2(F.col("id").cast("string"), 512)
    saved = ids.select(
        track.alias("track_id"),
        F.lit("2001-08-01T00:00:00Z").alias("added_at"),
        load.alias("track_name"),
        F.concat(F.lit("us"), F.col("id").cast("string")).alias("isrc"),
        F.lit("2001-08-01T00:00:00Z").alias("ingest_run_at"),
        *[F.lit(None).cast("int").alias(x) for x in ("popularity", "album_total_tracks")],
    )
    candidates = ids.select(
        track.alias("track_id"),
        F.concat(F.lit("us"), F.col("id").cast("string")).alias("isrc"),
        recording.alias("recording_mbid"),
        F.lit(1).alias("match_rank"),
        F.lit("2001-08-01T00:00:00Z").alias("matched_at"),
        load.alias("isrc_response_json"),
    )
    number = F.col("id").cast("string")
    document = F.format_string(
        '{"title":"%s","relation-list":[{"target-type":"work","relation":[{"work":{"id":"w%s"}}]}],'
        '"artist-relation-list":[{"attribute-list":["harp %s"]}]}',
        load,
        F.when(F.col("id") % 3 == 0, "0").otherwise(number),
        number,
    )
    payloads = spark.range(0, 9000, 1, 4).select(
        F.concat(F.lit("r"), number).alias("recording_mbid"),
        document.alias("payload_json"),
        F.lit("2001-08-01T00:00:00Z").alias("last_seen_at"),
    )
    works = spark.range(1, 2000, 1, 4).select(
        F.concat(F.lit("w"), number).alias("work_mbid"),
        F.concat(F.lit('{"title":"'), load, F.lit('"}')).alias("payload_json"),
        F.lit("2001-08-01T00:00:00Z").alias("last_seen_at"),
    )
    found = {
        "saved_tracks": saved,
        "isrc_candidates": candidates,
        "recording_payloads": payloads,
        "work_payloads": works,
    }
    from cratewise.sources.tables import conform, empty

    return {
        name: conform(found[name], ddl) if name in found else empty(spark, ddl)
        for name, ddl in schemas.LANDING.items()
    }


def pending(m):
    raw = m.landing
    few = raw["recording_payloads"].where("recording_mbid > 'r5'")
    return queue.pending_tracks(raw["saved_tracks"], raw["isrc_candidates"], few)


def retries(m):
    raw = m.landing
    return queue.retry_tracks(
        raw["saved_tracks"], raw["isrc_candidates"], m.recording_documents, raw["work_payloads"]
    )


def work_of_recordings(m):
    """The hot work's figures; their side is an aggregate by the work."""
    rows = recordings.profiles(m.recording_documents)
    figures = rows.groupBy("primary_work_mbid").agg(F.max("top_genre").alias("genre"))
    return lookup(rows, splittable(figures), "primary_work_mbid", spread_by="recording_mbid")


JOINS = {
    "pending": (pending, 22_000),
    "retries": (retries, 10_000),
    "instruments": (lambda m: marts.track_instruments(m.matches, m.recording_documents), TRACKS),
    "context": (lambda m: m.track_context, TRACKS),
    "works": (work_of_recordings, 9000),
}


@pytest.mark.parametrize("name", JOINS)
def test_spark_cuts_the_hot_key(spark, no_broadcast, plan_of, as_of, name):
    make, least = JOINS[name]
    df = make(Models(landing(spark), as_of))
    assert len(df.collect()) >= least
    assert "skew=true" in plan_of(df)


def test_a_side_made_by_the_key_is_not_cut_by_itself(spark, no_broadcast, plan_of):
    """What ``splittable`` is for: without it Spark leaves the hot key whole."""
    rows = spark.range(0, TRACKS, 1, 8).select(F.expr(HOT).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("load"))
    unique = rows.groupBy("k").agg(F.max("load").alias("most"))
    plain, cut = rows.join(unique, "k"), rows.join(splittable(unique), "k")
    assert plain.count() == cut.count() == TRACKS
    for df, expected in ((plain, False), (cut, True)):
        df.collect()
        assert ("skew=true" in plan_of(df)) is expected
