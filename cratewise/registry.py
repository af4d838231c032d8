"""Every operator and table as a query over one set of sample tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise import samples, schemas
from cratewise.fixtures import AS_OF, landing, sample
from cratewise.functions.moments import pad_release_date
from cratewise.functions.text import normalize_label, status_code
from cratewise.operators import quality, state
from cratewise.operators.clusters import gap_clusters
from cratewise.operators.fallback import fallback_union
from cratewise.operators.lists import (
    distinct_elements,
    filled_elements,
    newest_filled,
    ordered_elements,
)
from cratewise.operators.ranking import best_match, keep_first, last_wins, latest_per_key
from cratewise.plans import checks, marts, queue, reports
from cratewise.plans.models import PUBLISHED, Models
from cratewise.plans.refresh import Refresh
from cratewise.plans.update import Touched, Update
from cratewise.session import TIGHT_SETTINGS, discard, prepare, shared_folder, stored, using
from cratewise.sources import documents, files
from cratewise.sources.tables import Change, KeyedTables, conform, fill_counter

LATE = dt.datetime.fromisoformat(samples.LATE_STAMP).replace(tzinfo=None)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; the session gets the library's settings.

    A ``_q`` ending only keeps the name apart from the operator it calls.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__.removesuffix("_q")] = run
    return function


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(landing(spark, sf_dir), AS_OF)


def _as_json(df: DataFrame, *lists: str) -> DataFrame:
    return df.withColumns({name: F.to_json(name) for name in lists})


# --- tables -------------------------------------------------------------------------


@query
def saved_tracks(spark, sf_dir):
    return models(spark, sf_dir).tracks


@query
def track_artists(spark, sf_dir):
    return models(spark, sf_dir).credits


@query
def match_map(spark, sf_dir):
    return models(spark, sf_dir).matches


@query
def recordings_q(spark, sf_dir):
    return models(spark, sf_dir).recordings


@query
def recording_artists(spark, sf_dir):
    return models(spark, sf_dir).recording_artists


@query
def releases(spark, sf_dir):
    return models(spark, sf_dir).releases


@query
def works(spark, sf_dir):
    return models(spark, sf_dir).works


@query
def work_writers(spark, sf_dir):
    return models(spark, sf_dir).work_writers


@query
def recording_metadata(spark, sf_dir):
    return models(spark, sf_dir).metadata


@query
def enrichment_queue(spark, sf_dir):
    return models(spark, sf_dir).enrichment_queue


@query
def retry_queue(spark, sf_dir):
    """The queue that the tracks with missing works would make."""
    return queue.enrichment_queue(models(spark, sf_dir).retries)


@query
def queue_export(spark, sf_dir):
    """The queue file of a run capped at 1000 codes."""
    due = models(spark, sf_dir).due
    return queue.enrichment_queue(due, max_codes=1000).drop("id").orderBy("isrc", "track_id")


@query
def queue_export_all(spark, sf_dir):
    """The queue file of all codes."""
    due = models(spark, sf_dir).due
    return queue.enrichment_queue(due).drop("id").orderBy("isrc", "track_id")


@query
def queue_rank(spark, sf_dir):
    ranks = queue.ranked_codes(models(spark, sf_dir).due)
    return ranks.select("isrc", "error_404_count", "newest_added_at", "isrc_queue_rank")


@query
def ready_tracks_base(spark, sf_dir):
    return models(spark, sf_dir).ready_tracks_base


@query
def entity_context_base(spark, sf_dir):
    return models(spark, sf_dir).entity_context_base


@query
def ready_tracks(spark, sf_dir):
    return models(spark, sf_dir).ready_tracks


@query
def entity_context(spark, sf_dir):
    return models(spark, sf_dir).entity_context


@query
def track_instrument(spark, sf_dir):
    return models(spark, sf_dir).track_instruments


@query
def artist_stats(spark, sf_dir):
    return models(spark, sf_dir).artist_stats


@query
def favorite_artist(spark, sf_dir):
    return models(spark, sf_dir).favorite_artist


@query
def isrc_duplicates(spark, sf_dir):
    return models(spark, sf_dir).isrc_duplicates


@query
def isrc_duplicate_albums(spark, sf_dir):
    return models(spark, sf_dir).isrc_duplicate_albums


def _keeping(asked: str | None = None):
    """Store what other tables read; the one asked for is written once, by the caller."""
    return lambda name, df: df if name == asked else stored(df)


# What a batch touches of a build, and what is made of it before the tracks are joined.
_LANDED = ("saved_tracks", "track_artists", "isrc_candidates", "recording_payloads", "work_payloads")
_STAGED = ("tracks", "credits", "matches", "recording_documents", "work_documents")


def _updated(spark, sf_dir, name: str, asked: str | None = None) -> DataFrame:
    """A table after a batch of the newest tracks, from a build without them.

    With them come the answers to their codes: the newest payloads of their recordings, and
    the works that those name. With ``asked``, a table made of the joined tracks, a stored
    table is deleted when the last that is made of it was stored.
    """
    with using(spark, TIGHT_SETTINGS):
        now = {name: stored(df) for name, df in landing(spark, sf_dir).all().items()}
        added = F.try_to_timestamp("added_at")
        newest = now["saved_tracks"].agg(F.max(added)).first()[0] or AS_OF
        late = added >= F.lit(newest - dt.timedelta(days=14))
        tracks = stored(now["saved_tracks"].where(late).select("track_id"))
        answered = now["isrc_candidates"].join(tracks, "track_id", "left_semi")
        answered = stored(answered.select("recording_mbid").distinct())
        payloads = now["recording_payloads"].join(answered, "recording_mbid", "left_semi")
        last_seen = payloads.groupBy("recording_mbid").agg(
            F.max("last_seen_at").alias("last_seen_at")
        )
        works = stored(documents.work_links(payloads).select("work_mbid").distinct())
        before = dict(now)
        # Read once, where these rows are staged.
        for table in ("saved_tracks", "track_artists", "isrc_candidates"):
            before[table] = state.without_keys(now[table], tracks, ["track_id"])
        # Read twice, and from files.
        before["recording_payloads"] = stored(
            state.without_keys(
                now["recording_payloads"], last_seen, ["recording_mbid", "last_seen_at"]
            )
        )
        before["work_payloads"] = stored(
            state.without_keys(now["work_payloads"], works, ["work_mbid"])
        )
        keep = _keeping(asked)
        built = Models(before, AS_OF - dt.timedelta(days=3), keep)

        def replaced(table: str, df: DataFrame) -> DataFrame:
            new = keep(table, df)
            if asked and table != asked:
                discard(getattr(built, table))
            return new

        touched = Touched(tracks, answered, works)
        update = Update(lambda table: getattr(built, table), now, touched, AS_OF, replaced)
        if asked:
            for table in _LANDED:
                update.part.landing[table]
            for table in _STAGED:
                getattr(built, table)
            discard(*now.values(), before["recording_payloads"], before["work_payloads"])
            # The build is whole before it is brought up to date.
            built.track_context
        return getattr(update.models, name)


@query
def refresh_delta(spark, sf_dir):
    """Scored tracks brought up to date after a batch."""
    return _updated(spark, sf_dir, "entity_context", asked="entity_context_base")


@query
def refresh_delta_artists(spark, sf_dir):
    """Artist figures merged from stored parts after a batch."""
    return _updated(spark, sf_dir, "artist_stats")


@query
def refresh_delta_albums(spark, sf_dir):
    """Albums of repeated codes brought up to date after a batch."""
    return _updated(spark, sf_dir, "isrc_duplicate_albums")


# --- reports ------------------------------------------------------------------------


@query
def top_artists(spark, sf_dir):
    return reports.top_artists(models(spark, sf_dir).artist_stats)


@query
def top_ready_tracks(spark, sf_dir):
    return reports.top_ready_tracks(models(spark, sf_dir).scored_tracks)


@query
def top_entity_context(spark, sf_dir):
    return reports.top_entity_context(models(spark, sf_dir).entity_context)


@query
def artist_sample(spark, sf_dir):
    """Fifty artists; the order is ours, as none is asked for."""
    return models(spark, sf_dir).artist_stats.orderBy("artist_id", "artist_name").limit(50)


@query
def playlist_candidates(spark, sf_dir):
    return reports.playlist_candidates(models(spark, sf_dir).scored_tracks)


@query
def instrument_playlist(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.instrument_playlist(m.ready_tracks, m.instrument_lists, "harp")


@query
def artist_instrument_playlist(spark, sf_dir):
    m = models(spark, sf_dir)
    rows = reports.artist_instrument_playlist(m.ready_tracks, m.instrument_lists, "Artist 1")
    return _as_json(rows, "instrument_names")


@query
def title_duration_duplicates(spark, sf_dir):
    return reports.title_duration_duplicates(models(spark, sf_dir).tracks)


@query
def isrc_duplicate_detail(spark, sf_dir):
    return reports.isrc_duplicate_detail(models(spark, sf_dir).tracks)


@query
def isrc_duplicate_summary(spark, sf_dir):
    return reports.isrc_duplicate_summary(models(spark, sf_dir).tracks)


@query
def isrc_duplicates_arrays(spark, sf_dir):
    """Albums of repeated codes as arrays, here written as JSON."""
    rows = marts.isrc_duplicate_arrays(models(spark, sf_dir).isrc_duplicate_albums)
    return _as_json(rows, "album_names", "album_release_dates")


@query
def isrc_duplicate_text(spark, sf_dir):
    return reports.isrc_duplicate_text(models(spark, sf_dir).tracks)


@query
def isrc_duplicate_lines(spark, sf_dir):
    return reports.isrc_duplicate_lines(models(spark, sf_dir).tracks)


@query
def request_metrics(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.request_metrics(
        m.tracks,
        m.due.queued(),
        m.landing["isrc_failures"],
        m.matches,
        m.landing["recording_payloads"],
    )


@query
def retry_error_state(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.retry_error_state(
        m.landing["isrc_failures"], queue.ranked_codes(m.due), AS_OF
    )


# --- operators over the sample tables -----------------------------------------------


@query
def latest_per_key_q(spark, sf_dir):
    events = sample(spark, sf_dir, "events").drop("props")
    return latest_per_key(events, ["user_id"], "ts", [F.col("event_id").desc()])


@query
def best_match_q(spark, sf_dir):
    lines = sample(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )
    ties = [F.col("l_partkey").asc(), F.col("l_suppkey").asc()]
    return best_match(lines, ["l_orderkey"], "l_linenumber", "l_shipdate", ties)


@query
def rank_cap(spark, sf_dir):
    orders = sample(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    dearest = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()]
    return keep_first(orders, ["o_custkey"], dearest, 3)


@query
def gap_clusters_q(spark, sf_dir):
    """Events of a user no more than half an hour apart."""
    events = sample(spark, sf_dir, "events").select(
        "event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros")
    )
    return gap_clusters(events, ["user_id"], "micros", 1_800_000_000, "session", "session_events")


@query
def ordered_array_agg(spark, sf_dir):
    lines = sample(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    order = [F.col(c).asc() for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")]
    # Returned lines count as NULL elements, which stay.
    part = F.when(F.col("l_returnflag") != "R", F.col("l_partkey"))
    return ordered_elements(lines, ["l_orderkey"], order, {"part": part})


@query
def ordered_string_agg(spark, sf_dir):
    lines = sample(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    order = [F.col(c).asc() for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")]
    part = F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string"))
    return filled_elements(lines, ["l_orderkey"], order, part, "part")


@query
def distinct_list_json(spark, sf_dir):
    orders = sample(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    return distinct_elements(orders, ["o_custkey"], "o_orderpriority")


@query
def arg_max_non_null(spark, sf_dir):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return sample(spark, sf_dir, "events").groupBy("user_id").agg(
        newest_filled(kind, F.col("ts")).alias("last_event_type")
    )


@query
def normalize_label_q(spark, sf_dir):
    return sample(spark, sf_dir, "pages").select(
        "page_id",
        normalize_label(F.col("html")).alias("label"),
        normalize_label(F.col("html"), strip_wrappers=True).alias("stripped_label"),
    )


@query
def status_code_q(spark, sf_dir):
    """First status-like number of every text."""
    return sample(spark, sf_dir, "documents").select(
        "doc_id", status_code(F.col("text")).alias("status_code")
    )


@query
def release_date_pad(spark, sf_dir):
    status = F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    date: Column = (
        F.when(status == "F", F.left(day, F.lit(4)))
        .when(status == "O", F.left(day, F.lit(7)))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .when(F.col("o_orderpriority") != "1-URGENT", day)
    )
    precision = F.when(status == "F", "year").when(status == "O", "month")
    return sample(spark, sf_dir, "orders").select(
        "o_orderkey", pad_release_date(date, precision).alias("release_date")
    )


@query
def fallback_union_q(spark, sf_dir):
    """Free orders are none, so all count; urgent orders are some, so only they do."""
    orders = sample(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    free = fallback_union(orders.where("o_totalprice < 0"), orders)
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    return (
        free.withColumn("case_name", F.lit("free"))
        .unionByName(fallback_union(urgent, orders).withColumn("case_name", F.lit("urgent")))
    )


@query
def last_wins_q(spark, sf_dir):
    events = sample(spark, sf_dir, "events").drop("props")
    return last_wins(events, ["user_id", "event_type"], ["event_id"])


# --- intake -------------------------------------------------------------------------


def _items(spark, sf_dir):
    return documents.page_items(samples.saved_track_pages(spark, sf_dir))


@query
def flatten_tracks(spark, sf_dir):
    return documents.flatten_tracks(_items(spark, sf_dir), samples.LATE_STAMP)


@query
def flatten_track_artists(spark, sf_dir):
    return documents.flatten_track_artists(_items(spark, sf_dir), samples.LATE_STAMP)


@query
def flatten_candidates(spark, sf_dir):
    answers = samples.lookup_answers(spark, sf_dir)
    queued = samples.queue_file(spark, sf_dir)
    return documents.flatten_candidates(answers, queued, samples.LATE_STAMP)


@query
def lookup_failures(spark, sf_dir):
    return documents.lookup_failures(samples.lookup_answers(spark, sf_dir), samples.LATE_STAMP)


@query
def work_links(spark, sf_dir):
    return documents.work_links(models(spark, sf_dir).recording_documents)


@query
def incremental_cutoff(spark, sf_dir):
    """Items newest first, read until one is older than the mark."""
    newest_first = -F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    items = sample(spark, sf_dir, "orders").select(
        newest_first.alias("place"),
        F.col("o_orderkey").alias("item_no"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("string")).alias(
            "added_at"
        ),
    )
    mark = AS_OF.replace(year=2000)
    return state.until_older(items, ["place", "item_no"], mark).drop("place")


@query
def capped_intake(spark, sf_dir):
    """Events in input order up to the one that brings the hundredth user."""
    events = sample(spark, sf_dir, "events").select("event_id", "user_id")
    return state.up_to_distinct(events, "user_id", ["event_id"], 100)


@query
def queue_groups(spark, sf_dir):
    rows = samples.queue_file(spark, sf_dir)
    return queue.queue_groups(rows, ["isrc", "track_id"])


@query
def intake_resumed(spark, sf_dir):
    """Pages taken in by runs that are capped at half the tracks, until nothing is left."""
    # The pages lie in a folder, as those of a service do, and every run reads them there.
    pages = stored(samples.saved_track_pages(spark, sf_dir))
    orders = sample(spark, sf_dir, "orders")
    cap = max(1, -(-orders.agg(F.countDistinct("o_orderkey")).first()[0] // 2))
    run = Refresh(spark, f"{shared_folder(spark)}/intake-{uuid.uuid4().hex}", LATE, buckets=8)
    # The last run finds no new track, only those that come twice.
    for _ in range(3):
        run.take_pages(pages, max_tracks=cap)
    return run.tables()["saved_tracks"]


@query
def collected_results(spark, sf_dir):
    """Keys of what a batch of answers brings; answers nobody asked for are left out."""
    found = documents.results(
        samples.lookup_answers(spark, sf_dir),
        samples.recording_answers(spark, sf_dir),
        samples.work_answers(spark, sf_dir),
        samples.queue_file(spark, sf_dir),
        samples.LATE_STAMP,
    )
    keys = {
        "isrc_candidates": ["track_id", "recording_mbid"],
        "recording_payloads": ["recording_mbid", "payload_json"],
        "work_payloads": ["work_mbid", "payload_json"],
        "isrc_failures": ["isrc", "error_status_code"],
    }
    rows = [
        found[name].select(
            F.lit(name).alias("output_name"), F.col(a).alias("key"), F.col(b).alias("value")
        )
        for name, (a, b) in keys.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def recording_results(spark, sf_dir):
    """Payloads of the recordings whose detail lookup succeeded."""
    answers = samples.lookup_answers(spark, sf_dir)
    details = samples.recording_answers(spark, sf_dir)
    return documents.recording_payloads(details, answers, samples.LATE_STAMP)


@query
def work_results(spark, sf_dir):
    """Payloads of the works whose lookup gave something."""
    return documents.work_payloads(samples.work_answers(spark, sf_dir), samples.LATE_STAMP)


# --- updates ------------------------------------------------------------------------


@query
def upsert_by_key(spark, sf_dir):
    tracks = landing(spark, sf_dir)["saved_tracks"]
    incoming = samples.incoming_tracks(spark, sf_dir, tracks)
    return state.upsert_by_key(tracks, incoming, ["track_id"])


@query
def replace_children(spark, sf_dir):
    """Open orders get one new artist each, except those without a saved name."""
    rows = landing(spark, sf_dir)
    parents = samples.incoming_tracks(spark, sf_dir, rows["saved_tracks"])
    incoming = parents.where(F.col("primary_artist_id").isNotNull()).select(
        "track_id",
        F.col("primary_artist_id").alias("artist_id"),
        F.col("primary_artist_name").alias("artist_name"),
        F.lit(1).alias("artist_order"),
        "ingest_run_at",
    )
    return state.replace_children(rows["track_artists"], parents, incoming, "track_id")


@query
def load_candidates(spark, sf_dir):
    """New candidates take the place of all earlier ones of their tracks."""
    incoming = documents.flatten_candidates(
        samples.lookup_answers(spark, sf_dir), samples.queue_file(spark, sf_dir), samples.LATE_STAMP
    )
    return state.upsert_by_key(landing(spark, sf_dir)["isrc_candidates"], incoming, ["track_id"])


@query
def load_payloads(spark, sf_dir):
    """A new payload takes the place of all snapshots of its recording."""
    incoming = recording_results(spark, sf_dir)
    payloads = landing(spark, sf_dir)["recording_payloads"]
    return state.upsert_by_key(payloads, incoming, ["recording_mbid"])


@query
def schema_evolution(spark, sf_dir):
    """A ledger stored before the counter and the message came, read in today's layout."""
    older = landing(spark, sf_dir)["isrc_failures"].drop("error_404_count", "error_message")
    return fill_counter(conform(older, schemas.ISRC_FAILURES), "error_404_count")


@query
def stored_table(spark, sf_dir):
    """Saved tracks stored, cleared and stored again with a batch, then read back."""
    tables = KeyedTables(spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}", 8)
    saved = landing(spark, sf_dir)["saved_tracks"]

    def put(batch: DataFrame) -> None:
        change = Change(
            "track_id", schemas.SAVED_TRACKS, batch.select("track_id"),
            lambda now: state.upsert_by_key(now, batch, ["track_id"]),
        )
        tables.update(saved_tracks=change)

    put(saved)
    tables.clear("saved_tracks", schemas.SAVED_TRACKS)
    put(samples.incoming_tracks(spark, sf_dir, saved))
    return tables.read("saved_tracks", schemas.SAVED_TRACKS)


@query
def failure_ledger_merge(spark, sf_dir):
    ledger = landing(spark, sf_dir)["isrc_failures"]
    return state.merge_failures(ledger, samples.incoming_failures(spark, sf_dir))


@query
def high_water_mark(spark, sf_dir):
    return state.high_water_mark(models(spark, sf_dir).tracks)


@query
def row_count(spark, sf_dir):
    return state.row_count(landing(spark, sf_dir)["saved_tracks"])


# --- files and checks ---------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    """Recording payloads through a CSV file; quotes, commas and spaces survive."""
    payloads = landing(spark, sf_dir)["recording_payloads"]
    path = f"{shared_folder(spark)}/payloads-{uuid.uuid4().hex}.csv"
    files.write_csv(payloads, path)
    return files.read_csv(spark, path, schemas.RECORDING_PAYLOADS)


@query
def missing_file(spark, sf_dir):
    """Saved tracks after a result file that is not there was loaded: as they were."""
    saved = landing(spark, sf_dir)["saved_tracks"]
    absent = f"{shared_folder(spark)}/absent-{uuid.uuid4().hex}.csv"
    batch = files.read_csv(spark, absent, schemas.SAVED_TRACKS)
    return saved if batch is None else state.upsert_by_key(saved, batch, ["track_id"])


@query
def run_summary(spark, sf_dir):
    codes = documents.queued_tracks(samples.queue_file(spark, sf_dir))
    return files.run_summary(landing(spark, sf_dir).all(), AS_OF, codes)


def _built(spark, sf_dir, asked: str | None = None) -> Models:
    """Tables as a run builds them: what several of them read is stored once."""
    rows = {name: stored(df) for name, df in landing(spark, sf_dir).all().items()}
    return Models(rows, AS_OF, _keeping(asked))


def _published(spark, sf_dir):
    """Finished tables of a build."""
    m = _built(spark, sf_dir)
    return {name: m.published(name) for name in PUBLISHED}


@query
def built_recordings(spark, sf_dir):
    """Recordings from stored documents, the newest chosen without moving any payload."""
    return _built(spark, sf_dir).recordings


@query
def built_entity_context(spark, sf_dir):
    """Scored tracks of a build, whose documents were parsed once."""
    return _built(spark, sf_dir, asked="entity_context_base").entity_context


@query
def dq_not_null(spark, sf_dir):
    return checks.not_null_checks(_published(spark, sf_dir))


@query
def dq_unique(spark, sf_dir):
    return checks.unique_checks(_published(spark, sf_dir))


@query
def dq_freshness(spark, sf_dir):
    rows = landing(spark, sf_dir)
    return quality.freshness(
        rows["saved_tracks"], "saved_tracks", "ingest_run_at", AS_OF
    ).unionByName(
        quality.freshness(rows["track_artists"], "track_artists", "ingest_run_at", AS_OF)
    )
