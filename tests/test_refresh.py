"""A library from raw pages to finished tables, over two runs."""

import datetime as dt
import json

import pytest
from conftest import as_set

from cratewise.plans.models import PUBLISHED
from cratewise.plans.refresh import Refresh


def item(track_id, added_at, isrc, artists=("Ann",)):
    return {
        "added_at": added_at,
        "track": {
            "id": track_id, "name": f"Song {track_id}", "external_ids": {"isrc": isrc},
            "album": {"id": "al", "name": "Album", "release_date": "2001-05",
                      "release_date_precision": "month"},
            "duration_ms": 200000, "popularity": 40,
            "artists": [{"id": name.lower(), "name": name} for name in artists],
        },
    }


def write_lines(path, rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.json").write_text("".join(json.dumps(row) + "\n" for row in rows))


def pages(path, *contents):
    write_lines(path, [
        {"page_no": n, "body": json.dumps({"items": items})} for n, items in enumerate(contents)
    ])
    return str(path)


@pytest.fixture
def answers(tmp_path):
    root = tmp_path / "answers"
    found = {"isrc": {"recording-list": [{"id": "r1", "title": "One"}, {"id": "r2"}]}}
    detail = {"recording": {
        "id": "r1", "title": "One, \"live\"",
        "relation-list": [{"target-type": "work", "relation": [{"work": {"id": "w1"}}]}],
        "artist-relation-list": [{"type": "instrument", "attribute-list": ["harp"]}],
        "release-list": [{"id": "l1", "release-group": {"type": "Single"}}]}}
    work = {"work": {"title": "W", "relation-list": [{"target-type": "artist", "relation": [
        {"type": "composer", "artist": {"id": "m", "name": "Writer"}}]}]}}
    write_lines(root / "codes", [
        {"isrc": " us1", "body": json.dumps(found)},
        {"isrc": "US2", "error": "caused by: HTTP Error 404: Not Found"},
        {"isrc": "US9", "body": json.dumps(found)},
    ])
    write_lines(root / "recordings", [
        {"recording_mbid": "r1", "body": json.dumps(detail)},
        {"recording_mbid": "r2", "error": "HTTP Error 500"},
    ])
    write_lines(root / "works", [{"work_mbid": "w1", "body": json.dumps(work)}])
    return str(root)


def test_two_runs(spark, tmp_path, answers):
    root = str(tmp_path / "library")
    run = Refresh(spark, root, dt.datetime(2001, 8, 10))
    assert run.high_water_mark() is None and run.clear_saved_tracks() is False
    run.take_in(pages(
        tmp_path / "pages1",
        [item("t3", "2001-08-05T00:00:00Z", "us2"), item("t2", "2001-08-04T00:00:00Z", "us1")],
        [item("t1", "2001-08-03T00:00:00Z", "us1", ("Ann", "Bob"))],
    ))
    assert run.high_water_mark() == dt.datetime(2001, 8, 5)
    queue_path = run.export_queue()
    queued = spark.read.csv(queue_path, header=True)
    assert as_set(queued.select("track_id", "isrc_queue_rank")) == [
        ("t1", "2"), ("t2", "2"), ("t3", "1")
    ]
    run.collect_results(answers, queue_path)
    summary = {r["output_name"]: r["row_count"]
               for r in spark.read.json(f"{root}/exchange/summary.json").collect()}
    # The code that was not queued is left out.
    assert summary == {"isrc_candidates": 4, "recording_payloads": 1, "work_payloads": 1,
                       "isrc_failures": 1}
    run.load_results()
    run.load_results()  # loading twice changes nothing but the failure count
    now = run.tables()
    assert now["isrc_candidates"].count() == 4 and now["recording_payloads"].count() == 1
    assert as_set(now["isrc_failures"].select("isrc", "error_404_count")) == [("US2", 2)]

    run.build()
    ready = {r["track_id"]: r for r in spark.table("fct_playlist_ready_tracks").collect()}
    assert ready["t1"]["mb_recording_title"] == 'One, "live"'
    assert ready["t1"]["artist_names"] == "Ann, Bob"
    assert json.loads(ready["t1"]["work_writer_list_json"]) == ["Writer"]
    assert ready["t3"]["recording_mbid"] is None
    assert spark.table("int_track_instrument").count() == 2
    assert set(PUBLISHED) <= {t.name for t in spark.catalog.listTables()}
    reports = run.check()
    assert reports["not_null"].where("failing_rows > 0").isEmpty()
    assert reports["unique"].where("repeated_values > 0").isEmpty()
    assert {r["status"] for r in reports["freshness"].collect()} == {"pass"}

    base = spark.table("int_playlist_ready_tracks_base")
    assert base.columns == spark.table("fct_playlist_ready_tracks").columns and base.count() == 3

    later = Refresh(spark, root, dt.datetime(2001, 8, 12))
    later.take_in(pages(
        tmp_path / "pages2",
        [item("t4", "2001-08-11T00:00:00Z", "us4"), item("t3", "2001-08-05T00:00:00Z", "us2", ()),
         item("t2", "2001-08-04T00:00:00Z", "changed")],
    ))
    now = later.tables()
    saved = {r["track_id"]: r for r in now["saved_tracks"].collect()}
    assert sorted(saved) == ["t1", "t2", "t3", "t4"]
    assert saved["t2"]["isrc"] == "us1"  # older than the mark, not read again
    # The track at the mark was read again and lost its artists.
    assert now["track_artists"].where("track_id = 't3'").isEmpty()
    # t3 rests after its failure, t1 and t2 wait for the second candidate's payload.
    queue_path = later.export_queue(max_codes=1)
    assert as_set(spark.read.csv(queue_path, header=True).select("track_id")) == [("t4",)]
    assert later.clear_saved_tracks() is True and later.high_water_mark() is None


def test_results_without_files_change_nothing(spark, tmp_path):
    run = Refresh(spark, str(tmp_path), dt.datetime(2001, 8, 10))
    run.load_results()
    assert all(df.isEmpty() for df in run.tables().values())
    with pytest.raises(FileNotFoundError):
        run.collect_results(str(tmp_path), f"{tmp_path}/absent.csv")


def saved_ids(run):
    return sorted(r["track_id"] for r in run.tables()["saved_tracks"].collect())


def newest_first(n, added=lambda i: f"2001-07-{i + 1:02}T00:00:00Z"):
    listed = [item(f"t{i:02}", added(i), f"us{i}") for i in reversed(range(n))]
    return [listed[:7], listed[7:14], listed[14:]]


@pytest.mark.parametrize("dates", ["spread", "equal", "none"])
def test_a_capped_intake_goes_on_where_it_stopped(spark, tmp_path, dates):
    added = {
        "spread": lambda i: f"2001-07-{i + 1:02}T00:00:00Z",
        "equal": lambda i: "2001-07-01T00:00:00Z",
        "none": lambda i: " ",
    }[dates]
    run = Refresh(spark, str(tmp_path / "library"), dt.datetime(2001, 8, 10), buckets=4)
    path = pages(tmp_path / "pages", *newest_first(20, added))
    counts = []
    for _ in range(3):
        run.take_in(path, max_tracks=8)
        counts.append(len(saved_ids(run)))
    assert counts == [8, 16, 20]
    # New tracks come while older ones are still open.
    other = Refresh(spark, str(tmp_path / "other"), dt.datetime(2001, 8, 10), buckets=4)
    other.take_in(path, max_tracks=8)
    more = [[item(f"n{i}", f"2001-08-0{9 - i}T00:00:00Z", f"un{i}") for i in range(5)]]
    grown = pages(tmp_path / "grown", *more, *newest_first(20, added))
    for _ in range(4):
        other.take_in(grown, max_tracks=6)
    assert len(saved_ids(other)) == 25
    # All is read: only what is as new as the newest track is looked at again.
    changed = pages(tmp_path / "changed", [item("t03", "2001-07-04T00:00:00Z", "changed")])
    if dates == "spread":
        other.take_in(changed)
        codes = {r["track_id"]: r["isrc"] for r in other.tables()["saved_tracks"].collect()}
        assert codes["t03"] == "us3"


def test_pages_that_end_early_leave_a_gap_open(spark, tmp_path):
    run = Refresh(spark, str(tmp_path / "library"), dt.datetime(2001, 8, 10), buckets=4)
    contents = newest_first(20)
    run.take_in(pages(tmp_path / "all", *contents), max_tracks=5)
    run.take_in(pages(tmp_path / "first", contents[0]), complete=False)
    assert len(saved_ids(run)) == 7
    run.take_in(pages(tmp_path / "again", *contents))
    assert len(saved_ids(run)) == 20


def test_pages_are_parsed_once(spark, tmp_path, monkeypatch, plan_of):
    from cratewise.plans import intake

    seen = []
    real = intake.wanted_items
    monkeypatch.setattr(
        intake, "wanted_items", lambda items, *rest: seen.append(items) or real(items, *rest)
    )
    run = Refresh(spark, str(tmp_path / "library"), dt.datetime(2001, 8, 10), buckets=2)
    run.take_in(pages(tmp_path / "pages", *newest_first(20)), max_tracks=8)
    assert len(seen) == 1 and "from_json" not in plan_of(seen[0])


def test_tracks_of_pages_are_stored_once(spark, tmp_path, monkeypatch):
    """Whole tracks are written once a run, and only those that no earlier run has read."""
    from cratewise.plans import refresh

    seen = []
    real = refresh.stored

    def noted(df):
        kept = real(df)
        if "track" in kept.columns:
            seen.append(kept.count())
        return kept

    monkeypatch.setattr(refresh, "stored", noted)
    run = Refresh(spark, str(tmp_path / "library"), dt.datetime(2001, 8, 10), buckets=2)
    contents = newest_first(20)
    for _ in range(3):
        run.take_in(pages(tmp_path / "pages", *contents), max_tracks=12)
    assert len(saved_ids(run)) == 20
    # The last item of the first run and the newest one are looked at again.
    assert len(seen) == 3 and seen[0] == 20 and seen[1] < 12 and seen[2] < 4


def test_sample_pages_deal_lines_once_and_are_read_from_a_folder(
    spark, sf_dir, monkeypatch, plan_of
):
    from cratewise import registry, samples

    plan = plan_of(samples.saved_track_pages(spark, sf_dir))
    assert plan.count("hashpartitioning(l_orderkey") == 1
    assert plan.count("orders.parquet") == 1
    seen = []
    monkeypatch.setattr(
        registry.Refresh, "take_pages", lambda run, pages, max_tracks: seen.append(plan_of(pages))
    )
    registry.QUERIES["intake_resumed"](spark, sf_dir)
    assert len(seen) == 3 and not any("Exchange" in plan or "to_json" in plan for plan in seen)


@pytest.mark.parametrize("name", ["built_entity_context", "refresh_delta"])
def test_table_asked_for_is_stored_by_the_caller_only(spark, sf_dir, monkeypatch, name):
    from cratewise import registry

    seen = []
    real = registry.stored
    monkeypatch.setattr(registry, "stored", lambda df: seen.append(df.columns) or real(df))
    rows = registry.QUERIES[name](spark, sf_dir)
    assert "auto_playlist_score" in rows.columns
    assert not any("auto_playlist_score" in columns for columns in seen)
    # What it is made from is stored.
    assert any("credit_line" in columns for columns in seen)


def test_wide_copies_are_written_by_small_methods_with_short_times(spark, tmp_path):
    """Only while a copy is written; what it holds is exact."""
    from pyspark.sql import functions as F

    from cratewise import session

    names = ["spark.sql.codegen.maxFields", "spark.sql.parquet.outputTimestampType"]
    before = [spark.conf.get(name) for name in names]
    moments = (
        "array(timestamp'0001-01-01 00:00:00.000001', timestamp'1899-05-06 07:08:09.123456', "
        "timestamp'2001-08-10', null)"
    )
    wide = spark.range(5).select(
        F.explode(F.expr(moments)).alias("at"), *[F.col("id").alias(f"c{i}") for i in range(40)]
    )
    plans = []

    class Noted(type(wide)):
        @property
        def write(self):
            plans.append([spark.conf.get(name) for name in names])
            return super().write

    session.copied(Noted(wide._jdf, spark), str(tmp_path / "copy"), "error")
    assert plans == [["30", "TIMESTAMP_MICROS"]]
    assert [spark.conf.get(name) for name in names] == before
    copy = spark.read.parquet(str(tmp_path / "copy"))
    assert copy.dtypes == wide.dtypes
    shown = lambda df: sorted(map(str, df.withColumn("at", F.col("at").cast("string")).collect()))
    assert shown(copy) == shown(wide)
    # Times are plain numbers in the file, not Spark's 12 bytes.
    import pyarrow.parquet as pq

    assert "int96" not in str(pq.ParquetFile(next((tmp_path / "copy").glob("*.parquet"))).schema).lower()
    kept = session.stored(wide)
    file = kept.inputFiles()[0].removeprefix("file:").replace("///", "/")
    assert "int96" not in str(pq.ParquetFile(file).schema).lower()


def test_settings_return_when_a_copy_fails(spark, tmp_path):
    from cratewise import session

    before = {name: spark.conf.get(name) for name in session.COPY_SETTINGS}
    broken = spark.range(3).selectExpr("cast(concat('x', id) as int) as n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        session.copied(broken, str(tmp_path / "copy"), "error")
    assert {name: spark.conf.get(name) for name in session.COPY_SETTINGS} == before


def test_item_without_track_may_have_any_date(spark, tmp_path):
    run = Refresh(spark, str(tmp_path / "library"), dt.datetime(2001, 8, 10), buckets=2)
    odd = {"added_at": "no date", "track": None}
    run.take_in(pages(tmp_path / "pages", [item("t1", "2001-08-01T00:00:00Z", "us1"), odd]))
    assert saved_ids(run) == ["t1"]


def test_broken_input_stops_the_run_and_changes_nothing(spark, tmp_path, answers):
    root = tmp_path / "library"
    run = Refresh(spark, str(root), dt.datetime(2001, 8, 10), buckets=2)
    run.take_in(pages(tmp_path / "good", [item("t1", "2001-08-01T00:00:00Z", "us1")]))
    queue_path = run.export_queue()
    run.collect_results(answers, queue_path)
    run.load_results()
    before = {name: sorted(map(str, df.collect())) for name, df in run.tables().items()}

    def unchanged():
        now = {name: sorted(map(str, df.collect())) for name, df in run.tables().items()}
        return now == before

    body = json.dumps({"items": [item("t9", "2001-08-09T00:00:00Z", "us9")]})
    cut_page = tmp_path / "cut_page"
    write_lines(cut_page, [{"page_no": 0, "body": body}, {"page_no": 1, "body": body[:60]}])
    with pytest.raises(Exception, match="MALFORMED|does not parse"):
        run.take_in(str(cut_page))
    assert unchanged()
    cut_line = tmp_path / "cut_line"
    write_lines(cut_line, [{"page_no": 0, "body": body}])
    with (cut_line / "part.json").open("a") as file:
        file.write('{"page_no": 1, "body": "{')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ|parsing"):
        run.take_in(str(cut_line))
    assert unchanged()
    write_lines(tmp_path / "answers" / "recordings", [{"recording_mbid": "r1", "body": '{"recording":{"id'}])
    with pytest.raises(Exception, match="MALFORMED|does not parse"):
        run.collect_results(answers, queue_path)
    assert unchanged()


def test_a_stored_payload_that_does_not_parse_stops_the_tables(spark, rows):
    from cratewise import schemas
    from cratewise.plans import recordings

    latest = rows([("r1", '{"title":"a', "t")], schemas.RECORDING_PAYLOADS)
    with pytest.raises(Exception, match="MALFORMED|does not parse"):
        recordings.recordings(latest).collect()


def test_only_what_was_asked_for_is_loaded(spark, tmp_path, answers):
    run = Refresh(spark, str(tmp_path / "library"), dt.datetime(2001, 8, 10), buckets=2)
    run.take_in(pages(tmp_path / "pages", [item("t1", "2001-08-01T00:00:00Z", "us1")]))
    queue_path = run.export_queue()
    full = {"recording": {"id": "r1", "relation-list": [
        {"target-type": "work", "relation": [{"work": {"id": "w1"}}]}]}}
    work = {"work": {"title": "W"}}
    write_lines(tmp_path / "answers" / "recordings", [
        {"recording_mbid": "r1", "body": json.dumps(full)},
        {"recording_mbid": "stray", "body": json.dumps({"recording": {"id": "stray"}})},
    ])
    write_lines(tmp_path / "answers" / "works", [
        {"work_mbid": "w1", "body": json.dumps(work)}, {"work_mbid": "w9", "body": json.dumps(work)},
    ])
    run.collect_results(answers, queue_path)
    run.load_results()
    now = run.tables()
    assert [r["recording_mbid"] for r in now["recording_payloads"].collect()] == ["r1"]
    assert [r["work_mbid"] for r in now["work_payloads"].collect()] == ["w1"]
    summary = spark.read.json(f"{run.root}/exchange/summary.json")
    assert {r["processed_isrcs"] for r in summary.collect()} == {1}
    stored = now["recording_payloads"].first()["payload_json"]
    # An answer without a recording, for a code whose list has gone, leaves what is stored.
    write_lines(tmp_path / "answers" / "recordings", [{"recording_mbid": "r1", "body": "{}"}])
    write_lines(tmp_path / "answers" / "codes", [
        {"isrc": "us1", "body": json.dumps({"isrc": {"recording-list": []}})}])
    run.collect_results(answers, queue_path)
    run.load_results()
    assert run.tables()["recording_payloads"].first()["payload_json"] == stored


def published_rows(spark):
    return {
        name: sorted(str(r.asDict()) for r in spark.table(name).collect()) for name in PUBLISHED
    }


def test_a_refresh_gives_what_a_build_gives(spark, tmp_path, answers):
    """Changed, new and emptied tracks, new answers for an old track, another day."""
    root = str(tmp_path / "library")
    run = Refresh(spark, root, dt.datetime(2001, 8, 10), buckets=2)
    run.take_in(pages(tmp_path / "pages1", [
        item("t3", "2001-08-05T00:00:00Z", "us2"),
        item("t2", "2001-08-04T00:00:00Z", "us1", ("Cy",)),
        item("t1", "2001-08-03T00:00:00Z", "us1", ("Ann", "Bob")),
    ]))
    run.refresh()  # nothing is built yet, so all is
    assert spark.table("fct_playlist_ready_tracks").count() == 3
    later = Refresh(spark, root, dt.datetime(2001, 8, 12), buckets=2)
    later.collect_results(answers, later.export_queue())
    later.load_results()
    later.take_in(pages(tmp_path / "pages2", [
        item("t4", "2001-08-11T00:00:00Z", "us1", ("Ann",)),
        item("t3", "2001-08-05T00:00:00Z", "us3", ()),
    ]))
    for _ in range(2):  # the second time nothing is touched
        later.refresh()
        got = published_rows(spark)
        assert not (tmp_path / "library" / "changes").exists()
        numbers = {int(p.name) for p in (tmp_path / "library" / "builds").iterdir()}
        assert len(numbers) == 2
    later.build()
    assert got == published_rows(spark)
    ready = {r["track_id"]: r for r in spark.table("fct_playlist_ready_tracks").collect()}
    assert ready["t1"]["mb_recording_title"] == 'One, "live"'
    assert {r["artist_name"]: r["saved_track_count"] for r in spark.table("fct_artist_stats").collect()} == {
        "Ann": 2, "Bob": 1, "Cy": 1
    }
    # After the tracks are cleared, everything is built again.
    later.clear_saved_tracks()
    later.refresh()
    assert spark.table("fct_playlist_ready_tracks").isEmpty()


def test_a_build_parses_every_payload_once(spark, tmp_path, answers, monkeypatch):
    """Only the two tables of documents read payloads; all others read these."""
    run = Refresh(spark, str(tmp_path / "library"), dt.datetime(2001, 8, 10), buckets=2)
    run.take_in(pages(tmp_path / "pages", [item("t1", "2001-08-03T00:00:00Z", "us1")]))
    run.collect_results(answers, run.export_queue())
    run.load_results()
    plans = {}
    real = Refresh._keep

    def keep(self, number):
        inner = real(self, number)

        def record(name, df):
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
            return inner(name, df)

        return record

    monkeypatch.setattr(Refresh, "_keep", keep)
    models = run.build()
    for name in PUBLISHED:
        plans[f"published {name}"] = models.published(name)._jdf.queryExecution().executedPlan().toString()
    assert {name for name, plan in plans.items() if "from_json" in plan} == {
        "recording_documents", "work_documents"
    }
    # What an update parses are the rows of touched keys.
    for name in ("recording_documents", "work_documents"):
        choosing = plans[name][plans[name].index("from_json"):]
        assert "Sort" not in choosing and "payload_json" in choosing


def test_keys_are_found_alike_by_broadcast_by_marks_and_by_a_join(spark):
    from cratewise.plans.update import only

    rows = spark.createDataFrame([(f"k{i % 7}" if i % 5 else None, i) for i in range(60)], "k string, v int")
    keys = spark.createDataFrame([("k1",), ("k4",), ("k9",), (None,)], "k string")
    wanted = sorted((f"k{i % 7}", i) for i in range(60) if i % 5 and i % 7 in (1, 4))
    for few, marks in ((10, 10), (3, 10), (3, 3)):
        got = only(rows, keys, "k", few, marks)
        assert got.columns == ["k", "v"]
        assert sorted(tuple(r) for r in got.collect()) == wanted


def test_update_keeps_no_table_that_was_read_for_the_last_time(spark, sf_dir, monkeypatch):
    """What is left on the disk beside the table asked for: its rows, and lists of keys."""
    from pathlib import Path

    from cratewise import registry
    from cratewise.plans import update

    seen = []
    for module in (registry, update):
        monkeypatch.setattr(
            module, "stored", lambda df, real=module.stored: seen.append(real(df)) or seen[-1]
        )
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    files = {}
    real = registry.discard

    def discard(*tables):
        for df in tables:
            files[id(df)] = df.inputFiles()
        real(*tables)

    for module in (registry, update):
        monkeypatch.setattr(module, "discard", discard)
    rows = registry.QUERIES["refresh_delta"](spark, sf_dir)
    left = [df for df in seen if id(df) not in files]
    assert files and not any(
        Path(x.removeprefix("file:")).exists() for paths in files.values() for x in paths
    )
    # Of the six landing tables, the build, and its update: touched rows and the update.
    assert sum("credit_line" in df.columns for df in left) == 1
    assert sum("credit_line" in df.columns for df in seen) == 2
    assert sum("spotify_track_url" in df.columns and "id" in df.columns for df in left) == 2
    assert rows.count() > 0
    assert spark.conf.get("spark.sql.parquet.compression.codec") == before


def test_only_stored_copies_are_discarded(spark, tmp_path):
    from cratewise.session import discard, stored

    spark.range(3).write.parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    with pytest.raises(ValueError):
        discard(table)
    assert table.count() == 3
    copy = stored(table)
    path = copy.inputFiles()[0].removeprefix("file:")
    discard(copy)
    import os

    assert not os.path.exists(path)
