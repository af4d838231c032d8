"""Keyed updates, incremental reading, stored tables and files."""

import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.operators import quality, state
from cratewise.sources import files
from cratewise.sources.tables import Change, KeyedTables, Tables, conform, fill_counter


def test_upsert_is_idempotent_and_keeps_null_keys(rows):
    target = rows([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    incoming = rows([("b", 20), ("c", 30)], "k string, v int")
    once = state.upsert_by_key(target, incoming, ["k"])
    assert sorted(map(str, as_set_str(once))) == sorted(
        map(str, [("a", 1), ("b", 20), ("c", 30), ("None", 3)])
    )
    twice = state.upsert_by_key(once, incoming, ["k"])
    assert twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()


def as_set_str(df):
    return [(str(row[0]), row[1]) for row in df.collect()]


def test_upsert_fills_columns_one_side_lacks(rows):
    target = rows([("a", 1)], "k string, v int")
    incoming = rows([("b", "x")], "k string, w string")
    got = state.upsert_by_key(target, incoming, ["k"])
    assert got.columns == ["k", "v", "w"] and got.count() == 2


def test_replace_children_by_parent(rows):
    children = rows([("p1", "x"), ("p2", "y"), ("p3", "z")], "p string, c string")
    parents = rows([("p1",), ("p2",)], "p string")
    incoming = rows([("p1", "new1"), ("p1", "new2")], "p string, c string")
    got = state.replace_children(children, parents, incoming, "p")
    assert as_set(got) == [("p1", "new1"), ("p1", "new2"), ("p3", "z")]


def test_failure_ledger(rows):
    ledger = rows(
        [
            ("us1", "503", "busy", "t0", 2),
            ("US2", "404", "gone", "t0", None),
            ("us3", "404", "gone", "t0", 9),
        ],
        schemas.ISRC_FAILURES,
    )
    incoming = rows(
        [(" us1 ", "404", "gone", "t1"), ("us2", " ", None, "t1"), ("us4", " 404", "gone", "t1"),
         ("us5", "500", "oops", "t1")],
        schemas.RESULT_FILES["isrc_failures"],
    )
    got = state.merge_failures(ledger, incoming)
    assert got.columns == ledger.columns
    by_code = {row["isrc"]: tuple(row)[1:] for row in got.collect()}
    assert by_code == {
        "us1": ("404", "gone", "t1", 3),
        "US2": (None, None, "t1", 0),
        "us3": ("404", "gone", "t0", 9),
        "US4": ("404", "gone", "t1", 1),
        "US5": ("500", "oops", "t1", 0),
    }


def test_high_water_mark(rows):
    df = rows([(dt.datetime(2001, 1, 2),), (None,)], "added_at timestamp")
    assert state.high_water_mark(df).first()[0] == "2001-01-02 00:00:00"
    assert state.high_water_mark(df.limit(0)).first()[0] == ""


def test_reading_stops_at_the_first_older_item(rows):
    items = rows(
        [(1, 0, "2001-08-09T00:00:00Z"), (1, 1, None), (1, 2, "2001-08-05T00:00:00Z"),
         (2, 0, "2001-08-04T00:00:00Z"), (2, 1, "2001-08-09T00:00:00Z"), (2, 2, None)],
        "page_no int, item_no int, added_at string",
    )
    got = state.until_older(items, ["page_no", "item_no"], dt.datetime(2001, 8, 5))
    assert as_set(got.select("page_no", "item_no")) == [(1, 0), (1, 1), (1, 2)]
    assert state.until_older(items, ["page_no", "item_no"], None).count() == 6
    assert state.until_older(items, ["page_no", "item_no"], dt.datetime(2000, 1, 1)).count() == 6
    blank = items.na.fill(" ", ["added_at"])
    assert state.until_older(blank, ["page_no", "item_no"], dt.datetime(2001, 8, 5)).count() == 3


def test_reading_stops_at_the_nth_distinct_track(rows):
    items = rows([(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "b")], "at int, k string")
    assert as_set(state.up_to_distinct(items, "k", ["at"], 2)) == [(1, "a"), (2, "b")]
    assert as_set(state.up_to_distinct(items, "k", ["at"], 3))[-1] == (4, "c")
    assert state.up_to_distinct(items, "k", ["at"], 9).count() == 5
    assert state.up_to_distinct(items, "k", ["at"], None).count() == 5


def test_conform_adds_typed_nulls(rows):
    got = conform(rows([("a", 5, "extra")], "isrc string, error_404_count long, x string"),
                  schemas.ISRC_FAILURES)
    assert got.columns == ["isrc", "error_status_code", "error_message", "last_failed_at",
                           "error_404_count"]
    assert dict(got.dtypes)["error_404_count"] == "int"
    empty = conform(rows([("a",)], "isrc string"), schemas.ISRC_FAILURES)
    assert fill_counter(empty, "error_404_count").first()["error_404_count"] == 0


def test_tables_are_replaced_together(spark, rows, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert tables.read("a", "x int").count() == 0
    assert tables.clear("a", "x int") is False
    tables.replace(a=rows([(1,)], "x int"), b=rows([("p",)], "y string"))
    # The old version is read while the new one is written.
    tables.replace(a=tables.read("a", "x int").unionByName(rows([(2,)], "x int")))
    assert as_set(tables.read("a", "x int")) == [(1,), (2,)]
    assert as_set(tables.read("b", "y string")) == [("p",)]
    # A column added later reads as NULL.
    assert as_set(tables.read("b", "y string, z int")) == [("p", None)]
    # A run without its marker does not count.
    rows([(9,)], "x int").write.parquet(f"{tmp_path}/a/run=99")
    assert as_set(tables.read("a", "x int")) == [(1,), (2,)]
    assert tables.clear("a", "x int") is True
    assert tables.read("a", "x int").count() == 0


def merged(rows, data, key_of=lambda column: column):
    batch = rows(data, "k string, v int")
    return Change(
        "k", "k string, v int", batch.select("k"),
        lambda now: state.upsert_by_key(now, batch, ["k"]), key_of,
    )


def files_of(root):
    return {path: path.stat().st_mtime_ns for path in root.rglob("*.parquet")}


def test_an_upsert_overwrites_the_partitions_it_touches(spark, rows, tmp_path):
    tables = KeyedTables(spark, str(tmp_path), buckets=8)
    schema = "k string, v int"
    assert tables.read("a", schema).count() == 0 and tables.clear("a", schema) is False
    data = [(f"k{n}", n) for n in range(100)] + [(None, 7)]
    tables.update(a=merged(rows, data), b=merged(rows, data[:3]))
    before = files_of(tmp_path / "a")
    tables.update(a=merged(rows, [("k1", 1000)]))
    after = files_of(tmp_path / "a")
    new = set(after) - set(before)
    assert new and len({path.parent.name for path in new}) == 1
    # All other partitions are as they were, and nothing old is left of this one.
    assert {path.parent.name for path in set(before) - set(after)} == {path.parent.name for path in new}
    assert all(after[path] == time for path, time in before.items() if path in after)
    got = dict(tuple(r) for r in tables.read("a", schema).collect())
    assert got == {**dict(data), "k1": 1000}
    # A store keeps the number of partitions it began with.
    assert KeyedTables(spark, str(tmp_path), buckets=3).buckets == 8
    # A column added later reads as NULL.
    assert tables.read("a", "k string, v int, w int").where("w is null").count() == 101
    assert tables.clear("a", schema) is True and tables.read("a", schema).count() == 0
    assert tables.clear("a", schema) is False
    assert tables.read("b", schema).count() == 3
    tables.update(a=merged(rows, [("k5", 5)]))
    assert as_set(tables.read("a", schema)) == [("k5", 5)]


def test_a_partition_that_loses_its_last_row_goes(spark, rows, tmp_path):
    tables = KeyedTables(spark, str(tmp_path), buckets=4)
    tables.update(a=merged(rows, [(f"k{n}", n) for n in range(10)]))
    gone = rows([(f"k{n}",) for n in range(0, 10)], "k string")
    change = Change("k", "k string, v int", gone, lambda now: now.where("k = 'k3'"))
    tables.update(a=change)
    assert as_set(tables.read("a", "k string, v int")) == [("k3", 3)]


def test_rows_that_cannot_be_made_change_no_table(spark, rows, tmp_path):
    tables = KeyedTables(spark, str(tmp_path), buckets=4)
    tables.update(a=merged(rows, [("k1", 1)]), b=merged(rows, [("k1", 1)]))
    broken = rows([("k1", "x")], "k string, v string").selectExpr("k", "cast(v as int) as v")
    bad = Change("k", "k string, v int", broken.select("k"), lambda now: broken)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.update(a=merged(rows, [("k1", 2)]), b=bad)
    assert as_set(tables.read("a", "k string, v int")) == [("k1", 1)]


def test_broken_csv_rows_stop_the_query(spark, tmp_path):
    head = "recording_mbid,payload_json,last_seen_at\n"
    for name, line in (("comma", 'r1,{"title":"a","b"},t\n'), ("short", "r1,{}\n")):
        path = tmp_path / f"{name}.csv"
        path.write_text(head + "r0,{},t\n" + line)
        with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
            files.read_csv(spark, str(path), schemas.RECORDING_PAYLOADS).collect()


def test_csv_round_trip(spark, rows, tmp_path):
    data = [
        ("r1", '{"a":"x, \\"y\\""}', " padded "),
        ("r2", "line\nend", None),
        ("r3", '"', "\\"),
        ("r4", '"a', 'b"'),
    ]
    df = rows(data, schemas.RECORDING_PAYLOADS)
    path = f"{tmp_path}/payloads.csv"
    files.write_csv(df.unionByName(rows([("r5", "", "t")], schemas.RECORDING_PAYLOADS)), path)
    back = files.read_csv(spark, path, schemas.RECORDING_PAYLOADS)
    # Empty text comes back as NULL.
    want = df.unionByName(rows([("r5", None, "t")], schemas.RECORDING_PAYLOADS))
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()


def test_csv_written_by_other_tools(spark, tmp_path):
    path = tmp_path / "payloads.csv"
    path.write_text('recording_mbid,payload_json,last_seen_at\r\nr1,"{""a"":""b,c""}",t\r\n')
    got = files.read_csv(spark, str(path), schemas.RECORDING_PAYLOADS).first()
    assert got["payload_json"] == '{"a":"b,c"}'


def test_absent_and_header_only_files(spark, rows, tmp_path):
    assert files.read_csv(spark, f"{tmp_path}/none.csv", schemas.WORK_PAYLOADS) is None
    path = f"{tmp_path}/empty.csv"
    files.write_csv(rows([], schemas.WORK_PAYLOADS), path)
    assert any("work_mbid" in f.read_text() for f in (tmp_path / "empty.csv").glob("part-*"))
    assert files.read_csv(spark, path, schemas.WORK_PAYLOADS).count() == 0


def test_run_summary(rows):
    codes = rows([("us1",), ("us1",), ("us2",)], "isrc string")
    got = files.run_summary(
        {"a": rows([(1,), (2,)], "x int"), "b": rows([], "x int")}, dt.datetime(2001, 8, 10), codes
    )
    assert as_set(got.select("output_name", "row_count", "generated_at", "processed_isrcs")) == [
        ("a", 2, "2001-08-10T00:00:00", 2), ("b", 0, "2001-08-10T00:00:00", 2)
    ]


def test_quality_reports(rows, as_of):
    df = rows([("a", 1), ("a", None), (None, 2), (None, 2)], "k string, v int")
    assert as_set(quality.not_null(df, "t", ["k", "v"])) == [("t", "k", 2), ("t", "v", 1)]
    # NULLs are not compared.
    assert as_set(quality.unique(df, "t", ["k", "v"])) == [("t", "k", 1), ("t", "v", 1)]


@pytest.mark.parametrize(
    ("hours", "status"), [(1, "pass"), (48, "pass"), (49, "warn"), (168, "warn"), (169, "error")]
)
def test_freshness(rows, as_of, hours, status):
    loaded = (as_of - dt.timedelta(hours=hours)).isoformat() + "+00:00"
    df = rows([(loaded,), ("bad",), (None,)], "at string")
    assert quality.freshness(df, "t", "at", as_of).first()["status"] == status


def test_freshness_of_an_empty_table_is_an_error(rows, as_of):
    got = quality.freshness(rows([], "at string"), "t", "at", as_of).first()
    assert got["status"] == "error" and got["max_loaded_at"] is None


def test_row_count(rows):
    assert state.row_count(rows([(1,)], "x int").where(F.col("x") > 1)).first()[0] == 0


MARKS = {
    "exact": F.xxhash64,
    # Nine marks for all keys: most rows are candidates without being in the batch.
    "coarse": lambda *keys: F.pmod(F.xxhash64(*keys), F.lit(9)),
}


@pytest.mark.parametrize("few, marks", [(100, 100), (0, 100), (0, 0)])
@pytest.mark.parametrize("mark", MARKS)
def test_rows_of_other_keys_stay(rows, few, marks, mark):
    target = rows([(None if i % 7 == 0 else f"k{i}", i) for i in range(60)], "k string, v int")
    batch = rows([("k1",), ("k5",), ("k5",), (None,), ("new",)], "k string")
    got = state.without_keys(target, batch, ["k"], few, marks, MARKS[mark])
    assert sorted(r["v"] for r in got.collect()) == [i for i in range(60) if i not in (1, 5)]
    assert got.columns == ["k", "v"]


def test_what_cannot_be_in_the_batch_is_not_shuffled(spark, plan_of, tmp_path):
    spark.range(0, 5000).selectExpr("concat('k', id) as k", "id").write.parquet(f"{tmp_path}/target")
    target = spark.read.parquet(f"{tmp_path}/target")
    batch = spark.range(100).selectExpr("concat('k', id) as k")
    few = state.without_keys(target, batch, ["k"])
    assert few.count() == 4900
    assert "Exchange hashpartitioning" not in plan_of(few)
    marked = state.without_keys(target, batch, ["k"], few=10)
    marked.collect()
    outside, candidates = plan_of(marked).split("Union", 1)[1].split("LeftSemi", 1)
    assert "BroadcastHashJoin" in outside and "hashpartitioning" not in outside


@pytest.mark.parametrize("few", [100, 0])
def test_cells_whose_marks_clash_are_compared(rows, few):
    """With three marks for all cells, every mark repeats; only equal cells count."""
    data = [(f"a{i}", i % 5, None) for i in range(20)] + [("a1", None, "x"), ("a1", None, None)]
    df = rows(data, "k string, v int, w string")
    coarse = lambda cell: F.pmod(F.xxhash64(cell), F.lit(3))
    for mark in (F.xxhash64, coarse):
        got = quality.unique(df, "t", ["k", "v", "w"], mark, few)
        assert as_set(got) == [("t", "k", 1), ("t", "v", 5), ("t", "w", 0)]
    assert as_set(quality.unique(df.limit(0), "t", ["k"])) == [("t", "k", 0)]


def test_no_text_is_shuffled_while_marks_are_counted(spark, monkeypatch, plan_of):
    seen = []
    real = quality.checkpointed
    monkeypatch.setattr(quality, "checkpointed", lambda df: seen.append(df) or real(df))
    df = spark.range(100).selectExpr("concat('text ', id) as k")
    assert quality.unique(df, "t", ["k"]).first()["repeated_values"] == 0
    (counted,) = seen
    exchange = [line for line in plan_of(counted).splitlines() if "Exchange" in line]
    assert exchange and dict(counted.dtypes) == {"column_no": "int", "mark": "bigint"}


def test_csv_of_one_line_records_is_read_in_splits(spark, rows, tmp_path):
    data = [(f"r{i}", '{"a": "x, \\"y\\" \\n"}', " t ") for i in range(3000)]
    df = rows(data, schemas.RECORDING_PAYLOADS).coalesce(1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for name, more, splits in (("plain", None, True), ("broken", ("r", "line\nend", None), False)):
        whole = df.unionByName(rows([more], schemas.RECORDING_PAYLOADS)).coalesce(1) if more else df
        path = f"{tmp_path}/{name}.csv"
        files.write_csv(whole, path)
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
            back = files.read_csv(spark, path, schemas.RECORDING_PAYLOADS)
            assert (back.rdd.getNumPartitions() > 1) is splits
            assert as_set(back.na.fill("")) == as_set(whole.na.fill(""))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_documents_are_folded_to_one_line(rows):
    df = rows([('{"a":\r\n 1,\n"b": "x\\\\n"}',)], "d string")
    (text,) = df.select(files.one_line(F.col("d"))).first()
    assert "\n" not in text and "\r" not in text
    import json

    assert json.loads(text) == json.loads(df.first()[0])
