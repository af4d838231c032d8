"""Operators on small tables, each also with its hot-group way forced."""

import itertools
import hashlib
import random

import pytest
from conftest import as_set
from pyspark.sql import Window
from pyspark.sql import functions as F

from cratewise.operators.clusters import gap_clusters
from cratewise.operators.fallback import fallback_union
from cratewise.operators.lists import (
    distinct_elements,
    filled_elements,
    newest_filled,
    ordered_elements,
)
from cratewise.operators.ranking import (
    best_match,
    first_rows,
    keep_first,
    last_wins,
    latest_per_key,
    number_within,
)
from cratewise.operators.skew import attach, group_sizes, hot_groups, lookup


@pytest.fixture
def skewed(rows):
    """300 rows, a third of them under one key, some under NULL."""
    pick = random.Random(7)
    keys = ["hot"] * 100 + [None] * 40 + [f"k{n % 40}" for n in range(160)]
    pick.shuffle(keys)
    return rows(
        [(key, pick.randrange(20), n) for n, key in enumerate(keys)], "k string, v int, id bigint"
    )


@pytest.mark.parametrize("hot_rows", [30, 1_000_000])
def test_number_within_matches_a_plain_window(skewed, hot_rows):
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = number_within(skewed, ["k"], order, "n", hot_rows=hot_rows)
    window = Window.partitionBy("k").orderBy(*order)
    want = skewed.withColumn("n", F.row_number().over(window).cast("bigint"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("hot_rows", [30, 1_000_000])
def test_number_within_the_whole_table(skewed, hot_rows):
    got = number_within(skewed, [], [F.col("v"), F.col("id")], "n", hot_rows=hot_rows)
    numbered = sorted((row["n"], row["v"], row["id"]) for row in got.collect())
    assert [n for n, _, _ in numbered] == list(range(1, 301))
    assert [(v, i) for _, v, i in numbered] == sorted((v, i) for _, v, i in numbered)


def test_hot_groups_are_numbered_in_ranges_not_in_one_window(skewed, plan_of):
    order = [F.col("v").asc(), F.col("id").asc()]
    hot = hot_groups(group_sizes(skewed, ["k"]), 30)
    assert sorted(str(row["k"]) for row in hot.collect()) == ["None", "hot"]
    plan = plan_of(number_within(skewed, ["k"], order, "n", hot=hot, hot_rows=30))
    # The rows of the window are those that do not match a hot key.
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_no_group_is_hot_in_an_empty_table(rows):
    empty = rows([], "k string, v int")
    assert hot_groups(group_sizes(empty, ["k"]), 1) is None
    assert number_within(empty, ["k"], [F.col("v")], "n").count() == 0


@pytest.mark.parametrize("hot_rows", [30, 1_000_000])
def test_attach_gives_each_row_its_figures(skewed, hot_rows):
    figures = group_sizes(skewed, ["k"], F.max("v").alias("top")).where("group_size > 3")
    hot = hot_groups(group_sizes(skewed, ["k"]), hot_rows)
    got = attach(skewed, figures, ["k"], hot, null_safe=True)
    assert got.count() == 300
    assert got.where("k = 'hot'").select("group_size").distinct().first()[0] == 100
    assert got.where("k is null").select("group_size").distinct().first()[0] == 40


def test_lookup_keeps_facts_without_key(rows):
    facts = rows([("a", 1), (None, 2), ("x", 3), (None, 4)], "k string, id int")
    dimension = rows([("a", "A"), ("no key 2", "never")], "k string, name string")
    got = as_set(lookup(facts, dimension, "k", "id").select("id", "name"))
    assert got == [(1, "A"), (2, None), (3, None), (4, None)]


def test_aqe_splits_the_hot_key_of_a_lookup(spark, plan_of):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        facts = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            "id",
            F.sha2(F.col("id").cast("string"), 256).alias("load"),
        )
        dimension = spark.range(0, 2000).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            F.col("id").alias("name"),
        )
        got = lookup(facts, dimension, "k", "id")
        assert len(got.collect()) == 60_000
        assert "skew=true" in plan_of(got)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def brute_clusters(values, tolerance):
    """Cluster number and size per (value, id), by walking the sorted values."""
    ordered = sorted(values)
    numbers, number = [], 0
    for place, (value, _) in enumerate(ordered):
        if place == 0 or value - ordered[place - 1][0] > tolerance:
            number += 1
        numbers.append(number)
    return {item: (n, numbers.count(n)) for item, n in zip(ordered, numbers)}


@pytest.mark.parametrize("hot_rows", [20, 1_000_000])
@pytest.mark.parametrize("tolerance", [0, 1, 7, 3000])
def test_gap_clusters_match_brute_force(rows, tolerance, hot_rows):
    pick = random.Random(tolerance)
    data = [
        (pick.choice(["a", "a", "b", None]), pick.randrange(-2000, 200 * (tolerance + 1)), n)
        for n in range(200)
    ] + [("a", 5, 1000 + n) for n in range(60)]
    got = gap_clusters(
        rows(data, "k string, v int, id int"), ["k"], "v", tolerance, "c", "n", hot_rows=hot_rows
    )
    want = []
    for key in ("a", "b", None):
        found = brute_clusters([(v, i) for k, v, i in data if k == key], tolerance)
        want += [(str(key), v, i, c, n) for (v, i), (c, n) in found.items()]
    got = [(str(row["k"]), row["v"], row["id"], row["c"], row["n"]) for row in got.collect()]
    assert sorted(got) == sorted(want)


def test_gap_clusters_published_example(rows):
    data = [("x", d, n) for n, d in enumerate([1000, 3999, 7000, 10001, 20000])]
    df = rows(data, "k string, v int, id int")
    got = gap_clusters(df, ["k"], "v", 3000, "c", "n", min_size=2)
    # 3999 -> 7000 is 3001 apart, 7000 -> 10001 too; only the first two are close.
    assert as_set(got.select("v", "c", "n")) == [(1000, 1, 2), (3999, 1, 2)]


def test_latest_best_last(rows):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n")]
    df = rows(data, "k string, t int, v string")
    latest = latest_per_key(df, ["k"], "t", [F.col("v").desc()])
    assert as_set(latest.select("k", "v")) == [("a", "z"), ("b", "n")]
    ranked = rows(
        [("a", None, 9, "p"), ("a", 3, 1, "q"), ("a", 3, 5, "r"), ("b", None, 1, "s")],
        "k string, rank int, t int, v string",
    )
    best = best_match(ranked, ["k"], "rank", "t", [F.col("v")])
    assert as_set(best.select("k", "v")) == [("a", "r"), ("b", "s")]
    last = last_wins(df.withColumn("at", F.length("v") + F.coalesce("t", F.lit(0))), ["k"], ["at", "v"])
    assert as_set(last.select("k", "v")) == [("a", "z"), ("b", "n")]


def test_keep_first_limits_groups_before_the_shuffle(skewed, plan_of):
    df = keep_first(skewed, ["k"], [F.col("v").desc(), F.col("id").asc()], 3)
    plan = plan_of(df)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    counts = {row["k"]: row["count"] for row in df.groupBy("k").count().collect()}
    assert counts["hot"] == 3 and max(counts.values()) == 3


@pytest.mark.parametrize("hot_rows", [30, 1_000_000])
def test_ordered_elements_keep_nulls(skewed, hot_rows):
    value = F.when(F.col("v") != 3, F.col("v"))
    order = [F.col("v").asc(), F.col("id").asc()]
    lists = ordered_elements(skewed, ["k"], order, {"one": value}, hot_rows=hot_rows)
    got = {}
    for row in sorted(lists.collect(), key=lambda r: r["position"]):
        got.setdefault(row["k"], []).append(row["one"])
        assert row["position"] == len(got[row["k"]])
    data = sorted((str(r["k"]), r["v"]) for r in skewed.collect())
    want = {
        key: [v if v != 3 else None for _, v in group]
        for key, group in itertools.groupby(data, lambda x: x[0])
    }
    assert {str(k): v for k, v in got.items()} == want


def test_filled_elements_leave_nulls_out(rows):
    df = rows([("a", 2, "y"), ("a", 1, None), ("a", 3, "z"), ("b", 1, None)], "k string, o int, v string")
    got = filled_elements(df, ["k"], [F.col("o").asc()], F.col("v"), "one")
    assert as_set(got.select("k", "position", "one")) == [("a", 1, "y"), ("a", 2, "z")]


def test_distinct_elements(rows):
    df = rows([("a", "b"), ("a", "B"), ("a", "a"), ("a", "b"), ("a", None)], "k string, v string")
    got = distinct_elements(df, ["k"], "v").orderBy("position")
    assert [row["v"] for row in got.collect()] == ["a", "B", "b"]


@pytest.mark.parametrize("hot_rows", [30, 1_000_000])
def test_first_rows(skewed, hot_rows):
    order = [F.col("v").desc(), F.col("id").asc()]
    got = first_rows(skewed, order, 100, "n", hot_rows).orderBy("n").collect()
    want = sorted(skewed.collect(), key=lambda r: (-r["v"], r["id"]))[:100]
    assert [(r["id"], r["n"]) for r in got] == [(r["id"], n) for n, r in enumerate(want, 1)]


def test_a_hot_group_of_many_distinct_values(rows):
    """Wide values and a small tolerance: nearly as many cells as rows."""
    pick = random.Random(9)
    data = [("a", pick.randrange(100_000), n) for n in range(400)] + [("b", 5, -1), ("b", 6, -2)]
    got = gap_clusters(
        rows(data, "k string, v int, id int"), ["k"], "v", 100, "c", "n", hot_rows=25
    ).collect()
    for key in ("a", "b"):
        want = brute_clusters([(v, i) for k, v, i in data if k == key], 100)
        assert {(r["v"], r["id"]): (r["c"], r["n"]) for r in got if r["k"] == key} == want


def test_ordinary_groups_are_walked_after_one_shuffle(skewed, plan_of):
    df = gap_clusters(skewed, ["k"], "v", 3, "c", "n")
    assert plan_of(df).count("Exchange hashpartitioning") == 1


def test_newest_filled_ignores_rows_without_value_or_time(rows):
    df = rows([(1, "old"), (9, None), (None, "x"), (5, "new")], "t int, v string")
    assert df.agg(newest_filled(F.col("v"), F.col("t")).alias("v")).first()["v"] == "new"


def test_fallback_union(rows, plan_of):
    a, b = rows([(1,)], "x int"), rows([(2,), (3,)], "x int")
    assert as_set(fallback_union(a, b)) == [(1,)]
    assert as_set(fallback_union(a.where("x > 5"), b)) == [(2,), (3,)]
    assert "CartesianProduct" not in plan_of(fallback_union(a, b))


def test_newest_documents_are_chosen_without_moving_them(spark, plan_of, tmp_path):
    from cratewise.operators.ranking import newest_documents

    data = [("a", 1, "old"), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "only"), ("b", 1, None),
            (None, 3, "n"), (None, 4, "m"), ("c", 5, None), ("c", 5, "filled")]
    spark.createDataFrame(data, "k string, t int, doc string").repartition(3).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t").selectExpr(
        "*", "_metadata.file_path as file_path", "_metadata.row_index as row_index"
    )
    got = newest_documents(stored, ["k"], "t", "doc", ["file_path", "row_index"])
    digest = lambda doc: hashlib.md5(doc.encode()).hexdigest()
    tied = max(("x", "y"), key=digest)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [("a", 2, tied), ("b", 1, None), (None, 4, "m"), ("c", 5, "filled")])
    )
    plan = plan_of(got)
    assert "Sort" not in plan and "hashpartitioning" not in plan


def test_newest_documents_leave_many_rows_out_by_their_place(spark, tmp_path, monkeypatch):
    from cratewise.operators import ranking

    monkeypatch.setattr(ranking, "BROADCAST_ROWS", 3)
    spark.range(300).selectExpr("id % 20 as k", "id as t", "cast(id as string) as doc").write.parquet(
        f"{tmp_path}/t"
    )
    stored = spark.read.parquet(f"{tmp_path}/t").selectExpr(
        "*", "_metadata.file_path as file_path", "_metadata.row_index as row_index"
    )
    got = ranking.newest_documents(stored, ["k"], "t", "doc", ["file_path", "row_index"])
    assert sorted(r["t"] for r in got.collect()) == list(range(280, 300))


@pytest.mark.parametrize("block_rows", [3, 10_000])
def test_elements_are_put_together_in_order(rows, block_rows):
    from cratewise.operators.lists import assembled

    data = [(k, i + 1, None if i % 4 == 0 else f"v{i}", i) for k in ("a", None) for i in range(25)]
    random.shuffle(data)
    elements = rows(data, "k string, position bigint, v string, n int")
    got = {r["k"]: r["elements"] for r in assembled(elements, ["k"], ["v", "n"], block_rows).collect()}
    expected = [(None if i % 4 == 0 else f"v{i}", i) for i in range(25)]
    assert set(got) == {"a", None}
    assert all([tuple(x) for x in listed] == expected for listed in got.values())


def test_a_list_too_large_for_a_cell_is_named(rows):
    from cratewise.operators.lists import assembled

    data = [("small", 1, "x"), *[("large", i + 1, "x" * 50) for i in range(20)]]
    elements = rows(data, "k string, position bigint, v string")
    with pytest.raises(ValueError, match="large"):
        assembled(elements, ["k"], ["v"], cell_bytes=500)
