"""Rows picked or numbered in an order, per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.operators.skew import (
    BROADCAST_ROWS,
    GROUP_SIZE,
    HOT_GROUP_ROWS,
    group_sizes,
    hot_groups,
    split_hot,
)
from cratewise.session import checkpointed

# Passed for ``hot`` by callers that know nothing of the group sizes yet.
UNMEASURED = object()


def keep_first(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every group.

    Spark limits each group within every task before the shuffle, so a hot group
    sends at most ``n`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("place", F.row_number().over(window)).where(F.col("place") <= n).drop("place")
    )


def latest_per_key(
    df: DataFrame, keys: list[str], newest: str, tie_breaks: list[Column]
) -> DataFrame:
    """The newest row of every key."""
    return keep_first(df, keys, [F.col(newest).desc_nulls_last(), *tie_breaks])


def newest_documents(
    df: DataFrame, keys: list[str], newest: str, document: str, place: list[str]
) -> DataFrame:
    """The newest row of every key, chosen without moving its document.

    Keys, times and the documents' digests choose (of equal times the greatest digest, NULL
    last); ``place`` names the columns that tell where each row is stored. Rows that were not
    chosen are left out where they lie: by broadcast if they are few, as after a batch, else
    by a join on the place, which has no hot keys. Rows without a key are one key.
    """
    listed = df.select(*keys, newest, F.md5(F.col(document).cast("binary")).alias("digest"), *place)
    best = listed.groupBy(*keys).agg(F.max(F.struct(newest, "digest", *place)).alias("best"))
    chosen = best.select(*[F.col(f"best.{name}").alias(name) for name in place])
    passed_over = checkpointed(listed.select(*place).join(chosen, place, "left_anti"))
    if passed_over.count() <= BROADCAST_ROWS:
        passed_over = F.broadcast(passed_over)
    return df.join(passed_over, place, "left_anti").drop(*place)


def best_match(
    df: DataFrame, keys: list[str], rank: str, newest: str, tie_breaks: list[Column]
) -> DataFrame:
    """The lowest-ranked row of every key, unranked rows last, then the newest."""
    return keep_first(
        df, keys, [F.col(rank).asc_nulls_last(), F.col(newest).desc_nulls_last(), *tie_breaks]
    )


def last_wins(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """The row of every key that stands last in the input."""
    return keep_first(df, keys, [F.col(column).desc() for column in position])


def number_within(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    out: str,
    hot: DataFrame | None | object = UNMEASURED,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Number the rows of every group from 1; no keys means the whole table.

    ``order`` must be total. Group sizes are measured first unless the caller passes
    the hot groups it already knows. Groups that fit a task are numbered by a window,
    hot ones range by range.
    """
    if hot is UNMEASURED:
        hot = hot_groups(group_sizes(df, keys), hot_rows)
    if hot is None:
        return _number(df, keys, order, out)
    rest, big = split_hot(df, hot, keys)
    tasks = int(hot.agg(F.sum(GROUP_SIZE)).first()[0] // hot_rows + 1)
    numbered = _number_by_ranges(big, keys, order, out, tasks)
    return _number(rest, keys, order, out).unionByName(numbered) if keys else numbered


def first_rows(
    df: DataFrame, order: list[Column], n: int, out: str, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """The first ``n`` rows of a table in a total order, numbered from 1.

    Up to ``hot_rows`` rows are cut before one task numbers them; beyond, the table is
    numbered range by range.
    """
    if n <= hot_rows:
        return _number(df.orderBy(*order).limit(n), [], order, out)
    return number_within(df, [], order, out, hot_rows=hot_rows).where(F.col(out) <= n)


def _number(df: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window).cast("bigint"))


def _number_by_ranges(
    df: DataFrame, keys: list[str], order: list[Column], out: str, tasks: int
) -> DataFrame:
    """Sort by (keys, order) in ranges, count each range, and shift by the ranges before.

    The order columns are part of the range key, so one group spreads over many ranges.
    Positions are stored before they are counted: both readers see the same ranges.
    """
    by = [F.col(key).asc() for key in keys] + order
    placed = checkpointed(
        df.repartitionByRange(tasks, *by)
        .sortWithinPartitions(*by)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id())
    )
    parts = placed.groupBy(*keys, "part").agg(
        F.min("at").alias("part_start"), F.count(F.lit(1)).alias("part_rows")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = parts.select(
        *[F.col(key).alias(f"{key}__part") for key in keys],
        F.col("part").alias("part__part"),
        "part_start",
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    same = F.col("part") == F.col("part__part")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{key}__part"))
    # One row per range, and one more for every group that begins inside a range.
    few = tasks <= BROADCAST_ROWS and (not keys or starts.count() <= BROADCAST_ROWS)
    return placed.join(F.broadcast(starts) if few else starts, same).select(
        *df.columns,
        (F.col("at") - F.col("part_start") + F.col("rows_before") + 1).alias(out),
    )
