"""Runs of close values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.operators.ranking import number_within
from cratewise.operators.skew import (
    GROUP_SIZE,
    HOT_GROUP_ROWS,
    attach,
    group_sizes,
    hot_groups,
    measured,
    split_hot,
)
from cratewise.session import checkpointed


def gap_clusters(
    df: DataFrame,
    keys: list[str],
    value: str,
    tolerance: int,
    cluster: str,
    size: str,
    min_size: int = 1,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Number the clusters of every group and give each row its cluster's size.

    Sorted by the whole-number ``value``, a row starts a new cluster when it lies more
    than ``tolerance`` above its predecessor. Groups that fit a task are walked by one
    window; hot ones cell by cell, see ``_hot_clusters``.
    """
    hot = hot_groups(group_sizes(df, keys), hot_rows)
    if hot is None:
        return _walked(df, keys, value, tolerance, cluster, size, min_size)
    rest, big = split_hot(df, hot, keys)
    return _walked(rest, keys, value, tolerance, cluster, size, min_size).unionByName(
        _hot_clusters(big, keys, value, tolerance, cluster, size, min_size, hot_rows)
    )


def _starts(value: Column, before: Column, tolerance: int) -> Column:
    return F.when(before.isNull() | (value - before > tolerance), 1).otherwise(0)


def _walked(df, keys, value, tolerance, cluster, size, min_size) -> DataFrame:
    in_order = Window.partitionBy(*keys).orderBy(value)
    # Rows of one value are never apart: the running sum may take them together.
    starts = _starts(F.col(value), F.lag(value).over(in_order), tolerance)
    numbered = df.withColumn("starts", starts).withColumn(
        cluster, F.sum("starts").over(in_order)
    )
    counted = numbered.withColumn(
        size, F.count(F.lit(1)).over(Window.partitionBy(*keys, cluster))
    )
    return counted.where(F.col(size) >= min_size).drop("starts")


def _hot_clusters(df, keys, value, tolerance, cluster, size, min_size, hot_rows) -> DataFrame:
    """Clusters of groups too large for a task.

    Values are folded into cells ``tolerance + 1`` wide: two values of one cell are never
    further apart than the tolerance, so a cell is never cut. The cells, counted before the
    shuffle, are numbered range by range and meet their predecessor by number; clusters are
    numbered by the starts in earlier blocks of cells and those before in the own one. So
    neither many rows nor many different values of a group come to one task.
    """
    width = F.lit(tolerance + 1).cast("bigint")
    number = F.col(value).cast("bigint")
    celled = df.withColumn("cell", number - F.pmod(number, width))
    cells = measured(
        celled, [*keys, "cell"], F.min(value).alias("low"), F.max(value).alias("high")
    )
    placed = checkpointed(
        number_within(cells, keys, [F.col("cell").asc()], "at", hot_rows=hot_rows)
    )
    before = placed.select(
        *[F.col(key).alias(f"{key}__before") for key in keys],
        (F.col("at") + 1).alias("at__before"),
        F.col("high").alias("high__before"),
    )
    same = F.col("at") == F.col("at__before")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{key}__before"))
    marked = (
        placed.join(before, same, "left")
        .withColumn("starts", _starts(F.col("low"), F.col("high__before"), tolerance))
        .withColumn("block", F.floor((F.col("at") - 1) / hot_rows))
        .drop(*[f"{key}__before" for key in keys], "at__before", "high__before")
    )
    by_block = Window.partitionBy(*keys).orderBy("block")
    earlier = (
        marked.groupBy(*keys, "block")
        .agg(F.sum("starts").alias("block_starts"))
        .withColumn(
            "starts_before",
            F.coalesce(
                F.sum("block_starts").over(by_block.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("block_starts")
    )
    within = Window.partitionBy(*keys, "block").orderBy("at")
    counted = marked.withColumn(
        "own_starts", F.sum("starts").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    clustered = attach(counted, earlier, [*keys, "block"], None, null_safe=True).withColumn(
        cluster, F.col("own_starts") + F.col("starts_before")
    )
    clustered = checkpointed(clustered.select(*keys, "cell", cluster, GROUP_SIZE))
    sizes = (
        clustered.groupBy(*keys, cluster)
        .agg(F.sum(GROUP_SIZE).alias(size))
        .where(F.col(size) >= min_size)
    )
    sized = attach(clustered, sizes, [*keys, cluster], None, null_safe=True)
    hot_cells = hot_groups(cells.select(*keys, "cell", GROUP_SIZE), hot_rows)
    return attach(
        celled, sized.drop(GROUP_SIZE), [*keys, "cell"], hot_cells, null_safe=True
    ).drop("cell")
