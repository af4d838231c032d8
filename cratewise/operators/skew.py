"""Groups too large for one task: find them, set them apart, join their figures back.

Sizes come from an aggregate that Spark combines before its shuffle, so measuring a hot
group is cheap. The list of hot groups is counted before anything broadcasts it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.session import checkpointed

GROUP_SIZE = "group_size"
HOT_GROUP_ROWS = 1_000_000
BROADCAST_ROWS = 500_000


def group_sizes(df: DataFrame, keys: list[str], *figures: Column) -> DataFrame:
    """Row count per group, and further aggregates if asked for."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(GROUP_SIZE), *figures)


def measured(df: DataFrame, keys: list[str], *figures: Column) -> DataFrame:
    """Group sizes, stored: the check for hot groups and the later join read one copy."""
    return checkpointed(group_sizes(df, keys, *figures))


def hot_groups(sizes: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame | None:
    """The rows of ``sizes`` whose group is hot, stored; None when no group is.

    At most rows / ``hot_rows`` groups can be hot.
    """
    largest = sizes.agg(F.max(GROUP_SIZE)).first()[0]
    if largest is None or largest <= hot_rows:
        return None
    return checkpointed(sizes.where(F.col(GROUP_SIZE) > hot_rows))


def listed_groups(hot: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the hot groups, broadcast if there are at most BROADCAST_ROWS of them.

    More of them meet the rows in a shuffled join, whose hot keys AQE splits.
    """
    listed = hot.select(*keys)
    return F.broadcast(listed) if hot.count() <= BROADCAST_ROWS else listed


def split_hot(df: DataFrame, hot: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of the other groups, rows of the hot groups."""
    if not keys:
        return df.limit(0), df
    listed = listed_groups(hot, keys)
    return (
        _match(df, listed, keys, "left_anti", null_safe=True),
        _match(df, listed, keys, "left_semi", null_safe=True),
    )


def attach(
    df: DataFrame,
    figures: DataFrame,
    keys: list[str],
    hot: DataFrame | None,
    null_safe: bool = False,
) -> DataFrame:
    """Give every row the figures of its group; rows without figures drop out.

    ``figures`` has one row per group. Hot groups meet theirs by broadcast, so the
    shuffled join holds no group above the hot size.
    """
    if hot is None:
        return _match(df, figures, keys, "inner", null_safe)
    rest, big = split_hot(df, hot, keys)
    hot_figures = _match(figures, listed_groups(hot, keys), keys, "left_semi", null_safe=True)
    # One row per hot group at most.
    if hot.count() <= BROADCAST_ROWS:
        hot_figures = F.broadcast(hot_figures)
    return _match(rest, figures, keys, "inner", null_safe).unionByName(
        _match(big, hot_figures, keys, "inner", null_safe=True)
    )


def repeated_groups(
    df: DataFrame, keys: list[str], size: str, hot_rows: int, *figures: Column
) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key occurs more than once, with the group's size and further figures.

    Also returns the hot ones among these groups. Both carry the figures, so a following
    operator may count them among its keys and keep the partitioning of this join.
    """
    sizes = measured(df, keys, *figures).where(F.col(GROUP_SIZE) > 1)
    sizes = sizes.withColumn(size, F.col(GROUP_SIZE))
    hot = hot_groups(sizes, hot_rows)
    return attach(df, sizes.drop(GROUP_SIZE), keys, hot), hot


def splittable(unique: DataFrame) -> DataFrame:
    """The unique side of a many-to-one join, such that Spark can cut a hot key of the other.

    AQE cuts a partition only if both inputs of the join come straight from a shuffle. An
    aggregate, a distinct or a window on the join's key already lies by that key and gets
    none. Its rows, one per key, are dealt evenly first, so that the join deals them anew.
    What is read from storage, or lies by another key, needs nothing.
    """
    return unique.hint("rebalance")


def lookup(facts: DataFrame, dimension: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join to a table with one row per text ``key``.

    Facts without a key would all hash to one task; a stand-in made from another column
    spreads them, and the second condition keeps it from ever matching. A hot key is
    split by AQE, which replicates the one dimension row it meets; a dimension that is made
    by its key must be ``splittable``.
    """
    listed = dimension.withColumnRenamed(key, f"{key}__other")
    stand_in = F.concat(F.lit("no key "), F.col(spread_by).cast("string"))
    same = F.coalesce(F.col(key), stand_in) == F.col(f"{key}__other")
    return facts.join(listed, same & F.col(key).isNotNull(), "left").drop(f"{key}__other")


def _match(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool
) -> DataFrame:
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({key: f"{key}__other" for key in keys})
    same = reduce(
        lambda a, b: a & b, [left[key].eqNullSafe(renamed[f"{key}__other"]) for key in keys]
    )
    return left.join(renamed, same, how).drop(*[f"{key}__other" for key in keys])
