"""Keyed updates and what one run leaves for the next.

Each function returns the new table; storing it beside the old one is the caller's job
(see ``sources.tables``), because Parquet cannot be overwritten while it is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.moments import added_time, moment
from cratewise.functions.text import tidy_code
from cratewise.operators.ranking import first_rows, keep_first
from cratewise.operators.skew import BROADCAST_ROWS
from cratewise.session import checkpointed

# Key marks that are broadcast, 8 bytes each.
BROADCAST_MARKS = 4_000_000


def without_keys(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    few: int = BROADCAST_ROWS,
    marks: int = BROADCAST_MARKS,
    mark: Callable[..., Column] = F.xxhash64,
) -> DataFrame:
    """Target rows whose key is not in ``batch``; rows with a missing key stay.

    Only what may be in the batch is shuffled. Up to ``few`` keys are broadcast, and nothing
    is. Up to ``marks`` keys have their marks broadcast: rows whose mark does not occur pass,
    the others, a few of them by chance, meet the keys in a shuffled join. More keys meet all
    rows in one.
    """
    listed = checkpointed(batch.select(*keys).distinct())
    n = listed.count()
    if n <= few:
        return target.join(F.broadcast(listed), keys, "left_anti").select(target.columns)
    if n > marks:
        return target.join(listed, keys, "left_anti").select(target.columns)
    marked = target.withColumn("__mark", mark(*keys))
    known = F.broadcast(listed.select(mark(*keys).alias("__mark")))
    outside = marked.join(known, "__mark", "left_anti")
    candidates = marked.join(known, "__mark", "left_semi").join(listed, keys, "left_anti")
    return outside.unionByName(candidates).select(target.columns)


def upsert_by_key(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key does not come in, and all incoming rows.

    Columns only one side has come out NULL on the other.
    """
    kept = without_keys(target, incoming, keys)
    return kept.unionByName(incoming, allowMissingColumns=True)


def replace_children(
    children: DataFrame, parents: DataFrame, incoming: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows of all parents in ``parents`` give way to ``incoming``.

    A parent that comes in without children loses the ones it had.
    """
    kept = without_keys(children, parents, [parent_key])
    return kept.unionByName(incoming, allowMissingColumns=True)


def merge_failures(ledger: DataFrame, incoming: DataFrame) -> DataFrame:
    """Carry a run's failed lookups into the failure ledger.

    A known code takes the new status, message and time and counts one more 404 if it
    is one; a new code starts its count; the others stay as they are.
    """
    code = tidy_code(F.col("isrc"))
    status = F.trim("error_status_code")
    arrived = keep_first(
        incoming.select(
            code.alias("code"),
            F.when(status != "", status).alias("new_status"),
            F.col("error_message").alias("new_message"),
            F.col("last_failed_at").alias("new_time"),
        ),
        ["code"],
        [F.col("new_time").desc_nulls_last(), F.col("new_status"), F.col("new_message")],
    ).withColumn("arrived", F.lit(True))
    known = ledger.withColumn("code", code).withColumn("known", F.lit(True))
    merged = known.join(arrived, "code", "full_outer")
    hit = F.coalesce("arrived", F.lit(False))
    one_more = F.when(F.col("new_status") == "404", 1).otherwise(0)

    def updated(new: str, old: str) -> Column:
        return F.when(hit, F.col(new)).otherwise(F.col(old)).alias(old)

    return merged.select(
        F.when(F.col("known"), F.col("isrc")).otherwise(F.col("code")).alias("isrc"),
        updated("new_status", "error_status_code"),
        updated("new_message", "error_message"),
        updated("new_time", "last_failed_at"),
        F.when(hit, F.coalesce("error_404_count", F.lit(0)) + one_more)
        .otherwise(F.col("error_404_count"))
        .cast("int")
        .alias("error_404_count"),
    )


def high_water_mark(tracks: DataFrame) -> DataFrame:
    """One row: the newest ``added_at`` as text, '' for an empty table."""
    newest = F.max(F.col("added_at").cast("timestamp")).cast("string")
    return tracks.agg(F.coalesce(newest, F.lit("")).alias("max_added_at"))


def until_older(items: DataFrame, position: list[str], mark: dt.datetime | None) -> DataFrame:
    """Items, in input order, up to the first one added before ``mark``.

    Items at the mark are read again; items without a date do not stop the reading.
    """
    if mark is None:
        return items
    at = F.struct(*position)
    older = items.where(added_time(F.col("added_at")) < moment(mark))
    stop = older.agg(F.min(at)).scalar()
    return items.where(F.coalesce(at < stop, F.lit(True)))


def up_to_distinct(items: DataFrame, key: str, position: list[str], n: int | None) -> DataFrame:
    """Items, in input order, up to the one that brings the ``n``-th distinct key."""
    if not n:
        return items
    at = F.struct(*position)
    firsts = items.groupBy(key).agg(F.min(at).alias("first_at"))
    numbered = first_rows(firsts, [F.col("first_at").asc()], n, "place")
    # NULL, which stops nothing, when there are fewer than n.
    stop = numbered.agg(F.max(F.when(F.col("place") == n, F.col("first_at")))).scalar()
    return items.where(F.coalesce(at <= stop, F.lit(True)))


def row_count(df: DataFrame) -> DataFrame:
    """One row: how many rows the table has."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
