"""Mix sources to target weights by a low-discrepancy schedule of equal-token blocks.

Golden-ratio points, mapped through the cumulative shares of the sources, say which source
each slot of the mix takes from. The r-th slot of a source takes the r-th block of that
source: its documents in shuffled order, laid end to end, again from the start where the
target asks for more than the source has, and cut every ``block_tokens`` words. The last
block of a source ends at its target, so every source is met to the word.

Only DataFrame functions are used. Every running sum goes over chunks of a key and then
over the chunks' totals, so a source with a third of all rows is no single task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.llm.tables import ROW, numbered
from cratewise.operators.ranking import number_within
from cratewise.session import checkpointed

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
BLOCK_TOKENS = 4096
WORD = r"[^\x20\x09-\x0D]+"

# Points are j * GOLDEN mod POINTS: the golden ratio in units of 2^-31.
POINTS = 1 << 31
GOLDEN = 1327217885


@dataclass
class Mix:
    """``documents``: one row per input row. ``schedule``: one row per slot of the mix."""

    documents: DataFrame
    sources: DataFrame
    schedule: DataFrame


def running_sum(
    df: DataFrame, keys: list[str], chunk: str, order: list[Column], value: Column, out: str
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a key, in the order of (chunk, order).

    No window holds more than one chunk of a key, or the chunk totals of a key.
    """
    by = [*keys, chunk]
    earlier = Window.unboundedPreceding, -1
    totals = df.groupBy(*by).agg(F.sum(value).alias("chunk_sum"))
    starts = totals.select(
        *by,
        F.sum("chunk_sum")
        .over(Window.partitionBy(*keys).orderBy(chunk).rowsBetween(*earlier))
        .alias("chunk_start"),
    )
    local = F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(*earlier))
    zero = F.lit(0).cast("bigint")
    return (
        df.withColumn(out, F.coalesce(local, zero))
        .join(starts, by)
        .withColumn(out, F.col(out) + F.coalesce("chunk_start", zero))
        .drop("chunk_start")
    )


def chunk_rows(rows: int) -> int:
    """Rows of a chunk: as many as there are chunks, 256 at least."""
    return max(256, math.isqrt(max(rows, 1)))


def source_targets(
    sources: DataFrame, weights: tuple[int, ...], share: float, repeats: int
) -> DataFrame:
    """Add ``source_no``, ``weight`` and ``target`` to (source, source_size, source_rows).

    Targets stop at ``repeats`` times a source's size; what is above goes to the others by
    weight, until none is above. A round is one aggregate over the sources.
    """
    listed = F.array(*[F.lit(weight) for weight in weights])
    ranked = number_within(sources, [], [F.col("source").asc_nulls_last()], "place")
    ranked = checkpointed(
        ranked.withColumn("source_no", F.col("place") - 1)
        .withColumn("weight", F.get(listed, F.pmod("source_no", F.lit(len(weights))).cast("int")))
        .drop("place")
    )
    size, weight = F.col("source_size"), F.col("weight")
    total = ranked.agg(F.sum(size)).first()[0] or 0
    level, full = 0.0, F.lit(False)
    while total:
        is_open = ~full
        capped, open_weight = ranked.agg(
            F.coalesce(F.sum(F.when(full, repeats * size)), F.lit(0)),
            F.coalesce(F.sum(F.when(is_open, weight)), F.lit(0)),
        ).first()
        if not open_weight:
            break
        higher = (share * total - capped) / open_weight
        if higher == level:
            break
        level = higher
        full = weight * F.lit(level) > repeats * size
    target = F.when(full, (repeats * size).cast("double")).otherwise(weight * F.lit(level))
    return ranked.withColumn("target", target)


def slot_sources(sources: DataFrame, slots: int, cells: int) -> DataFrame:
    """(slot, source_no): the source whose share of [0, POINTS) holds the slot's point.

    Shares go by the blocks that a source needs. Both sides meet in equal cells of the
    range, about ``slots / cells`` points each.
    """
    spark = sources.sparkSession
    width = POINTS // cells + 1
    counted = sources.where("blocks > 0").withColumn("part", F.expr("source_no div 1000"))
    lower = running_sum(counted, [], "part", [F.col("source_no")], F.col("blocks"), "before")
    bound = lambda blocks: F.floor(blocks / F.lit(slots) * POINTS)
    shares = lower.select(
        "source_no",
        bound(F.col("before")).alias("low"),
        bound(F.col("before") + F.col("blocks")).alias("high"),
    ).where("low < high")
    spread = shares.withColumn(
        "cell", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})"))
    )
    points = spark.range(slots).select(
        F.col("id").alias("slot"), (F.col("id") % POINTS * GOLDEN % POINTS).alias("point")
    )
    placed = points.withColumn("cell", F.expr(f"point div {width}"))
    return placed.join(spread, "cell").where("point >= low and point < high").select(
        "slot", "source_no"
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: str = "mix",
) -> Mix:
    """Mix ``docs`` (doc_id, text, source).

    A null text has no words and is never taken; a null source is a source of its own, the
    last. Rows with equal doc_id count one by one. No rows give an empty mix. Documents are
    shuffled by md5 of seed and doc_id, so reruns agree whatever the partitioning.
    """
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    named = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = checkpointed(
        numbered(
            docs.select("doc_id", "source", words.alias("size"), F.md5(named).alias("shuffled"))
        )
    )
    grouped = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    sources = source_targets(checkpointed(grouped), weights, share, repeats)
    sources = checkpointed(
        sources.withColumn("take", F.floor("target")).withColumn(
            "blocks", F.ceil(F.col("take") / block_tokens)
        )
    )
    n_rows, slots = sources.agg(
        F.coalesce(F.sum("source_rows"), F.lit(0)), F.coalesce(F.sum("blocks"), F.lit(0))
    ).first()

    schedule = _schedule(sources, slots)
    known = sources.select(
        F.col("source").alias("source__of"), "source_no", "source_size", "target", "take"
    )
    placed = rows.join(known, F.col("source").eqNullSafe(F.col("source__of"))).drop("source__of")
    # Leading 32 bits of the shuffle key, in as many equal parts as there are chunks.
    chunks = n_rows // chunk_rows(n_rows) + 1
    head = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("bigint")
    placed = placed.withColumn("chunk", F.shiftright(head * chunks, 32))
    placed = running_sum(
        placed,
        ["source_no"],
        "chunk",
        [F.col("shuffled"), F.col("doc_id"), F.col("size"), F.col(ROW)],
        F.col("size"),
        "start",
    )
    placed = checkpointed(placed.drop("shuffled", "chunk"))
    taken = (
        _pieces(placed, repeats, block_tokens)
        .join(schedule.select("source_no", "block"), ["source_no", "block"])
        .groupBy(ROW)
        .agg(F.sum("words").alias("taken"))
    )
    documents = placed.join(taken, ROW, "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"),
        "source",
    )
    return Mix(documents, sources, schedule)


def _schedule(sources: DataFrame, slots: int) -> DataFrame:
    """(slot, source_no, block): which block each slot takes.

    Points miss a source's exact number of slots by a few: slots beyond it are left out,
    missing ones follow at the end.
    """
    size = chunk_rows(slots)
    drawn = slot_sources(sources, max(slots, 1), slots // 1000 + 1)
    drawn = drawn.withColumn("chunk", F.expr(f"slot div {size}"))
    ranked = running_sum(
        drawn, ["source_no"], "chunk", [F.col("slot")], F.lit(1).cast("bigint"), "block"
    )
    needed = sources.select("source_no", "blocks")
    kept = ranked.join(needed, "source_no").where("block < blocks")
    kept = checkpointed(kept.select("slot", "source_no", "block"))
    got = kept.groupBy("source_no").agg(F.count(F.lit(1)).alias("got"))
    missing = (
        needed.join(got, "source_no", "left")
        .withColumn("got", F.coalesce("got", F.lit(0).cast("bigint")))
        .where("got < blocks")
        .select("source_no", F.explode(F.expr("sequence(got, blocks - 1)")).alias("block"))
        .select((F.lit(slots) + F.col("block")).alias("slot"), "source_no", "block")
    )
    return kept.unionByName(missing)


def _pieces(placed: DataFrame, repeats: int, block_tokens: int) -> DataFrame:
    """(row, source_no, block, words): the parts of every document, a block at a time."""
    turns = placed.where("size > 0 and start < take").withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    )
    spans = (
        turns.withColumn("low", F.col("start") + F.col("turn") * F.col("source_size"))
        .withColumn("high", F.least(F.col("low") + F.col("size"), F.col("take")))
        .where("low < high")
    )
    cut = spans.withColumn(
        "block", F.explode(F.expr(f"sequence(low div {block_tokens}, (high - 1) div {block_tokens})"))
    )
    start = F.col("block") * block_tokens
    words = F.least(F.col("high"), start + block_tokens) - F.greatest(F.col("low"), start)
    return cut.select(ROW, "source_no", "block", words.alias("words"))
