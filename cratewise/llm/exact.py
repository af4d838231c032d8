"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of fixed size. Equal blocks get one integer name: blocks
are sorted by key and content, and a block's place in that order is its name. Then adjacent
names are paired, equal pairs get one name the same way, and so on until every document has
one name. Two documents of as many rounds have the same name exactly if their texts are equal;
nothing rests on a hash being free of collisions.

Texts move once, combined before the shuffle, to see that no key stands for two blocks; after
that only keys, names and positions move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.tables import ROW, numbered
from cratewise.llm.words import slices
from cratewise.session import checkpointed

BLOCK_BYTES = 4096
# Deleted before texts are compared: \x20\x09-\x0D.
_KEPT = np.ones(256, bool)
_KEPT[[32, *range(9, 14)]] = False


def block_key(block: bytes, turn: int) -> int:
    return xxhash.xxh64_intdigest(block, turn)


def _normalized(data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
    """Every text in UTF-8 without the deleted characters."""
    kept = _KEPT[data]
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    clean = data[kept].tobytes()
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield clean[low:high]


def _cut(text: bytes, size: int) -> list[bytes]:
    """Blocks of a text; an empty text is one empty block."""
    return [text[i : i + size] for i in range(0, max(len(text), 1), size)]


def _keys(blocks: list[bytes], key, turn: int) -> list[int]:
    """Keys as signed 64-bit numbers."""
    return np.array([key(x, turn) for x in blocks], np.uint64).view(np.int64).tolist()


def _emit_blocks(size: int, key, turn: int):
    """(key, block) of all blocks, each once per slice of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch):
                blocks = list({x for text in _normalized(data, offsets) for x in _cut(text, size)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_keys(blocks, key, turn), pa.int64()), pa.array(blocks, pa.binary())],
                    ["key", "block"],
                )

    return run


def _emit_rows(size: int, key, turn: int):
    """Every row with its length in code points, its digest and its blocks' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch):
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                texts = list(_normalized(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(points[offsets]), pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                        pa.array(
                            [_keys(_cut(x, size), key, turn) for x in texts], pa.list_(pa.int64())
                        ),
                    ],
                    ["doc_id", "chars", "text_sha256", "keys"],
                )

    return run


def named(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Give every different key an integer: its place among the sorted keys. Stored."""
    distinct = df.select(*keys).distinct().sortWithinPartitions(*keys)
    return checkpointed(distinct.withColumn(name, F.monotonically_increasing_id()))


def block_names(docs: DataFrame, size: int, key) -> tuple[DataFrame, DataFrame]:
    """Stored (row, doc_id, chars, text_sha256), and (row, names) by the names of the blocks.

    A key may stand for one block only. Where two blocks share one, all blocks are keyed
    anew by the next turn of ``key``; the blocks themselves decide that, not a hash.
    """
    turn, clash = 0, True
    while clash:
        blocks = docs.select("text").mapInArrow(
            _emit_blocks(size, key, turn), "key bigint, block binary"
        )
        names = checkpointed(
            blocks.distinct()
            .groupBy("key")
            .agg(F.count(F.lit(1)).alias("blocks"))
            .sortWithinPartitions("key")
            .withColumn("name", F.monotonically_increasing_id())
        )
        clash = not names.where("blocks > 1").isEmpty()
        turn += clash
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, chars bigint, text_sha256 string, keys array<bigint>"
    rows = docs.select("doc_id", "text").mapInArrow(_emit_rows(size, key, turn), schema)
    rows = checkpointed(numbered(rows))
    parts = rows.select(ROW, F.posexplode("keys").alias("place", "key"))
    return rows.drop("keys"), _lists(parts.join(names.drop("blocks"), "key"))


def _lists(parts: DataFrame) -> DataFrame:
    """Names of one document in order; a list is as long as its document."""
    listed = F.sort_array(F.collect_list(F.struct("place", "name")))
    return parts.groupBy(ROW).agg(F.transform(listed, lambda x: x["name"]).alias("names"))


def identities(lists: DataFrame) -> DataFrame:
    """(row, rounds, name): pair adjacent names until each document has one.

    An odd name at the end is paired with -1, which no name is.
    """
    lists = checkpointed(lists)
    done = lists.where(F.size("names") == 1).select(
        ROW, F.lit(0).alias("rounds"), F.col("names")[0].alias("name")
    )
    rounds = 0
    todo = lists.where(F.size("names") > 1)
    while not todo.isEmpty():
        rounds += 1
        half = F.ceil(F.size("names") / 2).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), half - 1),
            lambda i: F.struct(
                F.get("names", i * 2).alias("left"),
                F.coalesce(F.get("names", i * 2 + 1), F.lit(-1)).alias("right"),
            ),
        )
        parts = todo.select(ROW, F.posexplode(pairs).alias("place", "pair")).select(
            ROW, "place", "pair.left", "pair.right"
        )
        names = named(parts, ["left", "right"], "name")
        lists = checkpointed(_lists(parts.join(names, ["left", "right"])))
        done = done.unionByName(
            lists.where(F.size("names") == 1).select(
                ROW, F.lit(rounds).alias("rounds"), F.col("names")[0].alias("name")
            )
        )
        todo = lists.where(F.size("names") > 1)
    return done


def exact_duplicates(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, key=block_key
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), with its group of equal texts.

    Of a group the longest original text stays, then the smallest doc_id (nulls last), then
    the row that was read first. A null text is empty; all texts of white space are equal.
    No rows give no rows. ``key`` spreads the blocks; a poor one costs time, not results.
    """
    rows, lists = block_names(docs, block_bytes, key)
    members = checkpointed(rows.join(identities(lists), ROW))
    order = F.struct(
        (-F.col("chars")).alias("chars"),
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").alias("doc_id"),
        F.col(ROW).alias("row"),
    )
    groups = checkpointed(
        members.groupBy("rounds", "name")
        .agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best"))
        .select(
            "rounds",
            "name",
            "group_size",
            F.col("best.row").alias("keep_row"),
            F.col("best.doc_id").alias("keep_id"),
        )
    )
    return members.join(groups, ["rounds", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col(ROW) == F.col("keep_row")).alias("kept"),
        "text_sha256",
        "chars",
    )
