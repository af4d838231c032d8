"""Repeated passages, found at difference-cover anchors and removed.

Of every text, runs of ANCHOR words are hashed at those positions only that are in the cover
modulo PERIOD. For any two positions some shift of less than PERIOD takes both into the cover,
so two equal windows of WINDOW words share an aligned anchor whatever their positions are. An
anchor that stands in one chunk of texts only is done with. Around the others the match is
extended to whole windows, and these are compared.

Texts travel in chunks. A chunk sends its different hashes, sorted and cut into buckets of
the hash range, and gets back those that others have too: a passage that a third of all
documents share is one number per chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from cratewise.llm.tables import partitions
from cratewise.llm.words import (
    SPACED,
    from_six_bytes,
    sequence_hashes,
    six_bytes,
    slices,
    split_words,
)
from cratewise.session import shared_folder

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
CHUNK_BYTES = 3 << 20
SLICE_BYTES = 1 << 20

# Stands for a missing doc_id: larger than all others.
_NO_ID = np.iinfo(np.int64).max

_CHUNK = "chunk bigint, ids binary, missing binary, offsets binary, texts binary"
_NUMBERS = "bucket int, chunk bigint, numbers binary, least binary"


def _pack(chunk_bytes: int):
    """Texts of consecutive rows, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part, data, offsets in slices(batch, limit=chunk_bytes):
                ids = part.column("doc_id").cast(pa.int64())
                row = [
                    chunk,
                    ids.fill_null(_NO_ID).to_numpy().tobytes(),
                    np.array(ids.is_null().to_pylist(), bool).tobytes(),
                    offsets.tobytes(),
                    press.compress(data.tobytes()),
                ]
                kinds = [pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], kind) for x, kind in zip(row, kinds)],
                    ["chunk", "ids", "missing", "offsets", "texts"],
                )
                chunk += 1

    return run


class Chunk:
    """Texts of one chunk with the hashes of their words."""

    def __init__(self, ids: bytes, missing: bytes, offsets: bytes, texts: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.missing = np.frombuffer(missing, bool)
        self.offsets = np.frombuffer(offsets, np.int64)
        self.data = zstandard.ZstdDecompressor().decompress(texts, max_output_size=1 << 31)
        data = np.frombuffer(self.data, np.uint8)
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        at, last = 0, len(self.ids)
        while at < last:
            low = self.offsets[at]
            to = int(np.searchsorted(self.offsets, low + SLICE_BYTES, side="right")) - 1
            to = min(max(to, at + 1), last)
            words = split_words(data[low : self.offsets[to]], self.offsets[at : to + 1] - low, SPACED)
            hashes.append(words.hashes)
            counts.append(words.counts)
            at = to
        self.hashes, self.counts = np.concatenate(hashes), np.concatenate(counts)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def _word_ranges(self) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(self.first[:-1], self.counts), np.repeat(self.first[1:], self.counts)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all whole windows, and their hashes."""
        _, last = self._word_ranges()
        hashes = sequence_hashes(self.hashes, WINDOW)
        at = np.flatnonzero(np.arange(len(hashes)) + WINDOW <= last[: len(hashes)])
        return at, hashes[at]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the cover's anchors in texts that have a window, and their hashes."""
        begin, last = self._word_ranges()
        hashes = sequence_hashes(self.hashes, ANCHOR)
        at = np.arange(len(hashes))
        begin, last = begin[: len(hashes)], last[: len(hashes)]
        inside = (at + ANCHOR <= last) & (last - begin >= WINDOW)
        at = np.flatnonzero(inside & np.isin((at - begin) % PERIOD, COVER))
        return at, hashes[at]

    def text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, words, side="right") - 1

    def candidates(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows that hold an anchor among ``shared`` (short hashes, sorted, by bucket)."""
        at, hashes = self.anchors()
        marked = np.zeros(len(self.hashes) + PERIOD + 1, np.int64)
        marked[at[_among(_short(hashes), shared)] + 1] = 1
        upto = np.cumsum(marked)
        places, windows = self.windows()
        kept = upto[places + PERIOD] > upto[places]
        return places[kept], windows[kept]


def _short(hashes: np.ndarray) -> np.ndarray:
    """Anchors only point out candidates: their upper 48 bits are enough."""
    return hashes >> np.uint64(16)


def _among(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    place = np.searchsorted(sorted_values, values)
    place[place == len(sorted_values)] = 0
    return sorted_values[place] == values


def _cut(values: np.ndarray, bits: int, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, low, high) of sorted values of so many bits, in equal parts of their range."""
    step = (1 << bits) // buckets + 1
    cuts = np.searchsorted(values, np.array([i * step for i in range(buckets)], np.uint64))
    ends = [*cuts[1:].tolist(), len(values)]
    return [(i, a, z) for i, (a, z) in enumerate(zip(cuts.tolist(), ends)) if a < z]


def _rows(rows: list[tuple]) -> tuple[list[pa.Array], list[str]]:
    columns = list(zip(*rows)) if rows else [[]] * 4
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return [pa.array(x, t) for x, t in zip(columns, kinds)], ["bucket", "chunk", "numbers", "least"]


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                number = row.pop("chunk")
                values = np.unique(_short(Chunk(**row).anchors()[1]))
                rows = [
                    (bucket, number, six_bytes(values[a:z]), b"")
                    for bucket, a, z in _cut(values, 48, buckets)
                ]
                yield pa.RecordBatch.from_arrays(*_rows(rows))

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Of a bucket, the anchors of two chunks or more, for each chunk that has them."""
    lists = [from_six_bytes(x) for x in table.column("numbers").to_pylist()]
    values = np.sort(np.concatenate(lists))
    often = np.unique(values[1:][values[1:] == values[:-1]])
    rows = []
    for chunk, own in zip(table.column("chunk").to_pylist(), lists):
        kept = own[_among(own, often)]
        if len(kept):
            rows.append((0, chunk, six_bytes(kept), b""))
    arrays, names = _rows(rows)
    return pa.table(arrays, names=names)


def _only(table: pa.Table, read) -> np.ndarray:
    """All numbers sent to a chunk, sorted."""
    parts = [read(x) for x in table.column("numbers").to_pylist()]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _send_windows(buckets: int):
    def run(chunks: pa.Table, shared: pa.Table) -> pa.Table:
        rows = []
        for row in chunks.to_pylist():
            number = row.pop("chunk")
            chunk = Chunk(**row)
            at, hashes = chunk.candidates(_only(shared, from_six_bytes))
            ids = chunk.ids[chunk.text_of(at)]
            order = np.lexsort((ids, hashes))
            hashes, ids = hashes[order], ids[order]
            first = np.ones(len(hashes), bool)
            first[1:] = hashes[1:] != hashes[:-1]
            values, least = hashes[first], ids[first]
            rows += [
                (bucket, number, values[a:z].tobytes(), least[a:z].tobytes())
                for bucket, a, z in _cut(values, 64, buckets)
            ]
        arrays, names = _rows(rows)
        return pa.table(arrays, names=names)

    return run


def _earlier(table: pa.Table) -> pa.Table:
    """Of a bucket, the windows whose least document is in another chunk, for each chunk."""
    lists = [np.frombuffer(x, np.uint64) for x in table.column("numbers").to_pylist()]
    least = [np.frombuffer(x, np.int64) for x in table.column("least").to_pylist()]
    values, ids = np.concatenate(lists), np.concatenate(least)
    order = np.lexsort((ids, values))
    first = np.ones(len(values), bool)
    first[1:] = values[order][1:] != values[order][:-1]
    known, lowest = values[order][first], ids[order][first]
    rows = []
    for chunk, own, own_ids in zip(table.column("chunk").to_pylist(), lists, least):
        kept = own[lowest[np.searchsorted(known, own)] < own_ids]
        if len(kept):
            rows.append((0, chunk, kept.tobytes(), b""))
    arrays, names = _rows(rows)
    return pa.table(arrays, names=names)


def _remove(chunks: pa.Table, earlier: pa.Table) -> pa.Table:
    """Every document of a chunk without the words of repeated windows."""
    ids, missing, counts, removed, texts = [], [], [], [], []
    for row in chunks.to_pylist():
        row.pop("chunk")
        chunk = Chunk(**row)
        at, hashes = chunk.windows()
        own = chunk.ids[chunk.text_of(at)]
        # Windows that a smaller document of this chunk has.
        order = np.lexsort((own, hashes))
        start = np.ones(len(order), bool)
        start[1:] = hashes[order][1:] != hashes[order][:-1]
        least = own[order][start][np.cumsum(start) - 1]
        repeated = np.zeros(len(at), bool)
        repeated[order] = least < own[order]
        repeated |= _among(hashes, _only(earlier, lambda x: np.frombuffer(x, np.uint64)))
        change = np.zeros(len(chunk.hashes) + WINDOW + 1, np.int64)
        np.add.at(change, at[repeated], 1)
        np.add.at(change, at[repeated] + WINDOW, -1)
        kept = np.cumsum(change)[: len(chunk.hashes)] == 0
        upto = np.concatenate([[0], np.cumsum(~kept)])
        gone = upto[chunk.first[1:]] - upto[chunk.first[:-1]]
        for i, (low, high) in enumerate(zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist())):
            words = chunk.data[low:high].split()
            if gone[i]:
                words = compress(words, kept[chunk.first[i] : chunk.first[i + 1]].tolist())
            texts.append(b" ".join(words))
        ids.append(chunk.ids)
        missing.append(chunk.missing)
        counts.append(chunk.counts)
        removed.append(gone)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pa.table(
        [
            pa.array(join(ids), pa.int64(), mask=join(missing).astype(bool)),
            pa.array(join(counts), pa.int64()),
            pa.array(join(removed), pa.int64()),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "n_removed", "text"],
    )


def without_repeats(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (integer doc_id, text), its text without repeated passages.

    A word goes if a window of WINDOW words that covers it also starts in a document of a
    smaller doc_id, judged on the input. ``n_words``, ``n_removed``, and ``text``: the words
    left, joined by one blank. A null or wordless text has no words and an empty text. Rows
    of one doc_id are one document; a missing doc_id is larger than all others. No rows give
    no rows. Windows are compared by 64-bit hashes of their words.
    """
    spark = docs.sparkSession
    buckets = 2 * partitions(spark)
    path = f"{shared_folder(spark)}/chunks-{uuid.uuid4().hex}"
    packed = docs.select("doc_id", "text").mapInArrow(_pack(chunk_bytes), _CHUNK)
    packed.write.option("compression", "uncompressed").parquet(path)
    chunks = spark.read.schema(packed.schema).parquet(path)
    anchors = chunks.mapInArrow(_send_anchors(buckets), _NUMBERS)
    shared = anchors.groupBy("bucket").applyInArrow(_repeated, _NUMBERS)
    by_chunk = chunks.groupBy("chunk")
    windows = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(
        _send_windows(buckets), _NUMBERS
    )
    earlier = windows.groupBy("bucket").applyInArrow(_earlier, _NUMBERS)
    return by_chunk.cogroup(earlier.groupBy("chunk")).applyInArrow(
        _remove, "doc_id bigint, n_words bigint, n_removed bigint, text string"
    )
