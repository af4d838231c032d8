"""Benchmark passages in documents, by a prefix-filtered set join.

A window of a benchmark item occurs in a document only if all its shingles do. So of every
window one prefix token is enough to join on: its rarest shingle, by counts over all
documents. Where a document has that shingle, its position says where the window would have
to begin; it must lie inside the document as a whole, and its words are then compared.

The benchmark goes to the tasks in blocks of bounded size, however large it is; documents
are read once per block and are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.llm.words import (
    ALNUM_FOLDED,
    Words,
    sequence_hashes,
    slices,
    split_words,
    whole_sequences,
)
from cratewise.session import checkpointed

WINDOW = 13
SHINGLE = 5
BLOCK_BYTES = 16 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Bytes as the words have them: A-Z lower-cased, separators as blanks.
_PLAIN = np.where(ALNUM_FOLDED == 0, 32, np.arange(256)).astype(np.uint8)
_PLAIN[65:91] = np.arange(97, 123)

_MAP_BITS = 22


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, passage): the windows of every item, words joined by a blank.

    Items without an id have windows as well.
    """
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words"))
    items = items.where("size(words) > 0")
    last = F.greatest(F.size("words") - window, F.lit(0))
    passages = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", F.slice("words", i + 1, window))
    )
    return items.select("item_id", F.explode(passages).alias("passage")).distinct()


@dataclass
class Index:
    """The windows of one block, by the hash of their prefix token."""

    passages: list[bytes]
    items: list[list[str]]
    lengths: np.ndarray
    tokens: np.ndarray  # sorted hashes of prefix tokens, one per window
    at: np.ndarray  # place of the token in its window
    window: np.ndarray  # number of the window
    bitmap: np.ndarray


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    marked = np.zeros(1 << _MAP_BITS, bool)
    marked[hashes >> np.uint64(64 - _MAP_BITS)] = True
    return marked


def _listed(hashes: np.ndarray, sorted_tokens: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Positions of those ``hashes`` that are among the sorted tokens."""
    maybe = np.flatnonzero(bitmap[hashes >> np.uint64(64 - _MAP_BITS)])
    found = np.searchsorted(sorted_tokens, hashes[maybe])
    found[found == len(sorted_tokens)] = 0
    return maybe[sorted_tokens[found] == hashes[maybe]] if len(sorted_tokens) else maybe[:0]


class Block:
    """Windows of one block with the shingles of each."""

    def __init__(self, rows: list[tuple[str | None, str]], shingle: int):
        items: dict[bytes, list[str]] = {}
        for item_id, passage in rows:
            items.setdefault(passage.encode(), []).extend([] if item_id is None else [item_id])
        self.passages, self.items = list(items), list(items.values())
        data = np.frombuffer(b"".join(self.passages), np.uint8)
        offsets = np.cumsum([0, *map(len, self.passages)])
        self.words = split_words(data, offsets, ALNUM_FOLDED)
        self.lengths = self.words.counts
        self.shingle = shingle
        self.widths = sorted({min(shingle, int(n)) for n in self.lengths})
        tokens, at, window = [], [], []
        of_word = self.words.text_of_word()
        for k in self.widths:
            whole = np.flatnonzero(whole_sequences(self.words, k))
            whole = whole[np.minimum(self.lengths[of_word[whole]], shingle) == k]
            tokens.append(sequence_hashes(self.words.hashes, k)[whole])
            at.append(whole - self.words.first[of_word[whole]])
            window.append(of_word[whole])
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        self.tokens, self.at = join(tokens, np.uint64), join(at, np.int64)
        self.window = join(window, np.int64)
        self.distinct = np.unique(self.tokens)

    def index(self, counts: np.ndarray) -> Index:
        """One prefix token per window, the rarest; windows with a token nowhere seen go."""
        seen = counts[np.searchsorted(self.distinct, self.tokens)]
        order = np.lexsort((self.at, self.tokens, seen, self.window))
        first = np.ones(len(order), bool)
        first[1:] = self.window[order][1:] != self.window[order][:-1]
        chosen = order[first]
        chosen = chosen[seen[chosen] > 0]
        chosen = chosen[np.argsort(self.tokens[chosen], kind="stable")]
        tokens = self.tokens[chosen]
        return Index(
            self.passages, self.items, self.lengths, tokens, self.at[chosen],
            self.window[chosen], _bitmap(tokens),
        )


def _count(tokens, bitmap, widths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, marked = tokens.value, bitmap.value
        counts = np.zeros(len(own), np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch):
                words = split_words(data, offsets, ALNUM_FOLDED)
                for k in widths:
                    hashes = sequence_hashes(words.hashes, k)
                    found = _listed(hashes, own, marked)
                    found = found[whole_sequences(words, k)[found]]
                    np.add.at(counts, np.searchsorted(own, hashes[found]), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["token", "n"]
        )

    return run


def _occurrences(words: Words, index: Index, widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every place in these texts where a window occurs."""
    if not len(index.tokens) or not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = np.repeat(words.first[1:], words.counts)
    begin = np.repeat(words.first[:-1], words.counts)
    plain = _PLAIN[words.data]
    starts, windows = [], []
    for k in widths:
        hashes = sequence_hashes(words.hashes, k)
        found = _listed(hashes, index.tokens, index.bitmap)
        low = np.searchsorted(index.tokens, hashes[found], side="left")
        many = np.searchsorted(index.tokens, hashes[found], side="right") - low
        entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        place = np.repeat(found, many)
        window = index.window[entry]
        start = place - index.at[entry]
        fits = (start >= begin[place]) & (start + index.lengths[window] <= last[place])
        for s, w in zip(start[fits].tolist(), window[fits].tolist()):
            end = words.ends[s + index.lengths[w] - 1]
            if b" ".join(plain[words.starts[s] : end].tobytes().split()) == index.passages[w]:
                starts.append(s)
                windows.append(w)
    return np.array(starts, np.int64), np.array(windows, np.int64)


# Names of what is gathered while it stands beside columns of any name.
_WORDS, _SPANS, _ITEMS = "__words__", "__spans__", "__items__"
HITS = "__hits__"


def _mark(index, widths: list[int], names: list[str]):
    """Add the occurrences of one block's windows to every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for part, data, offsets in slices(batch):
                words = split_words(data, offsets, ALNUM_FOLDED)
                starts, windows = _occurrences(words, own, widths)
                texts = np.searchsorted(words.first, starts, side="right") - 1
                spans = [x or [] for x in part.column(_SPANS).to_pylist()]
                items = [x or [] for x in part.column(_ITEMS).to_pylist()]
                for text, start, window in zip(texts.tolist(), starts.tolist(), windows.tolist()):
                    start -= int(words.first[text])
                    spans[text] += [start, start + int(own.lengths[window])]
                    items[text] += own.items[window]
                gathered = {
                    _WORDS: pa.array(words.counts, pa.int64()),
                    _SPANS: pa.array([_merged(x) for x in spans], pa.list_(pa.int64())),
                    _ITEMS: pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays(
                    [gathered.get(x, part.column(x)) for x in names], names
                )

    return run


def _merged(spans: list[int]) -> list[int]:
    """Ends of the unions of overlapping or adjoining spans, in order."""
    out: list[int] = []
    for low, high in sorted(zip(spans[::2], spans[1::2])):
        if out and low <= out[-1]:
            out[-1] = max(out[-1], high)
        else:
            out += [low, high]
    return out


def marked_rows(
    docs: DataFrame,
    benchmark: DataFrame,
    names: list[str],
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns ``names`` of every row, with what of its text stands in ``benchmark``.

    Column HITS has the fields of ``benchmark_hits``. Rows are marked where they lie.
    """
    spark = docs.sparkSession
    listed = checkpointed(item_windows(benchmark, window))
    id_bytes = F.coalesce(F.octet_length("item_id"), F.lit(0))
    total = listed.agg(F.sum(F.octet_length("passage") + id_bytes)).first()[0]
    blocks = max(1, -(-(total or 0) // block_bytes))
    share = F.pmod(F.xxhash64("item_id", "passage"), F.lit(blocks))
    marked = docs.select(
        *dict.fromkeys([*names, "text"]),
        F.lit(0).cast("bigint").alias(_WORDS),
        F.array().cast("array<bigint>").alias(_SPANS),
        F.array().cast("array<string>").alias(_ITEMS),
    )
    for number in range(blocks):
        # Bounded by block_bytes, as is all that is made of it.
        block = Block([tuple(row) for row in listed.where(share == number).collect()], shingle)
        counts = np.zeros(len(block.distinct), np.int64)
        if len(block.distinct):
            tokens = spark.sparkContext.broadcast(block.distinct)
            bitmap = spark.sparkContext.broadcast(_bitmap(block.distinct))
            found = docs.select("text").mapInArrow(
                _count(tokens, bitmap, block.widths), "token bigint, n bigint"
            )
            for token, n in found.groupBy("token").agg(F.sum("n").alias("n")).collect():
                counts[token] = n
        index = spark.sparkContext.broadcast(block.index(counts))
        # The text goes on to the next block, after the last only if it is asked for.
        last = number == blocks - 1
        kept = [x for x in marked.columns if not last or x != "text" or "text" in names]
        schema = T.StructType([marked.schema[x] for x in kept])
        marked = marked.mapInArrow(_mark(index, block.widths, kept), schema)
    # Starts come first and count negative.
    signed = F.transform(_SPANS, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    hit = F.aggregate(signed, F.lit(0).cast("bigint"), lambda total, x: total + x)
    fields = {"n_words": F.col(_WORDS), "n_hit": hit, "spans": F.col(_SPANS), "item_ids": F.col(_ITEMS)}
    return marked.select(*names, F.struct(*[c.alias(x) for x, c in fields.items()]).alias(HITS))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): what of it stands in ``benchmark``.

    ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``spans`` (start and end
    of the hit stretches in words) and ``item_ids`` (items with an occurring window, as sorted
    strings). A null or wordless text has no words and no hits; an item without text or words
    has no windows; an item of fewer words than ``window`` is one window. Rows with one item_id
    are one item; rows without one hit as others do and are not in ``item_ids``. An empty benchmark hits nothing. ``options``: see ``marked_rows``.
    """
    return marked_rows(docs, benchmark, ["doc_id"], **options).select("doc_id", f"{HITS}.*")


def is_contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """A twentieth of the words, at least one, stand in the benchmark."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text), all columns, that are not contaminated."""
    marked = marked_rows(docs, benchmark, docs.columns)
    bad = is_contaminated(f"{HITS}.n_words", f"{HITS}.n_hit")
    return marked.where(~bad).select(docs.columns)
