"""Phrases whose words stand together more often than their parts foretell.

Texts are cut into chunks of word codes once. Words that occur often enough in their language
get dense ids, by a join of the chunks' own word lists. Then phrases of 2, 3, ... words are
counted, one length after another: every task packs them into counting quotient filters, the
filters of a range of quotients merge into one, and what occurs often enough is kept. A phrase
can only be frequent if both phrases one word shorter in it are; these are told by a bitmap of
fixed size, which may let others pass, whose exact counts then rule them out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cratewise.llm import filters
from cratewise.llm.filters import Packing
from cratewise.llm.tables import partitions
from cratewise.llm.words import slices
from cratewise.session import stored, using

LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
NO_LANGUAGE = "und"

CHUNK_BYTES = 4 << 20
# Entries that a task holds before it sends its filters on; sorting takes several times their bytes.
FILTER_ENTRIES = 1_500_000
# Bytes of merged filters aimed at for a range, at 8 a word. A task reads and sorts one at a time.
RANGE_BYTES = 16 << 20
# How chunks are stored. A reader takes all rows of a row group at once, and a chunk is a row of
# some MB; the lists of a few chunks are put together at a time, then those of others.
CHUNK_SETTINGS = {
    "parquet.block.row.count.limit": "4",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4",
}
ID_BITS = 32
# Bits of a bitmap: some for every frequent phrase, within bounds.
BITS_PER_PHRASE, LEAST_BITS, MOST_BITS = 16, 15, 29
MARK_BITS = 32
# What Spark's aggregate makes of one group.
BITMAP_PART = 1 << 15

_WORD, _BLANK, _BREAK = 0, 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x09]] = _BLANK
_KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = _FOLD[97:123]

_ENTRY = ("n_words", "wide", "body", "known")
_CHUNK = "words array<struct<lang: string, word: string, n: bigint>>, wide boolean, body binary"
_BLOCK = f"range bigint, {filters.COLUMNS}"


def _codes(wide: bool) -> type:
    return np.uint32 if wide else np.uint16


def _body(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Codes from 1, with a 0 before every word that starts a piece."""
    out = np.zeros(len(codes) + int(breaks.sum()), np.int64)
    out[np.arange(len(codes)) + np.cumsum(breaks)] = codes + 1
    return out


def cut(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
    """Distinct (language, word) of some texts with their counts, and the texts in codes."""
    kinds = _KINDS[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kinds == _WORD
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    n = len(starts)
    joined = _FOLD[data[inside[1:-1]]]
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeStringArray.from_buffers(n, pa.py_buffer(bounds), pa.py_buffer(joined))
    words = words.dictionary_encode()
    langs = batch.column("lang").fill_null(NO_LANGUAGE).dictionary_encode()
    del inside, edge, joined, bounds
    text_of = np.searchsorted(offsets, starts, side="right") - 1
    both = langs.indices.to_numpy()[text_of].astype(np.int64)
    both = both * max(len(words.dictionary), 1) + words.indices.to_numpy()
    words = words.dictionary
    distinct, codes, counts = np.unique(both, return_inverse=True, return_counts=True)
    del both
    broken = np.zeros(len(kinds) + 1, np.int32)
    np.cumsum(kinds == _BREAK, dtype=np.int32, out=broken[1:])
    breaks = np.ones(n, bool)
    breaks[1:] = (broken[starts[1:]] > broken[ends[:-1]]) | (text_of[1:] != text_of[:-1])
    lang, word = np.divmod(distinct, max(len(words), 1))
    listed = pa.StructArray.from_arrays(
        [
            langs.dictionary.take(pa.array(lang)).cast(pa.string()),
            words.take(pa.array(word)).cast(pa.string()),
            pa.array(counts.astype(np.int64)),
        ],
        names=["lang", "word", "n"],
    )
    return listed, _body(codes, breaks)


def _cut(chunk_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, limit=chunk_bytes):
                listed, body = cut(part, data, offsets)
                wide = len(listed) >= 1 << 16
                one = pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed)
                yield pa.RecordBatch.from_arrays(
                    [one, pa.array([wide]), pa.array([body.astype(_codes(wide)).tobytes()])],
                    names=["words", "wide", "body"],
                )

    return run


def _frequent_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in codes of their frequent words; other words are breaks. Lone words go."""
    for batch in batches:
        for i in range(batch.num_rows):
            n_words, wide, body, known = (batch.column(x)[i] for x in _ENTRY)
            body = np.frombuffer(body.as_buffer(), _codes(wide.as_py()))
            known = np.sort(known.values.to_numpy(zero_copy_only=False))
            code = np.zeros(n_words.as_py() + 1, np.int64)
            code[(known >> ID_BITS) + 1] = np.arange(1, len(known) + 1)
            ids = known & ((1 << ID_BITS) - 1)
            body = code[body]
            # Words with a neighbour, and the first break after each run of them.
            word = np.concatenate([[False], body != 0, [False]])
            keep = word[1:-1] & (word[:-2] | word[2:])
            before = np.concatenate([[False], keep[:-1]])
            body = np.where(keep, body, 0)[keep | before]
            wide = len(known) >= 1 << 16
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids)),
                    pa.array([wide]),
                    pa.array([body.astype(_codes(wide)).tobytes()]),
                ],
                names=["ids", "wide", "body"],
            )


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with dense ids from 0, in the order of its stored parts."""
    spark = words.sparkSession
    low = (1 << 33) - 1
    marked = stored(words.withColumn("mark", F.monotonically_increasing_id()))
    part = F.shiftright("mark", 33)
    sizes = marked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    firsts, first = [], 0
    for row in sorted(sizes):
        firsts.append((row["part"], first))
        first += row["n"]
    # A row per task that wrote a part.
    table = F.broadcast(spark.createDataFrame(firsts, "part bigint, first bigint"))
    ids = (F.col("first") + F.col("mark").bitwiseAND(F.lit(low))).alias("id")
    return stored(marked.withColumn("part", part).join(table, "part").select("lang", "word", "n", ids))


def _positions(ids: np.ndarray, body: np.ndarray, n: int, bits: int, bitmaps: dict) -> np.ndarray:
    """Where phrases of ``n`` words begin whose shorter phrases may all be frequent."""
    known = body != 0
    at = np.flatnonzero(known[:-1] & known[1:]) if len(body) > 1 else np.zeros(0, np.int64)
    for size in range(2, n):
        packing = Packing(size, bits)
        first = packing.keys([ids[body[at + i] - 1] for i in range(size)])[0]
        bitmap, bitmap_bits = bitmaps[size]
        place = packing.top(first, bitmap_bits).astype(np.int64)
        at = at[(bitmap[place >> 3] >> (place & 7)) & 1 == 1]
        at = at[:-1][np.diff(at) == 1] if len(at) else at
    return at


def _count(n: int, bits: int, range_bits: int, entries: int, bitmaps) -> Callable:
    """Filters of the phrases of ``n`` words in some chunks, a row per range."""
    packing = Packing(n, bits)

    def rows(limbs: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ranges = limbs[0] >> np.uint64(packing.widths[0] - range_bits)
        bounds = np.flatnonzero(np.diff(ranges, prepend=ranges[:1] + np.uint64(1))).tolist()
        firsts = ranges[bounds].tolist()
        del ranges
        names = [x.split()[0] for x in _BLOCK.split(", ")]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
        parts = list(zip(firsts, bounds, [*bounds[1:], len(counts)]))
        for at in range(0, len(parts), 64):
            out = []
            for first, a, z in parts[at : at + 64]:
                part = filters.write(packing, [x[a:z] for x in limbs], counts[a:z], range_bits)
                out.append((first, *part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names=names
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limbs, counts, held = [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                ids, wide, body = (batch.column(x)[i] for x in ("ids", "wide", "body"))
                body = np.frombuffer(body.as_buffer(), _codes(wide.as_py())).astype(np.int64)
                ids = ids.values.to_numpy(zero_copy_only=False)
                at = _positions(ids, body, n, bits, bitmaps.value)
                if not len(at):
                    continue
                keys = packing.keys([ids[body[at + k] - 1] for k in range(n)])
                keys, sums = filters.combined(keys, np.ones(len(at), np.int64))
                limbs.append(keys)
                counts.append(sums)
                held += len(sums)
                if held > entries:
                    keys, sums = _merged(limbs, counts)
                    held = len(sums)
                    if held > entries // 2:
                        yield from rows(keys, sums)
                        held = 0
                    else:
                        limbs.append(keys)
                        counts.append(sums)
                    del keys, sums
        if limbs:
            yield from rows(*_merged(limbs, counts))

    return run


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Arrays of all parts one after another; ``parts`` is emptied, to hold none twice."""
    whole = [np.concatenate(x) for x in zip(*parts)]
    parts.clear()
    return whole


def _merged(limbs: list[list[np.ndarray]], counts: list[np.ndarray]):
    sums = np.concatenate(counts)
    counts.clear()
    return filters.combined(_joined(limbs), sums)


def _merge(packing: Packing, range_bits: int, least: int) -> Callable:
    """Of the filters of a range: phrases that occur often enough."""

    def run(table: pa.Table) -> pa.Table:
        limbs, counts = [], []
        for batch in table.to_batches():
            range_no, bits, *binary = batch.columns
            for i in range(batch.num_rows):
                # Read where they lie, not copied.
                row = bits[i].as_py(), *[memoryview(x[i].as_buffer()) for x in binary]
                keys, sums = filters.read(packing, row, range_no[i].as_py(), range_bits)
                limbs.append(keys)
                counts.append(sums)
        limbs, counts = _merged(limbs, counts)
        often = counts >= least
        limbs = [x[often] for x in limbs]
        ids = np.stack(packing.ids(limbs), axis=1).ravel()
        offsets = np.arange(int(often.sum()) + 1, dtype=np.int32) * packing.n
        return pa.table(
            {
                "words": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                "f": counts[often],
                "mark": packing.top(limbs[0], MARK_BITS).astype(np.int64),
            }
        )

    return run


def _bitmap(phrases: DataFrame, packing: Packing) -> tuple[np.ndarray, int]:
    """Quotients of frequent phrases as bits, 2 to the MOST_BITS of them at most."""
    wanted = math.ceil(math.log2(max(2, phrases.count() * BITS_PER_PHRASE)))
    bits = min(max(wanted, LEAST_BITS), MOST_BITS, packing.widths[0])
    marks = min(MARK_BITS, packing.widths[0])
    place = F.shiftright("mark", marks - bits)
    part = BITMAP_PART
    rows = phrases.groupBy(F.floor(place / part).alias("part")).agg(
        F.bitmap_construct_agg(F.pmod(place, F.lit(part))).alias("bits")
    )
    out = np.zeros(max(1 << bits, part) // 8, np.uint8)
    for row in rows.collect():
        data = np.frombuffer(row["bits"], np.uint8)
        out[row["part"] * part // 8 :][: len(data)] = data
    return out, bits


def frequent_phrases(
    docs: DataFrame,
    least: int = LEAST_COUNT,
    longest: int = LONGEST,
    chunk_bytes: int = CHUNK_BYTES,
    entries: int = FILTER_ENTRIES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: frequent words (id, lang, word, n), languages (lang, total), and frequent
    phrases of one word and more (words: array of ids, f)."""
    spark = docs.sparkSession
    texts = docs.select("lang", "text").mapInArrow(_cut(chunk_bytes), _CHUNK)
    with using(spark, CHUNK_SETTINGS):
        chunks = stored(texts.withColumn("chunk", F.monotonically_increasing_id()))
    listed = chunks.select("chunk", F.posexplode("words").alias("code", "entry")).select(
        "chunk", "code", "entry.*"
    )
    totals = stored(listed.groupBy("lang").agg(F.sum("n").alias("total")))
    counts = listed.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    words = _numbered(counts)
    n_words = words.count()
    phrases = words.select(F.array("id").alias("words"), F.col("n").alias("f"))
    if not n_words:
        return words, totals, phrases
    bits = max(1, (n_words - 1).bit_length())
    # One row per entry of a chunk, whether its word is frequent or not: words have one row each.
    # A chunk's list is bounded by its bytes; entries without an id are left out of it.
    # Code and id share a number, which takes a quarter of what a struct of both does.
    entry = F.shiftleft(F.col("code").cast("bigint"), ID_BITS).bitwiseOR(F.col("id"))
    known = (
        listed.select("chunk", "code", "lang", "word")
        .join(words.drop("n"), ["lang", "word"], "left")
        .groupBy("chunk")
        .agg(F.collect_list(entry).alias("known"))
        .where(F.size("known") > 0)
    )
    bodies = chunks.select("chunk", F.size("words").alias("n_words"), "wide", "body")
    with using(spark, CHUNK_SETTINGS):
        encoded = stored(
            bodies.join(known, "chunk")
            .drop("chunk")
            .mapInArrow(_frequent_only, "ids array<bigint>, wide boolean, body binary")
        )
    total = totals.agg(F.sum("total")).first()[0]
    ranges = max(partitions(spark), 8 * total // RANGE_BYTES, 1)
    bitmaps = {}
    for n in range(2, longest + 1):
        packing = Packing(n, bits)
        range_bits = min(max(0, (ranges - 1).bit_length()), packing.widths[0])
        sent = encoded.mapInArrow(
            _count(n, bits, range_bits, entries, spark.sparkContext.broadcast(dict(bitmaps))), _BLOCK
        )
        found = stored(
            sent.groupBy("range").applyInArrow(
                _merge(packing, range_bits, least), "words array<bigint>, f bigint, mark bigint"
            )
        )
        if found.isEmpty():
            break
        phrases = phrases.unionByName(found.drop("mark"))
        if n < longest:
            bitmaps[n] = _bitmap(found, packing)
    return words, totals, phrases


def _score() -> str:
    wide = lambda x: f"cast({x} as decimal(20, 0))"
    return f"cast(1000 * {wide('a')} * {wide('total')} div ({wide('l')} * {wide('r')}) as bigint)"


def collocations(
    docs: DataFrame,
    least: int = LEAST_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    chunk_bytes: int = CHUNK_BYTES,
    entries: int = FILTER_ENTRIES,
) -> DataFrame:
    """The ``top`` phrases of each language of ``docs`` (lang, text) by how they hold together.

    A phrase of 2 to ``longest`` words that occurs ``a`` >= ``least`` times is cut where
    floor(1000 * a * n / (l * r)) is least, ``l`` and ``r`` being the occurrences of both sides
    and ``n`` the words of the language; of equal cuts the first counts. Phrases that a longer
    one as frequent holds are dropped. Returns lang, rank, phrase, a, l, r, n, score. A null
    text is empty, a null language is ``und``; repeated rows count each; no rows give none.
    All counts are exact.
    """
    words, totals, found = frequent_phrases(docs, least, longest, chunk_bytes, entries)
    phrases = found.where(F.size("words") > 1).withColumnRenamed("f", "a")
    # Phrases within longer ones, with the highest count of one that holds them.
    size = F.size("words")
    inner = phrases.where(size > 2).withColumn("part", F.explode(F.sequence(F.lit(2), size - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), size - F.col("part") + 1)))
    inner = inner.groupBy(F.slice("words", F.col("at"), F.col("part")).alias("words"))
    inner = stored(inner.agg(F.max("a").alias("within")))
    kept = phrases.join(inner, "words", "left").where("within is null or within < a").drop("within")
    langs = words.select(F.col("id").alias("first_id"), "lang").join(totals, "lang")
    kept = kept.withColumn("first_id", F.element_at("words", 1)).join(stored(langs), "first_id")
    cuts = kept.drop("first_id").withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumn("left", F.slice("words", F.lit(1), F.col("k")))
    cuts = cuts.withColumn("right", F.slice("words", F.col("k") + 1, size))
    for side, name in (("left", "l"), ("right", "r")):
        counted = found.select(F.col("words").alias(side), F.col("f").alias(name))
        cuts = cuts.join(counted, side)
    scored = cuts.withColumn("score", F.expr(_score()))
    best = scored.groupBy("words").agg(
        *[F.first(x).alias(x) for x in ("lang", "a", "total")],
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    )
    best = best.select("words", "lang", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
    order = [F.desc("score"), F.desc("a")]
    of_lang = Window.partitionBy("lang").orderBy(*order)
    # All that can be among the first, before words are spelled.
    first = best.withColumn("rank", F.rank().over(of_lang)).where(F.col("rank") <= top).drop("rank")
    first = stored(first)
    spelled = first.select("words", F.posexplode("words").alias("place", "id"))
    spelled = spelled.join(words.select("id", "word"), "id").groupBy("words")
    spelled = spelled.agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("spelled"))
    phrase = F.array_join(F.col("spelled.word"), " ").alias("phrase")
    named = first.join(spelled.select("words", phrase), "words")
    ranked = named.withColumn("rank", F.row_number().over(of_lang.orderBy(*order, "phrase")))
    ranked = ranked.where(F.col("rank") <= top)
    numbers = [F.col(x).cast("bigint").alias(x) for x in ("a", "l", "r", "n", "score")]
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", *numbers)
