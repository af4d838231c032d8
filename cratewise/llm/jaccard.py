"""Links between documents whose shingle sets are alike, by a size-aware heavy-light join.

Documents with one set count once. Of small sets all subsets of the sizes that a link needs
are enumerated: sets that share one are linked, no check needed, and linking each to the
smallest set of that subset reaches all. For the others, inverted lists of rare shingles are
scanned. Where to part is chosen by cost: subsets to write against list entries to read and
the sets that these move. Only sets that share shingles have entries, so the boundary is 0
where few short texts are alike, and above where many are.

A list links its members through a hub, so a group of copies costs its size, not its
square. What a hub leaves open (members in different classes) is settled from the members'
exact overlaps with the hub: they bound the overlap of any two, and only pairs that the bound
allows are compared. No pair that could be linked is left out.

Shingles are 64-bit hashes of their words and sets 64-bit hashes of their shingles. Between
chunks a shingle is told by 48 bits and its bucket, 48 + log2(buckets) bits b in all: two of n
shingles are taken for each other by chance with a probability of about n * n / 2^(b + 1).
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.components import components
from cratewise.llm.tables import partitions
from cratewise.llm.words import (
    SPACED_FOLDED,
    from_six_bytes,
    mixed,
    sequence_hashes,
    six_bytes,
    slices,
    split_words,
)
from cratewise.operators.skew import splittable
from cratewise.session import checkpointed

SHINGLE = 5
# A link: intersection / union of at least 3/4, so 7 * overlap >= 3 * (both sizes).
NEED, OF = 3, 7
SMALL = 12
CHUNK_BYTES = 8 << 20
# Bytes of text split into shingles at once: a byte takes tens of bytes then.
SPLIT_BYTES = 1 << 18
BLOCK_ROWS = 512
# Numbers in a row of a subset; in those of a list entry and of the pair it makes.
SUBSET_COST = 4
ENTRY_COST = 10


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingles of every text; fewer words than ``k`` are one shingle."""
    words = split_words(data, offsets, SPACED_FOLDED)
    hashes = sequence_hashes(words.hashes, k)
    out = []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= k:
            out.append(np.unique(hashes[low : high - k + 1]))
        else:
            out.append(sequence_hashes(words.hashes[low:high], high - low)[: high > low])
    return out


def _set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _describe(small: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, limit=SPLIT_BYTES):
                sets = shingle_sets(data, offsets, shingle)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([_set_id(x) if len(x) else None for x in sets], pa.int64()),
                        pa.array(
                            [x.view(np.int64) if 0 < len(x) <= small else None for x in sets],
                            pa.list_(pa.int64()),
                        ),
                    ],
                    ["doc_id", "n_shingles", "set_id", "tokens"],
                )

    return run


# --- light: subsets of small sets ------------------------------------------------------


def overlap_needed(n: int, m: int) -> int:
    return -(-NEED * (n + m) // OF)


def subset_sizes(n: int, most: int) -> list[int]:
    """Sizes of the overlaps by which a set of ``n`` can be linked to one of 1 to ``most``."""
    needed = {(overlap_needed(n, m), m) for m in range(1, most + 1)}
    return sorted({size for size, m in needed if size <= min(n, m)})


def _subsets(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["size", "subset", "set_id", "n"]
        for batch in batches:
            for one in range(batch.num_rows):
                tokens = np.array(batch.column("tokens")[one].as_py(), np.int64).view(np.uint64)
                set_id = batch.column("set_id")[one].as_py()
                for size in subset_sizes(len(tokens), most):
                    chosen = np.array(list(itertools.combinations(tokens.tolist(), size)), np.uint64)
                    key = np.full(len(chosen), np.uint64(size), np.uint64)
                    for column in range(size):
                        key = mixed(key * np.uint64(31) + chosen[:, column])
                    full = [np.full(len(key), x, np.int64) for x in (size, set_id, len(tokens))]
                    arrays = [full[0], key.view(np.int64), full[1], full[2]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names)

    return run


def light_links(sets: DataFrame, most: int) -> DataFrame:
    """(a, b): links that join all small sets that are linked among each other."""
    small = sets.where(F.col("n") <= most).select("set_id", "tokens")
    rows = small.mapInArrow(
        _subsets(most), "size bigint, subset bigint, set_id bigint, n bigint"
    )
    hubs = (
        rows.groupBy("size", "subset")
        .agg(F.min(F.struct("n", "set_id")).alias("hub"), F.count(F.lit(1)).alias("sets"))
        .where("sets > 1")
    )
    alike = OF * F.col("size") >= NEED * (F.col("n") + F.col("hub.n"))
    return (
        rows.join(hubs, ["size", "subset"])
        .where(alike & (F.col("set_id") != F.col("hub.set_id")))
        .select(F.col("set_id").alias("a"), F.col("hub.set_id").alias("b"))
        .distinct()
    )


# --- heavy: inverted lists --------------------------------------------------------------

# Of a chunk of texts and a bucket of the hash range, every shingle once: its low 48 bits, the
# place of the set that has it plus one, or 0 where several sets of the chunk do, and how many
# these are. One row of each chunk also has its sets, their sizes, and which sets have the
# shingles of several. So a shingle that a third of all sets share is one number per chunk.
_ENTRIES = (
    "bucket int, chunk bigint, keys binary, at binary, several binary, "
    "sets binary, sizes binary, own_keys binary, own_at binary"
)
_SHARED = _ENTRIES.replace("several", "df")
_CANDIDATES = "set_id bigint, n bigint, s bigint, tokens binary, prefix array<bigint>"
_KINDS = [pa.int32(), pa.int64(), *[pa.binary()] * 7]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*rows)) if rows else [[]] * len(_KINDS)
    return [pa.array(x, kind) for x, kind in zip(columns, _KINDS)]


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _entries(buckets: int, shingle: int):
    """Shingles of a chunk of texts, one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        step = np.uint64((1 << 64) // buckets + 1)
        for batch in batches:
            for _, data, offsets in slices(batch, limit=CHUNK_BYTES):
                sets = {_set_id(x): x for x in _bounded(data, offsets, shingle) if len(x)}
                if not sets:
                    continue
                ids, sizes = np.array(list(sets), np.int64), np.array([*map(len, sets.values())])
                every = np.concatenate(list(sets.values()))
                # A chunk has a million shingles and more: arrays of them go when they are read.
                del sets
                owner = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
                order = np.argsort(every, kind="stable")
                every, owner = every[order], owner[order]
                del order
                first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
                count = np.diff(np.r_[first, len(every)]).astype(np.int32)
                keys, at = every[first], np.where(count > 1, 0, owner[first] + 1)
                several = np.repeat(count > 1, count)
                own = [
                    ids.tobytes(), sizes.astype(np.int32).tobytes(),
                    every[several].tobytes(), _places(owner[several]),
                ]
                del every, owner, first, several
                cuts = np.searchsorted(keys, np.arange(buckets, dtype=np.uint64) * step)
                rows = []
                for bucket, (low, high) in enumerate(zip(cuts, [*cuts[1:], len(keys)])):
                    if low < high:
                        counts = count[low:high][count[low:high] > 1].astype(np.uint32)
                        part = [six_bytes(keys[low:high]), _places(at[low:high]), counts.tobytes()]
                        rows.append([bucket, chunk, *part, *[b""] * 4])
                rows[chunk % len(rows)][5:] = own
                chunk += 1
                yield pa.RecordBatch.from_arrays(_columns(rows), _names(_ENTRIES))

    return run


def _places(values: np.ndarray) -> bytes:
    wide = len(values) and int(values.max()) > 65535
    return (b"w" if wide else b"n") + values.astype(np.uint32 if wide else np.uint16).tobytes()


def _from_places(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32 if data[:1] == b"w" else np.uint16, offset=1)


def _bounded(data: np.ndarray, offsets: np.ndarray, shingle: int) -> Iterator[np.ndarray]:
    """Sets of the texts, some at a time, so that the arrays per byte stay small."""
    at, last = 0, len(offsets) - 1
    while at < last:
        to = int(np.searchsorted(offsets, offsets[at] + SPLIT_BYTES, side="right")) - 1
        to = min(max(to, at + 1), last)
        yield from shingle_sets(
            data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], shingle
        )
        at = to


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket, the shingles that two sets or more have, for each chunk that has them.

    Sets of different chunks count one by one, equal ones too.
    """
    lists = [from_six_bytes(x) for x in table.column("keys").to_pylist()]
    places = [_from_places(x) for x in table.column("at").to_pylist()]
    counts = []
    for at, several in zip(places, table.column("several").to_pylist()):
        own = np.ones(len(at), np.uint32)
        own[at == 0] = np.frombuffer(several, np.uint32)
        counts.append(own)
    keys, counts = np.concatenate(lists), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    total = np.minimum(np.add.reduceat(counts[order], first, dtype=np.int64), 65535)
    df = np.empty(len(keys), np.uint16)
    df[order] = np.repeat(total.astype(np.uint16), np.diff(np.r_[first, len(keys)]))
    del keys, counts, order, first, total
    fixed = [table.column(x).to_pylist() for x in ("bucket", "chunk")]
    own = [table.column(x).to_pylist() for x in _names(_SHARED)[5:]]
    out, start = [], 0
    for bucket, chunk, key, at, *rest in zip(*fixed, lists, places, *own):
        total = df[start : start + len(key)]
        start += len(key)
        kept = total > 1
        if kept.any() or rest[0]:
            found = (six_bytes(key[kept]), _places(at[kept]), total[kept].tobytes())
            out.append((bucket, chunk, *found, *rest))
    return pa.table(_columns(out), names=_names(_SHARED))


def _candidates(buckets: int):
    """Of a chunk, the sets that can have a link, with their shared shingles and prefix.

    The prefix is what any linked set must share one shingle of: the rarest shingles, as
    many as a link can lack and one more. Shingles of one set only come first and cannot be
    shared.
    """
    step = (1 << 64) // buckets + 1

    def run(table: pa.Table) -> pa.Table:
        load = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        ids, sizes = load("sets", np.int64), load("sizes", np.int32)
        numbers = table.column("bucket").to_pylist()
        parts = [from_six_bytes(x) for x in table.column("keys").to_pylist()]
        keys = np.concatenate([_tagged(x, b) for b, x in zip(numbers, parts)])
        at = np.concatenate([_from_places(x) for x in table.column("at").to_pylist()])
        df = load("df", np.uint16)
        # Shingles of several sets of the chunk: their sets are known here.
        own = load("own_keys", np.uint64)
        own_at = np.concatenate(
            [np.zeros(0, np.uint16), *[_from_places(x) for x in table.column("own_at").to_pylist() if x]]
        )
        own = _tagged(own & np.uint64((1 << 48) - 1), own // np.uint64(step))
        several = np.flatnonzero(at == 0)
        several = several[np.argsort(keys[several])]
        own_df = df[several][np.searchsorted(keys[several], own)] if len(own) else df[:0]
        single = at > 0
        keys = np.concatenate([keys[single], own])
        place = np.concatenate([at[single].astype(np.int64) - 1, own_at.astype(np.int64)])
        df = np.concatenate([df[single], own_df])
        order = np.lexsort((keys, df, place))
        keys, place = keys[order], place[order]
        cuts = np.searchsorted(place, np.arange(len(ids) + 1))
        rows = []
        for number, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            n, s = int(sizes[number]), high - low
            prefix = s - -(-3 * n // 4) + 1
            if s and prefix > 0:
                tokens = np.sort(keys[low:high]).tobytes()
                rows.append((int(ids[number]), n, s, tokens, keys[low : low + prefix].view(np.int64)))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        columns = list(zip(*rows)) if rows else [[]] * 5
        return pa.table(
            [pa.array(x, t) for x, t in zip(columns, kinds)],
            names=["set_id", "n", "s", "tokens", "prefix"],
        )

    return run


def _tagged(keys: np.ndarray, bucket) -> np.ndarray:
    """48 bits of a shingle and its bucket in one number."""
    return keys | (np.asarray(bucket, np.uint64) << np.uint64(48))


def list_candidates(docs: DataFrame, shingle: int) -> DataFrame:
    """One row per different set that shares enough shingles with others to have a link.

    Chunks are numbered where they are read: ``docs`` must give the same rows in the same
    order when a lost task reads them again, as a stored table does.
    """
    buckets = min(partitions(docs.sparkSession), 1 << 16)
    entries = docs.select("text").mapInArrow(_entries(buckets, shingle), _ENTRIES)
    shared = entries.groupBy("bucket").applyInArrow(_shared, _SHARED)
    found = shared.groupBy("chunk").applyInArrow(_candidates(buckets), _CANDIDATES)
    return checkpointed(found.dropDuplicates(["set_id"]), release=True)


_PAIR = ["a", "b", "a_n", "b_n", "a_s", "b_s"]


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [batch.column(x).to_pylist() for x in ("a_tokens", "b_tokens")]
        found = [
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True))
            for x, y in zip(*sides)
        ]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(x) for x in _PAIR], pa.array(found, pa.int64())], [*_PAIR, "overlap"]
        )


def overlaps(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Every pair (a, b) with sizes, shared shingles and overlap, stored."""
    side = lambda x: found.select(
        F.col("set_id").alias(x),
        *[F.col(y).alias(f"{x}_{y}") for y in ("n", "s", "tokens")],
    )
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    schema = ", ".join(f"{x} bigint" for x in [*_PAIR, "overlap"])
    return checkpointed(both.select(*_PAIR, "a_tokens", "b_tokens").mapInArrow(_overlaps, schema))


_ALIKE = f"{OF} * overlap >= {NEED} * (a_n + b_n)"


def _open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a hub's members, not both linked to it, whose overlap could make a link.

    Rows come sorted by cell. Members at side 0, which are not linked, meet those at side 1.
    """
    for cell in _cells(batches):
        n, o, rest = cell["n"], cell["overlap"], cell["s"] - cell["overlap"]
        own, right = cell["set_id"], np.flatnonzero(cell["side"] == 1)
        left = np.flatnonzero(cell["side"] == 0)
        seen = [np.zeros((0, 2), np.int64)]
        for start in range(0, len(left), 256):
            rows = left[start : start + 256][:, None]
            need = -(-NEED * (n[rows] + n[right]) // OF)
            most = np.minimum(o[rows], o[right]) + np.minimum(rest[rows], rest[right])
            x, y = np.nonzero(most >= need)
            a, b = own[rows[x, 0]], own[right[y]]
            seen.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b])
        pairs = np.unique(np.concatenate(seen), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Rows of consecutive batches, a cell at a time."""
    rest: list[pa.RecordBatch] = []
    for batch in itertools.chain(batches, [None]):
        table = pa.Table.from_batches([*rest, batch] if batch else rest) if rest or batch else None
        if table is None or not table.num_rows:
            continue
        columns = {name: table.column(name).to_numpy() for name in table.column_names}
        new = np.zeros(table.num_rows, bool)
        for name in ("hub", "low", "high"):
            new[1:] |= columns[name][1:] != columns[name][:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), table.num_rows]
        if batch is not None:
            rest = table.slice(cuts[-2]).combine_chunks().to_batches()
            cuts.pop()
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield {name: column[low:high] for name, column in columns.items()}


def open_pairs(stars: DataFrame) -> DataFrame:
    """(a, b): pairs of members that the hubs left open, from the members' overlaps with them.

    Members that are not linked to their hub meet all its members, in cells of BLOCK_ROWS
    rows a side.
    """
    members = stars.select(
        F.col("b").alias("hub"),
        F.col("a").alias("set_id"),
        F.col("a_n").alias("n"),
        F.col("a_s").alias("s"),
        "overlap",
        F.expr(_ALIKE).alias("linked"),
    )
    blocks = lambda rows: F.ceil(rows / BLOCK_ROWS)
    open_hubs = (
        members.groupBy("hub")
        .agg(F.count(F.lit(1)).alias("members"), F.count_if(~F.col("linked")).alias("open"))
        .where("open > 0 and members > 2")
        .select("hub", blocks(F.col("open")).alias("lefts"), blocks(F.col("members")).alias("rights"))
    )
    placed = members.join(splittable(open_hubs), "hub")
    of_block = lambda count: F.pmod(F.xxhash64("set_id"), F.col(count))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["hub", "low", "high", "side", "set_id", "n", "s", "overlap"]
    left = placed.where(~F.col("linked")).withColumns(
        {"low": of_block("lefts"), "high": every("rights"), "side": F.lit(0)}
    )
    right = placed.withColumns(
        {"high": of_block("rights"), "low": every("lefts"), "side": F.lit(1)}
    )
    cells = left.select(columns).unionByName(right.select(columns))
    dealt = cells.repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high")
    return dealt.mapInArrow(_open_pairs, "a bigint, b bigint").distinct()


def heavy_links(found: DataFrame, most: int) -> DataFrame:
    """(a, b): links that join all sets linked over the lists.

    Lists without a set of more than ``most`` shingles are left to the subsets.
    """
    postings = found.select("set_id", "n", "s", F.explode("prefix").alias("token"))
    # A set that shares most of its shingles is the likeliest original of a group.
    first = F.struct((F.col("s") / F.col("n")).alias("share"), -F.col("n"), "set_id")
    hubs = (
        postings.groupBy("token")
        .agg(F.max(first).alias("first"), F.count(F.lit(1)).alias("sets"), F.max("n").alias("n"))
        .where((F.col("sets") > 1) & (F.col("n") > most))
        .select("token", F.col("first.set_id").alias("b"))
    )
    members = postings.select("token", F.col("set_id").alias("a")).join(splittable(hubs), "token")
    stars = overlaps(members.select("a", "b").distinct(), found)
    more = overlaps(open_pairs(stars), found)
    return stars.unionByName(more).where(f"a != b and {_ALIKE}").select("a", "b")


# --- the join ---------------------------------------------------------------------------


def choose_boundary(small: dict[int, tuple[int, int]], small_max: int) -> int:
    """The size up to which sets are enumerated, from {size: (sets, list entries)}.

    Costs are numbers moved. A subset is a row of SUBSET_COST. A list entry is a row of
    ENTRY_COST, and its set meets the hub with the shingles of both.
    """

    def cost(most: int) -> int:
        subsets = sum(
            small.get(n, (0, 0))[0] * math.comb(n, size)
            for n in range(1, most + 1)
            for size in subset_sizes(n, most)
        )
        lists = sum((ENTRY_COST + 2 * n) * entries for n, (_, entries) in small.items() if n > most)
        return SUBSET_COST * subsets + lists

    return min(range(small_max + 1), key=lambda most: (cost(most), most))


def jaccard_classes(docs: DataFrame, shingle: int = SHINGLE, small: int = SMALL) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): size of its set and its class.

    ``component_id`` is the smallest doc_id reachable by links. A text without words, or
    null, has an empty set and is linked with nothing: its class is its own doc_id. Equal
    sets are linked. No rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = checkpointed(
        docs.select("doc_id", "text").mapInArrow(
            _describe(small, shingle),
            f"doc_id {kind}, n_shingles bigint, set_id bigint, tokens array<bigint>",
        )
    )
    sets = checkpointed(
        described.where("set_id is not null")
        .groupBy("set_id")
        .agg(
            F.first("n_shingles").alias("n"),
            F.first("tokens").alias("tokens"),
            F.min("doc_id").alias("doc_id"),
        )
    )
    found = list_candidates(docs, shingle)
    sizes = sets.where(F.col("n") <= small).groupBy("n").agg(F.count(F.lit(1)).alias("sets"))
    entries = found.where(F.col("n") <= small).groupBy("n").agg(F.sum(F.size("prefix")).alias("entries"))
    counted = sizes.join(entries, "n", "left").collect()  # a row per small size
    most = choose_boundary({row["n"]: (row["sets"], row["entries"] or 0) for row in counted}, small)
    classes = components(heavy_links(found, most).unionByName(light_links(sets, most)))
    rooted = sets.select("set_id", "doc_id").join(
        classes.withColumnRenamed("node", "set_id"), "set_id", "left"
    )
    rooted = rooted.withColumn("root", F.coalesce("root", "set_id"))
    # Stored, so that the join below can split a class that holds many sets.
    least = checkpointed(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    named = rooted.join(least, "root").select("set_id", "component_id")
    full = described.select("doc_id", "n_shingles", "set_id")
    linked = full.where("set_id is not null").join(named, "set_id")
    alone = full.where("set_id is null").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id", "set_id")
