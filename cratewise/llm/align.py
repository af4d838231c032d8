"""Two tokenizers aligned over a corpus, each distinct text tokenised once.

Rows are shuffled by their full text, so copies meet and are counted; each distinct text is
tokenised by both tokenizers and aligned, counts of id pairs weigh it by its copies, and its
measures are joined back to the rows.

Texts of a slice share the work on equal cells. A cell ends where a blank stands between two
characters that are no white space. The byte-level tokenizer starts a new pre-token at such a
blank, and no entry of the other holds a blank after another character (checked when it is
loaded), so no token of either crosses the cut: both encode a text cell by cell as they
encode it whole, and many cells joined by blanks as one by one.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cratewise.llm.words import slices
from cratewise.session import stored

TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

SLICE_BYTES = 3 << 20
# Pairs of texts that are looked up at a time.
SLICE_PAIRS = 1 << 19
# Cells up to this length are encoded many at a time.
SHORT_CELL = 256
JOINED_CELLS = 1000
# Links of a group up to which they are listed one by one before they are summed up.
LISTED_LINKS = 10_000
# Id pairs that are broadcast, 17 bytes each; the others meet the texts in a join.
BROADCAST_PAIRS = 2_000_000

MEASURES = ["n_a", "n_b", "n_groups", "n_links"]

# How the byte-level tokenizer cuts a text into pre-tokens.
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Entries of the second tokenizer write a blank so; in a text it is taken for one.
_MARK = "\u2581"

# Ids of some cells, and how many of them each cell has.
Tokens = tuple[np.ndarray, np.ndarray]


def _byte_of_character() -> dict[str, int]:
    """The byte-level code: printable bytes stand for themselves, others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Spelling:
    """The bytes that each id stands for."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.lengths = np.array([len(x) for x in entries])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.data[at + np.arange(len(at))]


class Tokenizers:
    """Both tokenizers, and the bytes each of their ids stands for."""

    def __init__(self, folder: str, byte_level: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/{byte_level}")
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=f"{folder}/{pieces}")
        told = json.loads(self.a.to_str())
        code = _byte_of_character()
        special = {x["content"] for x in told["added_tokens"] if x["special"]}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.of_a = _Spelling(
            [x.encode() if x in special else bytes(code[c] for c in x) for x in names]
        )
        ids = range(self.b.get_piece_size())
        names = [self.b.id_to_piece(i) for i in ids]
        one = lambda i: bytes([int(names[i][3:-1], 16)])
        self.of_b = _Spelling(
            [one(i) if self.b.is_byte(i) else names[i].replace(_MARK, " ").encode() for i in ids]
        )
        self.size_a, self.size_b = len(self.of_a.entries), len(names)
        # Only then do cells encode as the whole text does.
        crossing = any(re.search(f"[^{_MARK}]{_MARK}", x) for x in names)
        self.by_cells = not crossing and self.b.encode("a", out_type=str)[0].startswith(_MARK)
        self.short = self._by_ranks(told, special)

    def _by_ranks(self, told: dict, special: set[str]) -> Callable[[str], list[int]]:
        """The first tokenizer's quicker form, if its merges stand in the order of their ids.

        It is for texts without long runs of white space.
        """
        from tiktoken import Encoding

        model, split = told["model"], told["pre_tokenizer"]
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        first = min((model["vocab"]["".join(x)] for x in merges), default=0)
        in_order = all(model["vocab"]["".join(x)] == first + i for i, x in enumerate(merges))
        plain = split == split | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if not (in_order and plain and told["normalizer"] is None and model["type"] == "BPE"):
            return lambda text: self.a.encode(text, add_special_tokens=False).ids
        entries = enumerate(self.of_a.entries)
        known = {x for x in range(self.size_a) if self.a.id_to_token(x) not in special}
        ranks = {x: i for i, x in entries if i in known}
        form = Encoding("a", pat_str=_PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        return form.encode_ordinary

    def one(self, text: str) -> list[Tokens]:
        """Ids of both tokenizers for a blank and a text, none if one does not spell it back."""
        a = np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.int64)
        b = np.array(self.b.encode(text), np.int64)
        whole = (" " + text).encode()
        if self.of_a.of(a).tobytes() != whole or self.of_b.of(b).tobytes() != whole:
            a, b = a[:0], b[:0]
        return [(x, np.array([len(x)])) for x in (a, b)]

    def joined(self, cells: list[str]) -> list[Tokens] | None:
        """The same for several short cells as one text; None if that does not spell them."""
        text = " " + " ".join(cells)
        whole = np.frombuffer(text.encode(), np.uint8)
        # A blank before each cell, and none in it.
        bounds = np.append(np.flatnonzero(whole == 0x20)[1:], len(whole))
        if len(bounds) != len(cells):
            return None
        found = []
        for ids, spelling in ((self.short(text), self.of_a), (self.b.encode(text[1:]), self.of_b)):
            ids = np.array(ids, np.int64)
            ends = np.cumsum(spelling.lengths[ids])
            if ends[-1] != len(whole) or not np.array_equal(spelling.of(ids), whole):
                return None
            upto = np.searchsorted(ends, bounds) + 1
            if not np.array_equal(ends[upto - 1], bounds):
                return None
            found.append((ids, np.diff(upto, prepend=0)))
        return found

    def encode(self, cells: list[str]) -> tuple[np.ndarray, list[Tokens]]:
        """Both tokenizers' ids of all cells and how many each cell has, and in which order."""
        alone, alike = [], []
        for i, x in enumerate(cells):
            plain = " " not in x and _MARK not in x and x == x.strip().strip("\u180e")
            (alike if 0 < len(x) <= SHORT_CELL and plain and self.by_cells else alone).append(i)
        order, found = [], []
        for at in range(0, len(alike), JOINED_CELLS):
            part = alike[at : at + JOINED_CELLS]
            tokens = self.joined([cells[i] for i in part])
            if tokens is None:
                alone += part
            else:
                order += part
                found.append(tokens)
        found += [self.one(cells[i]) for i in alone]
        sides = [tuple(np.concatenate(x) for x in zip(*side)) for side in zip(*found)]
        return np.array(order + alone), sides


@lru_cache(maxsize=2)
def tokenizers(folder: str, byte_level: str, pieces: str) -> Tokenizers:
    return Tokenizers(folder, byte_level, pieces)


def _white(lead: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Whether three bytes begin with a character of several bytes that is white space or a
    mark of the second tokenizer, or may be: rather too many than too few."""
    of_two = (lead == 0xC2) & np.isin(second, (0x85, 0xA0))
    of_three = np.isin(lead, (0xE1, 0xE2, 0xE3)) & np.isin(second, (0x9A, 0xA0, 0x80, 0x81, 0x96))
    return of_two | (of_three & (np.isin(third, (0xA8, 0xA9, 0xAF, 0x9F)) | (third <= 0x8E)))


def cut_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Blanks of texts that end a cell."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    at = np.flatnonzero(data == 0x20)
    at = at[~edge[at] & ~edge[at + 1]]
    wide = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)])
    near = lambda i: wide[at + 3 + i]
    plain = lambda x: (x > 0x20) | (x < 9) | ((x > 13) & (x < 0x1C))
    good = plain(near(-1)) & plain(near(1)) & ~_white(near(1), near(2), near(3))
    good &= ~_white(near(-3), near(-2), near(-1))
    good &= ~((near(-2) == 0xC2) & np.isin(near(-1), (0x85, 0xA0)))
    return at[good]


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _told(ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers in decimal, each followed by its mark; and where each ends."""
    digits = np.ones(len(ids), np.int64)
    for power in range(1, 10):
        digits += ids >= 10**power
    ends = np.cumsum(digits + 1)
    out = np.zeros(ends[-1] if len(ids) else 0, np.uint8)
    out[ends - 1] = marks
    for place in range(digits.max(initial=0)):
        has = digits > place
        out[ends[has] - 2 - place] = 48 + ids[has] // 10**place % 10
    return out.tobytes(), ends


class Aligned:
    """Groups of distinct cells, and per cell, in ``order``, what a text adds up from them."""

    def __init__(self, found: Tokenizers, cells: list[str]):
        self.order, ((a, n_a), (b, n_b)) = found.encode(cells)
        ends_a, ends_b = np.cumsum(found.of_a.lengths[a]), np.cumsum(found.of_b.lengths[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        each_a = np.bincount(of_a, minlength=len(common))
        each_b = np.bincount(of_b, minlength=len(common))
        # Every cell ends a group.
        upto = np.concatenate([[0], ends_a])[np.cumsum(n_a)]
        n_groups = np.diff(np.searchsorted(common, upto, side="right"), prepend=0)
        cell_of = np.repeat(np.arange(len(cells)), n_groups)
        links = each_a * each_b
        n_links = np.bincount(cell_of, links, len(cells)).astype(np.int64)
        self.spelled = n_a > 0
        self.measures = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        self.groups = self._as_text(a, b, of_a, of_b, each_a, each_b, n_groups)
        self._list_pairs(found.size_b, a, b, each_a, each_b, cell_of, len(cells))

    @staticmethod
    def _as_text(a, b, of_a, of_b, each_a, each_b, n_groups) -> list[bytes]:
        """The groups of every cell."""
        group = np.concatenate([of_a, of_b])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        marks = np.full(len(order), ord(","), np.uint8)
        last = np.cumsum(each_a + each_b) - 1
        marks[last] = ord(";")
        marks[last - each_b] = ord("|")
        data, ends = _told(np.concatenate([a, b])[order], marks)
        upto = np.concatenate([[0], ends[last]])[np.concatenate([[0], np.cumsum(n_groups)])]
        return [data[x : max(x, y - 1)] for x, y in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def _list_pairs(self, size_b, a, b, each_a, each_b, cell_of, n_cells) -> None:
        """Pairs of every cell as a * size_b + b, and how many links each stands for."""
        first_a, first_b = np.cumsum(each_a) - each_a, np.cumsum(each_b) - each_b
        listed = np.where(each_a * each_b <= LISTED_LINKS, each_a * each_b, 0)
        group = np.repeat(np.arange(len(listed)), listed)
        place = np.arange(len(group)) - np.repeat(np.cumsum(listed) - listed, listed)
        row, column = np.divmod(place, each_b[group])
        pairs = [a[first_a[group] + row] * size_b + b[first_b[group] + column]]
        links, cells = [np.ones(len(group), np.int64)], [cell_of[group]]
        for g in np.flatnonzero(each_a * each_b > LISTED_LINKS):
            ids_a, times_a = np.unique(a[first_a[g] :][: each_a[g]], return_counts=True)
            ids_b, times_b = np.unique(b[first_b[g] :][: each_b[g]], return_counts=True)
            pairs.append(np.add.outer(ids_a * size_b, ids_b).ravel())
            links.append(np.multiply.outer(times_a, times_b).ravel())
            cells.append(np.full(len(pairs[-1]), cell_of[g]))
        cells = np.concatenate(cells)
        order = np.argsort(cells, kind="stable")
        self.pairs, self.links = np.concatenate(pairs)[order], np.concatenate(links)[order]
        self.n_pairs = np.bincount(cells, minlength=n_cells)
        self.first_pair = np.cumsum(self.n_pairs) - self.n_pairs


def align_texts(found: Tokenizers, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """Measures, digest of the groups, distinct pairs and their links, for texts not empty."""
    cuts = cut_places(data, offsets) if found.by_cells else np.zeros(0, np.int64)
    starts = np.sort(np.concatenate([offsets[:-1], cuts + 1]))
    ends = np.sort(np.concatenate([offsets[1:], cuts]))
    kept = np.ones(len(data), bool)
    kept[cuts] = False
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    cells = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[kept]))
    ).dictionary_encode()
    known = Aligned(found, cells.dictionary.to_pylist())
    place_of = np.empty(len(known.order), np.int64)
    place_of[known.order] = np.arange(len(known.order))
    numbers = place_of[cells.indices.to_numpy()]
    firsts = np.searchsorted(starts, offsets[:-1])
    sizes = np.diff(np.append(firsts, len(starts)))
    n, top = len(sizes), found.size_a * found.size_b
    spelled = np.logical_and.reduceat(known.spelled[numbers], firsts)
    sums = np.add.reduceat(known.measures[numbers], firsts, axis=0)
    listed = numbers.tolist()
    digests = [
        hashlib.sha256(b";".join(map(known.groups.__getitem__, listed[a : a + m]))).hexdigest() if ok else ""
        for a, m, ok in zip(firsts.tolist(), sizes.tolist(), spelled)
    ]
    # All pairs of all cells of a text, summed up by pair.
    text_of = np.repeat(np.arange(n), sizes)
    lengths = np.where(spelled[text_of], known.n_pairs[numbers], 0)
    place = np.repeat(known.first_pair[numbers] - np.cumsum(lengths) + lengths, lengths)
    place += np.arange(len(place))
    keys = np.repeat(text_of, lengths) * top + known.pairs[place]
    order = np.argsort(keys)
    keys, links = keys[order], known.links[place][order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    links = np.add.reduceat(links, first) if len(first) else links
    of_text, pairs = np.divmod(keys[first], top)
    counts = np.bincount(of_text, minlength=n)
    kind = np.int32 if top <= 1 << 31 else np.int64
    return [
        *[pa.array(np.where(spelled, sums[:, i], 0)) for i in range(4)],
        pa.array(digests, pa.string()),
        _lists(counts, pairs.astype(kind)),
        _lists(counts, links),
    ]


def _aligned(paths: tuple[str, str, str]) -> Callable:
    """Distinct texts (text, digest, copies) with their measures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tokenizers(*paths)
        for batch in batches:
            for part, data, offsets in slices(batch, limit=SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("digest"),
                        part.column("copies"),
                        *align_texts(found, data, offsets),
                    ],
                    names=["digest", "copies", *MEASURES, "groups_sha256", "pairs", "links"],
                )

    return run


def _few_pairs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about SLICE_PAIRS pairs at most, or one row beyond it."""
    ends = batch.column("pairs").offsets.to_numpy()
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, ends[at] + SLICE_PAIRS, side="right")) - 1
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


def _weighed(known) -> Callable:
    """Measures with n_best and count_sum over the broadcast pairs, and the links beyond."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, held, best = known.value
        for batch in (part for whole in batches for part in _few_pairs(whole)):
            lists, links = batch.column("pairs"), batch.column("links").flatten().to_numpy()
            mine = lists.flatten().to_numpy().astype(np.int64)
            # The last of the pairs is larger than any other.
            at = np.searchsorted(pairs, mine)
            hit = pairs[at] == mine
            counts = np.diff(lists.offsets.to_numpy())
            text_of = np.repeat(np.arange(batch.num_rows), counts)

            def per_text(values):
                upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                ends = np.cumsum(counts)
                return upto[ends] - upto[ends - counts]

            n_best = per_text(np.where(hit & best[at], links, 0))
            total = per_text(np.where(hit, links * held[at], 0))
            rest = np.bincount(text_of[~hit], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(x) for x in ["digest", *MEASURES, "groups_sha256"]],
                    pa.array(n_best),
                    pa.array(total),
                    _lists(rest, mine[~hit]),
                    _lists(rest, links[~hit]),
                ],
                names=["digest", *MEASURES, "groups_sha256", "n_best", "count_sum", "pairs", "links"],
            )

    return run


def pair_counts(texts: DataFrame, size_b: int) -> DataFrame:
    """(pair, held, best): how many documents hold each id pair, and whether no pair of its
    id of the first tokenizer is held by more; ``texts`` has distinct texts with copies."""
    counts = texts.select("copies", F.explode("pairs").alias("pair")).groupBy("pair")
    counts = counts.agg(F.sum("copies").alias("held"))
    # A partition has at most as many rows as the second tokenizer has ids.
    of_a = Window.partitionBy(F.floor(F.col("pair") / size_b))
    return counts.withColumn("best", F.col("held") == F.max("held").over(of_a))


def aligned(
    docs: DataFrame,
    folder: str = TOKENIZERS,
    byte_level: str = BYTE_LEVEL,
    pieces: str = PIECES,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): how both tokenizers' tokens align.

    ``n_a``, ``n_b`` tokens; ``n_groups`` byte ranges between offsets where both end a token;
    ``n_links`` pairs of occurrences that share a group. A pair of ids counts the rows that
    hold it linked: ``count_sum`` is the sum over links, ``n_best`` the links whose count is
    the highest of their first id. ``groups_sha256`` is the digest of all groups. A text that
    is null or empty, or that a tokenizer does not spell back, has zeros and an empty digest.
    Rows of one doc_id are rows of their own; no rows give no rows. ``folder`` must be
    readable by the driver and all executors.

    The most frequent pairs, ``broadcast_pairs`` at most, are broadcast; links of other pairs
    meet their counts in a join.
    """
    spark = docs.sparkSession
    paths = (folder, byte_level, pieces)
    vocabularies = tokenizers(*paths)
    top = vocabularies.size_a * vocabularies.size_b
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    pair_kind = "int" if top <= 1 << 31 else "bigint"
    measures = ", ".join(f"{x} bigint" for x in MEASURES)

    # Copies meet by their full text and are combined before the shuffle.
    distinct = docs.where("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = stored(
        distinct.select("text", digest.alias("digest"), "copies").mapInArrow(
            _aligned(paths),
            f"digest binary, copies bigint, {measures}, groups_sha256 string, "
            f"pairs array<{pair_kind}>, links array<bigint>",
        )
    )
    counts = stored(pair_counts(texts, vocabularies.size_b))
    # Pairs by powers of two of their counts: as many powers from above as fit.
    power = F.floor(F.log2(F.col("held").cast("double"))).cast("int")
    tally = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, n = 64, 0
    for row in sorted(tally, key=lambda x: -x["power"]):
        if n + row["n"] > broadcast_pairs:
            break
        least, n = row["power"], n + row["n"]
    frequent = counts.where(power >= least).sort("pair").toArrow()
    beyond = [(np.int64, np.iinfo(np.int64).max), (np.int64, 0), (bool, False)]
    known = spark.sparkContext.broadcast(
        tuple(
            np.append(frequent.column(name).to_numpy().astype(kind), [last]).astype(kind)
            for name, (kind, last) in zip(["pair", "held", "best"], beyond)
        )
    )
    weighed = texts.mapInArrow(
        _weighed(known),
        f"digest binary, {measures}, groups_sha256 string, n_best bigint, count_sum bigint, "
        "pairs array<bigint>, links array<bigint>",
    )
    weighed = stored(weighed)
    if n < sum(row["n"] for row in tally):
        rest = weighed.select(
            "digest", F.explode(F.arrays_zip("pairs", "links")).alias("link")
        ).select("digest", F.col("link.pairs").alias("pair"), F.col("link.links").alias("links"))
        rare = rest.join(counts.where(power < least), "pair").groupBy("digest")
        rare = rare.agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
            F.sum(F.col("links") * F.col("held")).alias("more_sum"),
        )
        more = weighed.join(rare, "digest", "left")
        for name, plus in (("n_best", "more_best"), ("count_sum", "more_sum")):
            more = more.withColumn(name, F.col(name) + F.coalesce(plus, F.lit(0)))
        weighed = stored(more)
    figures = [*MEASURES, "n_best", "count_sum"]
    measured = weighed.select("digest", *figures, "groups_sha256")
    # Rows without text are spread by a stand-in that meets nothing.
    alone = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")).cast("binary")
    rows = docs.select("doc_id", F.when(F.col("text") != "", digest).otherwise(alone).alias("digest"))
    joined = rows.join(measured, "digest", "left")
    return joined.select(
        "doc_id",
        *[F.coalesce(x, F.lit(0)).cast("bigint").alias(x) for x in figures],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
