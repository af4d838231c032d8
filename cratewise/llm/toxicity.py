"""Toxicity of whole texts by a convolutional classifier trained in numpy.

A word's embedding is the sum of the hashed embeddings of the word and of its beginnings (4
and 6 bytes), so inflected and unseen forms count. Filters of several widths run over all
words of a text, each is pooled by its maximum, and a logistic layer weighs the maxima: one
insult in a very long text is seen as well as in a short one.

All labelled rows teach. A few are learned on the driver; many are counted, learned and used for
thresholds by Spark tasks in rounds, whose states are averaged. Scoring is one pass over all
documents without a shuffle, where the filters' products with the embeddings are looked up in
one table. Thresholds are calibrated by language: a small word model guesses the language
from the text itself, and scores are shifted so that the best threshold of that language
falls on ``THRESHOLD``.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.llm.tables import thinned
from cratewise.llm.words import ALNUM_FOLDED, Words, buffers, mixed, slices, split_words
from cratewise.operators.skew import BROADCAST_ROWS
from cratewise.operators.state import BROADCAST_MARKS
from cratewise.session import checkpointed, stored

THRESHOLD = 0.3
# Name of the score while it stands beside columns of any name.
SCORE = "__toxicity__"
BUCKETS = 1 << 17
BEGINNINGS = (4, 6)
DIMENSIONS = 8
# Filters by width.
FILTERS = {1: 8, 2: 4, 3: 4}
# What the driver learns by itself: labelled rows of each class, and characters of those of its
# texts together that are longer than SHORT_CHARS. More is learned where it lies.
SAMPLE = {1: 2500, 0: 3500}
SHORT_CHARS = 20_000
LONG_CHARS = 10_000_000
EPOCHS = 12
# Texts that must have a bucket for it to be learned.
SEEN = 5
# Bytes of text scored or split at once: a word takes hundreds of bytes then.
SCORE_BYTES = 1 << 18
# Every so many-th text is left for the calibration.
CALIBRATE = 5
# Where texts are learned where they lie: rounds at least, texts and words of a batch (small ones,
# as a task takes few steps a round), buckets of a block of the state, and groups of scores (per
# logit) among which thresholds are looked for.
LEAST_ROUNDS = 6
BATCH_TEXTS = 16
BATCH_WORDS = 1 << 16
BLOCK = 1 << 13
BINS = 256

_MOVED = "block int, task int, texts bigint, at binary, data binary, squares binary"
_MOVED_ARROW = pa.schema(
    [("block", pa.int32()), ("task", pa.int32()), ("texts", pa.int64())]
    + [(name, pa.binary()) for name in ("at", "data", "squares")]
)


def held_out() -> Column:
    """Rows that no model learns from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def word_ids(words: Words) -> np.ndarray:
    """Buckets of every word: of itself and of its beginnings."""
    data = np.append(words.data, np.zeros(max(BEGINNINGS), np.uint8))
    values = ALNUM_FOLDED[data]
    ids = [words.hashes]
    value = np.full(len(words.starts), np.uint64(7), np.uint64)
    for i in range(max(BEGINNINGS)):
        at = words.starts + i
        value = np.where(at < words.ends, mixed(value * np.uint64(31) + values[at]), value)
        if i + 1 in BEGINNINGS:
            ids.append(value + np.uint64(i))
    return np.stack([mixed(x) % np.uint64(BUCKETS) for x in ids], 1).astype(np.int32)


@dataclass
class Model:
    """``table`` holds, per bucket, the embedding times each filter's part of a width."""

    table: np.ndarray  # buckets x columns
    bias: np.ndarray  # per filter
    weights: np.ndarray  # of the maxima
    offset: float
    languages: np.ndarray  # buckets x languages: log probability of a word
    shifts: np.ndarray  # per language, in logits


def _columns() -> list[tuple[int, int, slice, slice]]:
    """(width, part, columns of the table, filters) for every part of every width."""
    out, column, first = [], 0, 0
    for width, count in FILTERS.items():
        for part in range(width):
            out.append((width, part, slice(column, column + count), slice(first, first + count)))
            column += count
        first += count
    return out


def pooled(ids: np.ndarray, counts: np.ndarray, table: np.ndarray, bias: np.ndarray):
    """Maxima of every filter over every text (0 at least), and the values at each word.

    A text shorter than a width is filled up with nothing.
    """
    total = sum(FILTERS.values())
    values = table[ids[:, 0]]
    for i in range(1, ids.shape[1]):
        values += table[ids[:, i]]
    last = np.repeat(np.cumsum(counts), counts)
    at = np.arange(len(ids))
    found = np.empty((len(ids), total), np.float32)
    for _, part, columns, filters in _columns():
        if part == 0:
            found[:, filters] = values[:, columns] + bias[filters]
        elif len(ids) > part:
            here = (at[:-part] + part < last[:-part])[:, None]
            found[:-part, filters] += np.where(here, values[part:, columns], 0)
    out = np.zeros((len(counts), total), np.float32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.maximum(np.maximum.reduceat(found, starts, axis=0), 0)
    return out, found


def guess(ids: np.ndarray, counts: np.ndarray, languages: np.ndarray) -> np.ndarray:
    """Number of the likeliest language of every text, by its words; the first if it has none."""
    out = np.zeros((len(counts), languages.shape[1]), np.float32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(languages[ids[:, 0]], starts, axis=0)
    return out.argmax(1)


def logits(ids: np.ndarray, counts: np.ndarray, model: Model) -> np.ndarray:
    maxima, _ = pooled(ids, counts, model.table, model.bias)
    raw = maxima @ model.weights + model.offset
    return raw + model.shifts[guess(ids, counts, model.languages)]


# --- training ---------------------------------------------------------------------------


def _text_counts(ids, counts, labels) -> np.ndarray:
    """Per class and bucket: the texts that have the bucket."""
    seen = np.zeros((2, BUCKETS))
    start = 0
    for count, label in zip(counts, labels):
        seen[label, np.unique(ids[start : start + count])] += 1
        start += count
    return seen


def _log_odds(seen: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Per bucket: log of its share among toxic texts over that among the others.

    Buckets of fewer than SEEN texts are NaN: they are never learned, so that rare words
    are not learned by heart.
    """
    rate = [(seen[x] + 0.5) / (texts[x] + 1) for x in (0, 1)]
    odds = np.clip(np.log(rate[1] / rate[0]), -4, 4) / 4
    return np.where(seen.sum(0) >= SEEN, odds, np.nan)


class Fit:
    """Embeddings and filters while they are learned, with the squares of their gradients."""

    def __init__(self, odds: np.ndarray, random: np.random.Generator):
        total = sum(FILTERS.values())
        self.learned = ~np.isnan(odds)
        self.embedding = random.normal(0, 0.05, (BUCKETS, DIMENSIONS)).astype(np.float32)
        self.embedding[:, 0] = odds
        self.embedding[~self.learned] = 0
        self.values = {
            (width, part): random.normal(0, 0.2, (DIMENSIONS, filters.stop - filters.start))
            for width, part, _, filters in _columns()
        }
        self.values[1, 0][0, :] += 1.0
        self.values["bias"] = np.full(total, -0.2)
        self.values["weights"] = np.abs(random.normal(0, 0.5, total))
        self.values["offset"] = -1.0
        self.squares = {key: np.full(np.shape(x), 1e-4) for key, x in self.values.items()}
        self.embedding_squares = np.full(self.embedding.shape, 1e-4, np.float32)

    def _step(self, name, gradient) -> None:
        """Scale a gradient by the root of the squares so far."""
        self.squares[name] = self.squares[name] + gradient**2
        self.values[name] = self.values[name] - 0.1 * gradient / np.sqrt(self.squares[name])

    def epoch(self, ids, counts, labels, random, texts=64, most_words: int | None = None) -> None:
        """Gradient steps through the maxima, over batches of about so many texts.

        With ``most_words`` a batch of more words is cut, down to one text.
        """
        starts = np.cumsum(counts) - counts
        for batch in np.array_split(random.permutation(len(counts)), max(1, len(counts) // texts)):
            if most_words is None:
                self._batch(ids, starts, counts, labels, batch)
                continue
            ends = np.cumsum(counts[batch])
            cuts = np.flatnonzero(np.diff((ends - 1) // most_words)) + 1
            for piece in np.split(batch, cuts):
                self._batch(ids, starts, counts, labels, piece)

    def _batch(self, ids, starts, counts, labels, batch) -> None:
        embedding, parts = self.embedding, self.values
        own = np.concatenate(
            [np.arange(starts[i], starts[i] + counts[i]) for i in batch]
        ).astype(np.int64)
        rows, sizes = ids[own], counts[batch]
        values = embedding[rows].sum(1)
        product = np.concatenate([values @ parts[w, p] for w, p, _, _ in _columns()], 1)
        # The word vectors' products stand in for the table: one row per word.
        maxima, found = pooled(
            np.arange(len(rows))[:, None], sizes, product.astype(np.float32), parts["bias"]
        )
        weights = parts["weights"]
        score = 1 / (1 + np.exp(-(maxima @ weights + parts["offset"])))
        error = (score - labels[batch]) / len(batch)
        text = np.repeat(np.arange(len(batch)), sizes)
        last = np.repeat(np.cumsum(sizes), sizes)
        changes = np.zeros((len(rows), DIMENSIONS))
        back = error[:, None] * weights * (maxima > 0)
        updates = {}
        for width, part, _, filters in _columns():
            gradient = np.zeros_like(parts[width, part])
            for column, name in enumerate(range(filters.start, filters.stop)):
                at = np.flatnonzero(found[:, name] == maxima[text, name])
                at = at[np.unique(text[at], return_index=True)[1]]
                flow = back[text[at], name]
                inside = (at + part < last[at]) & (flow != 0)
                at, flow = at[inside] + part, flow[inside]
                gradient[:, column] = flow @ values[at]
                np.add.at(changes, at, flow[:, None] * parts[width, part][:, column])
            updates[width, part] = gradient
        updates |= {"weights": maxima.T @ error, "bias": back.sum(0), "offset": error.sum()}
        for key, gradient in updates.items():
            self._step(key, gradient)
        moved = np.flatnonzero(np.abs(changes).sum(1))
        for column in range(rows.shape[1]):
            where, change = rows[moved, column], changes[moved]
            where, change = where[self.learned[where]], change[self.learned[where]]
            # Repeated buckets add up.
            places, inverse = np.unique(where, return_inverse=True)
            summed = np.zeros((len(places), DIMENSIONS))
            np.add.at(summed, inverse, change)
            self.embedding_squares[places] += summed**2
            embedding[places] -= 0.1 * summed / np.sqrt(self.embedding_squares[places])

    def model(self, languages: np.ndarray) -> Model:
        table = np.concatenate([self.embedding @ self.values[w, p] for w, p, _, _ in _columns()], 1)
        return Model(
            table.astype(np.float32), self.values["bias"].astype(np.float32),
            self.values["weights"], float(self.values["offset"]), languages,
            np.zeros(languages.shape[1]),
        )


def train(
    ids: np.ndarray, counts: np.ndarray, labels: np.ndarray, langs: np.ndarray, epochs: int = EPOCHS
) -> Model:
    """Fit filters and embeddings to texts that are all at hand."""
    random = np.random.default_rng(7)
    texts = np.array([(labels == x).sum() for x in (0, 1)])
    fit = Fit(_log_odds(_text_counts(ids, counts, labels), texts), random)
    for _ in range(epochs):
        fit.epoch(ids, counts, labels, random)
    names = sorted({x for x in langs if x is not None})
    return fit.model(_language_table(_word_counts(ids, counts, langs, names)))


def _word_counts(ids: np.ndarray, counts: np.ndarray, langs: np.ndarray, names: list[str]) -> np.ndarray:
    """Per language of ``names`` and bucket: its words."""
    number = {name: i for i, name in enumerate(names)}
    which = np.repeat(np.array([number.get(x, -1) for x in langs], np.int16), counts)
    table = np.zeros((max(1, len(names)), BUCKETS))
    for i in range(len(names)):
        table[i] = np.bincount(ids[which == i, 0], minlength=BUCKETS)
    return table


def _language_table(words: np.ndarray) -> np.ndarray:
    table = words.T
    return np.log((table + 0.1) / (table.sum(0) + 0.1 * BUCKETS)).astype(np.float32)


AIM = np.log(THRESHOLD / (1 - THRESHOLD))


def _shift(toxic: np.ndarray, texts: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The shift that puts the threshold of the best F1 on THRESHOLD.

    Of texts in groups from the highest score down: the toxic ones, all, and the lowest and
    highest score. Between the last text above and the first below, the threshold lies in the
    middle.
    """
    hits = np.cumsum(toxic)
    if not len(hits) or not hits[-1]:
        return 0.0
    f1 = 2 * hits / (np.cumsum(texts) + hits[-1])
    top = int(f1.argmax())
    below = high[top + 1] if top + 1 < len(hits) else low[top] - 2
    return AIM - (low[top] + below) / 2


def _parts(ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Some texts at a time, so that no table of all words is held."""
    ends = np.cumsum(counts)
    for low in range(0, len(counts), 100):
        high = min(low + 100, len(counts))
        yield ids[ends[low] - counts[low] : ends[high - 1]], counts[low:high]


def _raw(ids, counts, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores in logits and guessed languages."""
    parts = list(_parts(ids, counts))
    raw = [logits(*part, model) for part in parts]
    return np.concatenate(raw), np.concatenate([guess(*part, model.languages) for part in parts])


def _calibrated(ids, counts, labels, model: Model) -> np.ndarray:
    """Per language, the shift of its best threshold; with too few texts, that of all."""
    raw, language = _raw(ids, counts, model)

    def best(rows: np.ndarray) -> float:
        order = rows[np.argsort(-raw[rows], kind="stable")]
        return _shift(labels[order], np.ones(len(order), np.int64), raw[order], raw[order])

    overall = best(np.arange(len(labels)))
    shifts = np.full(len(model.shifts), overall)
    for number in range(len(shifts)):
        rows = np.flatnonzero(language == number)
        if labels[rows].sum() >= 20 and (1 - labels[rows]).sum() >= 20:
            shifts[number] = best(rows)
    return shifts


# --- Spark ------------------------------------------------------------------------------


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of every text, once for every id of a task."""
    seen = set()
    for batch in batches:
        fresh = []
        for number, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            if doc_id not in seen:
                seen.add(doc_id)
                fresh.append(number)
        chosen = batch if len(fresh) == batch.num_rows else batch.take(pa.array(fresh, pa.int64()))
        for part, data, offsets in slices(chosen, limit=SCORE_BYTES):
            words = split_words(data, offsets, ALNUM_FOLDED)
            ids = word_ids(words)
            packed = [ids[a:z].tobytes() for a, z in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [*map(part.column, ("doc_id", "toxic", "lang")), pa.array(packed, pa.binary())],
                ["doc_id", "toxic", "lang", "ids"],
            )


def _chosen(rows: list[dict], n: int) -> list[dict]:
    """At most ``n`` of one class's rows (order, lang, chars), in their order.

    Long texts share LONG_CHARS by language. Of a language that has no short ones the shortest
    come first, and one at least.
    """
    short = {row["lang"] for row in rows if row["chars"] <= SHORT_CHARS}
    long: dict[str | None, list[dict]] = {}
    for row in rows:
        if row["chars"] > SHORT_CHARS:
            long.setdefault(row["lang"], []).append(row)
    taken = [(1, row["order"], row) for row in rows if row["chars"] <= SHORT_CHARS]
    for lang, own in long.items():
        left = LONG_CHARS // len(long)
        for number, row in enumerate(
            sorted(own, key=lambda row: (row["chars"] if lang not in short else 0, row["order"]))  # noqa: B023
        ):
            first = lang not in short and not number
            if first or row["chars"] <= left:
                left -= row["chars"]
                taken.append((0 if first else 1, row["order"], row))
    return [row for *_, row in sorted(taken, key=lambda x: x[:2])[:n]]


def learn(docs: DataFrame, labels: DataFrame) -> Model | float:
    """A model from labelled rows that are not held out; the share of toxic rows without two classes.

    All of them teach. Up to SAMPLE rows of a class, with longer texts of up to LONG_CHARS
    characters together among them, are learned on the driver; more are learned where they lie.
    Rows without label or text teach nothing, and an id teaches once. An id with several labels
    is toxic if one of them says so.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    if any(sizes.get(x, 0) > n for x, n in SAMPLE.items()):
        return _learn_all(docs, known)
    place = F.xxhash64(F.lit("toxic"), "doc_id")
    some = thinned(known, ["toxic"], place, max(SAMPLE.values()))
    texts = docs.where("text is not null").select(
        "doc_id", "text", "lang", F.xxhash64("text").alias("text_hash")
    )
    # One text of every id. Bounded by SAMPLE: about three times as many ids, without their texts.
    sizes = (
        texts.join(F.broadcast(some), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.struct("text_hash", "lang", F.length("text").alias("chars"))).alias("text"))
        # The shifted hash orders as the unsigned one, as which it was cut.
        .select("doc_id", "toxic", "text.*", F.shiftrightunsigned(place, 1).alias("order"))
        .orderBy("order", "doc_id")
    )
    found = sizes.toArrow().to_pylist()
    for number, row in enumerate(found):
        row["order"] = number
    picked = [
        (row["doc_id"], row["toxic"], row["text_hash"], row["lang"])
        for x, n in SAMPLE.items()
        for row in _chosen([row for row in found if row["toxic"] == x], n)
    ]
    if len(picked) < len(found):
        return _learn_all(docs, known)
    schema = T.StructType(
        [sizes.schema["doc_id"], *[T.StructField(x, sizes.schema[x].dataType) for x in ("toxic", "text_hash", "lang")]]
    )
    chosen = docs.sparkSession.createDataFrame(picked, schema).withColumnRenamed("lang", "own_lang")
    kind = sizes.schema["doc_id"].dataType.simpleString()
    # Bounded by SAMPLE, SHORT_CHARS and LONG_CHARS, on however many rows an id stands.
    sample = (
        texts.join(F.broadcast(chosen), ["doc_id", "text_hash"])
        .where(F.col("lang").eqNullSafe(F.col("own_lang")))
        .select("doc_id", "text", "lang", "toxic")
        .mapInArrow(_features, f"doc_id {kind}, toxic int, lang string, ids binary")
        .dropDuplicates(["doc_id"])
        .toArrow()
    )
    rows = list(zip(*[sample.column(x).to_pylist() for x in ("toxic", "lang", "ids")]))
    del sample
    rows.sort(key=lambda row: (row[0], row[1] or "", row[2]))
    toxic = np.array([row[0] for row in rows], np.int64)
    if not len(rows) or toxic.min() == toxic.max():
        return float(toxic.mean()) if len(rows) else 0.0
    langs = [row[1] for row in rows]
    ids = [np.frombuffer(row[2], np.int32).reshape(-1, len(BEGINNINGS) + 1) for row in rows]
    del rows

    def part(places):
        counts = np.array([len(ids[i]) for i in places], np.int64)
        return np.concatenate([ids[i] for i in places]), counts, toxic[places]

    places = np.arange(len(ids))
    kept = places[places % CALIBRATE != 0] if len(ids) >= 500 else places
    model = train(*part(kept), [langs[i] for i in kept])
    model.shifts = _calibrated(*part(places[places % CALIBRATE == 0]), model)
    return model


def _learn_all(docs: DataFrame, known: DataFrame) -> Model | float:
    """A model from the texts of all rows of ``known`` (doc_id, toxic), learned where they lie.

    Words of texts are stored once. Counts are added up over all of them; filters and
    embeddings are learned in rounds, in which every task goes on from the same state over its
    own texts and the states are averaged; thresholds are from all texts left for them. The
    driver holds what has the size of a model.
    """
    spark = docs.sparkSession
    features = _all_features(docs, known)
    taught, left = features.where("not calibrate"), features.where("calibrate")
    classes = {row["toxic"]: row["count"] for row in taught.groupBy("toxic").count().collect()}
    texts = np.array([classes.get(x, 0) for x in (0, 1)])
    if not texts.all():
        n, toxic = features.agg(F.count(F.lit(1)), F.sum("toxic")).first()
        if not n or toxic in (0, n):
            return toxic / n if n else 0.0
        # One class is all among those left out: no threshold then, but two classes.
        taught, left = features, features.limit(0)
        texts = np.array([n - toxic, toxic])
    names = sorted(row[0] for row in taught.where("lang is not null").select("lang").distinct().collect())
    found = (
        taught.mapInArrow(_counted(names), "kind int, bucket int, n bigint")
        .groupBy("kind", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    seen = np.zeros((2 + max(1, len(names)), BUCKETS))
    seen[found["kind"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    fit = Fit(_log_odds(seen[:2], texts), np.random.default_rng(7))
    rounds = max(LEAST_ROUNDS, min(EPOCHS, EPOCHS * sum(SAMPLE.values()) // int(texts.sum())))
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(fit)
        moved = taught.mapInArrow(_round(shared, number), _MOVED).groupBy("block").applyInArrow(
            _averaged, "block int, at binary, data binary, squares binary"
        )
        fit = _moved_to(fit, moved.toArrow())
        shared.unpersist()
    model = fit.model(_language_table(seen[2:]))
    shared = spark.sparkContext.broadcast(model)
    groups = (
        left.mapInArrow(_left_out(shared), "language int, toxic int, raw double")
        .groupBy("language", F.floor(F.col("raw") * BINS).alias("bin"))
        .agg(
            F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("texts"),
            F.min("raw").alias("low"), F.max("raw").alias("high"),
        )
        .orderBy(F.desc("bin"), "language")
        .toArrow()
    )
    columns = [groups[x].to_numpy() for x in ("toxic", "texts", "low", "high")]
    language, bins = groups["language"].to_numpy(), groups["bin"].to_numpy()
    starts = np.flatnonzero(np.diff(bins, prepend=bins[:1] + 1))
    joined = [
        how.reduceat(x, starts) if len(x) else x
        for how, x in zip((np.add, np.add, np.minimum, np.maximum), columns)
    ]
    model.shifts[:] = _shift(*joined)
    for number in range(len(model.shifts)):
        own = [x[language == number] for x in columns]
        if own[0].sum() >= 20 and (own[1] - own[0]).sum() >= 20:
            model.shifts[number] = _shift(*own)
    return model


def _all_features(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Words of the texts of ``known``, one text of every id, stored (toxic, lang, ids, calibrate)."""
    listed = F.broadcast(known) if known.count() <= BROADCAST_MARKS else known
    rows = docs.where("text is not null").join(listed, "doc_id")
    rows = rows.select("doc_id", "text", "lang", "toxic", F.xxhash64("text").alias("text_hash"))
    own = F.min(F.struct("text_hash", "lang")).alias("own")
    repeated = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), own).where("rows > 1")
    repeated = checkpointed(repeated.select("doc_id", "own.*"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ids = f"doc_id {kind}, toxic int, lang string, ids binary"
    words = lambda x: x.select("doc_id", "text", "lang", "toxic").mapInArrow(_features, ids)
    n = repeated.count()
    if n:
        few = F.broadcast if n <= BROADCAST_ROWS else (lambda x: x)
        other = repeated.withColumnsRenamed({x: f"own_{x}" for x in ("doc_id", "text_hash", "lang")})
        same = (
            (F.col("doc_id") == F.col("own_doc_id"))
            & (F.col("text_hash") == F.col("own_text_hash"))
            & F.col("lang").eqNullSafe(F.col("own_lang"))
        )
        chosen = words(rows.join(few(other), same, "left_semi")).dropDuplicates(["doc_id"])
        once = rows.join(few(repeated.select("doc_id")), "doc_id", "left_anti")
        found = words(once).unionByName(chosen)
    else:
        found = words(rows)
    calibrate = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(CALIBRATE)) == 0
    return stored(found.select("toxic", "lang", "ids", calibrate.alias("calibrate")))


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, numbers of words and labels of a batch of texts."""
    data, offsets = buffers(batch.column("ids"))
    width = len(BEGINNINGS) + 1
    return (
        data.view(np.int32).reshape(-1, width),
        np.diff(offsets) // (4 * width),
        batch.column("toxic").to_numpy().astype(np.int64),
    )


def _counted(names: list[str]):
    """Texts per class and bucket, and words per language and bucket, of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2 + max(1, len(names)), BUCKETS))
        for batch in batches:
            ids, counts, labels = _arrays(batch)
            seen[:2] += _text_counts(ids, counts, labels)
            seen[2:] += _word_counts(ids, counts, batch.column("lang").to_pylist(), names)
        kind, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()),
                pa.array(seen[kind, bucket].astype(np.int64)),
            ],
            ["kind", "bucket", "n"],
        )

    return run


def _flat(values: dict) -> np.ndarray:
    return np.concatenate([np.ravel(x) for x in values.values()])


def _round(shared, number: int):
    """A task's texts, batch by batch, from the shared state on: what it moved, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = copy.deepcopy(shared.value)
        task = TaskContext.get().partitionId()
        random = np.random.default_rng([7, number, task])
        texts = 0
        for batch in batches:
            ids, counts, labels = _arrays(batch)
            if len(counts):
                fit.epoch(ids, counts, labels, random, BATCH_TEXTS, BATCH_WORDS)
                texts += len(counts)
        if not texts:
            return
        touched = np.flatnonzero((fit.embedding_squares != shared.value.embedding_squares).any(1))
        rows = []
        for block in np.unique(touched // BLOCK):
            at = touched[touched // BLOCK == block].astype(np.int32)
            data, squares = fit.embedding[at], fit.embedding_squares[at]
            rows.append((int(block), at, data.astype(float), squares.astype(float)))
        rows.append((BUCKETS // BLOCK, np.zeros(1, np.int32), _flat(fit.values), _flat(fit.squares)))
        for block, *arrays in rows:
            yield pa.RecordBatch.from_pylist(
                [{"block": block, "task": task, "texts": texts,
                  **dict(zip(("at", "data", "squares"), [x.tobytes() for x in arrays]))}],
                _MOVED_ARROW,
            )

    return run


def _averaged(table: pa.Table) -> pa.Table:
    """The states of all tasks that moved a bucket or the filters, weighed by their texts."""
    out: dict[str, np.ndarray] = {}
    weight = np.zeros(BLOCK)
    block = table.column("block")[0].as_py()
    for row in sorted(table.to_pylist(), key=lambda row: row["task"]):
        at = np.frombuffer(row["at"], np.int32) % BLOCK
        weight[at] += row["texts"]
        for name in ("data", "squares"):
            values = np.frombuffer(row[name]).reshape(len(at), -1)
            if name not in out:
                out[name] = np.zeros((BLOCK if block < BUCKETS // BLOCK else 1, values.shape[1]))
            out[name][at] += row["texts"] * values
    at = np.flatnonzero(weight)
    mean = {name: (x[at] / weight[at, None]).tobytes() for name, x in out.items()}
    first = block * BLOCK if block < BUCKETS // BLOCK else 0
    return pa.table(
        {
            "block": pa.array([block], pa.int32()),
            "at": pa.array([(at + first).astype(np.int32).tobytes()], pa.binary()),
            **{name: pa.array([x], pa.binary()) for name, x in mean.items()},
        }
    )


def _moved_to(fit: Fit, moved: pa.Table) -> Fit:
    """The state of the next round."""
    for row in moved.to_pylist():
        data, squares = np.frombuffer(row["data"]), np.frombuffer(row["squares"])
        if row["block"] < BUCKETS // BLOCK:
            at = np.frombuffer(row["at"], np.int32)
            fit.embedding[at] = data.reshape(len(at), -1)
            fit.embedding_squares[at] = squares.reshape(len(at), -1)
            continue
        start = 0
        for key, old in fit.values.items():
            end, shape = start + np.size(old), np.shape(old)
            fit.values[key] = data[start:end].reshape(shape)
            fit.squares[key] = squares[start:end].reshape(shape)
            start = end
    return fit


def _left_out(shared):
    """Score and guessed language of the texts left for thresholds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, labels = _arrays(batch)
            if len(counts):
                raw, language = _raw(ids, counts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(language.astype(np.int32)), pa.array(labels.astype(np.int32)),
                        pa.array(raw, pa.float64()),
                    ],
                    ["language", "toxic", "raw"],
                )

    return run


def _score(shared, names: list[str]):
    """Pass the columns ``names`` on and add a score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, data, offsets in slices(batch, limit=SCORE_BYTES):
                words = split_words(data, offsets, ALNUM_FOLDED)
                if isinstance(model, float):
                    score = np.full(part.num_rows, model)
                else:
                    raw = logits(word_ids(words), words.counts, model)
                    score = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(x) for x in names], pa.array(score, pa.float64())],
                    [*names, SCORE],
                )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text).

    ``learn_from`` (doc_id, text, lang) holds the texts that ``labels`` (doc_id, toxic) speak
    of; ``docs`` itself by default.

    ``score`` is between 0 and 1 and depends on the text alone; ``predicted`` is 1 from
    THRESHOLD on. A null or empty text is scored as one without words. Without two classes of
    labelled rows every score is the share of toxic ones, 0 without any.
    """
    scored = scored_rows(docs.select("doc_id", "text"), learn(learn_from or docs, labels), ["doc_id"])
    score = F.col(SCORE).alias("score")
    return scored.select("doc_id", score, (score >= THRESHOLD).cast("int").alias("predicted"))


def scored_rows(docs: DataFrame, model: Model | float, names: list[str]) -> DataFrame:
    """The columns ``names`` of every row with the score of its text in column SCORE."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[x] for x in names]).add(SCORE, "double")
    needed = list(dict.fromkeys([*names, "text"]))
    return docs.select(needed).mapInArrow(_score(shared, names), schema)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang), all columns, that are not predicted toxic.

    Each row is judged where it lies; nothing is shuffled.
    """
    scored = scored_rows(docs, learn(docs, labels), docs.columns)
    return scored.where(F.col(SCORE) < THRESHOLD).drop(SCORE)
