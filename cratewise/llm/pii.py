"""Personal data in whole texts: patterns, and a skip-chain conditional random field.

The patterns give the base spans. The field labels the tokens with a digit or an @ of every
text. Neighbouring tokens share a potential, and so do a token and the next one that is the
same or similar (equal letters and digits, or the same part after the @): a number that is
personal data in one place is so in another, where it lacks what the pattern asks for. Tokens
inside base spans are evidence, and every like token is also joined to the nearest evidence on
either side, however many repeats lie between. Loopy message passing over all edges, until the
messages of a text stand still, gives each token its label. What it adds are spans that overlap
no base span.

The weights are fitted piecewise in numpy on a bounded, hash-ordered sample of tokens that
the patterns label; patterns are never features. A token that the patterns pass over though
they label its like teaches nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.spans import SPANS_SQL, Span, in_code_points, spans_array
from cratewise.llm.words import SPACED, Words, mixed, slices, split_words

KINDS = ["email", "ip", "card", "phone"]
LABELS = 1 + len(KINDS)

# Bounds of the training sample.
SAMPLE_DOCS = 5000
SAMPLE_TOKENS = 40_000
FEATURES = 1 << 12
SURE = 0.9
# A text is settled when no message of it changes by more in a round.
SETTLED = 1e-5
# Tokens further apart than this many words are no neighbours.
NEAR_WORDS = 4
EVIDENCE = 8.0

_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = bytes(x for x in range(256) if not 48 <= x <= 57)


# --- base spans -------------------------------------------------------------------------


def emails(text: bytes) -> list[Span]:
    """Matches of local part, @ and domain. Told from each @, so a long run is read once."""
    out, last, at = [], 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            out.append(("email", start, last))
        at = text.find(b"@", max(at + 1, last))
    return out


def ips(text: bytes) -> list[Span]:
    """A run of digits that fails at its start fails inside as well: runs are tried once."""
    small = lambda part: len(x := part.lstrip(b"0")) <= 3 and int(x or b"0") <= 255
    return [("ip", *m.span()) for m in _IP.finditer(text) if all(map(small, m.groups()))]


def luhn(digits: bytes) -> bool:
    values = [x - 48 for x in reversed(digits)]
    doubled = [2 * x - 9 * (x > 4) for x in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def cards(text: bytes) -> list[Span]:
    out = []
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = match[0].translate(None, _NO_DIGITS)
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *match.span()))
    return out


def phones(text: bytes) -> list[Span]:
    return [
        ("phone", *match.span())
        for match in _PHONE.finditer(text)
        if 9 <= len(match[0].translate(None, _NO_DIGITS)) <= 15
    ]


def base_spans(text: bytes) -> list[Span]:
    """Leftmost matches of every kind in byte offsets; kinds may overlap each other."""
    found = cards(text)
    if b"@" in text:
        found += emails(text)
    if b"." in text:
        found += ips(text)
    if b"+" in text:
        found += phones(text)
    return found


# --- tokens -----------------------------------------------------------------------------


@dataclass
class Tokens:
    """Words with a digit or an @, of consecutive texts, and what the field knows of them."""

    text: np.ndarray
    start: np.ndarray  # byte offsets in their text
    end: np.ndarray
    features: np.ndarray  # tokens x templates: numbers of the features that hold
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # pairs of same or similar tokens, each with the next
    alike: np.ndarray  # (key, token) of all tokens with a key, in this order


_STRIP = b"()[]{}<>,;:!?\"'*|"


def _bucket(value: int, edges: tuple[int, ...]) -> int:
    return sum(value >= edge for edge in edges)


def tokens(words: Words) -> Tokens:
    data = words.data
    marked = np.zeros(len(data) + 1, np.int64)
    np.cumsum(((data >= 48) & (data <= 57)) | (data == 64), out=marked[1:])
    chosen = np.flatnonzero(marked[words.ends] > marked[words.starts])
    of_word = words.text_of_word()
    text = of_word[chosen]
    begin = words.offsets[text]
    start, end, features, keys = [], [], [], []
    for word in chosen.tolist():
        raw = words.word(word)
        left = len(raw) - len(raw.lstrip(_STRIP))
        token = raw.strip(_STRIP).rstrip(b".")
        low = int(words.starts[word]) + left
        start.append(low)
        end.append(low + len(token))
        digits = token.translate(None, _NO_DIGITS)
        letters = sum(x.isalpha() for x in token.decode("utf-8", "replace"))
        features.append(
            (
                b"@" in token,
                token[:1] == b"+",
                _bucket(len(digits), (1, 4, 7, 9, 12, 16, 20)),
                _bucket(letters, (1, 4, 10)),
                min(token.count(b"."), 4),
                min(token.count(b"-"), 4),
                _bucket(len(token), (4, 8, 12, 20, 40)),
                token[:1].isdigit() + 2 * token[-1:].isdigit(),
            )
        )
        domain = token.rpartition(b"@")[2] if b"@" in token else b""
        plain = re.sub(rb"[^0-9a-z@\x80-\xff]", b"", token.lower())
        keys.append((plain, domain.lower()))
    shapes = np.array(features, np.uint64).reshape(len(chosen), 8)
    before = _neighbour(words, of_word, chosen, -1)
    after = _neighbour(words, of_word, chosen, 1)
    joint = (shapes * (np.uint64(9) ** np.arange(8, dtype=np.uint64))).sum(1, dtype=np.uint64)
    templates = [*shapes.T, joint, before, after]
    numbers = [
        mixed(np.asarray(x, np.uint64) + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        % np.uint64(FEATURES)
        for i, x in enumerate(templates)
    ]
    near = (np.diff(chosen) <= NEAR_WORDS) & (np.diff(text) == 0)
    first = np.flatnonzero(near)
    return Tokens(
        text,
        np.array(start, np.int64) - begin,
        np.array(end, np.int64) - begin,
        np.stack(numbers, 1).astype(np.int64),
        np.stack([first, first + 1], 1),
        *_repeats(text, keys),
    )


def _neighbour(words: Words, of_word: np.ndarray, chosen: np.ndarray, step: int) -> np.ndarray:
    """Hash of the word beside each token in the same text; 0 at its ends."""
    at = np.clip(chosen + step, 0, max(len(of_word) - 1, 0))
    same = (of_word[at] == of_word[chosen]) & (at != chosen)
    return np.where(same, words.hashes[at], np.uint64(0))


def _repeats(text: np.ndarray, keys: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Each token with the next of its text that has the same key: edges grow as tokens do.

    Second, (key, token) of all, keys numbered by text.
    """
    pairs, alike = set(), []
    for place in (0, 1):
        last: dict[tuple[int, bytes], int] = {}
        numbers: dict[tuple[int, int, bytes], int] = {}
        shift = max((key for key, _ in alike), default=-1) + 1
        for number, (owner, key) in enumerate(zip(text.tolist(), keys)):
            if len(key[place]) >= 4:
                before = last.get((owner, key[place]))
                if before is not None:
                    pairs.add((before, number))
                last[owner, key[place]] = number
                alike.append((shift + numbers.setdefault((place, owner, key[place]), len(numbers)), number))
    as_array = lambda x: np.array(sorted(x), np.int64).reshape(-1, 2)
    return as_array(pairs), as_array(alike)


def to_evidence(found: Tokens, labels: np.ndarray) -> np.ndarray:
    """Pairs of a token without a label and the nearest labelled like one before and after it.

    Evidence lets nothing pass, so these are all that the repeats of a key can tell it. Pairs
    that ``skip`` has are left out.
    """
    key, token = found.alike.T
    place = np.arange(len(key))
    told = labels[token] > 0
    before = np.maximum.accumulate(np.where(told, place, -1)) if len(key) else place
    after = np.minimum.accumulate(np.where(told, place, len(key))[::-1])[::-1] if len(key) else place
    pairs = []
    for other in (before, after):
        near = (other >= 0) & (other < len(key)) & ~told
        near[near] = key[other[near]] == key[near]
        pairs.append(np.sort(np.stack([token[near], token[other[near]]], 1), axis=1))
    code = lambda x: x[:, 0] * (len(labels) + 1) + x[:, 1]
    found_pairs = np.unique(np.concatenate(pairs), axis=0)
    return found_pairs[~np.isin(code(found_pairs), code(found.skip))]


def observed(found: Tokens, spans: dict[int, list[Span]]) -> np.ndarray:
    """Label of each token by the base spans of its text that it overlaps; 0 for none.

    Of several, the first kind as listed.
    """
    labels = np.zeros(len(found.text), np.int64)
    cuts = np.searchsorted(found.text, sorted(spans))
    for low, text in zip(cuts.tolist(), sorted(spans)):
        high = int(np.searchsorted(found.text, text, side="right"))
        for kind, start, end in sorted(spans[text], key=lambda x: -KINDS.index(x[0])):
            a = low + int(np.searchsorted(found.end[low:high], start, side="right"))
            z = low + int(np.searchsorted(found.start[low:high], end, side="left"))
            labels[a:z] = KINDS.index(kind) + 1
    return labels


def known_labels(found: Tokens, labels: np.ndarray) -> np.ndarray:
    """Mask of the tokens whose label teaches something.

    The patterns say what is personal data, not what is none: a token outside their spans
    that is the same as or similar to one inside, over any number of edges, is left open.
    """
    reached = labels > 0
    size = -1
    while reached.sum() != size:
        size = reached.sum()
        for a, b in ((0, 1), (1, 0)):
            reached[found.skip[reached[found.skip[:, a]], b]] = True
    return (labels > 0) | ~reached


# --- the field --------------------------------------------------------------------------


@dataclass
class Field:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return (np.log(np.exp(values - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def _sums(target: np.ndarray, messages: np.ndarray, size: int) -> np.ndarray:
    """Sum of the messages to every token."""
    place = target[:, None] * LABELS + np.arange(LABELS)
    return np.bincount(place.ravel(), messages.ravel(), size * LABELS).reshape(size, LABELS)


def marginals(
    found: Tokens, labels: np.ndarray, field: Field, rounds: int | None = None
) -> np.ndarray:
    """Probability of every label of every token, by loopy message passing.

    Tokens with a label are evidence, which no message changes, however many it is joined to.
    Messages are damped by half and sent until those of a text change by SETTLED at most (or
    ``rounds`` times, if given). The step is halved again
    each time a text has had rounds for two ways through all its tokens, so that messages that
    go to and fro come to rest as well.
    """
    own = field.unary[found.features].sum(1)
    known = np.flatnonzero(labels)
    own[known] = 0
    own[known, labels[known]] = EVIDENCE
    similar = np.concatenate([found.skip, to_evidence(found, labels)])
    edges = [(found.chain, field.chain), (similar, field.skip)]
    source = np.concatenate([x for pairs, _ in edges for x in (pairs[:, 0], pairs[:, 1])])
    target = np.concatenate([x for pairs, _ in edges for x in (pairs[:, 1], pairs[:, 0])])
    tables = np.stack([p for _, table in edges for p in (table, table.T)])
    sizes = [len(pairs) for pairs, _ in edges for _ in (0, 1)]
    starts = np.cumsum([0, *sizes])
    which = np.repeat(np.arange(len(sizes)), sizes)
    back = np.concatenate(
        [np.arange(starts[i ^ 1], starts[i ^ 1] + sizes[i]) for i in range(len(sizes))]
    ).astype(np.int64)
    messages = np.zeros((len(source), LABELS))
    # Nothing is sent to evidence.
    heard = labels[target] == 0
    text = found.text[source]
    patience = 200 + 2 * np.bincount(found.text)[text]
    # Edges of the texts that are not settled; each text ends as it would alone.
    live = np.arange(len(source))
    turn = 0
    while len(live) and turn != rounds:
        place = np.zeros(len(source), np.int64)
        place[live] = np.arange(len(live))
        nodes, ends = np.unique(np.concatenate([source[live], target[live]]), return_inverse=True)
        low, high = ends[: len(live)], ends[len(live) :]
        sent, reverse, potential = messages[live], place[back[live]], tables[which[live]]
        owner, wait, base = text[live], patience[live], own[nodes]
        open_ = heard[live][:, None]
        moving = len(np.unique(owner))
        while turn != rounds:
            turn += 1
            belief = base + _sums(high, sent, len(nodes))
            fresh = _log_sum((belief[low] - sent[reverse])[:, :, None] + potential, 1)
            fresh -= _log_sum(fresh, 1)[:, None]
            change = (0.5 ** (1 + turn // wait))[:, None] * (fresh - sent) * open_
            sent += change
            unsettled = np.unique(owner[np.abs(change).max(1) > SETTLED])
            if len(unsettled) < moving:
                break
        messages[live] = sent
        live = live[np.isin(owner, unsettled)]
    belief = own + _sums(target, messages, len(own))
    return np.exp(belief - _log_sum(belief, 1)[:, None]) if len(belief) else belief


def fit(features: np.ndarray, labels: np.ndarray, pairs: np.ndarray) -> Field:
    """Logistic weights of the features, and smoothed log ratios of the pairs' labels.

    ``pairs`` counts labels of neighbours (first table) and of similar tokens (second).
    """
    unary = np.zeros((FEATURES, LABELS))
    squares = np.full(unary.shape, 1e-6)
    random = np.random.default_rng(3)
    for _ in range(5 if len(labels) else 0):
        for batch in np.array_split(random.permutation(len(labels)), max(1, len(labels) // 256)):
            rows = features[batch]
            score = unary[rows].sum(1)
            share = np.exp(score - _log_sum(score, 1)[:, None])
            share[np.arange(len(batch)), labels[batch]] -= 1
            used, inverse = np.unique(rows, return_inverse=True)
            gradient = np.zeros((len(used), LABELS))
            np.add.at(gradient, inverse.ravel(), np.repeat(share, rows.shape[1], 0))
            squares[used] += gradient**2
            unary[used] -= 0.2 * gradient / np.sqrt(squares[used])
    tables = []
    for counts in pairs:
        both = counts + counts.T + 0.5 + 2.0 * np.eye(LABELS)
        both /= both.sum()
        tables.append(np.clip(np.log(both / np.outer(both.sum(1), both.sum(0))), -4, 4))
    return Field(unary, *tables)


# --- Spark ------------------------------------------------------------------------------


def _read(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
    """Tokens of a slice, base spans by text (byte offsets), and the slice's bytes."""
    whole = data.tobytes()
    spans = {}
    for number, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        own = base_spans(whole[low:high])
        if own:
            spans[number] = own
    return tokens(split_words(data, offsets, SPACED)), spans, whole


def _teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features, labels and places of tokens, and the counted labels of pairs (``table`` 0 or 1)."""
    names = ["features", "label", "table", "other", "n", "doc", "spot"]
    kinds = [pa.list_(pa.int64()), *[pa.int64()] * 6]
    for batch in batches:
        for part, data, offsets in slices(batch):
            found, spans, _ = _read(part, data, offsets)
            labels = observed(found, spans)
            known = known_labels(found, labels)
            doc = part.column("doc").to_numpy()[found.text[known]].tolist()
            told = zip(found.features[known].tolist(), labels[known].tolist(), doc, found.start[known].tolist())
            rows = [(f, k, None, None, 1, d, s) for f, k, d, s in told]
            for number, pairs in enumerate((found.chain, found.skip)):
                pairs = pairs[known[pairs].all(1)]
                counts = np.zeros((LABELS, LABELS), np.int64)
                np.add.at(counts, (labels[pairs[:, 0]], labels[pairs[:, 1]]), 1)
                rows += [
                    (None, i, number, j, int(counts[i, j]), None, None)
                    for i, j in zip(*np.nonzero(counts))
                ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names
                )


def learn(docs: DataFrame) -> Field:
    """Weights from about SAMPLE_DOCS documents by hash of doc_id, SAMPLE_TOKENS tokens at most.

    Tokens are taken by a hash of where they stand, so equal ones have the share that they have
    in the documents.
    """
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    place = F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(1 << 30))
    # Of a giant document only tokens are chosen, below.
    chosen = docs.where(place < int(share * (1 << 30)))
    # Documents without an id are told by their texts.
    rows = chosen.select("text", F.xxhash64("doc_id", "text").alias("doc")).mapInArrow(
        _teach,
        "features array<bigint>, label bigint, table bigint, other bigint, n bigint, "
        "doc bigint, spot bigint",
    )
    order = [F.xxhash64("doc", "spot"), F.col("features"), F.col("label")]
    some = rows.where("table is null").orderBy(*order).limit(SAMPLE_TOKENS)
    some = some.select("features", "label").collect()
    counted = rows.where("table is not null").groupBy("table", "label", "other")
    pairs = np.zeros((2, LABELS, LABELS))
    for row in counted.agg(F.sum("n").alias("n")).collect():
        pairs[row["table"], row["label"], row["other"]] = row["n"]
    width = len(some[0]["features"]) if some else 1
    features = np.array([row["features"] for row in some], np.int64).reshape(-1, width)
    return fit(features, np.array([row["label"] for row in some], np.int64), pairs)


def added_spans(found: Tokens, spans: dict[int, list[Span]], field: Field) -> dict[int, list[Span]]:
    """Spans of tokens that the field is sure of and that overlap no base span."""
    labels = observed(found, spans)
    chance = marginals(found, labels, field)
    out: dict[int, list[Span]] = {}
    if len(chance):
        best = chance.argmax(1)
        sure = (labels == 0) & (best > 0) & (chance.max(1) >= SURE) & (found.end > found.start)
        for i in np.flatnonzero(sure).tolist():
            span = (KINDS[best[i] - 1], int(found.start[i]), int(found.end[i]))
            out.setdefault(int(found.text[i]), []).append(span)
    return out


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            for part, data, offsets in slices(batch):
                found, spans, whole = _read(part, data, offsets)
                more = added_spans(found, spans, field)
                rows = [[]] * part.num_rows
                marks = [[]] * part.num_rows
                for i in {*spans, *more}:
                    text = whole[offsets[i] : offsets[i + 1]]
                    rows[i] = in_code_points(text, spans.get(i, []) + more.get(i, []), KINDS)
                    marks[i] = in_code_points(text, spans.get(i, []), KINDS)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), spans_array(rows), spans_array(marks)],
                    ["doc_id", "spans", "base"],
                )

    return run


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, spans, base) for every row of ``docs`` (doc_id, text).

    ``base`` are the patterns' spans, ``spans`` these and what the field adds, in code points
    by start and kind. A null or empty text has none. Where no token is found to learn from,
    the field adds nothing it is sure of. No rows give no rows.
    """
    field = docs.sparkSession.sparkContext.broadcast(learn(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {SPANS_SQL}, {SPANS_SQL.replace('spans', 'base', 1)}"
    return docs.select("doc_id", "text").mapInArrow(_find(field), schema)
