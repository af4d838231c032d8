"""Secrets in whole texts, by rules over a trigram inverted index.

From every rule's regex a Boolean query of trigrams is derived that each match satisfies. A
slice of texts is indexed by the trigrams that some rule asks for; a query intersects and
unites their postings, and only the texts it leaves are searched with the regex. A rule
without a mandatory trigram is searched for in every text.

The index lives where the texts are: postings of a slice, made and asked in one pass, so
nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cratewise.llm.spans import SPANS_SQL, Span, in_code_points, spans_array
from cratewise.llm.words import slices

# A match must hold, of each clause, one string with all its trigrams.
Query = list[list[set[bytes]]]

_MOST_STRINGS = 64


def _joined(strings: list[bytes], parts: list[bytes]) -> list[bytes] | None:
    return [a + b for a, b in product(strings, parts)] if len(strings) * len(parts) <= _MOST_STRINGS else None


def _strings(parsed) -> list[bytes] | None:
    """All strings that a parsed piece matches, if these are few; else None."""
    strings = [b""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            parts = [bytes([value])]
        elif name == "IN" and all(str(k) == "LITERAL" for k, _ in value):
            parts = [bytes([x]) for _, x in value]
        elif name == "SUBPATTERN":
            parts = _strings(value[3])
        elif name == "BRANCH":
            options = [_strings(x) for x in value[1]]
            parts = None if None in options else [s for option in options for s in option]
        elif name == "MAX_REPEAT" and value[:2] == (0, 1):
            parts = _strings(value[2])
            parts = parts and [b"", *parts]
        else:
            parts = None
        strings = parts and _joined(strings, parts)
        if not strings:
            return None
    return strings


def trigram_query(pattern: bytes) -> Query:
    """Clauses of which a match satisfies all; no clause if nothing is mandatory.

    Letters are taken in lower case, as the index has them.
    """
    clauses, run = [], [b""]

    def close():
        nonlocal run
        if all(len(x) >= 3 for x in run):
            folded = sorted({x.lower() for x in run})
            clauses.append([{x[i : i + 3] for i in range(len(x) - 2)} for x in folded])
        run = [b""]

    def walk(parsed):
        nonlocal run
        for item in parsed:
            name, value = str(item[0]), item[1]
            parts = _strings([item])
            longer = parts and _joined(run, parts)
            if longer:
                run = longer
            elif name == "SUBPATTERN":
                walk(value[3])
            elif name == "MAX_REPEAT" and value[0] >= 1:
                close()
                walk(value[2])
                close()
            else:
                close()

    walk(re._parser.parse(pattern))
    close()
    return clauses


@dataclass
class Rule:
    """A kind of secret: its regex over bytes, and what of a match must be how long.

    ``needs`` is a group that must have matched: a rule may eat what it drops, so that no
    part of a text is read again and again.
    """

    kind: str
    pattern: bytes
    group: int = 0
    least: int = 1
    needs: int = 0
    query: Query = field(init=False)

    def __post_init__(self):
        self.query = trigram_query(self.pattern)

    def find(self, text: bytes) -> list[Span]:
        return [
            (self.kind, *match.span())
            for match in re.finditer(self.pattern, text)
            if match[self.needs] is not None and len(match[self.group]) >= self.least
        ]


# Fixed patterns. A maximal run of 24 or more is the same as a maximal run that is 24 long.
BASE = [
    Rule(
        "assign",
        rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", rb"AKIA[A-Z0-9]+", least=20),
    Rule("hex", rb"[0-9a-f]{24,}"),
]
MORE = [
    Rule("forge", rb"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("chat", rb"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("signed", rb"eyJ[A-Za-z0-9_-]++(\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)?", least=40, needs=1),
    Rule("key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE + MORE

_FOLD = np.arange(256, dtype=np.int32)
_FOLD[65:91] += 32


class Trigrams:
    """The trigrams that some rule asks for, and where a slice's texts have them."""

    def __init__(self, rules: list[Rule]):
        wanted = sorted({t for r in rules for clause in r.query for one in clause for t in one})
        self.number = {trigram: i for i, trigram in enumerate(wanted)}
        self.table = np.zeros(1 << 24, np.uint16)
        for trigram, i in self.number.items():
            self.table[trigram[0] << 16 | trigram[1] << 8 | trigram[2]] = i + 1

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Per trigram, the sorted numbers of the texts that have it."""
        if len(data) < 3:
            return [np.zeros(0, np.int64)] * len(self.number)
        folded = _FOLD[data]
        codes = folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]
        found = self.table[codes]
        at = np.flatnonzero(found)
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 3 <= offsets[text + 1]
        at, text = at[inside], text[inside]
        pairs = np.unique(found[at].astype(np.int64) * len(offsets) + text)
        cuts = np.searchsorted(pairs, np.arange(1, len(self.number) + 2) * len(offsets))
        return [pairs[a:z] % len(offsets) for a, z in zip(cuts[:-1], cuts[1:])]

    def texts(self, query: Query, postings: list[np.ndarray], count: int) -> np.ndarray:
        """Numbers of the texts that satisfy a query."""
        left = np.arange(count)
        for clause in query:
            either = np.zeros(0, np.int64)
            for one in clause:
                own = left
                for trigram in one:
                    own = np.intersect1d(own, postings[self.number[trigram]], assume_unique=True)
                either = np.union1d(either, own)
            left = either
        return left


def _scan(rules: list[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Trigrams(rules)
        kinds = [rule.kind for rule in rules]
        for batch in batches:
            for part, data, offsets in slices(batch):
                postings = index.postings(data, offsets)
                found: dict[int, list[Span]] = {}
                whole = data.tobytes()
                for rule in rules:
                    for number in index.texts(rule.query, postings, part.num_rows).tolist():
                        spans = rule.find(whole[offsets[number] : offsets[number + 1]])
                        if spans:
                            found.setdefault(number, []).extend(spans)
                rows = [
                    in_code_points(whole[offsets[i] : offsets[i + 1]], found[i], kinds)
                    if i in found
                    else []
                    for i in range(part.num_rows)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), spans_array(rows)], ["doc_id", "spans"]
                )

    return run


def secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(doc_id, spans) for every row of ``docs`` (doc_id, text).

    Spans of a kind are the leftmost, non-overlapping matches of its rule, whole matches in
    code points; one that is too short is dropped without another try. Kinds may overlap. A
    null or empty text has none. No rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan(rules), f"doc_id {kind}, {SPANS_SQL}")
