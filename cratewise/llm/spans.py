"""Spans in texts: found in UTF-8 bytes, told in code points, sorted by start and kind."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Span = tuple[str, int, int]

SPANS_SQL = "spans array<struct<kind: string, start: bigint, end: bigint>>"
SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def in_code_points(text: bytes, spans: Iterable[Span], kinds: list[str]) -> list[Span]:
    """Spans of byte offsets as spans of code points, by start and then by kind as listed."""
    found = sorted(spans, key=lambda span: (span[1], kinds.index(span[0]), span[2]))
    if not found or text.isascii():
        return found
    points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    upto = lambda at: int(points[at - 1]) if at else 0
    return [(kind, upto(start), upto(end)) for kind, start, end in found]


def spans_array(rows: list[list[Span]]) -> pa.Array:
    """A column of span lists."""
    flat = [span for row in rows for span in row]
    offsets = np.cumsum([0, *map(len, rows)])
    values = pa.StructArray.from_arrays(
        [
            pa.array([x[0] for x in flat], pa.string()),
            pa.array([x[1] for x in flat], pa.int64()),
            pa.array([x[2] for x in flat], pa.int64()),
        ],
        names=["kind", "start", "end"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    part = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    return F.concat_ws(",", F.transform(spans, part))


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(kinds))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(of_kinds(spans, [kind])).cast("bigint")
