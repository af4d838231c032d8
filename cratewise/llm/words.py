"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A text's words are runs of bytes that a 256-entry table marks as word bytes; all word
rules used here can be decided byte by byte in UTF-8. Every word gets a 64-bit hash
from differences of a running sum, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def byte_table(separators: bytes, fold: bool) -> np.ndarray:
    """A 64-bit value per byte, 0 for separators; ``fold`` gives A-Z the values of a-z."""
    table = np.random.default_rng(20011).integers(1, 1 << 63, 256, dtype=np.uint64)
    if fold:
        table[65:91] = table[97:123]
    table[list(separators)] = 0
    return table


# Separators \x20\x09-\x0D, case kept.
SPACED = byte_table(bytes([32, *range(9, 14)]), fold=False)
# The same, A-Z lower-cased.
SPACED_FOLDED = byte_table(bytes([32, *range(9, 14)]), fold=True)
# Words of digits, a-z and all beyond ASCII; A-Z lower-cased.
ALNUM_FOLDED = byte_table(
    bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), fold=True
)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    out = values ^ (values >> np.uint64(33))
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(33)
    return out


def six_bytes(values: np.ndarray) -> bytes:
    """The low 48 bits of 64-bit numbers, in six bytes each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def from_six_bytes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").reshape(-1)


class _Powers:
    """Powers of the multiplier and of its inverse, as far as asked for."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, hashes, and where each text's words lie."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # text i has words first[i]:first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def split_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    n = len(data)
    inside = np.zeros(n + 1, bool)
    values = table[data]
    inside[:n] = values != 0
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:]
    stops = np.zeros(n + 1, bool)
    stops[1:] = inside[:-1] & (~inside[1:] | edge[1:])
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    up, down = _Powers.of(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], dtype=np.uint64, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return Words(data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))


def sequence_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position; shorter by k - 1 than ``hashes``."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        out = out * _STEP + hashes[i : i + n]
    return mixed(out)


def whole_sequences(words: Words, k: int) -> np.ndarray:
    """Mask over positions: ``k`` words from there lie in one text."""
    n = max(0, len(words.hashes) - k + 1)
    last = np.repeat(words.first[1:], words.counts)
    return np.arange(n) + k <= last[:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    if texts.buffers()[2] is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows with about ``limit`` bytes of text at most, or one row beyond it."""
    data, offsets = buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], (
            offsets[at : to + 1] - offsets[at]
        )
        at = to
