"""Counting quotient filters of packed n-grams, without loss.

The ids of an n-gram's words are packed into 64-bit limbs. An invertible permutation spreads
the first limb, mixed with the others; its top bits are the quotient, all other bits of all
limbs the remainder, which is kept in full. A filter lists its entries by quotient: how many
each quotient has, their remainders in whole bytes, and their counts in a byte each, larger
ones apart. Filters of one range of quotients are sorted alike and merge into one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LARGE = 255


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def _spread(x: np.ndarray, width: int) -> np.ndarray:
    """A bijection of ``width``-bit numbers."""
    shift = np.uint64((width + 1) // 2)
    for odd in _ODD:
        x = x ^ (x >> shift)
        x = (x * np.uint64(odd)) & _mask(width)
    return x ^ (x >> shift)


def _gathered(x: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``_spread``: a shift by half the width or more undoes itself."""
    shift = np.uint64((width + 1) // 2)
    for odd in reversed(_ODD):
        x = x ^ (x >> shift)
        x = (x * np.uint64(pow(odd, -1, 1 << 64))) & _mask(width)
    return x ^ (x >> shift)


@dataclass(frozen=True)
class Packing:
    """How n-grams of ``n`` ids of ``bits`` bits lie in limbs."""

    n: int
    bits: int

    def __post_init__(self):
        if not 1 <= self.bits <= 32:
            raise ValueError("ids must fit 32 bits")

    @property
    def parts(self) -> list[range]:
        """Words of each limb."""
        each = 64 // self.bits
        return [range(at, min(at + each, self.n)) for at in range(0, self.n, each)]

    @property
    def widths(self) -> list[int]:
        return [len(part) * self.bits for part in self.parts]

    def keys(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Permuted limbs of n-grams; ``ids`` has an array per word."""
        limbs = []
        for part, width in zip(self.parts, self.widths):
            limb = np.zeros(len(ids[0]), np.uint64)
            for i in part:
                limb = (limb << np.uint64(self.bits)) | ids[i].astype(np.uint64)
            limbs.append(_spread(limb, width))
        return self._mixed(limbs, 1)

    def ids(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        """The inverse of ``keys``."""
        out = []
        for part, width, limb in zip(self.parts, self.widths, self._mixed(limbs, -1)):
            limb = _gathered(limb, width)
            out += [
                (limb >> np.uint64(self.bits * (len(part) - 1 - i))) & _mask(self.bits)
                for i in range(len(part))
            ]
        return [x.astype(np.int64) for x in out]

    def _mixed(self, limbs: list[np.ndarray], sign: int) -> list[np.ndarray]:
        if len(limbs) == 1:
            return limbs
        width, first = self.widths[0], limbs[0]
        other = sum(_spread(x * np.uint64(_ODD[1]), 64) for x in limbs[1:]) & _mask(width)
        if sign > 0:
            first = _spread((first + other) & _mask(width), width)
        else:
            first = (_gathered(first, width) - other) & _mask(width)
        return [first, *limbs[1:]]

    def top(self, first: np.ndarray, bits: int) -> np.ndarray:
        """The first ``bits`` bits of the quotient, or all bits of a shorter limb."""
        return first >> np.uint64(max(self.widths[0] - bits, 0))


def combined(limbs: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(counts):
        return limbs, counts
    # Stable: sorted runs one after another are merged.
    order = np.argsort(limbs[0], kind="stable")
    if len(limbs) > 1:
        same = ~_steps(limbs[0][order])
        if any((_steps(x[order]) & same).any() for x in limbs[1:]):
            order = np.lexsort(limbs[::-1])
    limbs = [x[order] for x in limbs]
    counts = counts[order]
    del order
    new = np.zeros(len(counts), bool)
    new[0] = True
    for x in limbs:
        new[1:] |= _steps(x)
    at = np.flatnonzero(new)
    return [x[at] for x in limbs], np.add.reduceat(counts, at)


def _steps(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    return x[1:] != x[:-1]


def _low_bytes(x: np.ndarray, n: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes()


def _from_low_bytes(data: bytes, n: int, rows: int) -> np.ndarray:
    wide = np.zeros((rows, 8), np.uint8)
    wide[:, :n] = np.frombuffer(data, np.uint8).reshape(rows, n)
    return wide.view("<u8").reshape(-1)


# A filter as columns of a row: quotients of the range, entries of each, remainders, counts.
COLUMNS = "quotient_bits int, runs binary, rest binary, counts binary, large binary"


def write(packing: Packing, limbs: list[np.ndarray], counts: np.ndarray, range_bits: int) -> tuple:
    """A filter of sorted distinct keys of one range, as the values of COLUMNS."""
    width = packing.widths[0]
    left = max(width - range_bits, 0)
    bits = min(left, max(int(len(counts)).bit_length() - 1, 0))
    inner = limbs[0] & _mask(left)
    quotients = (inner >> np.uint64(left - bits)).astype(np.int64)
    runs = np.bincount(quotients, minlength=1 << bits)
    kind = np.uint8 if runs.max(initial=0) < 256 else np.uint32
    rest = _low_bytes(inner & _mask(left - bits), (left - bits + 7) // 8)
    for limb, w in zip(limbs[1:], packing.widths[1:]):
        rest += _low_bytes(limb, (w + 7) // 8)
    small = np.minimum(counts, _LARGE).astype(np.uint8)
    return bits, runs.astype(kind).tobytes(), rest, small.tobytes(), counts[counts >= _LARGE].tobytes()


def read(packing: Packing, row: tuple, range_no: int, range_bits: int):
    """Keys and counts of a filter."""
    bits, runs, rest, counts, large = row
    width = packing.widths[0]
    left = max(width - range_bits, 0)
    kind = np.uint8 if len(runs) == 1 << bits else np.uint32
    quotients = np.repeat(np.arange(1 << bits, dtype=np.uint64), np.frombuffer(runs, kind))
    rows, at, n = len(quotients), 0, (left - bits + 7) // 8
    first = _from_low_bytes(rest[: rows * n], n, rows) | (quotients << np.uint64(left - bits))
    first |= np.uint64(range_no << left)
    limbs, at = [first], rows * n
    for w in packing.widths[1:]:
        n = (w + 7) // 8
        limbs.append(_from_low_bytes(rest[at : at + rows * n], n, rows))
        at += rows * n
    out = np.frombuffer(counts, np.uint8).astype(np.int64)
    out[out == _LARGE] = np.frombuffer(large, np.int64)
    return limbs, out
