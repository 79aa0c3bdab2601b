"""Words and hashes of many texts at once, on the UTF-8 bytes of an Arrow column.

A word is a longest run of bytes of one class, inside one text.  Its hash is a
polynomial over a random 64-bit value per byte; prefix sums give the hash of
any span without a loop over words.  All memory follows the slice size
(``SLICE`` bytes of text, or one text if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(20240229))
_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)


def byte_class(members) -> np.ndarray:
    """Table of 256 booleans, true for the given byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Runs of anything but space and the ASCII controls 9 to 13.
NOT_SPACE = ~byte_class([0x20, *range(0x09, 0x0E)])
#: ASCII letters and digits and every byte of a character beyond ASCII.
WORD = byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_BASE, 2 * SLICE), _powers(_BASE_INV, 2 * SLICE)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo:hi`` with their bytes and offsets, about ``size`` bytes each; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def spans(data: np.ndarray, at: np.ndarray, table: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of the first word of each text (and the end)."""
    inside = table[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(inside):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edge = at[(at > 0) & (at < len(data))]
        before[edge] = False
        after[edge - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each span; spans are in order of their start. ``lower`` takes A-Z as a-z."""
    out = np.empty(len(starts), dtype=np.uint64)
    values = _VALUES[LOWER] if lower else _VALUES
    lo = 0
    while lo < len(starts):
        first = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, first + SLICE, side="right")))
        last = int(ends[lo:hi].max())
        n = last - first
        power, inverse = (_POW, _INV) if n <= len(_POW) else (_powers(_BASE, n), _powers(_BASE_INV, n))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[data[first:last]] * power[:n], out=sums[1:])
        s, e = starts[lo:hi] - first, ends[lo:hi] - first
        out[lo:hi] = mix((sums[e] - sums[s]) * inverse[np.minimum(s, n - 1)] + (e - s).astype(np.uint64))
        lo = hi
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed long, Spark's type."""
    return x.view(np.int64)
