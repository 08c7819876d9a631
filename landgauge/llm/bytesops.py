"""Words, lines and hashes over a whole batch of UTF-8 texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from xxhash import xxh3_64_intdigest

U = np.uint64
#: Bytes of a range up to which sums modulo 2^64 are its hash.
SHORT = 64
#: An odd multiplier and its inverse modulo 2^64, for hashes of any byte range by prefix sums.
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)
_BYTES = np.random.default_rng(20231).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64; kept in a table that doubles."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        steps = np.full(size, base, U)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all 64 bits."""
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    sums = np.empty(len(buf) + 1, U)
    sums[0] = 0
    terms = _BYTES[buf]
    terms *= powers(STEP, len(buf))
    np.cumsum(terms, out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, buf: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the bytes in [start, end) that does not depend on where they stand.

    Sums modulo 2^64 are weak for long regular texts; with ``buf``, the bytes summed, longer ranges get another hash."""
    raw = (sums[ends] - sums[starts]) * powers(BACK, len(sums))[starts]
    out = mix(raw + (ends - starts).astype(U))
    if buf is not None:
        data = memoryview(np.ascontiguousarray(buf))
        for i in np.flatnonzero(ends - starts > SHORT).tolist():
            out[i] = xxh3_64_intdigest(data[starts[i] : ends[i]])
    return out


def word_bounds(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes; none crosses the border of two texts."""
    n = len(is_word)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    starts = np.flatnonzero(is_word & (~before | border[:-1]))
    ends = np.flatnonzero(is_word & (~after | border[1:])) + 1
    return starts, ends


def rows_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text in which each position lies."""
    return np.searchsorted(offsets, positions, side="right") - 1


def counts_of(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges [start, start + length), one range after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)


def chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive items, by the place of its first item."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, U)
    out = hashes[:n].copy()
    for k in range(1, width):
        out *= U(STEP)
        out += hashes[k : k + n]
        out ^= out >> U(29)
    return mix(out)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the ranges."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true places; none crosses a border."""
    return word_bounds(mask, offsets)


def slabs(buf: np.ndarray, offsets: np.ndarray, cut: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes; each ends at the border of a text or before a byte that ``cut`` marks."""
    at = 0
    while at < len(buf):
        end = at + limit
        border = int(offsets[min(np.searchsorted(offsets, end), len(offsets) - 1)])
        while end < border:
            free = np.flatnonzero(cut[buf[end : min(border, end + 65536)]])
            if len(free):
                border = end + int(free[0])
                break
            end += 65536
        yield at, border
        at = border
