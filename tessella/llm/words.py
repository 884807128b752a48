"""Words of many texts at once, as numpy arrays over the texts' UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE, GRAM = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
PIECE = 1 << 18


def letters(separators: bytes, lower: bool) -> np.ndarray:
    """A 64-bit value for each byte, 0 for separators; A-Z like a-z if ``lower``."""
    table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    table[list(separators)] = 0
    return table


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


#: By white space, as written or with A-Z in lower case; by what is neither digit, letter nor beyond ASCII, in lower case.
SPACE = bytes([32, *range(9, 14)])
AS_WRITTEN, LOWERED = letters(SPACE, False), letters(SPACE, True)
ALNUM_LOWERED = letters(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), True)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64, for i below n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, PIECE + 4096)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 4 * PIECE:
            _powers[base] = have
    return have


def _pieces(buf: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about PIECE that end between texts or at separators."""
    at, n = 0, len(buf)
    while at < n:
        to = min(n, at + PIECE)
        if to < n:
            edge = int(bounds[np.searchsorted(bounds, to)])
            while to < edge:
                gap = np.flatnonzero(table[buf[to : min(to + 4096, edge)]] == 0)
                if len(gap):
                    to += int(gap[0])
                    break
                to = min(to + 4096, edge)
        yield at, to
        at = to


def words(buf: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word, and for each text the number of words before it (one more at the end)."""
    starts, ends, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lo, hi in _pieces(buf, bounds, table):
        value = table[buf[lo:hi]]
        word = value != 0
        edges = bounds[np.searchsorted(bounds, lo, "right") : np.searchsorted(bounds, hi)] - lo
        before, after = np.zeros(hi - lo, bool), np.zeros(hi - lo, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        before[edges], after[edges - 1] = False, False
        start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        up, down = powers(BASE, hi - lo)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(value * up[: hi - lo], out=total[1:])
        starts.append(start + lo)
        ends.append(end + lo)
        hashes.append(mixed((total[end] - total[start]) * down[start]))
    start = np.concatenate(starts)
    return start, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(start, bounds)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive words, also where they cross from one text to the next."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for lo in range(0, n, PIECE):
        part = hashes[lo : min(lo + PIECE + k - 1, len(hashes))]
        up, down = powers(GRAM, len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=total[1:])
        m = len(part) - k + 1
        out[lo : lo + m] = mixed((total[k:] - total[:-k]) * down[:m])
    return out


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """The text to which each word belongs."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def inside(bounds: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the first n positions begin k words of one text."""
    ok = np.ones(n, bool)
    for back in range(1, k):
        at = bounds[1:] - back
        at = at[(at >= bounds[:-1]) & (at < n)]
        ok[at] = False
    return ok
