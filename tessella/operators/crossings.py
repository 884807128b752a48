"""Junctions of pairs of roads that lie in one row each: Arrow batches of pairs, worked out as arrays over all their segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Pairs of segments that are looked at together at most, and metres by which boxes are taken to be wider.
CHUNK, EPS = 1 << 18, 1e-6


def _together(first: np.ndarray, size: np.ndarray, second: np.ndarray, width: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of (pair, i, j): every segment i of a pair's one road with every segment j of the other; these begin at ``first`` and ``second``."""
    pair = np.repeat(np.arange(len(size)), size)
    i = first[pair] + np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
    upto = np.cumsum(width[pair])
    at = 0
    while at < len(pair):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CHUNK, "right")))
        n = width[pair[at:to]]
        p = np.repeat(pair[at:to], n)
        yield p, np.repeat(i[at:to], n), second[p] + np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n)
        at = to


def _meet(x1, y1, x2, y2, u1, v1, u2, v2):
    """(which, x, y, overlap): the pairs of segments that share a point, and where; the formulas of ``lines.meetings``."""
    dx, dy, ex, ey = x2 - x1, y2 - y1, u2 - u1, v2 - v1
    turn, offset, aside = dx * ey - dy * ex, (u1 - x1) * dy - (v1 - y1) * dx, (u1 - x1) * ey - (v1 - y1) * ex
    length2 = dx * dx + dy * dy
    with np.errstate(all="ignore"):
        t, u = aside / turn, offset / turn
        p, q = ((u1 - x1) * dx + (v1 - y1) * dy) / length2, ((u2 - x1) * dx + (v2 - y1) * dy) / length2
    first, last = np.maximum(0.0, np.minimum(p, q)), np.minimum(1.0, np.maximum(p, q))
    across, beside = (turn != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1), (turn == 0) & (offset == 0) & (first <= last)
    which = np.flatnonzero(across | beside)
    s = np.where(across, t, first)[which]
    return which, x1[which] + s * dx[which], y1[which] + s * dy[which], (beside & (first < last))[which]


def _foot(x, y, x1, y1, x2, y2):
    """(d2, x, y): the point of a segment nearest to (x, y), and its squared distance; the formulas of ``lines.distance2``."""
    dx, dy = x2 - x1, y2 - y1
    with np.errstate(all="ignore"):
        t = ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)
    t = np.maximum(0.0, np.minimum(1.0, np.where(dx * dx + dy * dy == 0, 0.0, t)))
    fx, fy = x1 + t * dx, y1 + t * dy
    return (x - fx) * (x - fx) + (y - fy) * (y - fy), fx, fy


def _least(pair: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, starts): rows sorted by pair and ``order``, and where each pair's begin."""
    rows = np.lexsort((*order[::-1], pair))
    return rows, np.flatnonzero(np.diff(pair[rows], prepend=-1))


def junctions(ends: np.ndarray, first: np.ndarray, size: np.ndarray, second: np.ndarray, width: np.ndarray, back: np.ndarray, span: float, gap: float) -> tuple[np.ndarray, ...]:
    """(pair, x, y, extent, exact) for the pairs that have a junction, by the rule of ``lines.junctions``. Number n + k stands for pair k of n the other way round, if ``back`` asks for it.

    ``ends``: x1, y1, x2, y2 of all segments; the roads of a pair have ``size`` of them from ``first`` on and ``width`` from ``second`` on.
    """
    n = len(size)
    low, high = np.minimum(ends[:2], ends[2:]) - gap / 2 - EPS, np.maximum(ends[:2], ends[2:]) + gap / 2 + EPS
    met, close = [], []
    for pair, i, j in _together(first, size, second, width):
        near = np.flatnonzero((low[0, i] <= high[0, j]) & (low[0, j] <= high[0, i]))
        near = near[(low[1, i[near]] <= high[1, j[near]]) & (low[1, j[near]] <= high[1, i[near]])]
        pair, i, j = pair[near], i[near], j[near]
        turned = back[pair]
        pair, i, j = np.concatenate([pair, pair[turned] + n]), np.concatenate([i, j[turned]]), np.concatenate([j, i[turned]])
        a, b = ends[:, i], ends[:, j]
        which, x, y, overlap = _meet(*a, *b)
        met.append((pair[which], x, y, overlap))
        for k in (0, 2):
            d2, x, y = _foot(b[k], b[k + 1], *a)
            in_reach = d2 <= gap * gap
            close.append(tuple(c[in_reach] for c in (pair, d2, x, y, (x + b[k]) / 2, (y + b[k + 1]) / 2)))
            d2, u, v = _foot(a[k], a[k + 1], *b)
            in_reach = d2 <= gap * gap
            close.append(tuple(c[in_reach] for c in (pair, d2, a[k], a[k + 1], (a[k] + u) / 2, (a[k + 1] + v) / 2)))
    if not met:
        return tuple(np.zeros(0, t) for t in (int, float, float, float, bool))
    pair, x, y, overlap = (np.concatenate(c) for c in zip(*met, strict=True))
    rows, starts = _least(pair, x, y)
    pair, x, y, overlap = pair[rows], x[rows], y[rows], overlap[rows]
    known = pair[starts], x[starts], y[starts]
    box = [np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts), np.minimum.reduceat(y, starts), np.maximum.reduceat(y, starts)] if len(starts) else [x] * 4
    extent = np.maximum(box[1] - box[0], box[3] - box[2])
    exact = ~(np.logical_or.reduceat(overlap, starts) if len(starts) else overlap) & (extent <= span)
    settled = np.zeros(2 * n, bool)
    settled[known[0][exact]] = True
    # Crossings count as approaches of no distance; their least one and their bounds are known already.
    far = [known[0], np.zeros(len(starts)), known[1], known[2], *box]
    pair, d2, x, y, mx, my = (np.concatenate(c) for c in zip(*close, strict=True))
    left = ~settled[pair]
    pair, d2, x, y, w, e, s, m = (np.concatenate([c[left], f[~exact]]) for c, f in zip((pair, d2, x, y, mx, mx, my, my), far, strict=True))
    rows, starts = _least(pair, d2, x, y)
    if len(starts):
        wide = np.maximum(np.maximum.reduceat(e[rows], starts) - np.minimum.reduceat(w[rows], starts), np.maximum.reduceat(m[rows], starts) - np.minimum.reduceat(s[rows], starts))
    else:
        wide = np.zeros(0)
    least = rows[starts][wide <= span]
    columns = zip((known[0], known[1], known[2], extent), (pair, x, y), strict=False)
    out = [np.concatenate([a[exact], b[least]]) for a, b in columns]
    return *out, np.concatenate([extent[exact], wide[wide <= span]]), np.concatenate([np.ones(int(exact.sum()), bool), np.zeros(len(least), bool)])


def _segments(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ends of all segments, where each list begins, and its size."""
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    return np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in range(4)]), (offsets - offsets[0])[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)


def found(span: float, gap: float):
    """A function for ``mapInArrow``: pairs (names, drawn, others, drawn2, back) to junctions (names, others, forward, x, y, extent, exact)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, first, size), (b, second, width) = _segments(batch.column("drawn")), _segments(batch.column("drawn2"))
            back = batch.column("back").to_numpy(zero_copy_only=False).astype(bool)
            pair, x, y, extent, exact = junctions(np.concatenate([a, b], axis=1), first, size, second + a.shape[1], width, back, span, gap)
            if len(pair):
                row = pa.array(pair % batch.num_rows)
                values = [batch.column("names").take(row), batch.column("others").take(row), pa.array(pair < batch.num_rows), *map(pa.array, (x, y, extent, exact))]
                yield pa.RecordBatch.from_arrays(values, ["names", "others", "forward", "x", "y", "extent", "exact"])

    return work
