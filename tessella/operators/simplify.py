"""Lines with fewer corners."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessella.session import ship


def corners_kept(x: np.ndarray, y: np.ndarray, tolerance: float, least: int = 4) -> np.ndarray:
    """Which corners of a line stay (Douglas and Peucker's rule): its ends, and between two that stay the one farthest from their segment, the first of such, if farther than ``tolerance``.

    A line of fewer than ``least`` corners stays as it is. Stretches wait on a stack, so a long line needs no deep recursion.
    """
    keep = np.zeros(len(x), bool)
    if len(x) < least:
        return ~keep
    keep[[0, -1]] = True
    # A stretch of fewer than ``least`` corners, too, stays whole.
    stack = [(0, len(x) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a + 1 < least:
            keep[a : b + 1] = True
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        px, py, scale = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a], dx * dx + dy * dy
        t = np.clip((px * dx + py * dy) / scale, 0.0, 1.0) if scale else np.zeros(len(px))
        d2 = (px - t * dx) ** 2 + (py - t * dy) ** 2
        far = int(d2.argmax())
        if d2[far] > tolerance * tolerance:
            at = a + 1 + far
            keep[at] = True
            stack += [(a, at), (at, b)]
    return keep


def simplified(rows: DataFrame, line: str, tolerance: str, least: int = 4) -> DataFrame:
    """``rows`` with the array of struct(x, y) in ``line`` thinned to within ``tolerance`` (a column; null or a null line: as it is).

    Arrow batches of lines: the work on one line is in arrays, and Spark deals out the lines. A closed ring keeps its first and last corner, which
    are the same. A null among the coordinates fails the batch.
    """
    ship(rows.sparkSession)
    at, by = rows.columns.index(line), rows.columns.index(tolerance)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at)
            points = old.flatten()
            if points.null_count or any(points.field(c).null_count for c in ("x", "y")):
                raise ValueError("a line has a corner without coordinates")
            x, y = (points.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("x", "y"))
            sizes = pc.list_value_length(old).fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            limits = batch.column(by).to_pylist()
            keep = np.concatenate([np.zeros(0, bool), *[corners_kept(x[i:j], y[i:j], t, least) if t is not None else np.ones(j - i, bool) for i, j, t in zip(starts, starts[1:], limits, strict=False)]])
            left = np.concatenate([[0], np.cumsum(keep)])[starts]
            offsets = pa.array(left, pa.int32(), mask=np.append(old.is_null().to_numpy(zero_copy_only=False), False))
            new = pa.ListArray.from_arrays(offsets, points.filter(pa.array(keep)), type=old.type)
            yield pa.RecordBatch.from_arrays([new if k == at else c for k, c in enumerate(batch.columns)], schema=batch.schema)

    return rows.mapInArrow(thin, rows.schema)
