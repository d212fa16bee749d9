"""Contour lines of slices: marching squares on whole arrays, crossings chained into lines.

A slice is one row with a flat array, x first, so its contours are found inside the row, a batch
of rows at a time, and nothing is shuffled. A node is numbered i * ny + j; the edge from it along x has number
2 * node, the one along y 2 * node + 1. A line crosses an edge once at most per level, so an
edge number names a point of a line, and cells agree on shared points exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sides of a cell: 0 low y, 1 high x, 2 high y, 3 low x. By the sum of 1, 2, 4 and 8 for the
# corners above the level, anticlockwise from the lowest; each segment (from, to) has them on its left.
_SEGMENTS = [
    [], [(0, 3)], [(1, 0)], [(1, 3)], [(2, 1)], [(0, 3), (2, 1)], [(2, 0)], [(2, 3)],
    [(3, 2)], [(0, 2)], [(1, 0), (3, 2)], [(1, 2)], [(3, 1)], [(0, 1)], [(3, 0)], [],
]
#: The two saddles again, for a centre above the level: the high corners are one region.
_JOINED = {5: [(0, 1), (2, 3)], 10: [(3, 0), (1, 2)]}
_POINT = T.StructType([
    T.StructField("level", T.DoubleType()), T.StructField("line", T.LongType()), T.StructField("closed", T.BooleanType()),
    T.StructField("pos", T.IntegerType()), T.StructField("edge", T.LongType()), T.StructField("_i", T.DoubleType()), T.StructField("_j", T.DoubleType()),
])
_ARROW = [pa.float64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
#: Values of slices whose points are held at once; one slice at least.
PART_VALUES = 1 << 15


def _cases() -> tuple[np.ndarray, np.ndarray]:
    """Sides (from, to) of up to two segments per case, -1 for none; 16 and 17 are the saddles with a high centre."""
    table = np.full((18, 2, 2), -1)
    for k, found in enumerate([*_SEGMENTS, _JOINED[5], _JOINED[10]]):
        for n, side in enumerate(found):
            table[k, n] = side
    return table[:, :, 0], table[:, :, 1]


_FROM, _TO = _cases()


def segments(grid: np.ndarray, level: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of all segments of one level, in the order of cells.

    Cells with a value that is not finite have none. A value equal to the level lies below it. Saddles
    follow the mean of the corners.
    """
    corners = [grid[:-1, :-1], grid[1:, :-1], grid[1:, 1:], grid[:-1, 1:]]
    case = sum((c > level).astype(np.int8) << k for k, c in enumerate(corners))
    finite = np.isfinite(grid)
    whole = finite[:-1, :-1] & finite[1:, :-1] & finite[1:, 1:] & finite[:-1, 1:]
    i, j = np.nonzero(whole & (case > 0) & (case < 15))
    case = case[i, j]
    # Quarters first: the sum of four values may overflow.
    high = sum(c[i, j] / 4 for c in corners) > level
    case = np.where(high & (case == 5), 16, np.where(high & (case == 10), 17, case))
    n = grid.shape[1]
    p = i * n + j
    sides = np.stack([2 * p, 2 * (p + n) + 1, 2 * (p + 1), 2 * p + 1], 1)
    at = np.arange(len(p))[:, None]
    used = _FROM[case] >= 0
    return sides[at, _FROM[case]][used], sides[at, _TO[case]][used]


def chain(a: np.ndarray, b: np.ndarray) -> list[tuple[int, bool, list[int]]]:
    """(name, closed, edges) of each line; a line is named by its least edge, where a closed one starts and ends."""
    after = dict(zip(a.tolist(), b.tolist()))
    ends = set(after.values())
    out = []
    # Open lines first; what they leave are loops, met at their least edge.
    for start in [*sorted(e for e in after if e not in ends), *sorted(e for e in after if e in ends)]:
        if start in after:
            path = [start]
            while path[-1] in after:
                path.append(after.pop(path[-1]))
            out.append((min(path), path[0] == path[-1], path))
    return out


def _slice_lines(data: np.ndarray | None, ny: int | None, levels: np.ndarray | None) -> list[tuple]:
    if data is None or levels is None or not ny or ny < 2 or len(data) < 2 * ny:
        return []
    flat = np.asarray(data, float)
    grid = flat[: len(flat) // ny * ny].reshape(-1, ny)
    out = []
    for level in sorted({float(v) for v in levels if v is not None and np.isfinite(v)}):
        for line, closed, path in chain(*segments(grid, level)):
            edge = np.array(path)
            p, along_x = edge // 2, edge % 2 == 0
            low, high = flat[p], flat[p + np.where(along_x, ny, 1)]
            # Halves, as the difference of two values may overflow.
            part = (level / 2 - low / 2) / (high / 2 - low / 2)
            i, j = p // ny + np.where(along_x, part, 0.0), p % ny + np.where(along_x, 0.0, part)
            out += [(level, line, closed, k, e, x, y) for k, (e, x, y) in enumerate(zip(path, i.tolist(), j.tolist()))]
    return out


def _points(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Columns of the batch but the last three (values, ny, levels), with the points of its slices, about PART_VALUES values at a time."""
    data, ny, levels = (batch.column(k) for k in range(batch.num_columns - 3, batch.num_columns))
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(data), 0), np.int64)
    part = (np.cumsum(sizes) - 1).clip(0) // PART_VALUES
    array = lambda v: v.values.to_numpy(zero_copy_only=False) if v.is_valid else None
    for a, b in pairwise([0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]):
        found = [_slice_lines(array(data[k]), ny[k].as_py(), levels[k].as_py()) for k in range(a, b)]
        take = pa.array(np.repeat(np.arange(a, b), [len(f) for f in found]))
        columns = list(zip(*(p for f in found for p in f))) or [()] * len(_POINT)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k).take(take) for k in range(batch.num_columns - 3)], *[pa.array(c, t) for c, t in zip(columns, _ARROW)]],
            names=[*batch.schema.names[:-3], *_POINT.names])


def lines(
    slices: DataFrame, keys: Sequence[str], levels: Sequence[float] | Column, *,
    x: tuple[float | Column, float | Column] = (0.0, 1.0), y: tuple[float | Column, float | Column] = (0.0, 1.0), data: str = "data", ny: str = "ny",
) -> DataFrame:
    """Points of the contour lines: rows (keys, level, line, closed, pos, edge, x, y).

    `levels` are numbers or an array column; `x` and `y` are first coordinate and step, numbers or columns.
    Higher values lie to the left of a line's direction. A level that is not finite has no lines, one given twice counts once;
    slices narrower than two points and missing ones have none. Slices that share their keys keep their own lines, but cannot be
    told apart by them.
    """
    many = levels if isinstance(levels, Column) else F.array(*[F.lit(float(v)) for v in levels])
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))

    source = slices.select(
        *keys, *[lit(v).cast("double").alias(c) for c, v in zip(("_x0", "_dx", "_y0", "_dy"), (*x, *y))],
        F.col(data).cast("array<double>").alias("_data"), F.col(ny).cast("bigint").alias("_ny"), many.cast("array<double>").alias("_levels"),
    )
    kept = source.drop("_data", "_ny", "_levels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _points(batch)

    rows = source.mapInArrow(run, T.StructType([*kept.schema.fields, *_POINT.fields]))
    return rows.select(
        *keys, "level", "line", "closed", "pos", "edge",
        (F.col("_x0") + F.col("_i") * F.col("_dx")).alias("x"), (F.col("_y0") + F.col("_j") * F.col("_dy")).alias("y"),
    )
