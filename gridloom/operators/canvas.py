"""Canvases painted from rectangles: one rectangle per chunk, one shuffle of rectangles, no rows of points.

Lookups on a uniform grid separate into a row and a column part, so a chunk paints the rectangle of
canvas points it covers with two index vectors. Rectangles are cut into blocks of canvas lines of at
most BLOCK points and shuffled by canvas and block; each block is filled in paint order. Where
a canvas has several blocks, a second shuffle puts them side by side. A canvas whose chunks cover more than
POINTS points is dealt by a hash of the paint order into parts: each part is painted in its own task, points
keep the order of what is on top, and parts are laid over one another, FAN at a time. A chunk's array is read in
place by base and strides, so a cut through a 3D array is painted like a plane.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.skew import is_small, join_keys

#: Canvas points that one task fills at a time.
BLOCK = 1 << 20
#: Points of rectangles that one task paints, about; a rectangle counts for EACH more.
POINTS, EACH = 8 << 20, 64
#: Parts laid over one another at a time.
FAN = 8


def grid_points(lo: float, hi: float, n: int) -> np.ndarray:
    """n evenly spaced points from lo to hi, both exact."""
    points = lo + np.arange(n) * ((hi - lo) / max(n - 1, 1))
    if n > 1:
        points[-1] = hi
    return points


class Lookup:
    """Where the points of a canvas axis fall on a chunk's axis: covered points, nearest centre, interval."""

    def __init__(self, points: np.ndarray, origin: float, start: float, step: float, n: int):
        at = lambda k: origin + (start + k) * step
        first, last = at(0), at(n - 1)
        low, high, half = min(first, last), max(first, last), abs(step) / 2 if n > 1 else 0.0
        self.covered = np.flatnonzero((points >= low - half) & (points <= high + half))
        x, up = points[self.covered], 1 if step > 0 else -1
        u = (x - first) / step
        b = (np.floor(u) if up > 0 else np.ceil(u)).astype(np.int64)
        before, after = b.clip(0, n - 1), (b + up).clip(0, n - 1)
        self.nearest = np.where(np.abs(x - at(before)) < np.abs(x - at(after)), before, after)
        e = np.where(x >= at(b + up), b + up, np.where(x < at(b), b - up, b))
        self.p0 = np.maximum(0, np.minimum(n - 2, e)) if up > 0 else np.maximum(1, np.minimum(n - 1, e))
        self.p1 = self.p0 + up
        with np.errstate(divide="ignore", invalid="ignore"):
            self.w = (x - at(self.p0)) / (at(self.p1) - at(self.p0))
        self.hull = (x >= low) & (x <= high) & (n > 1)


def rectangle(data: np.ndarray, base: int, slow: int, fast: int, y: Lookup, x: Lookup, linear: bool) -> np.ndarray:
    """Values at the covered points, NaN where the array has none."""

    def pick(j: np.ndarray, i: np.ndarray) -> np.ndarray:
        k = base + j[:, None] * slow + i[None] * fast
        there = (k >= 0) & (k < len(data))
        return np.where(there, data[np.where(there, k, 0)], np.nan) if len(data) else np.full(k.shape, np.nan)

    values = pick(y.nearest, x.nearest)
    if linear:
        wy, wx = y.w[:, None], x.w[None]
        between = (
            pick(y.p0, x.p0) * (1 - wy) * (1 - wx) + pick(y.p0, x.p1) * (1 - wy) * wx
            + pick(y.p1, x.p0) * wy * (1 - wx) + pick(y.p1, x.p1) * wy * wx
        )
        values = np.where(y.hull[:, None] & x.hull[None], between, values)
    return values


def parted(flat: DataFrame, keys: Sequence[str], area: Column) -> tuple[DataFrame, int]:
    """flat + _part, by a hash of _prio, and the most parts of a canvas; from metadata alone."""
    parts = flat.groupBy(*keys).agg(F.ceil(F.sum(area + EACH) / POINTS).cast("int").alias("_parts")).where("_parts > 1")
    most = parts.agg(F.max("_parts")).first()[0]
    if most is None:
        return flat.withColumn("_part", F.lit(0)), 1
    salt = F.pmod(F.xxhash64("_prio"), F.coalesce("_parts", F.lit(1))).cast("int")
    return join_keys(flat, parts, keys, broadcast=is_small(parts)).withColumn("_part", salt).drop("_parts"), most


#: What a row tells of its chunk besides keys, order and array: axes, counts, place in the array, canvas box.
ROW = (
    "_yo", "_ys", "_yd", "_xo", "_xs", "_xd", "_yn", "_xn", "_base", "_slow", "_fast", "x_min", "x_max", "y_min", "y_max",
)


def painted(flat: DataFrame, keys: Sequence[str], nx: int, ny: int, method: str, x_first: bool = False) -> DataFrame:
    """Canvases (keys, data) of the rows of `flat`: keys, _prio (paint order as a string), _data and ROW; NaN where nothing was written.

    `data` runs along x first in memory order y, x; with `x_first` in order x, y.
    """
    if method not in ("nearest", "linear"):
        raise ValueError(f"method must be 'nearest' or 'linear', not {method!r}")
    keys, linear = list(keys), method == "linear"

    def across(n: str, points: int) -> Column:
        step = (F.col(f"{n}_max") - F.col(f"{n}_min")) / max(points - 1, 1)
        return F.least(F.lit(float(points)), F.coalesce(F.try_divide(F.col(f"_{n}n") * F.abs(f"_{n}d"), step), F.lit(float(points))) + 2)

    flat, most = parted(flat, keys, across("y", ny) * across("x", nx))
    key_fields = [flat.schema[k] for k in keys]
    lines = max(1, BLOCK // nx)
    blocks = -(-ny // lines)
    piece = T.StructType([
        *key_fields, T.StructField("_prio", T.StringType()), T.StructField("_part", T.IntegerType()), T.StructField("_block", T.IntegerType()),
        *[T.StructField(n, T.IntegerType()) for n in ("_j", "_i", "_w")], T.StructField("_v", T.BinaryType()),
    ])

    def paint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, grids = set(), {}

        def grid(lo: float, hi: float, n: int) -> np.ndarray:
            if (lo, hi, n) not in grids:
                grids[lo, hi, n] = grid_points(lo, hi, n)
            return grids[lo, hi, n]

        for batch in batches:
            canvases = list(zip(*[batch.column(k).to_pylist() for k in keys]))
            column = {n: batch.column(n).to_pylist() for n in ROW}
            offsets, flat_data = batch.column("_data").offsets.to_numpy(), batch.column("_data").values.to_numpy(zero_copy_only=False)
            made = []
            for r in range(batch.num_rows):
                ys, xs = (grid(column[f"{n}_min"][r], column[f"{n}_max"][r], size) for n, size in (("y", ny), ("x", nx)))
                y = Lookup(ys, *(column[f"_y{p}"][r] for p in "osd"), column["_yn"][r])
                x = Lookup(xs, *(column[f"_x{p}"][r] for p in "osd"), column["_xn"][r])
                if canvases[r] not in seen:
                    seen.add(canvases[r])
                    made.append((r, 0, 0, 0, 0, b""))  # the canvas exists, whatever is written
                if not len(y.covered) or not len(x.covered):
                    continue
                values = rectangle(flat_data[offsets[r] : offsets[r + 1]], *(column[n][r] for n in ("_base", "_slow", "_fast")), y, x, linear)
                j0, i0 = int(y.covered[0]), int(x.covered[0])
                for b in range(j0 // lines, int(y.covered[-1]) // lines + 1):
                    a, z = max(j0, b * lines), min(int(y.covered[-1]) + 1, (b + 1) * lines)
                    made.append((r, b, a - b * lines, i0, values.shape[1], np.ascontiguousarray(values[a - j0 : z - j0]).tobytes()))
            row = pa.array([m[0] for m in made], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(row) for k in (*keys, "_prio", "_part")], *[pa.array([m[c] for m in made], pa.int32()) for c in (1, 2, 3, 4)], pa.array([m[5] for m in made], pa.binary())],
                [*keys, "_prio", "_part", "_block", "_j", "_i", "_w", "_v"])

    def turned(canvas: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(canvas.T) if x_first else canvas

    def slice_row(table: pa.Table, names: list[str], values: np.ndarray) -> pa.Table:
        """The first row's `names` with the values as one list; NaN stays NaN."""
        data = pa.ListArray.from_arrays(pa.array([0, values.size], pa.int32()), pa.array(values.ravel()))
        return pa.table([*[table.column(n).slice(0, 1) for n in names], data], [*names, "data"])

    def blank(table: pa.Table) -> np.ndarray:
        block = table.column("_block")[0].as_py()
        return np.full((min(lines, ny - block * lines), nx), np.nan)

    def pieces(table: pa.Table) -> list[tuple]:
        return sorted(zip(*[map(int, table.column("_prio").to_pylist()), *[table.column(c).to_pylist() for c in ("_j", "_i", "_w", "_v")]]))

    def block_row(table: pa.Table, canvas: np.ndarray) -> pa.Table:
        return slice_row(table, [*keys, "_block"], turned(canvas) if blocks == 1 else canvas)

    def fill(table: pa.Table) -> pa.Table:
        canvas = blank(table)
        for _, j, i, w, v in pieces(table):
            if w:
                values = np.frombuffer(v).reshape(-1, w)
                np.copyto(canvas[j : j + len(values), i : i + w], values, where=np.isfinite(values))
        return block_row(table, canvas)

    def part_row(table: pa.Table, canvas: np.ndarray, top: np.ndarray, orders: list[int]) -> pa.Table:
        """The written points of a part: place, value and, as an index into `_orders`, paint order."""
        at = np.flatnonzero(top.ravel() >= 0)
        used, order = np.unique(top.ravel()[at], return_inverse=True)
        own = {
            "_at": pa.array([at.astype(np.int32).tobytes()], pa.binary()), "_v": pa.array([canvas.ravel()[at].tobytes()], pa.binary()),
            "_top": pa.array([order.astype(np.int32).tobytes()], pa.binary()), "_orders": pa.array([[str(orders[k]) for k in used]], pa.list_(pa.string())),
        }
        names = [*keys, "_block", "_part"]
        return pa.table([*[table.column(n).slice(0, 1) for n in names], *own.values()], [*names, *own])

    def fill_part(table: pa.Table) -> pa.Table:
        canvas, orders = blank(table), []
        top = np.full(canvas.shape, -1, np.int32)
        for prio, j, i, w, v in pieces(table):
            if w:
                values = np.frombuffer(v).reshape(-1, w)
                there = np.isfinite(values)
                np.copyto(canvas[j : j + len(values), i : i + w], values, where=there)
                top[j : j + len(values), i : i + w][there] = len(orders)
                orders.append(prio)
        return part_row(table, canvas, top, orders)

    def laid(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int]]:
        canvas = blank(table)
        top, values = np.full(canvas.size, -1, np.int32), canvas.reshape(-1)
        each = [[int(o) for o in own] for own in table.column("_orders").to_pylist()]
        orders = sorted({o for own in each for o in own})
        place = {o: k for k, o in enumerate(orders)}
        for own, at, v, order in zip(each, *[table.column(c) for c in ("_at", "_v", "_top")]):
            at, v = np.frombuffer(at.as_py(), np.int32), np.frombuffer(v.as_py())
            order = np.array([place[o] for o in own], np.int32)[np.frombuffer(order.as_py(), np.int32)]
            over = order > top[at]
            values[at[over]], top[at[over]] = v[over], order[over]
        return canvas, top.reshape(canvas.shape), orders

    def lay(table: pa.Table) -> pa.Table:
        return part_row(table, *laid(table))

    def lay_last(table: pa.Table) -> pa.Table:
        return block_row(table, laid(table)[0])

    def beside(table: pa.Table) -> pa.Table:
        canvas = np.full((ny, nx), np.nan)
        column = table.column("data").combine_chunks()
        for block, data in zip(table.column("_block").to_pylist(), column):
            own = data.values.to_numpy().reshape(-1, nx)
            canvas[block * lines : block * lines + len(own)] = own
        return slice_row(table, keys, turned(canvas))

    data = T.StructField("data", T.ArrayType(T.DoubleType()))
    block_type = T.StructType([*key_fields, T.StructField("_block", T.IntegerType()), data])
    drawn = flat.mapInArrow(paint, piece)
    if most == 1:
        filled = drawn.groupBy(*keys, "_block").applyInArrow(fill, block_type)
    else:
        part_type = T.StructType([
            *key_fields, *[T.StructField(n, T.IntegerType()) for n in ("_block", "_part")], *[T.StructField(n, T.BinaryType()) for n in ("_at", "_v", "_top")],
            T.StructField("_orders", T.ArrayType(T.StringType())),
        ])
        filled = drawn.groupBy(*keys, "_block", "_part").applyInArrow(fill_part, part_type)
        while most > FAN:
            filled = filled.withColumn("_part", F.expr(f"cast(_part div {FAN} as int)")).groupBy(*keys, "_block", "_part").applyInArrow(lay, part_type)
            most = -(-most // FAN)
        filled = filled.groupBy(*keys, "_block").applyInArrow(lay_last, block_type)
    whole = filled if blocks == 1 else filled.groupBy(*keys).applyInArrow(beside, T.StructType([*key_fields, data]))
    return whole.select(*keys, "data")
