"""Slice stacks: alignment, derived fields, limits, profiles.

A slice is one row with a flat array, so elementwise work stays inside the row
and needs no cell table; cells are exploded only where the result is per cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.grid import Axis, StoredAxis, bilinear, half_open_count, half_open_point
from gridloom.functions.scalars import NAN, is_finite, safe_divide_arrays
from gridloom.operators.ordered import Ordered
from gridloom.operators.selection import percentiles
from gridloom.operators.skew import sized


def cells(slices: DataFrame, data: str = "data", ny: str = "ny") -> DataFrame:
    """Long form: (i, j, v) per cell, x being the slow axis."""
    keep = [c for c in slices.columns if c != data]
    return (
        slices.select(*keep, F.posexplode(data).alias("_p", "v"))
        .withColumn("i", F.expr(f"_p div {ny}")).withColumn("j", F.expr(f"_p % {ny}")).drop("_p")
    )


def frame_index(slices: DataFrame, keys: Sequence[str] = ("run", "variable")) -> DataFrame:
    """Number the slices of each variable by iteration from 0.

    Only (keys, iteration) is ordered; the arrays are joined to the result
    instead of being sorted.
    """
    on = [*keys, "iteration"]
    index = Ordered.of(slices.select(*on).distinct(), keys, "iteration").index("frame_idx").result()
    return slices.join(sized(index), on)


def frame_count(indexed: DataFrame, keys: Sequence[str] = ("run",)) -> DataFrame:
    """Frames every variable of a run has: the shortest wins."""
    return (
        indexed.groupBy(*keys, "variable").agg(F.count(F.lit(1)).alias("_c"))
        .groupBy(*keys).agg(F.min("_c").alias("n_frames"))
    )


def align_frames(slices: DataFrame, variables: Mapping[str, str], keys: Sequence[str] = ("run",)) -> DataFrame:
    """One row per (run, frame index) with each variable's slice as a struct column named by alias.

    Index-aligned: frame k of every variable, whatever its iteration; frames
    beyond the shortest variable drop out. A single grouping by frame replaces
    a join per variable.
    """
    used = slices.filter(F.col("variable").isin(*set(variables.values())))
    indexed = frame_index(used, [*keys, "variable"])
    row = F.struct("iteration", "time", "data")
    return (
        indexed.groupBy(*keys, "frame_idx")
        .agg(*[F.first(F.when(F.col("variable") == v, row), ignorenulls=True).alias(a) for a, v in variables.items()])
        .filter(" and ".join(f"`{a}` is not null" for a in variables))
    )


def derived(frames: DataFrame, out: str, num: str, den: str) -> DataFrame:
    """Elementwise safe ratio of two aligned slices."""
    return frames.withColumn(out, safe_divide_arrays(F.col(f"{num}.data"), F.col(f"{den}.data")))


def map_cells(data: Column | str, fn: Callable[[Column], Column]) -> Column:
    return F.transform(data, fn)


def finite_values(data: Column | str, positive: bool = False) -> Column:
    keep = (lambda v: is_finite(v) & (v > 0)) if positive else is_finite
    return F.filter(data, keep)


def slice_extrema(slices: DataFrame, data: str = "data") -> DataFrame:
    """v_max and v_min of every slice over its finite cells, without leaving the row."""
    good = finite_values(data)
    return slices.withColumns({"v_max": F.array_max(good), "v_min": F.array_min(good)}).drop(data)


def nan_count(data: Column | str) -> Column:
    return F.size(F.filter(data, lambda v: v.isNull() | F.isnan(v))).cast("bigint")


def colour_limits(
    values: DataFrame, keys: Sequence[str], value: str, *, log: bool = False,
    vmin: float | None = None, vmax: float | None = None,
) -> DataFrame:
    """1st and 99th percentile of the finite (for `log` positive) values of each canvas.

    Exact for canvases of any size, with bounded state (see `selection`). Equal limits are spread to vmin * 1.01, or 1 when vmin is 0. `log_norm` tells
    whether a log scale applies. Canvases without usable values are absent.
    """
    keep = is_finite(value) & (F.col(value) > 0) if log else is_finite(value)
    limits = (
        percentiles(values.filter(keep), keys, value, (0.01, 0.99), "_p")
        .withColumn("vmin", F.col("_p")[0] if vmin is None else F.lit(float(vmin)))
        .withColumn("_hi", F.col("_p")[1] if vmax is None else F.lit(float(vmax)))
    )
    spread = F.when(F.col("vmin") != 0, F.col("vmin") * 1.01).otherwise(F.lit(1.0))
    return limits.select(
        *keys, "vmin",
        F.when(F.col("vmin") == F.col("_hi"), spread).otherwise(F.col("_hi")).alias("vmax"),
        (F.lit(log) & (F.col("vmin") > 0)).alias("log_norm"),
    )


def zoom(cell_rows: DataFrame, track: DataFrame, on: Sequence[str], half_width: float = 1.75) -> DataFrame:
    """Cells within +-half_width of the tracked centre (columns cx, cy) of their iteration."""
    c = cell_rows.join(track.select(*on, "cx", "cy"), list(on))
    return c.filter(
        F.col("x").between(F.col("cx") - half_width, F.col("cx") + half_width)
        & F.col("y").between(F.col("cy") - half_width, F.col("cy") + half_width)
    )


def polar_mean(
    slices: DataFrame, keys: Sequence[str], *, x0: float, y0: float, dx: float, dy: float,
    nx: str = "nx", ny: str = "ny", r_start: float, r_stop: float, r_step: float, n_phi: int = 501,
    data: str = "data", transposed: bool = False,
) -> DataFrame:
    """Azimuthal mean per radius: rows (keys, k, r, mean).

    The slice is sampled bilinearly at (r cos phi, r sin phi), continuing
    linearly past its edges, and averaged over n_phi angles 2 pi / n_phi apart.
    Every slice row explodes to its own polar mesh and reads its own array; the
    mean combines on the map side. `transposed` swaps the roles of the two axes
    in the lookup, as interpolators given (x, y) axes for [y, x] data do.
    """
    n_r = half_open_count(r_start, r_stop, r_step)
    d_phi = 2 * math.pi / n_phi
    if not n_r:
        raise ValueError("empty radius range")
    n_angles = half_open_count(0.0, 2 * math.pi, d_phi)
    zero = F.lit(0.0)
    xa, ya = StoredAxis("x"), StoredAxis("y")
    first, second = ("_py", "_px") if transposed else ("_px", "_py")
    mesh = (
        slices.select(
            *keys, F.col(data).alias("_data"), F.col(ny).cast("int").alias("_ny"),
            *[
                c.alias(n) for n, c in {
                    **xa.columns(Axis(F.lit(float(x0)), zero, F.lit(float(dx)), F.col(nx))),
                    **ya.columns(Axis(F.lit(float(y0)), zero, F.lit(float(dy)), F.col(ny))),
                }.items()
            ],
        )
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n_r - 1))))
        .withColumn("r", half_open_point(F.col("k"), r_start, r_step))
        .withColumn("_m", F.explode(F.sequence(F.lit(0), F.lit(n_angles - 1))))
        .withColumn("_phi", F.col("_m") * F.lit(d_phi))
        .withColumns({"_px": F.col("r") * F.cos("_phi"), "_py": F.col("r") * F.sin("_phi")})
    )
    mesh = xa.locate(mesh, first, nearest=False, linear=True)
    mesh = ya.locate(mesh, second, nearest=False, linear=True)

    def pick(i: Column, j: Column) -> Column:
        return F.get("_data", i * F.col("_ny") + j)

    return (
        mesh.select(*keys, "k", "r", bilinear(pick, "x", "y").alias("_v"))
        .groupBy(*keys, "k", "r").agg((F.sum("_v") * d_phi / 2 / math.pi).alias("mean"))
    )


def to_slices(canvas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Canvas points to slice rows, x first; each group is one canvas of fixed size.

    Columns of one x are gathered first, then the columns, so that no buffer
    holds more than one canvas of plain doubles.
    """
    line = F.transform(F.array_sort(F.collect_list(F.struct("j", "v"))), lambda s: s["v"])
    stack = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "_line"))), lambda s: s["_line"]))
    return (
        canvas.select(*keys, "i", "j", F.coalesce("v", F.lit(NAN)).alias("v"))
        .groupBy(*keys, "i").agg(line.alias("_line"))
        .groupBy(*keys).agg(
            F.count(F.lit(1)).cast("int").alias("nx"), F.max(F.size("_line")).alias("ny"), stack.alias("data")
        )
    )
