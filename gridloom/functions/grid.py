"""Uniform-grid arithmetic: coordinates, footprints, nearest and bilinear lookup.

A uniform axis is (first, step, n). Points are found by index arithmetic on the
axis and values by array position in the chunk, so no coordinate is ever joined
against another. Axes may run downwards (step < 0).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid_point(i: Column, lo: Column, hi: Column, n: Column | int) -> Column:
    """Point i of n evenly spaced points from lo to hi, both included and exact."""
    n = F.lit(n) if isinstance(n, int) else n
    step = (hi - lo) / F.greatest(n - 1, F.lit(1))
    return F.when((i == n - 1) & (n > 1), hi).otherwise(lo + i * step)


def half_open_count(start: float, stop: float, step: float) -> int:
    """Length of the half-open range start, start + step, ... below stop."""
    return max(0, math.ceil((stop - start) / step))


def half_open_point(i: Column, start: float, step: float) -> Column:
    return F.lit(float(start)) + i * F.lit(float(step))


def world(offset: Column, index: Column, position: Column, spacing: Column) -> Column:
    return offset + (index + position) * spacing


def cell_edges(first: Column | str, step: Column | str, n: Column | str) -> Column:
    """The n + 1 edges around n cell centres."""
    f, s, n = _col(first), _col(step), _col(n)
    return F.transform(F.sequence(F.lit(0), n.cast("int")), lambda k: f + (k.cast("double") - 0.5) * s)


def clip_index(k: Column, n: Column) -> Column:
    return F.greatest(F.lit(0), F.least(n - 1, k))


@dataclass(frozen=True)
class Axis:
    """Centres of a chunk axis: centre k is origin + (start + k) * step."""

    origin: Column
    start: Column
    step: Column
    n: Column

    def at(self, k: Column) -> Column:
        return self.origin + (self.start + k) * self.step

    @property
    def first(self) -> Column:
        return self.at(F.lit(0))

    @property
    def last(self) -> Column:
        return self.at(self.n - 1)

    @property
    def low(self) -> Column:
        return F.least(self.first, self.last)

    @property
    def high(self) -> Column:
        return F.greatest(self.first, self.last)

    @property
    def half(self) -> Column:
        """Half a cell; a single centre has no width."""
        return F.when(self.n > 1, F.abs(self.step) / 2).otherwise(F.lit(0.0))


class StoredAxis:
    """An axis held in columns, computed once per chunk, plus lookups staged per point.

    Each stage becomes its own projection, so no expression is repeated inside
    another and the whole lookup stays inside generated code.
    """

    def __init__(self, name: str):
        self.name = name

    def _c(self, part: str) -> Column:
        return F.col(f"_{self.name}_{part}")

    def columns(self, axis: Axis) -> dict[str, Column]:
        parts = {
            "origin": axis.origin.cast("double"), "start": axis.start.cast("double"),
            "step": axis.step.cast("double"), "n": axis.n.cast("int"),
            "first": axis.first, "low": axis.low, "high": axis.high,
            "foot_low": axis.low - axis.half, "foot_high": axis.high + axis.half,
            "up": F.when(axis.step > 0, F.lit(1)).otherwise(F.lit(-1)),
        }
        return {f"_{self.name}_{p}": c for p, c in parts.items()}

    def _at(self, k: Column) -> Column:
        return self._c("origin") + (self._c("start") + k) * self._c("step")

    def covers(self, v: Column) -> Column:
        """Inside the closed cell footprint."""
        return v.between(self._c("foot_low"), self._c("foot_high"))

    def span(self, lo: Column, hi: Column, n: int) -> Column:
        """Indexes of the n-point grid lo..hi that may lie in the footprint.

        One index wider than needed on both sides; filter with `covers` afterwards.
        """
        step = (hi - lo) / F.lit(max(n - 1, 1))
        a = F.floor(F.try_divide(self._c("foot_low") - lo, step)) - 1
        b = F.ceil(F.try_divide(self._c("foot_high") - lo, step)) + 1
        first = F.coalesce(F.greatest(F.lit(0), F.least(a, F.lit(n))), F.lit(0)).cast("int")
        last = F.coalesce(F.least(F.lit(n - 1), F.greatest(b, F.lit(-1))), F.lit(n - 1)).cast("int")
        return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def locate(self, df: DataFrame, v: str, *, nearest: bool = True, linear: bool = False) -> DataFrame:
        """Add the index of the nearest centre (`k`) and the interval (`p0`, `p1`, weight `w`, `hull`).

        Nearest is clipped to the axis and exact ties take the larger
        coordinate. The interval of a point on a centre is the one above it;
        outside the hull it is the end interval, so that the same two centres
        extrapolate linearly.
        """
        name, at, x = self.name, self._at, F.col(v)
        n, up, b = self._c("n"), self._c("up"), self._c("b")
        u = (x - self._c("first")) / self._c("step")
        # Each entry may use the ones before it (lateral aliases): one projection per stage.
        stages = {"b": F.when(up > 0, F.floor(u)).otherwise(F.ceil(u)).cast("int")}
        keep = []
        if nearest:
            low, high = self._c("l"), self._c("h")
            stages["l"] = clip_index(b, n)
            stages["h"] = clip_index(b + up, n)
            stages["k"] = F.when(F.abs(x - at(low)) < F.abs(x - at(high)), low).otherwise(high)
            keep += ["k"]
        if linear:
            # The division may round a point onto the wrong side of a centre.
            e, p0 = self._c("e"), self._c("p0")
            stages["e"] = F.when(x >= at(b + up), b + up).when(x < at(b), b - up).otherwise(b)
            stages["p0"] = F.when(up > 0, F.greatest(F.lit(0), F.least(n - 2, e))).otherwise(
                F.greatest(F.lit(1), F.least(n - 1, e))
            )
            stages["p1"] = p0 + up
            stages["w"] = F.try_divide(x - at(p0), at(p0 + up) - at(p0))
            stages["hull"] = (x >= self._c("low")) & (x <= self._c("high")) & (n > 1)
            keep += ["p0", "p1", "w", "hull"]
        extra = [c.alias(f"_{name}_{p}") for p, c in stages.items()]
        return df.select("*", *extra).drop(*[f"_{name}_{p}" for p in stages if p not in keep])


def bilinear(pick: Callable[[Column, Column], Column], slow: str, fast: str) -> Column:
    """Bilinear value from two located axes; a NaN at any of the four corners makes the result NaN.

    `pick(slow index, fast index)` reads one stored value.
    """
    y0, y1, wy = (F.col(f"_{slow}_{p}") for p in ("p0", "p1", "w"))
    x0, x1, wx = (F.col(f"_{fast}_{p}") for p in ("p0", "p1", "w"))
    return (
        pick(y0, x0) * (1 - wy) * (1 - wx)
        + pick(y0, x1) * (1 - wy) * wx
        + pick(y1, x0) * wy * (1 - wx)
        + pick(y1, x1) * wy * wx
    )
