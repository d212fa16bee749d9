"""Cubic splines of any length: a tridiagonal system solved in blocks.

Every inner knot has one equation in the second derivatives at its neighbours. Knots are cut into blocks of
`block`; a block's unknowns are linear in the two values just outside it, left and right, so six numbers say all
that the rest of the series needs to know of it: its first and last unknown for the block's own right-hand side, and
per unit of the value on either side. Two such blocks side by side are again such a block, so `fan` of them merge
into one, on as many levels as the length asks for; the borders then come back down the same levels. The result is
the exact solution, whatever the blocks, and no task holds more than `block` knots or `fan` blocks.

Inside a block the equations are solved by parallel cyclic reduction: log2(block) steps on whole arrays.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.ordered import Ordered
from gridloom.operators.skew import KeyStats

BLOCK = 1 << 16
FAN = 1 << 10
#: Points made of one row at a time.
POINTS = 1 << 12

#: A block's first and last unknown: for its right-hand side, per unit of the value to its left, and to its right.
_SIX = ("_fd", "_fl", "_fr", "_ed", "_el", "_er")


def tridiagonal(low: np.ndarray, diag: np.ndarray, up: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Solve low[i] u[i-1] + diag[i] u[i] + up[i] u[i+1] = rhs[i] for all columns of rhs, by cyclic reduction."""
    a, b, c, f = low.copy(), diag.copy(), up.copy(), rhs.copy()
    a[:1], c[-1:] = 0.0, 0.0
    step = 1
    while step < b.size:
        back, ahead = np.zeros_like(b), np.zeros_like(b)
        back[step:] = a[step:] / b[:-step]
        ahead[:-step] = c[:-step] / b[step:]
        a2, b2, c2, f2 = np.zeros_like(a), b.copy(), np.zeros_like(c), f.copy()
        a2[step:] = -a[:-step] * back[step:]
        c2[:-step] = -c[step:] * ahead[:-step]
        b2[step:] -= c[:-step] * back[step:]
        b2[:-step] -= a[step:] * ahead[:-step]
        f2[step:] -= f[:-step] * back[step:, None]
        f2[:-step] -= f[step:] * ahead[:-step, None]
        a, b, c, f = a2, b2, c2, f2
        step *= 2
    return f / b[:, None]


def _block_solution(pdf: pd.DataFrame) -> np.ndarray:
    """Unknowns of a block, one row each: for its own right-hand side, per unit left, per unit right."""
    low, diag, up, rhs = (pdf[c].to_numpy(float) for c in ("_low", "_diag", "_up", "_rhs"))
    sides = np.zeros((rhs.size, 3))
    sides[:, 0] = rhs
    sides[0, 1], sides[-1, 2] = -low[0], -up[-1]
    return tridiagonal(low, diag, up, sides)


def _unknown(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf[(pdf["_i"] >= 1) & (pdf["_i"] <= pdf["_n"] - 2)]


def _chain(pdf: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last unknown of each block of a row of blocks, for several (left, right) at once.

    The block sums of `_fd` and `_ed` count for the first column only, so that further columns are per unit.
    """
    fd, fl, fr, ed, el, er = (pdf[c].to_numpy(float) for c in _SIX)
    q, own = fd.size, np.zeros(left.size)
    own[0] = 1.0
    alpha, rho = np.empty((q + 1, left.size)), np.empty(q + 1)
    base, slope = np.empty((q, left.size)), np.empty(q)
    # Last unknown of the block before, as alpha + rho * (first unknown of this one).
    alpha[0], rho[0] = left, 0.0
    for b in range(q):
        det = 1.0 - fl[b] * rho[b]
        base[b] = (fd[b] * own + fl[b] * alpha[b]) / det
        slope[b] = fr[b] / det
        alpha[b + 1] = ed[b] * own + el[b] * (alpha[b] + rho[b] * base[b])
        rho[b + 1] = er[b] + el[b] * rho[b] * slope[b]
    first, last = np.empty((q + 1, left.size)), np.empty((q, left.size))
    first[q] = right
    for b in range(q - 1, -1, -1):
        last[b] = alpha[b + 1] + rho[b + 1] * first[b + 1]
        first[b] = base[b] + slope[b] * first[b + 1]
    return first[:-1], last, first[1:]


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


def _with_keys(keys: Sequence[str], pdf: pd.DataFrame, size: int) -> dict:
    return {k: pdf[k].iloc[:1].repeat(size).array for k in keys}


def _borders(six: DataFrame, keys: list[str], fan: int, blocks: int) -> DataFrame:
    """(keys, _g, _left, _right): the values just outside every block, zero beyond the ends of a series."""
    out = T.StructType(_key_fields(six, keys) + [T.StructField("_g", T.LongType())] + _doubles("_left", "_right"))

    def settle(pdf: pd.DataFrame, left: float, right: float) -> pd.DataFrame:
        pdf = pdf.sort_values("_g")
        _, last, after = _chain(pdf, np.array([left]), np.array([right]))
        before = np.concatenate([[left], last[:-1, 0]])
        return pd.DataFrame({**_with_keys(keys, pdf, len(pdf)), "_g": pdf["_g"].to_numpy(), "_left": before, "_right": after[:, 0]})

    if blocks <= fan:
        return six.groupBy(*keys).applyInPandas(lambda pdf: settle(pdf, 0.0, 0.0), out)

    merged = T.StructType(_key_fields(six, keys) + [T.StructField("_g", T.LongType())] + _doubles(*_SIX))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_g")
        first, last, _ = _chain(pdf, np.array([0.0, 1.0, 0.0]), np.array([0.0, 0.0, 1.0]))
        values = [*first[0], *last[-1]]
        return pd.DataFrame({**_with_keys(keys, pdf, 1), "_g": [int(pdf["_g"].iat[0]) // fan], **{c: [v] for c, v in zip(_SIX, values)}})

    tagged = six.withColumn("_up_g", F.expr(f"_g div {fan}"))
    higher = tagged.groupBy(*keys, "_up_g").applyInPandas(merge, merged)
    outer = _borders(higher, keys, fan, -(-blocks // fan)).withColumnRenamed("_g", "_up_g")

    def settle_both(pdf: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        return settle(pdf, float(edge["_left"].iat[0]), float(edge["_right"].iat[0]))

    return tagged.groupBy(*keys, "_up_g").cogroup(outer.groupBy(*keys, "_up_g")).applyInPandas(settle_both, out)


def _equations(rows: DataFrame) -> DataFrame:
    """Adds the equation of each inner knot; the not-a-knot ends are eliminated into the first and last one."""
    h0, h1 = F.col("_x") - F.col("_x0"), F.col("_x1") - F.col("_x")
    first, last = F.col("_i") == 1, F.col("_i") == F.col("_n") - 2
    none = F.lit(0.0)
    rise = F.try_divide(F.col("_y1") - F.col("_y"), h1) - F.try_divide(F.col("_y") - F.col("_y0"), h0)
    diag = (
        2 * (h0 + h1) + F.when(first, h0 * (1 + F.try_divide(h0, h1))).otherwise(none)
        + F.when(last, h1 * (1 + F.try_divide(h1, h0))).otherwise(none)
    )
    return rows.withColumns({
        "_low": F.when(first, none).otherwise(h0 - F.when(last, F.try_divide(h1 * h1, h0)).otherwise(none)),
        "_up": F.when(last, none).otherwise(h1 - F.when(first, F.try_divide(h0 * h0, h1)).otherwise(none)),
        "_diag": diag, "_rhs": 6 * rise,
    })


_KNOT = ("_x", "_y", "_x1", "_y1")


def second_derivatives(rows: DataFrame, keys: Sequence[str], longest: int, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(keys, _i, _n, _x, _y, _x1, _y1, _m0, _m1): every interval with the second derivatives at its ends.

    `rows` has one row per knot (keys, _i, _n, _x, _y and the neighbours' _x0, _y0, _x1, _y1). A series of one
    knot keeps that knot, two are a line, three a parabola.
    """
    keys = list(keys)
    # The knots at both ends go with their neighbours.
    block_no = F.expr(f"(greatest(least(_i, _n - 2), 1) - 1) div {block}")
    wide = _equations(rows).withColumn("_g", block_no.cast("bigint"))
    out = T.StructType(
        _key_fields(rows, keys) + [T.StructField("_i", T.LongType()), T.StructField("_n", T.LongType())] + _doubles(*_KNOT, "_m0", "_m1"))

    def solve(pdf: pd.DataFrame, left: float, right: float) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        n, i = int(pdf["_n"].iat[0]), pdf["_i"].to_numpy()
        inner = _unknown(pdf)
        if n < 4:
            # A parabola has one second derivative, a line none.
            m = 0.0 if n < 3 else float((inner["_rhs"] / (3 * (inner["_x1"] - inner["_x0"]))).iat[0])
            start, at = 0, np.full(n, m)
        else:
            own = _block_solution(inner)
            at = np.concatenate([[left], own @ np.array([1.0, left, right]), [right]])
            start, end = int(inner["_i"].iat[0]) - 1, int(inner["_i"].iat[-1]) + 1
            x0, x, x1 = (inner[c].to_numpy(float) for c in ("_x0", "_x", "_x1"))
            if start == 0:
                at[0] = at[1] + (at[1] - at[2]) * (x[0] - x0[0]) / (x1[0] - x[0])
            if end == n - 1:
                at[-1] = at[-2] + (at[-2] - at[-3]) * (x1[-1] - x[-1]) / (x[-1] - x0[-1])
        keep = (i <= n - 2) | (n == 1)
        part, j = pdf[keep], i[keep] - start
        made = {**_with_keys(keys, part, len(part)), "_i": i[keep], "_n": n, **{c: part[c].to_numpy(float) for c in _KNOT}}
        return pd.DataFrame({**made, "_m0": at[j], "_m1": at[np.minimum(j + 1, at.size - 1)]})

    if longest <= block + 2:
        return wide.groupBy(*keys).applyInPandas(lambda pdf: solve(pdf, 0.0, 0.0), out)

    six_schema = T.StructType(_key_fields(rows, keys) + [T.StructField("_g", T.LongType())] + _doubles(*_SIX))

    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        inner = _unknown(pdf)
        values = np.zeros(6)
        if len(inner) and int(pdf["_n"].iat[0]) >= 4:
            own = _block_solution(inner)
            values = np.concatenate([own[0], own[-1]])
        return pd.DataFrame({**_with_keys(keys, pdf, 1), "_g": [int(pdf["_g"].iat[0])], **{c: [v] for c, v in zip(_SIX, values)}})

    six = wide.groupBy(*keys, "_g").applyInPandas(summary, six_schema)
    borders = _borders(six, keys, fan, (longest - 3) // block + 1)

    def solve_both(pdf: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        return solve(pdf, float(edge["_left"].iat[0]), float(edge["_right"].iat[0]))

    return wide.groupBy(*keys, "_g").cogroup(borders.groupBy(*keys, "_g")).applyInPandas(solve_both, out)


def cubic_spline(
    df: DataFrame, keys: Sequence[str], x: str, y: str, start: float, stop: float, step: float,
    *, block: int = BLOCK, fan: int = FAN, stats: KeyStats | None = None,
) -> DataFrame:
    """Interpolating cubic spline (not-a-knot ends) on start, start + step, ... < stop: rows (keys, k, x, y).

    Points outside the knots continue the end polynomials. Fewer than four knots give the interpolating
    polynomial. Two knots at one x have no spline; their block's points are NaN.
    """
    keys = list(keys)
    total = max(0, math.ceil((stop - start) / step))
    stats = stats or KeyStats.of(df, keys)
    knots = df.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    o = Ordered.of(knots, keys, "_x", stats=stats).index("_i").count("_n")
    rows = o.neighbours(_x0="lag:_x", _y0="lag:_y", _x1="lead:_x", _y1="lead:_y").result()
    pieces = second_derivatives(rows, keys, stats.longest, block, fan)
    return evaluate(pieces, keys, start, step, total)


def evaluate(pieces: DataFrame, keys: Sequence[str], start: float, step: float, total: int) -> DataFrame:
    """Points k = 0 .. total - 1 of the piecewise cubics, each made by the interval that holds it."""
    first, last = F.col("_i") == 0, F.col("_i") >= F.col("_n") - 2

    def place(at: Column, shift: float) -> Column:
        inside = F.greatest(F.lit(0.0), F.least(F.lit(float(total)), (at - start) / step + shift))
        return F.floor(F.when(F.isnan(inside), F.lit(0.0)).otherwise(inside)).cast("bigint")

    # A little wider than the interval; the exact test follows on the points themselves.
    ranged = pieces.withColumns({
        "_k0": F.when(first, F.lit(0)).otherwise(place(F.col("_x"), -1.0)).cast("bigint"),
        "_k1": F.when(last, F.lit(total)).otherwise(place(F.col("_x1"), 2.0)).cast("bigint"),
    }).filter("_k1 > _k0")
    some = ranged.withColumn("_c", F.explode(F.expr(f"sequence(_k0 div {POINTS}, (_k1 - 1) div {POINTS})")))
    points = some.withColumn("k", F.explode(F.expr(f"sequence(greatest(_k0, _c * {POINTS}), least(_k1, (_c + 1) * {POINTS}) - 1)")))
    points = points.withColumn("x", F.lit(float(start)) + F.col("k") * F.lit(float(step))).filter(
        (first | (F.col("x") >= F.col("_x"))) & (last | (F.col("x") < F.col("_x1"))))
    h, d = F.col("_x1") - F.col("_x"), F.col("x") - F.col("_x")
    slope = F.try_divide(F.col("_y1") - F.col("_y"), h) - h * (2 * F.col("_m0") + F.col("_m1")) / 6
    cubic = F.try_divide(F.col("_m1") - F.col("_m0"), 6 * h)
    value = F.col("_y") + d * (slope + d * (F.col("_m0") / 2 + d * cubic))
    return points.select(*keys, "k", "x", F.when(F.col("_n") == 1, F.col("_y")).otherwise(value).alias("y"))
