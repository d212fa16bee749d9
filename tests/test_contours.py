"""Contour lines and frames of several panels."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import contours
from gridloom.plans import config, frames

SLICE = "k int, nx int, ny int, data array<double>"


def lines_of(spark, grids, levels, **more):
    rows = [(k, g.shape[0], g.shape[1], [float(v) for v in g.ravel()]) for k, g in enumerate(grids)]
    out = {}
    for r in contours.lines(spark.createDataFrame(rows, SLICE), ["k"], levels, **more).orderBy("pos").collect():
        out.setdefault((r.k, r.level, r.line), []).append(r)
    return out


def test_circle_is_one_closed_line_with_the_inside_on_its_left(spark):
    x, y = np.meshgrid(np.linspace(-2, 2, 41), np.linspace(-2, 2, 81), indexing="ij")
    got = lines_of(spark, [-(x**2 + y**2)], [-1.0], x=(-2.0, 0.1), y=(-2.0, 0.05))
    (line,) = got.values()
    assert all(r.closed for r in line) and line[0].edge == line[-1].edge == line[0].line
    assert [r.pos for r in line] == list(range(len(line)))
    px, py = np.array([r.x for r in line]), np.array([r.y for r in line])
    assert np.abs(np.hypot(px, py) - 1).max() < 2e-3
    area = (px[:-1] * py[1:] - px[1:] * py[:-1]).sum() / 2
    assert area == pytest.approx(math.pi, rel=5e-3)


def test_every_crossed_edge_is_met_once_and_lines_end_at_the_rim(spark):
    rng = np.random.default_rng(3)
    grids = [rng.normal(size=s) for s in ((2, 2), (5, 9), (12, 7), (30, 30))]
    got = lines_of(spark, grids, [0.3, -0.2])
    for k, g in enumerate(grids):
        nx, ny = g.shape
        for level in (0.3, -0.2):
            high = g > level
            crossed = {2 * (i * ny + j) for i, j in zip(*np.nonzero(high[1:] != high[:-1]))}
            crossed |= {2 * (i * ny + j) + 1 for i, j in zip(*np.nonzero(high[:, 1:] != high[:, :-1]))}
            met = [r.edge for (kk, lv, _), line in got.items() if (kk, lv) == (k, level) for r in (line[:-1] if line[0].closed else line)]
            assert sorted(met) == sorted(crossed)
            for (kk, lv, name), line in got.items():
                if (kk, lv) == (k, level):
                    assert name == min(r.edge for r in line)
                    for end in () if line[0].closed else (line[0], line[-1]):
                        assert end.x in (0.0, nx - 1.0) or end.y in (0.0, ny - 1.0)


def test_saddles_follow_the_mean(spark):
    high, low = np.array([[1.0, 0.0], [0.0, 1.0]]), np.array([[1.0, 0.0], [0.0, 0.9]])
    low[0, 0] = 0.9
    assert sorted(len(v) for v in lines_of(spark, [high], [0.4]).values()) == [2, 2]
    joined = {frozenset((r.edge for r in v)) for v in lines_of(spark, [high], [0.4]).values()}
    apart = {frozenset((r.edge for r in v)) for v in lines_of(spark, [low], [0.5]).values()}
    # Edges: 0 along x at low y, 2 at high y; 1 along y at low x, 5 at high x.
    assert joined == {frozenset((0, 5)), frozenset((2, 1))}
    assert apart == {frozenset((0, 1)), frozenset((2, 5))}


def test_gaps_flat_empty_and_missing_slices(spark):
    holed = np.arange(16.0).reshape(4, 4)
    holed[1, 1] = np.nan
    got = lines_of(spark, [holed, np.ones((3, 3)), np.arange(3.0).reshape(1, 3)], [7.5, 1.0, float("nan"), 7.5])
    assert {k for k, _, _ in got} == {0}
    cells = [(r.x, r.y) for line in got.values() for r in line]
    assert cells and all(not (x < 2 and y < 2) for x, y in cells if (x, y) != (2.0, 2.0))
    odd = spark.createDataFrame([(1, 2, 2, None), (2, 2, None, [1.0, 2.0, 3.0, 4.0]), (3, 2, 2, [1.0, None, 3.0, 4.0]), (4, 0, 0, [])], SLICE)
    assert contours.lines(odd, ["k"], [2.0]).count() == 0
    assert contours.lines(odd.limit(0), ["k"], [2.0]).count() == 0
    assert contours.lines(odd, ["k"], []).count() == 0
    same = spark.createDataFrame([(1, 2, 2, [0.0, 0.0, 1.0, 1.0])] * 2, SLICE)
    assert contours.lines(same, ["k"], [0.5]).count() == 4


def test_no_shuffle(spark):
    df = spark.createDataFrame([(1, 2, 2, [0.0, 0.0, 1.0, 1.0])], SLICE)
    assert "Exchange" not in contours.lines(df, ["k"], F.array(F.lit(0.5)))._jdf.queryExecution().executedPlan().toString()


def test_panels_fill_rows_and_share_frames(spark):
    rows = [("r", v, "xy", 10 * k + d, float(k), 2, 2, [float(k), 0.0, 1.0, float(d)]) for v, d, n in (("a", 1, 3), ("b", 2, 2)) for k in range(n)]
    df = spark.createDataFrame(rows, "run string, variable string, plane string, iteration long, time double, nx int, ny int, data array<double>")
    settings = {**config.MOVIE_DEFAULTS, "FIG_ROWS": 2, "FIG_COLS": 2, "MILLIS": 1.0, "MSUN_TO_KM": 2.0}
    specs = [frames.Panel(lambda v: v["x"], "x", "{it} {t:.1f}", k / 2, [frames.Contour(lambda v: v["y"], "y", [0.5])] * (k % 2)) for k in range(5)]
    made = frames.panels(df, {"x": "a", "y": "b"}, specs, settings)
    got = made.orderBy("frame_idx", "panel").collect()
    assert [(r.frame_idx, r.panel, r.row, r.col) for r in got] == [(f, p, p // 2, p % 2) for f in range(2) for p in range(4)]
    assert [r.title for r in got[:4]] == ["1 0.0", "1 -0.5", "1 -1.0", "1 -1.5"]
    assert [len(r.contours) for r in got[:4]] == [0, 1, 0, 1] and got[0].file == "frame_0000.png"
    lines = frames.panel_lines(made, specs, {"y": frames.FieldGrid(2, (1.0, 1.0), (0.0, 3.0))}, settings).collect()
    assert {r.panel for r in lines} == {1, 3}
    # Frame 0 of y is 0, 0 on the first and 1, 2 on the second line of x.
    first = sorted((r.pos, r.x, r.y) for r in lines if (r.frame_idx, r.panel) == (0, 1))
    assert first == [(0, 2.5, 6.0), (1, 3.0, 0.0)]


def test_points_come_in_bounded_parts(monkeypatch):
    """A batch of many slices gives its points a few slices at a time, with the columns of their own slice."""
    import pyarrow as pa

    from gridloom.operators import contours

    rng = np.random.default_rng(4)
    grids = [*rng.normal(size=(40, 64)), None, [], [1.0, None, 0.0, 2.0]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(43)), pa.array([None if g is None else list(g) for g in grids], pa.list_(pa.float64())), pa.array([8] * 42 + [2]), pa.array([[0.0, 0.5]] * 43)],
        names=["k", "_data", "_ny", "_levels"])
    monkeypatch.setattr(contours, "PART_VALUES", 200)
    parts = list(contours._points(batch))
    assert len(parts) > 8 and max(len(set(p.column("k").to_pylist())) for p in parts) <= 4
    got = [tuple(r.values()) for p in parts for r in p.to_pylist()]
    assert got == [(k, *row) for k, g in enumerate(grids[:40]) for row in contours._slice_lines(g, 8, np.array([0.0, 0.5]))]
    assert list(contours._points(batch.slice(0, 0)))[0].num_rows == 0
