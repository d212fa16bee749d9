import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.constants import MILLIS, MSUN_TO_KM
from gridloom.functions import scalars
from gridloom.functions.grid import cell_edges, grid_point, half_open_count
from gridloom.operators import fields, selection
from gridloom.plans import config, frames, tasks
from gridloom.schema import FIELD_SLICE

NAN = float("nan")


def test_unit_closure():
    assert abs(MILLIS - 1e-3 * 299792.458 / MSUN_TO_KM) < 1e-9


def test_linspace_is_exact(spark):
    for lo, hi, n in ((-50.0, 50.0, 1000), (0.1, 0.7, 13), (3.0, 3.0, 4)):
        got = [r.v for r in spark.range(n).select(grid_point(F.col("id"), F.lit(lo), F.lit(hi), n).alias("v"), "id").orderBy("id").collect()]
        assert got == list(np.linspace(lo, hi, n))
    assert half_open_count(1500, 5000, 0.01) == np.arange(1500, 5000, 0.01).size


def test_safe_divide(spark):
    rows = [(1.0, 0.0), (NAN, 1.0), (4.0, 2.0), (1.0, float("inf")), (1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double").select(scalars.safe_divide(F.col("a"), F.col("b")).alias("r"))
    got = [r.r for r in df.collect()]
    assert got[2] == 2.0 and all(math.isnan(v) for k, v in enumerate(got) if k != 2)


def test_edges(spark):
    r = spark.range(1).select(cell_edges(F.lit(1.0), F.lit(0.5), F.lit(3)).alias("e")).first().e
    assert r == [0.75, 1.25, 1.75, 2.25]


@pytest.mark.parametrize("values, log, want", [
    ([5.0] * 4, False, (5.0, 5.05, False)), ([0.0] * 3, False, (0.0, 1.0, False)),
    ([1.0, NAN, float("inf"), -2.0], True, (1.0, 1.01, True)),
])
def test_colour_limit_cases(spark, values, log, want):
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    r = fields.colour_limits(df, ["k"], "v", log=log).first()
    assert (r.vmin, pytest.approx(r.vmax), r.log_norm) == want


def test_colour_limits_percentiles_and_overrides(spark):
    v = np.random.default_rng(0).normal(size=500)
    df = spark.createDataFrame([("a", float(x)) for x in v], "k string, v double")
    r = fields.colour_limits(df, ["k"], "v").first()
    np.testing.assert_allclose([r.vmin, r.vmax], np.percentile(v, [1, 99]))
    assert fields.colour_limits(df, ["k"], "v", vmin=-9).first().vmin == -9
    assert fields.colour_limits(df.filter("v > 1e9"), ["k"], "v").count() == 0


@pytest.mark.parametrize("small, steps", [(1 << 20, 512), (60, 16)])
def test_percentiles_of_any_size(spark, small, steps):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=3000), "b": np.round(rng.exponential(size=900), 1), "c": np.full(500, 7.0), None: rng.normal(size=400) ** 5, "d": np.array([2.0])}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probs = (0.0, 0.013, 0.5, 0.99, 1.0)
    got = {r.k: r.p for r in selection.percentiles(df, ["k"], "v", probs, "p", small=small, steps=steps).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        np.testing.assert_allclose(got[k], np.percentile(v, [100 * p for p in probs]), rtol=1e-12, atol=1e-12)


def test_narrowing_does_not_repeat_earlier_passes(spark):
    rows = spark.range(2000).selectExpr("'a' as k", "cast(id % 997 as double) as _v")
    ranks = spark.createDataFrame([("a", 2000, 0, 500)], "k string, _n bigint, _j int, _rank bigint")
    left, found = selection._narrowed(rows, ranks, ["k"], ["k"], 16)
    plans = [t._jdf.queryExecution().executedPlan().toString() for t in (left, found)]
    assert not any(x in p for p in plans for x in ("Range", "Join")), plans
    assert left.count() == found.first()["_n"] < 500


def stack(spark):
    rows = [("r", "a", "xy", i, i * 1.0, 2, 3, [float(i + k) for k in range(6)]) for i in (10, 30, 20)]
    rows += [("r", "b", "xy", i, i * 2.0, 2, 3, [float(k) for k in range(6)]) for i in (5, 15)]
    return spark.createDataFrame(rows, FIELD_SLICE)


def test_frames_align_by_index(spark):
    al = fields.align_frames(stack(spark), {"x": "a", "y": "b"}).orderBy("frame_idx").collect()
    assert [(r.frame_idx, r.x.iteration, r.y.iteration) for r in al] == [(0, 10, 5), (1, 20, 15)]
    assert fields.frame_count(stack(spark)).first().n_frames == 2
    c = fields.cells(stack(spark)).filter("iteration = 10").collect()
    assert {(r.i, r.j): r.v for r in c} == {(i, j): 10.0 + 3 * i + j for i in range(2) for j in range(3)}


def test_frame_preparation(spark):
    settings = {**config.MOVIE_DEFAULTS, "FRAME_START": 1, "OUT_PREFIX": "f", "T_MERGE": 10.0}
    got = frames.prepare(
        stack(spark), {"x": "a", "y": "b"}, lambda v: scalars.safe_divide_arrays(v["x"], v["y"]), settings,
        title="{t:.3f} {it}", ref="x",
    ).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.frame_idx, r.seq, r.file, r.iteration) == (1, 0, "f_0000.png", 20)
    assert r.title == f"{10.0 / MILLIS:.3f} 20"
    assert math.isnan(r.data[0]) and r.data[1] == 21.0
    assert frames.contour_levels([3, 1, 2]) == [1.0, 2.0, 3.0]


def test_drawing_tools_are_optional(spark, tmp_path):
    settings = {**config.MOVIE_DEFAULTS, "OUT_DIR": str(tmp_path)}
    df = spark.createDataFrame([("t", "f.png", [1.0] * 6)], "title string, file string, data array<double>")
    try:
        import matplotlib  # noqa: F401
    except ImportError:
        with pytest.raises(Exception, match="matplotlib"):
            frames.render(df, 2, 3, (0, 1), (0, 1), settings).collect()
    assert frames.movie_from_files([], str(tmp_path / "m.mp4")) is None


@pytest.mark.parametrize("transposed", [False, True])
def test_polar_mean(spark, transposed):
    n, dx = 21, 0.5
    g = -5 + dx * np.arange(n)
    rng = np.random.default_rng(2)
    data = rng.normal(size=(n, n))
    df = spark.createDataFrame([("a", n, n, [float(v) for v in data.ravel()])], "k string, nx int, ny int, data array<double>")
    got = fields.polar_mean(df, ["k"], x0=-5.0, y0=-5.0, dx=dx, dy=dx, r_start=0.1, r_stop=6.0, r_step=0.7, n_phi=51, transposed=transposed)
    phi = np.arange(0, 2 * np.pi, 2 * np.pi / 51)
    for r in got.collect():
        x, y = r.r * np.cos(phi), r.r * np.sin(phi)
        if transposed:
            x, y = y, x
        i = np.clip(np.searchsorted(g, x, side="right") - 1, 0, n - 2)
        j = np.clip(np.searchsorted(g, y, side="right") - 1, 0, n - 2)
        wx, wy = (x - g[i]) / dx, (y - g[j]) / dx
        v = data[i, j] * (1 - wx) * (1 - wy) + data[i, j + 1] * (1 - wx) * wy + data[i + 1, j] * wx * (1 - wy) + data[i + 1, j + 1] * wx * wy
        assert r["mean"] == pytest.approx(v.sum() * (2 * np.pi / 51) / (2 * np.pi), abs=1e-10)


def test_rotation_of_rigid_body(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-3.0, 0.5)], "x double, y double")
    om = scalars.rotation_rate("x", "y", -0.3 * F.col("y"), 0.3 * F.col("x"), F.lit(0.0), F.lit(0.0), F.lit(1.0), unit=1.0)
    assert [r[0] for r in df.select(om).collect()] == pytest.approx([0.3, 0.3])


def test_task_lists(spark):
    its = spark.createDataFrame([(i,) for i in (30, 10, 20)], "iteration bigint")
    got = {r.task: (r.variable, r.iteration) for r in tasks.task_grid(its, ["a", "b"]).collect()}
    assert got == {k: v for k, v in enumerate((n, i) for n in "ab" for i in (10, 20, 30))}
    idx = spark.createDataFrame([("b", 1), ("a", 2), ("z", 3)], "variable string, iteration bigint")
    assert {(r.seq, r.variable) for r in tasks.requested_variables(idx, ["a", "q", "b"]).collect()} == {(0, "a"), (2, "b")}
    assert [r.variable for r in tasks.skipped_variables(idx, ["a", "q", "b"]).collect()] == ["q"]
    assert tasks.run_cutoffs(spark.createDataFrame([("r",)], "run string")).count() == 4


def test_resample_config(tmp_path):
    f = tmp_path / "c.yaml"
    f.write_text("simdir: /s\nlabel: l\nvariables: rho\nsimdir_exclude: {dirs: chk, files: ['*.x']}\nunknown: 1\ngrid: {min: [-1, -2], max: [3, 4]}\n")
    c = config.load_resample_config(f)
    assert c.variables == ("rho",) and c.exclude_dirs == ("chk",) and c.exclude_files == ("*.x",)
    assert c.grid.bounds() == ((-1, -2), (3, 4)) and c.grid.resolution == (1000, 1000) and c.compression_level == 4
    assert config.Grid(min=(0, 0)).bounds() == ((-50.0, -50.0), (50.0, 50.0))
    for bad in ("label: l\nvariables: [a]\n", "simdir: s\nlabel: l\nvariables: [a]\nplane: zz\n", "simdir: s\nlabel: l\nvariables: [a]\nresample_chunks: 0\n",
                "simdir: s\nlabel: l\nvariables: [a]\nsimdir_pickle: {pickled: yes}\n"):
        f.write_text(bad)
        with pytest.raises(ValueError):
            config.load_resample_config(f)


def test_movie_config(tmp_path):
    f = tmp_path / "m.yaml"
    config.write_movie_config({"OUT_PREFIX": "p", "XLIM": (-1.0, 1.0)}, f)
    c = config.load_movie_config(f)
    assert c["OUT_PREFIX"] == "p" and c["XLIM"] == [-1.0, 1.0] and c["ZFILL"] == 4
    f.write_text("NOPE: 1\n")
    with pytest.warns(UserWarning, match="NOPE"):
        config.load_movie_config(f)
    f.write_text("OUT_EXT: pdf\n")
    with pytest.raises(ValueError):
        config.load_movie_config(f)
