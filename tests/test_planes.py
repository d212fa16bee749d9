"""Resampling tells planes, elevations and series apart."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import amr, canvas, fields, painting
from gridloom.plans import config, resample
from gridloom.schema import AMR_CHUNK


def chunk(series, name, value, chunk_id=0):
    return (series, 3, 1.5, name, "scalar", 0, chunk_id, [4, 4], [0, 0], [4, 4], [0.0, 0.0], [1.0, 1.0], [0.0, 0.0], [float(value)] * 16)


def slices(spark, rows, **options):
    cfg = config.ResampleConfig(simdir="s", label="r", variables=("hydrobasex_rho",), interp_order=0, **options)
    out = resample.resample(amr.labelled(spark.createDataFrame(rows, AMR_CHUNK)), cfg, "r").collect()
    return {r.plane: {v for v in r.data if v == v} for r in out}


TAGS = {"xy": "xy_z_pos0000p000", "high": "xy_z_pos0001p500", "xz": "xz_y_pos0000p000"}


def name(tag):
    return f"{tag}_hydrobasex_rho_patch00_lev00"


def test_plane_is_chosen(spark):
    rows = [chunk("a", name(TAGS["xy"]), 1), chunk("a", name(TAGS["xz"]), 2), chunk("a", name(TAGS["high"]), 3)]
    assert slices(spark, rows) == {"xy": {1.0}, TAGS["high"]: {3.0}}
    assert slices(spark, rows, plane="xz") == {"xz": {2.0}}


def test_series_are_painted_in_one_order(spark):
    rows = [chunk("a", name(TAGS["xy"]), 1), chunk("b", name(TAGS["xy"]), 2)]
    assert slices(spark, rows) == slices(spark, rows[::-1])


def test_chunk_numbers_have_room(spark):
    rows = [chunk("a", name(TAGS["xy"]), k, chunk_id=k) for k in (7, (1 << 31) - 1, 1 << 24)]
    assert slices(spark, rows) == {"xy": {float((1 << 31) - 1)}}


@pytest.mark.parametrize("method", ["nearest", "linear"])
@pytest.mark.parametrize("block", [1 << 20, 90])
def test_slices_equal_the_point_composite(spark, monkeypatch, method, block):
    monkeypatch.setattr(canvas, "BLOCK", block)
    rng = np.random.default_rng(6)
    rows = []
    for k in range(40):
        ny, nx = (int(v) for v in rng.integers(1, 6, 2))
        data = np.where(rng.random(ny * nx) < 0.1, np.nan, rng.normal(size=ny * nx))
        level = int(rng.integers(0, 3))
        step = rng.choice([-1.0, 1.0], 2) / 2**level
        rows.append((
            "ab"[k % 2], k % 3, 0.5, f"hydrobasex_rho_patch{k % 2:02d}_lev{level:02d}", "scalar", k % 2, k, [20, 20],
            [int(v) for v in rng.integers(0, 9, 2)], [ny, nx], [float(v) for v in rng.normal(size=2)], [float(v) for v in step],
            [0.5 * (k % 2)] * 2, [float(v) for v in data]))
    rows.append(("a", 9, 0.5, "hydrobasex_rho_patch00_lev00", "scalar", 0, 0, [2, 2], [0, 0], [2, 2], [99.0, 99.0], [1.0, 1.0], [0.0, 0.0], [1.0] * 4))
    chunks = amr.labelled(spark.createDataFrame(rows, AMR_CHUNK))
    keys, extent = ["label", "iteration"], amr.Extent(-6.0, 9.0, -5.5, 8.0)
    own = painting.composite_slices(chunks, nx=31, ny=27, method=method, extent=extent, keys=keys)
    want = fields.to_slices(amr.composite_plane(chunks, nx=31, ny=27, method=method, extent=extent, keys=keys), keys)
    own, want = ({(r.label, r.iteration): r for r in x.collect()} for x in (own, want))
    assert own.keys() == want.keys() and len(own) == 4
    for k, r in own.items():
        assert (r.nx, r.ny) == (want[k].nx, want[k].ny)
        np.testing.assert_array_equal(r.data, want[k].data)


@pytest.mark.parametrize("block", [1 << 20, 90])
def test_hot_canvas_is_painted_in_parts(spark, monkeypatch, block):
    """One canvas of many overlapping chunks: no task takes them all, and what is on top stays on top."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(120):
        data = np.where(rng.random(16) < 0.2, np.nan, rng.normal(size=16))
        rows.append((
            "a", 3 if k < 110 else 4, 0.5, f"hydrobasex_rho_patch00_lev{k % 3:02d}", "scalar", 0, k, [20, 20], [int(v) for v in rng.integers(0, 9, 2)], [4, 4],
            [0.0, 0.0], [1 / 2 ** (k % 3)] * 2, [0.0, 0.0], [float(v) for v in data]))
    rows.append(("a", None, 0.5, "hydrobasex_rho_patch00_lev00", "scalar", 0, 0, [2, 2], [0, 0], [2, 2], [99.0, 99.0], [1.0, 1.0], [0.0, 0.0], [1.0] * 4))
    chunks = amr.labelled(spark.createDataFrame(rows, AMR_CHUNK))
    options = {"nx": 31, "ny": 27, "method": "linear", "extent": amr.Extent(0, 12, 0, 12), "keys": ["iteration"]}
    monkeypatch.setattr(canvas, "BLOCK", block)
    whole = {r.iteration: np.array(r.data) for r in painting.composite_slices(chunks, **options).collect()}
    monkeypatch.setattr(canvas, "POINTS", 600)
    monkeypatch.setattr(canvas, "FAN", 2)
    dealt, most = canvas.parted(chunks.withColumn("_prio", F.col("chunk_id")), ["iteration"], F.lit(50))
    sizes = [r["count"] for r in dealt.where("iteration = 3").groupBy("_part").count().collect()]
    assert most == 21 and max(sizes) < 20
    parts = {r.iteration: np.array(r.data) for r in painting.composite_slices(chunks, **options).collect()}
    assert set(whole) == set(parts) == {3, 4, None}
    for k in whole:
        np.testing.assert_array_equal(parts[k], whole[k])


def test_no_point_rows_before_a_canvas_is_done(spark):
    """Between the chunks and the finished canvases nothing is exploded."""
    chunks = amr.labelled(spark.createDataFrame([], AMR_CHUNK))
    for made in (
        amr.composite_plane(chunks, nx=5, ny=4), amr.composite_slice(chunks, "yz", 0.5, n=5),
        amr.composite_recipe(chunks, {"a": "rho", "b": "press"}, lambda v: v["a"] + v["b"], nx=5, ny=4),
    ):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("FlatMapGroupsInArrow", 1)
        assert above.count("Generate posexplode") == 1 and below.count("Generate posexplode") == 0
        assert "Generate" not in below.split("MapInArrow", 1)[0]
        assert made.count() == 0


def test_given_boxes_without_chunks_are_blank(spark):
    rows = [("a", 0, 0.5, "hydrobasex_rho_patch00_lev00", "scalar", 0, 0, [3, 3], [0, 0], [3, 3], [0.0, 0.0], [1.0, 1.0], [0.0, 0.0], [float(k) for k in range(9)])]
    chunks = amr.labelled(spark.createDataFrame(rows, AMR_CHUNK))
    boxes = spark.createDataFrame([("a", it, "hydrobasex_rho", 0.0, 2.0, 0.0, 2.0) for it in (0, 7)], "series string, iteration bigint, label string, x_min double, x_max double, y_min double, y_max double")
    got = amr.composite_plane(chunks, nx=3, ny=3, method="nearest", extent=boxes).orderBy("iteration", "j", "i").collect()
    assert [r.v for r in got[:9]] == [float(k) for k in range(9)] and all(np.isnan(r.v) for r in got[9:]) and len(got) == 18
