import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.scalars import safe_divide
from gridloom.operators import amr
from gridloom.plans import planes
from gridloom.schema import AMR_CHUNK


def chunk(name, cid, off, ext, spacing, data, offset=(0.0, 0.0), position=(0.0, 0.0), shape=None, comp="scalar", seq=0, it=0):
    nd = len(ext)
    return (
        "s", it, 0.0, name, comp, seq, cid, list(shape or [1000] * nd), list(off), list(ext),
        list(offset), [float(v) for v in spacing], list(position), [float(v) for v in np.ravel(data)],
    )


def axis(c, d, three=False):
    off, ext, go, sp, pos = c[8][d], c[9][d], c[10][d], c[11][d], c[12][d]
    if pos != 0:
        ext = min(ext, max(0, c[7][d] - 1 - off))
    if three:
        return go + (np.arange(off, off + ext) + pos) * sp
    return go + (off + pos) * sp + np.arange(ext) * sp


def paint(canvas, gy, gx, data, yc, xc, linear):
    """Straightforward per-point painting, written from the rules."""
    if yc.size > 1 and yc[0] > yc[-1]:
        yc, data = yc[::-1], data[::-1]
    if xc.size > 1 and xc[0] > xc[-1]:
        xc, data = xc[::-1], data[:, ::-1]
    hy = abs(yc[1] - yc[0]) / 2 if yc.size > 1 else 0.0
    hx = abs(xc[1] - xc[0]) / 2 if xc.size > 1 else 0.0
    for j, y in enumerate(gy):
        for i, x in enumerate(gx):
            if not (yc[0] - hy <= y <= yc[-1] + hy and xc[0] - hx <= x <= xc[-1] + hx):
                continue
            def near(c, v):
                k = min(np.searchsorted(c, v), c.size - 1)
                return k - 1 if k > 0 and abs(v - c[k - 1]) < abs(v - c[k]) else k
            v = data[near(yc, y), near(xc, x)]
            inside = yc[0] <= y <= yc[-1] and xc[0] <= x <= xc[-1]
            if linear and inside and yc.size > 1 and xc.size > 1:
                a = min(np.searchsorted(yc, y, side="right") - 1, yc.size - 2)
                b = min(np.searchsorted(xc, x, side="right") - 1, xc.size - 2)
                wy, wx = (y - yc[a]) / (yc[a + 1] - yc[a]), (x - xc[b]) / (xc[b + 1] - xc[b])
                v = (data[a, b] * (1 - wy) * (1 - wx) + data[a, b + 1] * (1 - wy) * wx
                     + data[a + 1, b] * wy * (1 - wx) + data[a + 1, b + 1] * wy * wx)
            if np.isfinite(v):
                canvas[j, i] = v


def scene(seed=0, bad=True):
    rng = np.random.default_rng(seed)
    out = [chunk("f_rho_patch00_lev00", 0, (0, 0), (9, 11), (1.0, 1.0), rng.normal(size=(9, 11)))]
    out.append(chunk("f_rho_patch00_lev00", 1, (0, 8), (9, 6), (1.0, 1.0), rng.normal(size=(9, 6))))
    fine = rng.normal(size=(8, 8))
    if bad:
        fine[3, 4], fine[0, 0], fine[6, 2] = np.nan, np.inf, -np.inf
    out.append(chunk("f_rho_patch01_lev01", 0, (4, 6), (8, 8), (0.5, 0.5), fine, offset=(0.25, 0.1), position=(0.5, 0.5), shape=(12, 64)))
    # Descending axes, a single row and a later patch of the same level.
    out.append(chunk("f_rho_patch00_lev02", 0, (0, 0), (6, 5), (-0.25, 0.25), rng.normal(size=(6, 5)), offset=(6.0, 5.0)))
    out.append(chunk("f_rho_patch03_lev02", 0, (0, 0), (5, 6), (0.25, -0.25), rng.normal(size=(5, 6)), offset=(5.0, 6.5)))
    out.append(chunk("f_rho_lev01_patch02", 0, (2, 2), (1, 7), (0.5, 0.5), rng.normal(size=(1, 7)), offset=(1.0, 1.0)))
    return out


ORDER = {"f_rho_patch00_lev00": (0, 0), "f_rho_patch01_lev01": (1, 1), "f_rho_lev01_patch02": (1, 2), "f_rho_patch00_lev02": (2, 0), "f_rho_patch03_lev02": (2, 3)}


def brute(chunks, gy, gx, linear):
    canvas = np.full((gy.size, gx.size), np.nan)
    for c in sorted(chunks, key=lambda c: (*ORDER[c[3]], c[6])):
        data = np.array(c[13]).reshape(c[9])
        yc, xc = axis(c, 0), axis(c, 1)
        paint(canvas, gy, gx, data[: yc.size, : xc.size], yc, xc, linear)
    return canvas


def grid(rows, ny, nx):
    out = np.full((ny, nx), -777.0)
    for r in rows:
        out[r.j, r.i] = r.v
    return out


@pytest.mark.parametrize("method", ["nearest", "linear"])
@pytest.mark.parametrize("n", [(29, 31), (17, 17)])
def test_plane_composite_matches_brute_force(spark, method, n):
    chunks = scene()
    ny, nx = n
    gy, gx = np.linspace(0.0, 9.0, ny), np.linspace(0.0, 14.0, nx)
    df = amr.labelled(spark.createDataFrame(chunks, AMR_CHUNK).repartition(4))
    got = amr.composite_plane(df, nx=nx, ny=ny, method=method)
    rows = got.collect()
    assert len(rows) == nx * ny
    assert {r.label for r in rows} == {"f_rho"}
    np.testing.assert_allclose(grid(rows, ny, nx), brute(chunks, gy, gx, method == "linear"), atol=1e-12)
    np.testing.assert_allclose([r.x for r in rows], [gx[r.i] for r in rows])


def test_composite_does_not_depend_on_row_order(spark):
    chunks = scene(3)
    a, b = (
        amr.composite_plane(amr.labelled(spark.createDataFrame(c, AMR_CHUNK).repartition(k)), nx=20, ny=20).orderBy("j", "i").select("v").collect()
        for c, k in ((chunks, 1), (chunks[::-1], 5))
    )
    assert [str(r.v) for r in a] == [str(r.v) for r in b]


def test_fine_nan_lets_coarse_through(spark):
    coarse = chunk("g_patch00_lev00", 0, (0, 0), (3, 3), (1.0, 1.0), np.full((3, 3), 5.0))
    for fine, want in ((np.nan, 5.0), (7.0, 7.0)):
        f = chunk("g_patch00_lev01", 0, (2, 2), (1, 1), (0.5, 0.5), [[fine]])
        df = amr.labelled(spark.createDataFrame([coarse, f], AMR_CHUNK))
        got = amr.composite_plane(df, nx=3, ny=3, method="nearest", extent=amr.Extent(0, 2, 0, 2)).filter("j = 1 and i = 1").first()
        assert got.v == want


def test_explicit_extent_is_all_or_nothing():
    assert amr.Extent.of() is None
    assert amr.Extent.of(0, 1, 0, 1) == amr.Extent(0, 1, 0, 1)
    with pytest.raises(ValueError):
        amr.Extent.of(0, 1, 0)
    with pytest.raises(ValueError):
        amr.Extent(1, 1, 0, 2)


def test_clip_and_drop(spark):
    rows = [
        chunk("g_patch00_lev00", 0, (4, 4), (4, 4), (1, 1), np.zeros((4, 4)), position=(0.5, 0.0), shape=(8, 8)),
        chunk("g_patch00_lev00", 1, (4, 0), (1, 4), (1, 1), np.zeros((1, 4)), position=(0.5, 0.0), shape=(5, 8)),
    ]
    got = amr.clip_chunks(spark.createDataFrame(rows, AMR_CHUNK)).collect()
    assert [(r.chunk_id, r.ext) for r in got] == [(0, [3, 4])]


def test_sparsity(spark):
    rows = [chunk("g_patch00_lev00", 0, (0, 0), (5, 2), (1, 1), np.zeros((5, 2)), shape=(10, 10))]
    r = amr.sparsity(amr.labelled(spark.createDataFrame(rows, AMR_CHUNK))).first()
    assert (r.declared_points, r.actual_points, r.n_chunks, r.pct_unwritten) == (100, 10, 1, 90.0)


def test_chunk_listing_shows_ends(spark):
    rows = [chunk("g_patch00_lev00", k, (k, 0), (1, 1), (1, 1), [[0.0]]) for k in range(9)]
    got = amr.chunk_listing(spark.createDataFrame(rows, AMR_CHUNK)).collect()
    assert sorted(r.idx for r in got) == [0, 1, 7, 8]


def volume(seed=1):
    rng = np.random.default_rng(seed)
    return [
        chunk("h_patch00_lev00", 0, (0, 0, 0), (4, 5, 6), (1, 1, 1), rng.normal(size=(4, 5, 6)), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)),
        chunk("h_patch00_lev01", 0, (2, 2, 2), (5, 4, 3), (0.5, 0.5, 0.5), rng.normal(size=(5, 4, 3)), (0.0, 0.25, 0.0), (0.5, 0.0, 0.5), shape=(6, 99, 99)),
        chunk("h_patch01_lev01", 0, (0, 0, 0), (3, 3, 4), (0.5, -0.5, 0.5), rng.normal(size=(3, 3, 4)), (1.0, 4.0, 0.0), (0.0, 0.0, 0.0)),
    ]


@pytest.mark.parametrize("name", ["xy", "xz", "yz"])
@pytest.mark.parametrize("at", [0.5, 1.25, 3.5])
@pytest.mark.parametrize("method", ["nearest", "linear"])
def test_slice_matches_brute_force(spark, name, at, method):
    chunks, a, n = volume(), amr.SLICE_AXES[name], 19
    order = {"h_patch00_lev00": 0, "h_patch00_lev01": 1, "h_patch01_lev01": 2}
    parts, box = [], []
    for c in sorted(chunks, key=lambda c: order[c[3]]):
        cz = axis(c, a["cut"], True)
        pad = abs(c[11][a["cut"]]) / 2
        if not cz.min() - pad <= at <= cz.max() + pad:
            continue
        sizes = [axis(c, d, True).size for d in range(3)]
        data = np.array(c[13]).reshape(c[9])[: sizes[0], : sizes[1], : sizes[2]]
        slab = np.take(data, int(np.argmin(np.abs(cz - at))), axis=a["cut"])
        yc, xc = axis(c, a["slow"], True), axis(c, a["fast"], True)
        parts.append((slab, yc, xc))
        if order[c[3]] == 0 or not box:
            box = [xc.min(), xc.max(), yc.min(), yc.max()]
    gx, gy = np.linspace(box[0], box[1], n), np.linspace(box[2], box[3], n)
    want = np.full((n, n), np.nan)
    for slab, yc, xc in parts:
        paint(want, gy, gx, slab, yc, xc, method == "linear")
    df = amr.labelled(spark.createDataFrame(chunks, AMR_CHUNK))
    got = amr.composite_slice(df, name, at, n=n, method=method).collect()
    np.testing.assert_allclose(grid(got, n, n), want, atol=1e-12)


def test_slice_stab_is_inclusive(spark):
    df = amr.labelled(spark.createDataFrame(
        [chunk("h_patch00_lev00", 0, (0, 0, 0), (3, 2, 2), (1, 1, 1), np.arange(12), (0.0,) * 3, (0.0,) * 3)], AMR_CHUNK))
    assert amr.stabbed(df, "xy", 2.5).first()._k == 2
    assert amr.stabbed(df, "xy", 0.5).first()._k == 0
    assert amr.stabbed(df, "xy", 2.51).count() == 0


def test_recipe(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(5, 5)), rng.normal(size=(5, 5))
    b[2, 2] = 0.0
    rows = [chunk("rho_patch00_lev00", 0, (0, 0), (5, 5), (1, 1), a), chunk("press_patch00_lev00", 0, (0, 0), (5, 5), (1, 1), b)]
    df = spark.createDataFrame(rows, AMR_CHUNK)
    recipe = planes.Recipe({"r": "rho", "p": "press"}, lambda v: safe_divide(v["r"], v["p"]), "ratio")
    got = planes.render_recipe(df, recipe, nx=6, ny=6, method="nearest").collect()
    assert len(got) == 36 and {r.label for r in got} == {"ratio"}
    at = {(r.j, r.i): r.v for r in got}
    assert at[0, 0] == a[0, 0] / b[0, 0] and np.isnan(at[2, 2])
    with pytest.raises(ValueError):
        planes.render_recipe(df, planes.Recipe({"r": "rho", "p": "press"}))
    with pytest.raises(ValueError):
        planes.render_recipe(df, planes.Recipe({"r": "nothing"}))


def test_label_choice(spark):
    df = spark.createDataFrame([("rho",), ("rho_b",), ("press",)], "label string")
    assert amr.select_label(df, "RHO") == "rho"
    assert amr.select_label(df, "press") == "press"
    with pytest.raises(ValueError, match="several"):
        amr.select_label(df, "r")


def test_assemble(spark):
    rows = [
        chunk("g_patch00_lev00", 0, (1, 1), (2, 2), (1, 1), [[1, 2], [3, 4]]),
        chunk("g_patch00_lev00", 1, (2, 2), (2, 2), (1, 1), [[5, 6], [7, 8]]),
    ]
    got = {(r.gj, r.gi): r.v for r in amr.assemble(spark.createDataFrame(rows, AMR_CHUNK)).collect()}
    assert len(got) == 9
    assert got[2, 2] == 5 and got[1, 1] == 1 and got[3, 3] == 8 and np.isnan(got[1, 3])


def test_assemble_in_three_dimensions(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 3, 4)), rng.normal(size=(3, 2, 2))
    a[1, 1, 1] = np.nan
    rows = [
        chunk("g_patch00_lev00", 0, (1, 1, 0), (2, 3, 4), (1, 1, 1), a, (0.0,) * 3, (0.0,) * 3),
        chunk("g_patch00_lev00", 1, (2, 3, 2), (3, 2, 2), (1, 1, 1), b, (0.0,) * 3, (0.5, 0.0, 0.0), shape=(5, 9, 9)),
        chunk("h_patch00_lev00", 0, (3,), (4,), (1,), [1, 2, 3, 4], (0.0,), (0.0,)),
    ]
    got = amr.assemble(spark.createDataFrame(rows, AMR_CHUNK)).collect()
    want = np.full((3, 4, 4), np.nan)
    want[0:2, 0:3, :] = a
    want[1:3, 2:4, 2:4] = b[:2]  # the fill row is cut off
    cells = {(r.gk - 1, r.gj - 1, r.gi): r.v for r in got if r.mesh_name[0] == "g"}
    assert len(cells) == want.size
    np.testing.assert_array_equal([cells[k] for k in np.ndindex(want.shape)], want.ravel())
    assert sorted((r.gi, r.v) for r in got if r.mesh_name[0] == "h") == [(3, 1.0), (4, 2.0), (5, 3.0), (6, 4.0)]
    with pytest.raises(Exception, match="one to three axes"):
        amr.assemble(spark.createDataFrame([chunk("g_patch00_lev00", 0, (0,) * 4, (1,) * 4, (1,) * 4, [1], (0.0,) * 4, (0.0,) * 4)], AMR_CHUNK)).collect()


def test_metadata_queries_do_not_read_data(spark, tmp_path):
    path = str(tmp_path / "chunks")
    spark.createDataFrame(scene(), AMR_CHUNK).write.parquet(path)
    df = amr.labelled(spark.read.parquet(path))
    for q in (amr.sparsity(df), amr.plane_extents(df), amr.chunk_listing(df)):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "data:array<double>" not in plan


def test_first_and_last_iteration(spark):
    rows = [chunk("g_patch00_lev00", 0, (0, 0), (2, 2), (1, 1), np.full((2, 2), k), it=k) for k in (3, 5, 9)]
    df = spark.createDataFrame(rows, AMR_CHUNK)
    assert planes.first_iteration(df).first().iteration == 3
    assert planes.first_iteration(df, last=True).first().iteration == 9
    cut = planes.render_planes(df, "g", nx=3, ny=3)
    lim = planes.limits(cut).first()
    assert (lim.vmin, lim.vmax) == (3.0, pytest.approx(3.03))
