import json
import os

import numpy as np
import pytest

from gridloom.operators import amr, series, tracks
from gridloom.plans import config, resample
from gridloom.schema import FIELD_SLICE
from gridloom.sources import ascii, openpmd, restarts, slice_store, walk
from gridloom.streaming import slices as stream


def scalar_row(it, t, v):
    cols = ["0"] * 13
    cols[0], cols[8], cols[12] = str(it), repr(t), repr(v)
    return " ".join(cols)


def test_scalar_restarts(spark, tmp_path):
    for r, its in ((0, [0, 1, 2]), (1, [2]), (2, [2, 3, 3])):
        d = tmp_path / f"output-{r:04d}" / "data_asc_0D"
        d.mkdir(parents=True)
        lines = ["# header", ""] + ["  " + scalar_row(i, i * 0.5, 10.0 * r + i) + "  # note" for i in its]
        (d / "ADMMass_VolumeMass[0]..asc").write_text("\n".join(lines) + "\n")
    df = ascii.read_scalar(spark, "hi", str(tmp_path), "ADMMass_VolumeMass[0]")
    assert df.count() == 7
    kept = series.first_restart_wins(df, ["run"], "iteration", "restart").orderBy("iteration", "restart").collect()
    assert [(r.iteration, r.restart, r.time, r.value) for r in kept] == [
        (0, 0, 0.0, 0.0), (1, 0, 0.5, 1.0), (2, 0, 1.0, 2.0), (3, 2, 1.5, 23.0), (3, 2, 1.5, 23.0)]


def _restarts(tmp_path):
    for r in range(4):
        d = tmp_path / f"output-{r:04d}" / "data_asc_0D"
        d.mkdir(parents=True)
        for q in ("mass", "energy", "mass_b[0]"):
            (d / f"{q}..asc").write_text("".join(scalar_row(i, i * 0.5, r + 0.25) + "\n" for i in range(r, r + 3)))
        (d / "mass.txt").write_text("not a table\n")
    (tmp_path / "output-17").mkdir()
    (tmp_path / "other").mkdir()


def test_filters_open_only_their_files(spark, tmp_path):
    _restarts(tmp_path)
    # A file that would break the scan if it were opened.
    os.chmod(tmp_path / "output-0003" / "data_asc_0D" / "mass..asc", 0)
    (tmp_path / "output-0002" / "data_asc_0D" / "mass..asc").unlink()
    os.symlink(tmp_path / "nowhere", tmp_path / "output-0002" / "data_asc_0D" / "mass..asc")
    df = ascii.read_scalar(spark, "a", str(tmp_path), "mass")
    early = df.filter("restart < 2")
    assert early.rdd.getNumPartitions() == 2
    assert sorted((r.restart, r.iteration) for r in early.collect()) == [(r, i) for r in (0, 1) for i in range(r, r + 3)]
    some = ascii.read_restarts(spark, "a", str(tmp_path), "data_asc_0D").filter("restart in (0, 3) and quantity like 'en%' and line > 0")
    assert some.rdd.getNumPartitions() == 2
    assert sorted((r.restart, r.quantity, r.cols[0]) for r in some.collect()) == [(0, "energy", 1.0), (0, "energy", 2.0), (3, "energy", 4.0), (3, "energy", 5.0)]
    assert df.filter("restart = 9").count() == 0


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
@pytest.mark.parametrize("split", [1, 2, 5, 8, 1000])
def test_pieces_of_a_file_hold_each_line_once(size, split):
    import io

    for text in ("", "\n", "a", "a\n", "\n\nab\n", "ab\r\ncd\n\nefghijkl", "x" * 20 + "\ny\n"):
        raw = text.encode()
        got = []
        for start in range(0, max(len(raw), 1), split):
            for places, lines in restarts.line_batches(io.BytesIO(raw), start, min(start + split, len(raw)), size):
                got += zip(places, lines)
        want, at = [], 0
        for line in raw.split(b"\n")[: None if raw and not raw.endswith(b"\n") else -1]:
            want.append((at, line.decode().removesuffix("\r")))
            at += len(line) + 1
        assert got == want


def test_puncture_and_volume(spark, tmp_path):
    for r in (0, 1):
        d = tmp_path / f"output-{r:04d}" / "Scalars"
        d.mkdir(parents=True)
        for axis in "xyz":
            for body in (0, 1):
                (d / f"pt_loc_{axis}[{body}]..asc").write_text("\n".join(scalar_row(i, i * 1.0, i + body * 0.5) for i in (r, r + 1)) + "\n")
    track = tracks.combine_axes(ascii.read_puncture(spark, "a", str(tmp_path)))
    got = sorted((r.body, r.iteration, r.time, r.x, r.y, r.z) for r in track.collect())
    assert got == [(b, i, float(i), i + b * 0.5, i + b * 0.5, i + b * 0.5) for b in (0, 1) for i in (0, 1, 2)]

    (tmp_path / "short.txt").write_text("1 2 3 4 5 6 7 8\n")
    (tmp_path / "long.txt").write_text("1 2 3 4 5 6 7 8 9 10 11\n")
    short = ascii.read_volume(spark, "s", str(tmp_path / "short.txt"), long=False)
    long = ascii.read_volume(spark, "l", str(tmp_path / "long.txt"), long=True)
    both = {r.run: r for r in series.merge_volume_families(short, long).collect()}
    assert both["s"].mass == 8.0 and both["s"]["kinetic-shi"] is None and both["l"]["kinetic-shi"] == 7.0 and both["l"].mass == 11.0


def test_profile_round_trip_and_noise(spark, tmp_path):
    df = spark.createDataFrame([(0.1, 2.5), (0.2, 3.5)], "r double, v double")
    ascii.write_profile(df, str(tmp_path / "p"))
    back = ascii.read_profile(spark, str(tmp_path / "p"), ["r", "v"]).orderBy("r").collect()
    assert [tuple(r) for r in back] == [(0.1, 2.5), (0.2, 3.5)]
    (tmp_path / "noise.txt").write_text("10 1e-23 2e-23 3e-23\n")
    assert ascii.read_noise(spark, str(tmp_path / "noise.txt"), 3).first().amp == 3e-23


@pytest.fixture()
def tree(tmp_path):
    for p in ("a/b/c/d/deep.h5", "a/one.par", "a/log.out", "b/err.err", "b/checkpoint.chkpt.it_0.h5", "SIMFACTORY/x.par", "b/tmp/y.h5", "b/keep/.hidden", "top.h5"):
        f = tmp_path / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("")
    os.symlink(tmp_path / "a", tmp_path / "link")
    os.symlink(tmp_path / "top.h5", tmp_path / "toplink.h5")
    return tmp_path


@pytest.mark.parametrize("parallelism", [1, 5])
def test_walk(spark, tree, parallelism):
    idx = walk.walk(spark, str(tree), exclude_dirs=["keepnot"], exclude_files=["checkpoint.chkpt.*"], parallelism=parallelism)
    files = sorted(os.path.relpath(r.path, tree) for r in idx.filter("not is_dir").collect())
    assert files == ["a/b/c/d/deep.h5", "a/log.out", "a/one.par", "b/err.err", "b/keep/.hidden", "top.h5"]
    dirs = sorted(os.path.relpath(r.path, tree) for r in idx.filter("is_dir").collect())
    assert dirs == [".", "a", "a/b", "a/b/c", "a/b/c/d", "b", "b/keep"]
    ext = {r.name: r.ext for r in idx.filter("not is_dir").collect()}
    assert ext[".hidden"] == "" and ext["deep.h5"] == ".h5"
    kinds = {k: [r.name for r in v.collect()] for k, v in walk.by_extension(idx).items()}
    assert kinds == {"log": ["log.out"], "err": ["err.err"], "par": ["one.par"]}


def test_walk_depth_and_cache(spark, tree, tmp_path, capsys):
    shallow = walk.walk(spark, str(tree), max_depth=2)
    files = sorted(os.path.relpath(r.path, tree) for r in shallow.filter("not is_dir").collect())
    assert files == ["a/log.out", "a/one.par", "b/checkpoint.chkpt.it_0.h5", "b/err.err", "top.h5"]
    assert "a/b" in {os.path.relpath(r.path, tree) for r in shallow.filter("is_dir").collect()}
    cache = str(tree / "report" / "index")
    a = walk.open_index(spark, str(tree), cache).collect()
    b = walk.open_index(spark, str(tree), cache, reuse=True).collect()
    assert sorted(a) == sorted(b)
    walk.open_index(spark, "/elsewhere", cache, reuse=True)
    assert "WARNING" in capsys.readouterr().out
    with pytest.raises(ValueError):
        walk.open_index(spark, str(tree), None, reuse=True)


def slices(spark, its=(3, 1, 2), variable="rho", run="r"):
    rows = [(run, variable, "xy", i, i * 0.5, 2, 2, [float(i), 1 / 3, float("nan"), 4.0]) for i in its]
    return spark.createDataFrame(rows, FIELD_SLICE)


@pytest.mark.parametrize("level, dtype", [(0, "float64"), (None, "float64"), (4, "float32")])
def test_slice_store(spark, tmp_path, level, dtype):
    path = str(tmp_path / "store")
    slice_store.write(slices(spark).unionByName(slices(spark, (7,), "press")), path, compression_level=level, dtype=dtype)
    got = list(slice_store.iterate(spark, path, "rho", "r"))
    assert [r.iteration for r in got] == [1, 2, 3]
    assert got[0].data[1] == (1 / 3 if dtype == "float64" else float(np.float32(1 / 3)))
    assert slice_store.at_iteration(spark, path, "rho", 2).time == 1.0
    with pytest.raises(KeyError):
        slice_store.at_iteration(spark, path, "rho", 99)
    gz = [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".gz.parquet")]
    assert bool(gz) == bool(level)
    plan = slice_store.variable(spark, path, "rho").filter("iteration > 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "variable" in plan.split("PartitionFilters")[1][:200]
    assert "GreaterThan(iteration,1)" in plan


def test_lookup_opens_one_file(spark, tmp_path):
    path = str(tmp_path / "store")
    many = slices(spark, range(40), "a:b[0] c").unionByName(slices(spark, range(0, 40, 3), "press", "r 2"))
    slice_store.write(many, path, file_bytes=200, staged=False)
    listed = slice_store.manifest(spark, path).collect()
    assert len(listed) > 4 and sum(r.n for r in listed) == 54
    for key in {(r.run, r.variable) for r in listed}:
        mine = sorted((r.lo, r.hi) for r in listed if (r.run, r.variable) == key)
        assert all(a[1] < b[0] for a, b in zip(mine, mine[1:]))
    hit = slice_store.lookup(spark, path, "a:b[0] c", [17])
    assert len(hit.inputFiles()) == 1 and [r.time for r in hit.collect()] == [8.5]
    assert slice_store.lookup(spark, path, "press", [1, 2]).count() == 0 and slice_store.lookup(spark, path, "press", []).count() == 0
    assert slice_store.at_iteration(spark, path, "press", 39, "r 2").iteration == 39


def test_stream_sorts_no_arrays(spark, tmp_path):
    path = str(tmp_path / "store")
    runs = [slices(spark, range(5, 45, s), "rho", r) for s, r in ((2, "a"), (3, "b"))]
    slice_store.write(runs[0].unionByName(runs[1]), path, file_bytes=150)
    want = sorted([(i, "a") for i in range(5, 45, 2)] + [(i, "b") for i in range(5, 45, 3)])
    assert [(r.iteration, r.run) for r in slice_store.iterate(spark, path, "rho")] == want
    placed = slice_store.numbered(spark, path, "rho")
    got = sorted((r.run, r.position, r.iteration) for r in placed.collect())
    assert got == sorted((r, k, i) for r, s in (("a", 2), ("b", 3)) for k, i in enumerate(range(5, 45, s)))
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert not any("data#" in line for line in plan.splitlines() if line.strip(" :+-").startswith(("Sort", "Window", "RepartitionBy")))
    # A streamed append lands in the middle, first unlisted, then listed.
    slices(spark, (8, 100), "rho", "a").write.mode("append").partitionBy("run", "variable").parquet(path)
    for _ in range(2):
        assert [(r.iteration, r.run) for r in slice_store.iterate(spark, path, "rho")] == sorted([*want, (8, "a"), (100, "a")])
        assert slice_store.at_iteration(spark, path, "rho", 100).run == "a"
        slice_store.refresh(spark, path)
    assert slice_store._listed(spark, path).count() == slice_store.manifest(spark, path).count()
    with pytest.raises(ValueError):
        slice_store.numbered(spark, path, "rho")


def test_gzip_levels(spark, tmp_path):
    noisy = np.round(np.random.default_rng(0).normal(size=40_000), 1).tolist()
    df = spark.createDataFrame([("r", "v", "xy", 1, 0.0, 200, 200, noisy)], FIELD_SLICE)
    sizes = []
    for level in (1, 6, 9):
        path = tmp_path / str(level)
        slice_store.write(df, str(path), compression_level=level)
        sizes.append(sum(f.stat().st_size for f in path.rglob("*.gz.parquet") if slice_store.MANIFEST not in str(f)))
    assert sizes[0] > sizes[1] >= sizes[2]
    with pytest.raises(ValueError):
        slice_store.write(df, str(tmp_path / "x"), compression_level=10)


def test_streamed_append(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    slices(spark, (1, 2)).write.parquet(src)
    for extra in (None, (5,)):
        if extra:
            slices(spark, extra).write.mode("append").parquet(src)
        stream.append_slices(stream.new_slices(spark, src), out, ck).awaitTermination()
    assert sorted(r.iteration for r in slice_store.read(spark, out).collect()) == [1, 2, 5]


def fake_series(path, its=(0, 8), base=0.0):
    def it(k):
        record = {"shape": [9, 9], "position": [0.5, 0.0], "chunks": [[[0, 0], [9, 9]]], "base": base + 100 * k}
        mesh = {"components": {"scalar": record}, "attrs": {"gridSpacing": [1.0, 1.0], "gridGlobalOffset": [-4.0, -4.0], "time": 7.0 + k}}
        far = {"components": {"scalar": record}, "attrs": {"gridSpacing": [1.0, 1.0], "gridGlobalOffset": [500.0, 500.0], "time": 7.0}}
        return {"time": 2.0 * k if k else None, "meshes": {"hydro_rho_patch00_lev00": mesh, "hydro_rho_patch01_lev00": far, "odd": mesh}}

    path.write_text(json.dumps({k: it(k) for k in its}))


def test_openpmd_index_and_load(spark, tmp_path):
    p = tmp_path / "sim.it00000000.bp5"
    fake_series(p)
    idx = openpmd.chunk_index(spark, [str(p)], "all")
    assert idx.count() == 6 and {r.time for r in idx.collect()} == {7.0, 16.0}
    assert {r.iteration for r in openpmd.chunk_index(spark, [str(p)]).collect()} == {0}
    assert {r.iteration for r in openpmd.chunk_index(spark, [str(p)], "last").collect()} == {8}
    near = openpmd.intersecting(amr.labelled(idx), -10, 10, -10, 10)
    assert {r.mesh_name for r in near.collect()} == {"hydro_rho_patch00_lev00"}
    row = openpmd.load_chunks(near.filter("iteration = 0")).first()
    # The unwritten last row of the cell-centred axis is not loaded.
    assert row.ext == [8, 9] and len(row.data) == 72 and row.data[:10] == [float(v) for v in range(10)]


def test_resample_end_to_end(spark, tmp_path):
    sim = tmp_path / "sim"
    sim.mkdir()
    for k in (0, 8, 16):
        fake_series(sim / f"s.it{k:08d}.bp5", its=(k,))
    y = tmp_path / "cfg.yaml"
    y.write_text(
        f"simdir: {sim}\nlabel: test\nvariables: [hydro_rho, missing]\noutput_dir: {tmp_path}/out\n"
        "iteration_min: 8\ninterp_order: 1\ngrid: {resolution: [5, 7], box_bound: 3.0}\n"
    )
    cfg = config.load_resample_config(y)
    out = resample.run(spark, cfg)
    rows = slice_store.read(spark, out).orderBy("iteration").collect()
    assert [r.iteration for r in rows] == [8, 16]
    r = rows[0]
    assert (r.nx, r.ny, r.run, r.variable) == (5, 7, "test", "hydro_rho")
    # f = 9 * row + column on centres y = -3.5 + row, x = -4 + column.
    gx, gy = np.linspace(-3, 3, 5), np.linspace(-3, 3, 7)
    want = 800 + 9 * (gy[None, :] + 3.5) + (gx[:, None] + 4)
    np.testing.assert_allclose(np.array(r.data).reshape(5, 7), want)
    bad = config.ResampleConfig(**{**cfg.__dict__, "variables": ("nothing",)})
    with pytest.raises(ValueError):
        resample.run(spark, bad)


def test_hdf5_needs_h5py(spark):
    with pytest.raises(Exception, match="h5py"):
        openpmd.read_slice_files(spark, "r", {"rho": "/nowhere.h5"}).collect()
