import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import formats, names
from gridloom.operators import diagnostics


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "s string").select(column("s").alias("r")).first().r


@pytest.mark.parametrize("text, elevation, plane, axis, start", [
    ("xy_z_pos0012p500", 12.5, "xy", "z", 0),
    ("xz_y_neg0003p000", -3.0, "xz", "y", 0),
    ("xy_z_pos12p5", 12.5, "xy", "z", 0),
    ("sim.yz_x_pos7.it00000001.bp5", 7.0, "yz", "x", 4),
    ("sim.yz_z_neg7p.it1.bp5", -7.0, "yz", "z", 4),
    ("/a/xz_y_pos1/sim.xy_z_pos2p25.it1.bp5", 2.25, "xy", "z", 4),
    ("/a/xz_y_pos1p5/sim.it1.bp5", 1.5, "xz", "y", 3),
])
def test_plane_tag(spark, text, elevation, plane, axis, start):
    r = one(spark, names.plane_tag, text)
    assert (r.elevation, r.plane, r.normal_axis, r.start) == (elevation, plane, axis, start)
    assert r.end - r.start == len(r.tag) and r.tag in text


def test_no_plane_tag(spark):
    for text in ("volume", "xy_w_pos1", "zx_y_pos1", "", "xy_z_pos"):
        assert one(spark, names.plane_tag, text) is None


@pytest.mark.parametrize("name, group, centering, level, patch, tag", [
    ("xy_z_pos0000p000_hydrobasex_rho_patch00_lev09", "hydrobasex_rho", None, 9, 0, "xy_z_pos0000p000"),
    ("xz_y_neg0003p000_hydrobasex_bvec_cv_patch00_lev02", "hydrobasex_bvec", "cv", 2, 0, "xz_y_neg0003p000"),
    ("hydrobasex_rho_lev09_patch03", "hydrobasex_rho", None, 9, 3, None),
    ("admbasex_g_vc_patch10_lev010", "admbasex_g", "vc", 10, 10, None),
    ("a_xy_z_pos1_b_patch00_lev00", "a_xy_z_pos1_b", None, 0, 0, "xy_z_pos1"),
    ("f_cc_patch00_lev00", "f_cc", None, 0, 0, None),
    ("a_lev1_patch2_lev3", "a_lev1", None, 3, 2, None),
])
def test_mesh_name(spark, name, group, centering, level, patch, tag):
    r = one(spark, names.mesh_name, name)
    assert (r.group, r.centering, r.level, r.patch) == (group, centering, level, patch)
    assert (r.plane.tag if r.plane else None) == tag


def test_unparseable_mesh(spark):
    for name in ("rho", "rho_patch00", "_patch00_lev00", "rho_lev1"):
        assert one(spark, names.mesh_name, name) is None
    df = spark.createDataFrame([("rho",), ("rho_patch00_lev00",)], "mesh_name string")
    assert names.with_mesh(df).count() == 1 and names.with_mesh(df, keep_unparsed=True).count() == 2
    assert [r.mesh_name for r in diagnostics.unrecognised(df).collect()] == ["rho"]


@pytest.mark.parametrize("comp, group, label", [
    ("scalar", "rho", "rho"), ("VALUE", "rho", "rho"), ("0", "rho", "rho"), ("vx", "rho", "vx"), ("scalar", "", "scalar"), ("", "rho", "rho"),
])
def test_component_label(spark, comp, group, label):
    df = spark.createDataFrame([(comp, group)], "c string, g string")
    assert df.select(names.component_label("c", "g").alias("r")).first().r == label


def test_small_name_helpers(spark):
    assert one(spark, names.file_token, "vel[0]") == "vel_0"
    assert one(spark, names.safe_name, "vel[0]") == "vel_0_"
    assert one(spark, names.iteration_number, "/x/name.it00012345.bp5") == 12345
    assert one(spark, names.iteration_number, "/x/name.bp5") == 0
    assert one(spark, names.level_in_name, "m_lev07_x") == 7
    assert one(spark, names.level_in_name, "m") == 0
    assert one(spark, names.truncated, "a" * 70) == "a" * 67 + "..."
    assert one(spark, names.truncated, "a" * 69) == "a" * 69
    assert one(spark, lambda c: names.part_file(names.variable_file(c, "run"), F.lit(7)), "vel[0]") == "vel_0__run.part0007.h5"


def test_series_names(spark):
    ok = {"a.it1.bp5": (True, True), "a.bp5": (True, False), "a.it1.h5/": (True, True), "a.md.0": (False, False),
          "a.it1.md.bp5": (False, False), "a.it1.dir": (False, False), "a.it1.txt": (False, False), "x.it/a.bp": (True, False)}
    df = spark.createDataFrame([(k,) for k in ok], "p string").select("p", names.is_series_name("p").alias("s"), names.is_iteration_series("p").alias("i"))
    assert {r.p: (r.s, r.i) for r in df.collect()} == ok


def test_globs_agree_with_fnmatch(spark):
    globs = ["*.xyz.h5", "checkpoint.chkpt.*", "a[0-9]?", "b[!x]", "c.d", "[[]z"]
    cases = ["f.xyz.h5", "fxyz.h5", "checkpoint.chkpt.it_0", "a1b", "a1", "bx", "by", "cxd", "c.d", "[z", "f.xyz.h5.old"]
    df = spark.createDataFrame([(c,) for c in cases], "s string").select("s", names.any_glob("s", globs).alias("r"))
    assert {r.s: r.r for r in df.collect()} == {c: names.matches_glob(c, globs) for c in cases}


def test_plane_filter(spark):
    paths = ["s.xy_z_pos0012p500.it1.bp5", "s.xy_z_pos0013.it1.bp5", "s.xz_y_pos0012p500.it1.bp5", "s.it1.bp5"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")

    def kept(**kw):
        return [r.path for r in df.filter(names.plane_matches("path", **kw)).collect()]

    assert kept() == paths
    assert kept(elevation=12.500001) == [paths[0], paths[2]]
    assert kept(plane="xy") == paths[:2]
    assert kept(tag="xy_z_pos0013") == [paths[1]]
    assert kept(normal_axis="y", elevation=12.5) == [paths[2]]
    kinds = {r.kind: r.n_series for r in diagnostics.series_kinds(df).collect()}
    assert kinds == {"2D": 3, "3D": 1}


def test_title(spark):
    df = spark.createDataFrame([(1.5, 42)], "t double, it bigint")
    got = df.select(names.title(r"$\rho_{x}$ {t:.3f} {it} {idx}", t="t", it="it", idx=F.lit(3)).alias("r")).first().r
    assert got == r"$\rho_{x}$ 1.500 42 3"


SPECS = [".0f", ".1f", ".2f", ".3f", "+.2f", " .1f", "010.2f", ",.2f", "_.1f", ">12.3f", "*<9.1f", "^11.2f", "x=+12.1f", ".1%", ".0%", "f", "F", "", ">12", ".12f"]
WHOLE_SPECS = ["", "d", ">6", "<6d", "^7", "+d", "06d", ",", "_d", "x", "X", "o", "b", "08b", "_x", ".2f", ".1%", "*=+9d"]


def test_format_specs_equal_python(spark):
    rng = np.random.default_rng(6)
    values = [0.0, -0.0, 0.125, 0.375, 2.675, 1.005, -2.5, 0.5, 1.5, 1e15 + 0.5, 1e16, 123456789.125, -1234567.891, 1e-7, 0.00012345, 9.995, 99.95, float("nan"), float("inf"), -float("inf"), 2.0**52]
    values += [float(v) for v in rng.normal(size=60) * 10.0 ** rng.integers(-6, 9, 60)]
    values += [float(k) / 2 ** int(rng.integers(0, 12)) for k in rng.integers(-10**7, 10**7, 60)] + [round(float(v), int(d)) for v, d in zip(rng.uniform(0, 2000, 120), rng.integers(1, 6, 120))]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    made = df.select("k", *[formats.formatted(F.col("v"), s, integer=False).alias(f"s{i}") for i, s in enumerate(SPECS)]).collect()
    for r in made:
        for i, s in enumerate(SPECS):
            if s != ".12f" or abs(values[r.k]) < 1000:
                assert r[f"s{i}"] == format(values[r.k], s), (values[r.k], s)
    whole = [0, 7, -7, 1234, -123456, 2**40, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(whole)], "k int, v bigint")
    for r in df.select("k", *[formats.formatted(F.col("v"), s, integer=True).alias(f"s{i}") for i, s in enumerate(WHOLE_SPECS)]).collect():
        for i, s in enumerate(WHOLE_SPECS):
            if "f" not in s and "%" not in s or abs(whole[r.k]) < 2**50:
                assert r[f"s{i}"] == format(whole[r.k], s), (whole[r.k], s)


@pytest.mark.parametrize("spec, integer", [(".3e", False), ("g", False), ("d", False), ("010,.2f", False), (".20f", False), ("abc", True), (".2d", True), (",x", True)])
def test_unsupported_specs_are_errors(spec, integer):
    with pytest.raises(ValueError):
        formats.formatted(F.lit(1), spec, integer=integer)
