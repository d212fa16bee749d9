import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import gridjoin, spectral
from gridloom.plans import waves


def modes(n=240, seed=0):
    rng = np.random.default_rng(seed)
    t = 3.0 + 0.5 * np.arange(n)
    out = []
    for run in "ab":
        for l, m in ((2, 2), (3, 2), (2, -1), (4, 2)):
            w = np.exp(-((t - t.mean()) ** 2) / 400) * np.exp(1j * (0.4 + 0.1 * l) * t) * rng.uniform(0.5, 1.5)
            out.append(pd.DataFrame({"run": run, "l": l, "m": m, "t": t, "re": w.real, "im": w.imag}))
    return pd.concat(out, ignore_index=True)


def ffi(z, dt, cutoff, order):
    om = 2 * np.pi * np.fft.fftfreq(z.size, dt)
    floor = np.maximum(np.abs(om), 2 * np.pi / cutoff)
    x = np.fft.fft(z)
    return np.fft.ifft(-x / floor**2 if order == 2 else -1j * x * np.sign(om) / floor)


@pytest.mark.parametrize("order", [1, 2])
def test_fixed_frequency_integration(spark, order):
    pdf = modes()
    got = waves.integrate_fixed_frequency(spark.createDataFrame(pdf).repartition(3), 30.0, order).toPandas()
    for key, g in pdf.groupby(["run", "l", "m"]):
        mine = got[(got.run == key[0]) & (got.l == key[1]) & (got.m == key[2])].sort_values("t")
        np.testing.assert_allclose(mine.t, g.t, atol=1e-9)
        np.testing.assert_allclose(mine.re + 1j * mine.im, ffi(g.re.to_numpy() + 1j * g.im.to_numpy(), 0.5, 30.0, order), atol=1e-9)


def test_integration_of_a_wave_is_its_antiderivative(spark):
    n, dt = 256, 0.25
    w = 2 * np.pi * 16 / (n * dt)
    t = dt * np.arange(n)
    pdf = pd.DataFrame({"run": "a", "l": 2, "m": 2, "t": t, "re": np.cos(w * t), "im": np.sin(w * t)})
    got = waves.integrate_fixed_frequency(spark.createDataFrame(pdf), 100.0, 1).toPandas().sort_values("t")
    np.testing.assert_allclose(got.re + 1j * got.im, np.exp(1j * w * t) / (1j * w), atol=1e-10)


def test_strain_trims_one_cutoff(spark):
    pdf = modes()
    h = waves.strain(spark.createDataFrame(pdf), 500.0, 10.0).toPandas()
    assert h.t.min() == pytest.approx(pdf.t.min() + 10) and h.t.max() == pytest.approx(pdf.t.max() - 10)


def test_harmonics():
    theta, phi = 0.8, 0.3
    assert waves.spin_harmonic(2, 2, theta, phi) == pytest.approx(
        math.sqrt(5 / (64 * math.pi)) * (1 + math.cos(theta)) ** 2 * np.exp(2j * phi))
    assert waves.spin_harmonic(2, 0, theta, phi) == pytest.approx(math.sqrt(15 / (32 * math.pi)) * math.sin(theta) ** 2)
    assert waves.spin_harmonic(2, -2, theta, phi) == pytest.approx(
        math.sqrt(5 / (64 * math.pi)) * (1 - math.cos(theta)) ** 2 * np.exp(-2j * phi))
    # Orthonormality over the sphere.
    th = (np.arange(400) + 0.5) * np.pi / 400
    y = [np.array([waves.spin_harmonic(l, 1, v, 0.0).real for v in th]) for l in (2, 3)]
    area = 2 * np.pi * np.sin(th) * np.pi / 400
    assert (y[0] * y[0] * area).sum() == pytest.approx(1, abs=1e-4)
    assert (y[0] * y[1] * area).sum() == pytest.approx(0, abs=1e-4)


def test_total_strain(spark):
    pdf = modes()
    got = waves.total_strain(spark.createDataFrame(pdf), 0.8, 0.3).toPandas()
    for run, g in pdf.groupby("run"):
        z = sum((x.re + 1j * x.im).to_numpy() * waves.spin_harmonic(l, m, 0.8, 0.3) for (l, m), x in g.groupby(["l", "m"]))
        mine = got[got.run == run].sort_values("t")
        np.testing.assert_allclose(mine.re + 1j * mine.im, z, atol=1e-12)


def test_radiated(spark):
    pdf = modes()
    got = waves.radiated(spark.createDataFrame(pdf), 100.0, 30.0).toPandas()

    def d(l, m):
        return math.sqrt(max(0.0, (l * l - 4) * (l * l - m * m) / ((2 * l - 1) * (2 * l + 1)))) / l

    for run, g in pdf.groupby("run"):
        z = {k: (x.re + 1j * x.im).to_numpy() for k, x in g.groupby(["l", "m"])}
        one = {k: ffi(v, 0.5, 30.0, 1) for k, v in z.items()}
        two = {k: ffi(v, 0.5, 30.0, 2) for k, v in z.items()}
        zero = np.zeros(240, complex)
        unit = 100.0**2 / (16 * np.pi)
        e = unit * sum(abs(v) ** 2 for v in one.values())
        j = unit * sum(m * (two[l, m] * one[l, m].conj()).imag for l, m in one)
        p = unit * sum(
            (one[l, m] * np.conj(2 * m / (l * (l + 1)) * one[l, m] + d(l, m) * one.get((l - 1, m), zero) + d(l + 1, m) * one.get((l + 1, m), zero))).real
            for l, m in one)
        mine = got[got.run == run].sort_values("t")
        for name, flux in (("energy", e), ("j_z", j), ("p_z", p)):
            want = np.concatenate([[0], np.cumsum(0.25 * (flux[1:] + flux[:-1]))])
            np.testing.assert_allclose(mine[name], want, rtol=1e-8, atol=1e-8)


def test_chain(spark):
    out = waves.analyse(spark.createDataFrame(modes()), 100.0, 30.0)
    assert out["merger"].count() == 2 and out["peak"].count() == 2
    assert out["frequency"].filter("f_gw = 0").count() >= 4


def test_chain_over_cutoffs_and_detectors(spark):
    noise = spark.createDataFrame([(d, 100.0 * k, a * (1 + 0.01 * k)) for d, a in (("one", 1.0), ("two", 2.0)) for k in range(400)], "detector string, f double, amp double")
    out = waves.snr_chain(spark.createDataFrame(modes()), 100.0, noise, cutoffs=(20.0, 30.0), before=40, distance=1.0, band=(5000.0, 30000.0, 250.0))
    got = {(r.run, r.cutoff, r.detector): r.snr for r in out["snr"].collect()}
    assert len(got) == 8 and all(v > 0 for v in got.values())
    for (run, cutoff, detector), v in got.items():
        np.testing.assert_allclose(v, got[run, cutoff, "one"] / (1 if detector == "one" else 2), rtol=1e-9)
    one = waves.strain(spark.createDataFrame(modes()), 100.0, 30.0).orderBy("run", "l", "m", "t").toPandas()
    many = waves.strains(spark.createDataFrame(modes()), 100.0, (20.0, 30.0)).filter("cutoff = 30").orderBy("run", "l", "m", "t").toPandas()
    np.testing.assert_allclose(many["re"], one["re"], rtol=1e-9, atol=1e-9)
    assert out["peak"].count() == 4


def test_join_on_grid(spark):
    left = spark.createDataFrame([("a", 0.1 * k, k) for k in range(50)] + [(None, 0.3, 99)], "run string, t double, n int")
    right = spark.createDataFrame([("a", 0.1 * k + (-1) ** k * 4e-7, -k) for k in range(50)] + [(None, 0.3, -99), ("b", 0.2, 0)], "run string, t double, v int")
    got = gridjoin.join_on_grid(left, right, ["run"], "t", tolerance=1e-6)
    assert got.columns == ["run", "t", "n", "v"] and sorted((r.n, r.v) for r in got.collect()) == sorted([(k, -k) for k in range(50)] + [(99, -99)])
    fewer = right.filter("v <> -7")
    with pytest.raises(Exception, match="no partner"):
        gridjoin.join_on_grid(left, fewer, ["run"], "t", tolerance=1e-6).collect()
    assert gridjoin.join_on_grid(left, fewer, ["run"], "t", tolerance=1e-6, missing="drop").count() == 50
    assert gridjoin.join_on_grid(left, fewer, ["run"], "t", tolerance=1e-6, missing="null").filter("v is null").count() == 1
    with pytest.raises(Exception, match="two tolerances"):
        gridjoin.join_on_grid(left, right.unionByName(right.filter("v = -5")), ["run"], "t", tolerance=1e-6).collect()


def test_gaps_in_a_spectrum_are_errors(spark):
    spec = spark.createDataFrame([("a", k, 1.0 + k, 2.0) for k in range(9)], "run string, k int, f double, amp double")
    noise = spark.createDataFrame([(k, 0.5) for k in range(9)], "k int, noise double")
    snr = lambda n: spectral.signal_to_noise(spec, n, ["run"], "k", "f", "amp", "noise", F.lit(9), F.lit(1.0)).collect()
    assert len(snr(noise)) == 1
    for bad in (noise.filter("k <> 4"), noise.filter("k <> 4").unionByName(noise.filter("k = 3"))):
        with pytest.raises(Exception, match="every point"):
            snr(bad)


@pytest.mark.parametrize("group", [1 << 18, 16, 40])
def test_filtered_any_length(spark, group):
    """Group 16 forces the split form for 150 and 64 and the convolution form for the prime 97; a NULL run is a run."""
    rng = np.random.default_rng(5)
    z = {n: rng.normal(size=n) + 1j * rng.normal(size=n) for n in (150, 97, 64, 2, 12)}
    rows = [(None if n == 64 else str(n), n, i, 0.5, float(v.real), float(v.imag)) for n, x in z.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "run string, n bigint, idx bigint, dt double, re double, im double").repartition(3)
    responses = [lambda w: np.exp(-w * w), lambda w: 1j * w]
    got = spectral.filtered(df, ["run", "dt"], "idx", "n", "dt", "re", "im", responses, group=group).toPandas()
    assert len(got) == len(rows)
    for n, x in z.items():
        mine = got[got.n == n].sort_values("k")
        assert mine.run.isna().all() if n == 64 else (mine.run == str(n)).all()
        for i, response in enumerate(responses):
            # fftfreq puts the middle frequency of an even length below zero, as here.
            want = np.fft.ifft(np.fft.fft(x) * response(2 * np.pi * np.fft.fftfreq(n, 0.5)))
            np.testing.assert_allclose(mine[f"re{i}"] + 1j * mine[f"im{i}"], want, atol=1e-9)


def test_chain_is_read_once_and_shuffled_little(spark, monkeypatch):
    """Long runs: the flux is made once for all later passes, and the transforms of both orders share their three steps."""
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.localCheckpoint()

    monkeypatch.setattr(waves, "settled", kept)
    spark.conf.set("gridloom.hot.rows", "100")
    df = spark.createDataFrame(modes()).localCheckpoint()
    try:
        out = waves.radiated(df, 100.0, 30.0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        hot = out.orderBy("run", "t").toPandas()
    finally:
        spark.conf.unset("gridloom.hot.rows")
    assert len(plans) == 1 and plans[0].count("FlatMapGroupsIn") == 1 and "FlatMapGroupsIn" not in plan
    usual = waves.radiated(df, 100.0, 30.0).orderBy("run", "t").toPandas()
    np.testing.assert_allclose(hot[["t", "energy", "j_z", "p_z"]], usual[["t", "energy", "j_z", "p_z"]], rtol=1e-9, atol=1e-9)
