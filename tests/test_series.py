import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import series, spectral, splines, tracks


@pytest.fixture(params=["plain", "hot"])
def mode(request, spark):
    if request.param == "hot":
        request.getfixturevalue("hot")
    return request.param


def runs(seed=0, sizes=(150, 90, 60)):
    rng = np.random.default_rng(seed)
    out = []
    for name, n in zip("abc", sizes):
        t = np.cumsum(rng.uniform(0.5, 1.5, n))
        amp = np.exp(-((t - t[n // 3]) ** 2) / 50) + 0.1 * rng.random(n)
        ph = np.cumsum(rng.uniform(0.1, 0.9, n))
        out.append(pd.DataFrame({"run": name, "t": t, "amp": amp, "re": amp * np.cos(ph), "im": -amp * np.sin(ph)}))
    return pd.concat(out, ignore_index=True)


def test_align_matches_loop(spark, mode):
    pdf = runs()
    df = spark.createDataFrame(pdf).repartition(4)
    got = series.align(df, ["run"], "t", "amp").toPandas()
    merge = {r: g.loc[g.amp.round(15) == round(g.amp.max(), 15), "t"].iloc[-1] for r, g in pdf.groupby("run")}
    common = min((g.t - merge[r]).max() for r, g in pdf.groupby("run"))
    for r, g in pdf.groupby("run"):
        t = g.t.to_numpy()
        past = np.nonzero(t >= common + merge[r])[0]
        end = past[0] if past.size else 0
        want = g.iloc[:end][g.t.to_numpy()[:end] >= merge[r]]
        mine = got[got.run == r].sort_values("t")
        np.testing.assert_array_equal(mine.t, want.t)
        np.testing.assert_allclose(mine.amp_norm, want.amp / g.amp.max())


def test_last_peak_wins(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 2.0, 5.0 + 1e-17), ("a", 3.0, 4.0)], "run string, t double, amp double")
    assert series.merger(df, ["run"], "t", "amp").first().t_merge == 2.0


def test_unwrap_and_frequency(spark, mode):
    pdf = runs(1)
    df = spark.createDataFrame(pdf).repartition(4)
    ph = spectral.unwrap_phase(df, ["run"], "t", "re", "im")
    got = spectral.instantaneous_frequency(ph, ["run"], "t", "phase").toPandas()
    for r, g in pdf.groupby("run"):
        raw = np.arctan(-g.im.to_numpy() / g.re.to_numpy())
        for j in range(1, raw.size):
            while raw[j] < raw[j - 1]:
                raw[j] += math.pi
        t = g.t.to_numpy()
        f = np.zeros_like(raw)
        f[1:-1] = (raw[2:] - raw[:-2]) / (2 * math.pi) / (t[2:] - t[:-2])
        mine = got[got.run == r].sort_values("t")
        np.testing.assert_allclose(mine.phase, raw, atol=1e-9)
        np.testing.assert_allclose(mine.f_gw, f, atol=1e-9)
        assert mine.f_gw.iloc[0] == 0 and mine.f_gw.iloc[-1] == 0


def test_unwrap_hand_case(spark):
    raw = [0.1, 1.0, -1.4]
    df = spark.createDataFrame([("a", float(i), math.cos(p), -math.sin(p)) for i, p in enumerate(raw)], "run string, t double, re double, im double")
    got = [r.phase for r in spectral.unwrap_phase(df, ["run"], "t", "re", "im").orderBy("t").collect()]
    np.testing.assert_allclose(got, [0.1, 1.0, math.pi - 1.4])


def test_no_phase_at_zero_amplitude(spark):
    """Sample 2 has amplitude 0: no phase there, no frequency beside it, one drop counted after it; 5 and 7 share a time."""
    raw = [0.1, 0.8, None, 0.2, 0.9, 1.0, 1.1, 1.2]
    t = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 5.0, 5.0]
    parts = [(0.0, 0.0) if p is None else (math.cos(p), -math.sin(p)) for p in raw]
    df = spark.createDataFrame([("a", i, t[i], *p) for i, p in enumerate(parts)], "run string, i int, t double, re double, im double")
    got = spectral.instantaneous_frequency(spectral.unwrap_phase(df, ["run"], "t", "re", "im"), ["run"], "t", "phase").orderBy("t", "i").collect()
    after = [p + math.pi for p in raw[3:]]
    np.testing.assert_allclose([r.phase for r in got], [0.1, 0.8, math.nan, *after], atol=1e-12)
    f = [r.f_gw * 2 * math.pi for r in got]
    np.testing.assert_allclose(f, [0, math.nan, (after[0] - 0.8) / 2, math.nan, 0.4, 0.2, math.inf, 0], atol=1e-12)


def tukey(n, alpha):
    k = np.arange(n)
    width = int(np.floor(alpha * (n - 1) / 2.0))
    w = np.ones(n)
    w[: width + 1] = 0.5 * (1 + np.cos(np.pi * (-1 + 2.0 * k[: width + 1] / alpha / (n - 1))))
    w[n - width - 1 :] = 0.5 * (1 + np.cos(np.pi * (-2.0 / alpha + 1 + 2.0 * k[n - width - 1 :] / alpha / (n - 1))))
    return w


@pytest.mark.parametrize("alpha", [0.2, 0.25, 0.5])
def test_polarised_spectrum(spark, mode, alpha):
    pdf = runs(2)
    df = spark.createDataFrame(pdf).repartition(4)
    got = spectral.polarised_spectrum(df, ["run"], "t", "re", "im", alpha).toPandas()
    for r, g in pdf.groupby("run"):
        w = tukey(len(g), alpha)
        dt = (g.t.max() - g.t.min()) / (len(g) - 1)
        p, c = (np.abs(np.fft.rfft((g[k] - g[k].mean()) * w)) * dt for k in ("re", "im"))
        mine = got[got.run == r].sort_values("k")
        np.testing.assert_allclose(mine.amp, np.sqrt((p**2 + c**2) / 2), atol=1e-10)
        np.testing.assert_allclose(mine.f, np.fft.rfftfreq(len(g), dt), atol=1e-12)


@pytest.mark.parametrize("inverse", [False, True])
@pytest.mark.parametrize("group", [1 << 18, 16, 40])
def test_fft_any_length(spark, mode, group, inverse):
    """Group 16 forces the split form for 150 and 64 and the convolution form for the prime 97."""
    rng = np.random.default_rng(5)
    z = {n: rng.normal(size=n) + 1j * rng.normal(size=n) for n in (150, 97, 64, 1, 2, 12)}
    rows = [(str(n), n, i, float(v.real), float(v.imag)) for n, x in z.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "run string, n bigint, idx bigint, re double, im double").repartition(3)
    got = spectral.fft(df, ["run"], "idx", "n", "re", "im", group=group, inverse=inverse).toPandas()
    assert len(got) == len(rows)
    for n, x in z.items():
        mine = got[got.run == str(n)].sort_values("k")
        want = np.fft.ifft(x) if inverse else np.fft.fft(x)
        np.testing.assert_allclose(mine.re + 1j * mine.im, want, atol=1e-10)


@pytest.mark.parametrize("n", [2, 3, 4, 5, 10, 101, 1000])
def test_simpson_average_rule(spark, n):
    rng = np.random.default_rng(n)
    y = rng.normal(size=n)

    def rule(v):
        w = np.ones(v.size)
        w[1:-1:2], w[2:-1:2] = 4, 2
        return (w * v).sum() / 3

    if n == 2:
        want = (y[0] + y[1]) / 2
    elif n % 2:
        want = rule(y)
    else:
        want = ((rule(y[:-1]) + (y[-2] + y[-1]) / 2) + (rule(y[1:]) + (y[0] + y[1]) / 2)) / 2
    df = spark.createDataFrame([("a", i, n, float(v)) for i, v in enumerate(y)], "run string, i bigint, n bigint, y double")
    got = spectral.simpson(df, ["run"], F.col("y"), "i", "n", F.lit(0.5), "s").first().s
    assert got == pytest.approx(want * 0.5, rel=1e-12, abs=1e-12)


def dense_spline(x, y, at):
    n, h = x.size, np.diff(x)
    a, b = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    a[0, :3] = h[1], -(h[0] + h[1]), h[0]
    a[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    m = np.linalg.solve(a, b)
    j = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    d, e = at - x[j], x[j + 1] - at
    return (m[j] * e**3 + m[j + 1] * d**3) / (6 * h[j]) + (y[j] / h[j] - m[j] * h[j] / 6) * e + (y[j + 1] / h[j] - m[j + 1] * h[j] / 6) * d


@pytest.mark.parametrize("block, fan", [(1 << 16, 1 << 10), (100, 1 << 10), (7, 3)])
def test_spline_blocks_equal_dense_solve(spark, mode, block, fan):
    rng = np.random.default_rng(8)
    x = np.cumsum(rng.uniform(0.3, 3.0, 700))
    y = np.sin(x / 40) + 0.05 * rng.normal(size=x.size)
    df = spark.createDataFrame(pd.DataFrame({"run": "a", "x": x, "y": y})).repartition(3)
    lo, hi = x[0] - 1.0, x[-1] + 1.0
    got = splines.cubic_spline(df, ["run"], "x", "y", lo, hi, 0.37, block=block, fan=fan).toPandas().sort_values("k")
    at = lo + np.arange(math.ceil((hi - lo) / 0.37)) * 0.37
    assert list(got.k) == list(range(at.size))
    np.testing.assert_allclose(got.y, dense_spline(x, y, at), rtol=1e-8, atol=1e-8)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_spline_of_short_series_and_null_keys(spark, block):
    rng = np.random.default_rng(4)
    frames, want = [], {}
    at = np.arange(-1.0, 9.0, 0.5)
    for run, n in (("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("f", 6), (None, 11), ("g", 12)):
        x, y = np.cumsum(rng.uniform(0.2, 1.5, n)), rng.normal(size=n)
        frames.append(pd.DataFrame({"run": [run] * n, "x": x, "y": y}))
        want[run] = dense_spline(x, y, at) if n > 3 else np.polyval(np.polyfit(x, y, n - 1), at)
    df = spark.createDataFrame(pd.concat(frames), "run string, x double, y double").repartition(3)
    got = splines.cubic_spline(df, ["run"], "x", "y", -1.0, 9.0, 0.5, block=block, fan=2).toPandas()
    assert len(got) == len(want) * at.size
    for run, values in want.items():
        mine = got[got.run.isna() if run is None else got.run == run].sort_values("k")
        np.testing.assert_allclose(mine.y, values, rtol=1e-7, atol=1e-7)


def test_cyclic_reduction_equals_dense_solve():
    rng = np.random.default_rng(9)
    for n in (1, 2, 3, 8, 33):
        low, up, rhs = rng.normal(size=n), rng.normal(size=n), rng.normal(size=(n, 3))
        diag = 2.5 + np.abs(low) + np.abs(up)
        full = np.diag(diag) + np.diag(low[1:], -1) + np.diag(up[:-1], 1)
        np.testing.assert_allclose(splines.tridiagonal(low, diag, up, rhs), np.linalg.solve(full, rhs), rtol=1e-10, atol=1e-12)


def test_cubic_is_reproduced(spark):
    x = np.linspace(0, 3, 9)
    df = spark.createDataFrame(pd.DataFrame({"run": "a", "x": x, "y": x**3 - 2 * x}))
    got = splines.cubic_spline(df, ["run"], "x", "y", -1.0, 4.0, 0.1).toPandas()
    np.testing.assert_allclose(got.y, got.x**3 - 2 * got.x, atol=1e-9)


def test_cumulative_integral(spark, mode):
    pdf = runs(3)
    got = series.cumulative_integral(spark.createDataFrame(pdf).repartition(3), ["run"], "t", "amp", "e").toPandas()
    for r, g in pdf.groupby("run"):
        want = np.concatenate([[0], np.cumsum(np.diff(g.t) * (g.amp.to_numpy()[1:] + g.amp.to_numpy()[:-1]) / 2)])
        np.testing.assert_allclose(got[got.run == r].sort_values("t").e, want, atol=1e-10)


def test_tracks_take_one_shuffle(spark):
    df = spark.createDataFrame([("a", 0, 0, "x", 1, 0.5, 2.0, 0)], "run string, restart int, body int, axis string, iteration bigint, time double, value double, line int")
    plan = tracks.combine_axes(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_tracks_are_distinct_rows(spark):
    rows = [("a", r, b, ax, it, it * 0.5, it * 1.0 + b) for r in (0, 1) for b in (0, 1) for ax in "xyz" for it in (1, 2)]
    # A restart that recomputed iteration 2 differently is kept as a second row.
    rows += [("a", 2, 0, ax, 2, 1.0, 99.0) for ax in "xyz"]
    df = spark.createDataFrame(rows, "run string, restart int, body int, axis string, iteration bigint, time double, value double")
    track = tracks.combine_axes(df)
    assert track.filter("body = 0").count() == 3 and track.filter("body = 1").count() == 2
    hit = tracks.lookup(track, spark.createDataFrame([("a", 1)], "run string, iteration bigint")).first()
    assert (hit.body0.x, hit.body1.x) == (1.0, 2.0)
