"""Gravitational waves from Weyl-scalar modes: strain, total strain, radiated energy and momenta.

Conventions. Modes are psi4_lm extracted at a fixed radius on an even time grid.
Double time integration is done in frequency space with every |omega| below
omega_0 = 2 pi / cutoff replaced by omega_0 (Reisswig & Pollney 2011). Fluxes
follow Ruiz, Alcubierre, Nunez & Takahashi (2008); integrals of the flux are
cumulative trapezoids. Spin weight -2 harmonics are the Wigner sums of Ajith et
al. (2007).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.constants import HUNDRED_MPC
from gridloom.functions.scalars import characteristic_strain, cutoff_periods, to_hertz
from gridloom.operators import series, spectral, splines
from gridloom.operators.ordered import Ordered
from gridloom.operators.skew import KeyStats, attach
from gridloom.sources.scratch import settled

MODE = ("run", "l", "m")


def at_radius(modes: DataFrame, radius: float) -> DataFrame:
    """Modes extracted at the radius (to nine digits); a table without a radius column has one radius."""
    if "radius" not in modes.columns:
        return modes
    return modes.filter(F.abs(F.col("radius") - radius) <= 1e-9 * abs(radius)).drop("radius")


def _integrator(order: int, period: float) -> Callable[[np.ndarray], np.ndarray]:
    """Factors of one or two time integrals; the zero frequency has no sign and integrates to nothing once."""
    def factor(omega: np.ndarray) -> np.ndarray:
        floor = np.fmax(np.abs(omega), 2 * np.pi / period)
        return -1j * np.sign(omega) / floor if order == 1 else -1 / (floor * floor)

    return factor


def _integrals(modes: DataFrame, kinds: Sequence[tuple[int, float]], keys: Sequence[str], stats: KeyStats) -> DataFrame:
    """Rows (keys, t, re0, im0, re1, im1, ...): the time integrals of each kind (order, cutoff) from one pair of transforms."""
    keys = list(keys)
    rows = Ordered.of(modes.select(*keys, "t", "re", "im"), keys, "t", stats=stats).index("idx").result()
    grid = modes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_w"), F.count(F.lit(1)).alias("n"), F.min("t").alias("t0"),
        F.try_divide(F.max("t") - F.min("t"), F.count(F.lit(1)) - 1).alias("dt"),
    )
    rows = attach(rows, grid, keys, weight="_w", stats=stats)
    back = spectral.filtered(
        rows, [*keys, "t0", "dt"], "idx", "n", "dt", "re", "im", [_integrator(*kind) for kind in kinds], longest=stats.longest)
    pairs = [f"{c}{i}" for i in range(len(kinds)) for c in ("re", "im")]
    return back.select(*keys, (F.col("t0") + F.col("k") * F.col("dt")).alias("t"), *pairs)


def integrate_fixed_frequency(
    modes: DataFrame, cutoff: float, order: int = 2, keys: Sequence[str] = MODE, stats: KeyStats | None = None
) -> DataFrame:
    """`order` time integrals of complex series (keys, t, re, im) with cutoff period `cutoff`."""
    if order not in (1, 2):
        raise ValueError("order must be 1 or 2")
    made = _integrals(modes, [(order, cutoff)], keys, stats or KeyStats.of(modes, keys))
    return made.withColumnsRenamed({"re0": "re", "im0": "im"})


def strain(
    modes: DataFrame, radius: float, cutoff: float, trim: bool = True, stats: KeyStats | None = None
) -> DataFrame:
    """r * h_lm from psi4_lm at this radius; `trim` removes one cutoff period at both ends of each mode."""
    modes = at_radius(modes, radius)
    stats = stats or KeyStats.of(modes, MODE)
    h = integrate_fixed_frequency(modes, cutoff, stats=stats).withColumns({
        "re": F.col("re") * F.lit(float(radius)), "im": F.col("im") * F.lit(float(radius)),
    })
    if not trim:
        return h
    ends = modes.groupBy(*MODE).agg(F.count(F.lit(1)).alias("_n"), F.min("t").alias("_a"), F.max("t").alias("_b"))
    return (
        attach(h, ends, list(MODE), stats=stats)
        .filter((F.col("t") >= F.col("_a") + cutoff) & (F.col("t") <= F.col("_b") - cutoff))
        .drop("_a", "_b")
    )


def spin_harmonic(l: int, m: int, theta: float, phi: float) -> complex:
    """Spin-weighted spherical harmonic of weight -2."""
    f, c, s = math.factorial, math.cos(theta / 2), math.sin(theta / 2)
    total = 0.0
    for k in range(max(0, m - 2), min(l + m, l - 2) + 1):
        total += (
            (-1) ** k * math.sqrt(f(l + m) * f(l - m) * f(l + 2) * f(l - 2))
            / (f(l + m - k) * f(l - 2 - k) * f(k) * f(k + 2 - m))
            * c ** (2 * l + m - 2 - 2 * k) * s ** (2 * k + 2 - m)
        )
    amp = math.sqrt((2 * l + 1) / (4 * math.pi)) * total
    return amp * complex(math.cos(m * phi), math.sin(m * phi))


def harmonics(spark: SparkSession, l_max: int, theta: float, phi: float) -> DataFrame:
    """(l, m, yr, yi) of all modes up to l_max in one direction: (l_max + 1)^2 - 4 rows."""
    rows = [(l, m, y.real, y.imag) for l in range(2, l_max + 1) for m in range(-l, l + 1) for y in (spin_harmonic(l, m, theta, phi),)]
    return spark.createDataFrame(rows, "l int, m int, yr double, yi double")


def total_strain(h: DataFrame, theta: float, phi: float, l_max: int | None = None, modes: DataFrame | None = None) -> DataFrame:
    """Sum over modes of h_lm times its harmonic in the direction (theta, phi): rows (run, t, re, im).

    All modes count unless `l_max` is given. `modes` is any table with the (l, m) of h, read instead of h to list them.
    """
    if l_max is None:
        l_max = (h if modes is None else modes).agg(F.max("l")).first()[0] or 2
    rows = h.join(F.broadcast(harmonics(h.sparkSession, l_max, theta, phi)), ["l", "m"])
    return rows.groupBy("run", "t").agg(
        F.sum(F.col("re") * F.col("yr") - F.col("im") * F.col("yi")).alias("re"),
        F.sum(F.col("re") * F.col("yi") + F.col("im") * F.col("yr")).alias("im"),
    )


def _d(l: Column, m: Column) -> Column:
    square = (l * l - 4) * (l * l - m * m) / ((2 * l - 1) * (2 * l + 1))
    return F.sqrt(F.greatest(square, F.lit(0.0))) / l


def radiated(modes: DataFrame, radius: float, cutoff: float, l_max: int = 4) -> DataFrame:
    """Cumulative radiated energy, J_z and P_z per run from the modes at this radius: rows (run, t, energy, j_z, p_z)."""
    used = at_radius(modes, radius).filter(F.col("l") <= l_max)
    rows = _integrals(used, [(1, cutoff), (2, cutoff)], MODE, KeyStats.of(used, MODE)).withColumnsRenamed(
        {"re0": "re", "im0": "im", "re1": "re2", "im1": "im2"})
    # Neighbours in l at the same m and time, on the rows of a time that the sum over modes needs anyway.
    near = W.partitionBy("run", "t").orderBy("m", "l")
    for name, side in (("lo", F.lag), ("hi", F.lead)):
        gap = F.lit(-1 if name == "lo" else 1)
        there = (side("m").over(near) == F.col("m")) & (side("l").over(near) == F.col("l") + gap)
        rows = rows.withColumns({
            f"{name}_{part}": F.coalesce(F.when(there, side(part).over(near)), F.lit(0.0)) for part in ("re", "im")
        })
    l, m = F.col("l").cast("double"), F.col("m").cast("double")
    c, d, up = 2 * m / (l * (l + 1)), _d(l, m), _d(l + 1, m)
    mix_re = c * F.col("re") + d * F.col("lo_re") + up * F.col("hi_re")
    mix_im = c * F.col("im") + d * F.col("lo_im") + up * F.col("hi_im")
    unit = F.lit(radius * radius / (16 * math.pi))
    flux = rows.groupBy("run", "t").agg(
        (F.sum(F.col("re") * F.col("re") + F.col("im") * F.col("im")) * unit).alias("_e"),
        (F.sum(m * (F.col("im2") * F.col("re") - F.col("re2") * F.col("im"))) * unit).alias("_j"),
        (F.sum(F.col("re") * mix_re + F.col("im") * mix_im) * unit).alias("_p"),
    )
    stats = KeyStats.of(used, ["run"])
    if stats.hot:
        # Read for the edges of segments, at their borders and at last; what made it is a long way. It has fewer rows than all modes.
        flux = settled(flux)
        stats = KeyStats.of(flux, ["run"])
    o = Ordered.of(flux, ["run"], "t", stats=stats).neighbours(_pt="lag:t", _pe="lag:_e", _pj="lag:_j", _pp="lag:_p")
    o = o.running_sums(**{
        out: F.coalesce((F.col("t") - F.col("_pt")) * (F.col(now) + F.col(before)) / 2, F.lit(0.0))
        for now, before, out in (("_e", "_pe", "energy"), ("_j", "_pj", "j_z"), ("_p", "_pp", "p_z"))
    })
    return o.result().select("run", "t", "energy", "j_z", "p_z")


def strains(modes: DataFrame, radius: float, cutoffs: Sequence[float], stats: KeyStats | None = None) -> DataFrame:
    """`strain` for several cutoff periods at once, each trimmed by its own: rows (run, l, m, cutoff, t, re, im)."""
    modes = at_radius(modes, radius)
    stats = stats or KeyStats.of(modes, MODE)
    each = F.array(*[
        F.struct(F.lit(float(p)).alias("cutoff"), *[(F.col(f"{c}{i}") * F.lit(float(radius))).alias(c) for c in ("re", "im")])
        for i, p in enumerate(cutoffs)])
    h = _integrals(modes, [(2, float(p)) for p in cutoffs], MODE, stats).select(*MODE, "t", F.inline(each))
    ends = modes.groupBy(*MODE).agg(F.count(F.lit(1)).alias("_n"), F.min("t").alias("_a"), F.max("t").alias("_b"))
    inside = (F.col("t") >= F.col("_a") + F.col("cutoff")) & (F.col("t") <= F.col("_b") - F.col("cutoff"))
    return attach(h, ends, list(MODE), stats=stats).filter(inside).drop("_a", "_b")


def snr_chain(
    modes: DataFrame, radius: float, noise: DataFrame, *, cutoffs: Sequence[float] | None = None, before: int = 214, alpha: float = 0.25,
    theta: float = 0.0, phi: float = 0.0, distance: float = HUNDRED_MPC, band: tuple[float, float, float] = (1500.0, 5000.0, 0.01),
) -> dict[str, DataFrame]:
    """From psi4 to the signal-to-noise ratio per run, cutoff period and detector.

    For every cutoff: strain, merger of the total strain, the (2, 2) strain from `before` samples ahead of it to the end
    that all runs reach, its tapered spectrum as characteristic strain, spline onto the band (start, stop, step in Hz),
    integral against the spline of each noise curve (detector, f in Hz, amp). Returns the tables `window`, `spectrum`
    (run, cutoff, k, f in Hz, strain), `smooth` (on the band), `peak` and `snr`.
    """
    keys = ["run", "cutoff"]
    h = strains(modes, radius, cutoffs or cutoff_periods())
    l_max = h.agg(F.max("l")).first()[0] or 2
    table = harmonics(h.sparkSession, l_max, theta, phi)
    own = (F.col("l") == 2) & (F.col("m") == 2)
    rows = h.join(F.broadcast(table), ["l", "m"]).groupBy(*keys, "t").agg(
        F.hypot(F.sum(F.col("re") * F.col("yr") - F.col("im") * F.col("yi")), F.sum(F.col("re") * F.col("yi") + F.col("im") * F.col("yr"))).alias("amp"),
        F.max(F.when(own, F.col("re"))).alias("re"), F.max(F.when(own, F.col("im"))).alias("im"),
    )
    # Read several times below; what made it is a long way.
    rows = settled(rows)
    stats = KeyStats.of(rows, keys)
    runs = series.merger(rows, keys, "t", "amp", stats=stats)
    common = runs.groupBy("cutoff").agg(F.min(F.col("t_end") - F.col("t_merge")).alias("_common"))
    ends = runs.join(common, "cutoff").select(*keys, (F.col("t_merge") + F.col("_common")).alias("_stop"), "_n")
    window = series.event_window(attach(rows, ends, keys, stats=stats), keys, "t", "amp", before=before, stop="_stop")
    spectrum = settled(spectral.polarised_spectrum(window, keys, "t", "re", "im", alpha).select(
        *keys, "k", to_hertz("f").alias("f"), characteristic_strain("amp", "f", distance).alias("strain")))
    start, stop, step = band
    smooth = splines.cubic_spline(spectrum, keys, "f", "strain", start, stop, step).withColumnsRenamed({"x": "f", "y": "strain"})
    curves = splines.cubic_spline(noise, ["detector"], "f", "amp", start, stop, step).select("detector", "k", F.col("y").alias("noise"))
    points = max(0, math.ceil((stop - start) / step))
    return {
        "window": window, "spectrum": spectrum, "smooth": smooth,
        "peak": spectral.spectral_peak(smooth, keys, "f", F.col("strain")),
        "snr": spectral.signal_to_noise(smooth, curves, keys, "k", "f", "strain", "noise", F.lit(points), F.lit(float(step)), ["detector"]),
    }


def analyse(modes: DataFrame, radius: float, cutoff: float, *, alpha: float = 0.25, theta: float = 0.0, phi: float = 0.0) -> dict[str, DataFrame]:
    """The chain from psi4 to merger times, phase, frequency, spectrum and spectral peak, lazily."""
    from gridloom.functions.scalars import modulus, spectral_density

    modes = at_radius(modes, radius)
    h = strain(modes, radius, cutoff)
    stats = KeyStats.of(modes.filter("l = 2 and m = 2"), ["run"])
    full = total_strain(h, theta, phi, modes=modes).withColumn("amp", modulus("re", "im"))
    h22 = h.filter("l = 2 and m = 2").drop("l", "m")
    phase = spectral.unwrap_phase(h22, ["run"], "t", "re", "im", stats=stats)
    spectrum = spectral.polarised_spectrum(h22, ["run"], "t", "re", "im", alpha, stats)
    return {
        "strain": h,
        "total_strain": full,
        "merger": series.merger(full, ["run"], "t", "amp").drop("_n"),
        "frequency": spectral.instantaneous_frequency(phase, ["run"], "t", "phase", stats=stats),
        "spectrum": spectrum,
        "peak": spectral.spectral_peak(spectrum, ["run"], "f", spectral_density("amp", "f")),
    }
