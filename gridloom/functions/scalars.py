"""Elementwise physics, unit and safety expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.constants import (
    CUTOFF_FACTORS, HUNDRED_MPC, J_START, M_START, MILLIS, ORBITAL_OMEGA,
)

NAN = float("nan")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(value: Column | str) -> Column:
    """Not NULL, not NaN, not infinite."""
    v = _col(value)
    return F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))


def finite_or_null(value: Column | str) -> Column:
    """NaN and infinities become NULL, so that aggregates skip them."""
    v = _col(value)
    return F.when(is_finite(v), v)


def safe_divide(num: Column, den: Column) -> Column:
    """num / den, or NaN where either is not finite or den is 0."""
    return F.when(is_finite(num) & is_finite(den) & (den != 0), F.try_divide(num, den)).otherwise(F.lit(NAN))


def safe_divide_arrays(num: Column | str, den: Column | str) -> Column:
    """Elementwise `safe_divide` of two equally long arrays."""
    return F.zip_with(_col(num), _col(den), safe_divide)


def modulus(re: Column | str, im: Column | str) -> Column:
    return F.hypot(_col(re), _col(im))


def deformation(re: Column | str, im: Column | str) -> Column:
    return F.sqrt(_col(re) * _col(re) + _col(im) * _col(im))


def polarisation_average(plus: Column | str, cross: Column | str) -> Column:
    """Root mean square of the two polarisation amplitudes."""
    p, c = _col(plus), _col(cross)
    return F.sqrt((p * p + c * c) / 2)


def cylindrical(x: Column | str, y: Column | str) -> tuple[Column, Column, Column]:
    """(r, cos phi, sin phi) with r kept off zero by 1e-17."""
    cx, cy = _col(x), _col(y)
    r = F.sqrt(cx * cx + cy * cy) + F.lit(1e-17)
    return r, cx / r, cy / r


def rotation_rate(
    x: Column | str, y: Column | str, vx: Column | str, vy: Column | str,
    shift_x: Column | str, shift_y: Column | str, lapse: Column | str, unit: float = MILLIS,
) -> Column:
    """Angular velocity seen from infinity: unit * (lapse * v_phi - shift_phi)."""
    r, cos, sin = cylindrical(x, y)

    def azimuthal(ax: Column, ay: Column) -> Column:
        return (cos * ay - sin * ax) / r

    return F.lit(unit) * (
        _col(lapse) * azimuthal(_col(vx), _col(vy)) - azimuthal(_col(shift_x), _col(shift_y))
    )


def to_hertz(f: Column | str) -> Column:
    return _col(f) * F.lit(MILLIS * 1000)


def characteristic_strain(amp: Column | str, f: Column | str, distance: float = HUNDRED_MPC) -> Column:
    """2 A sqrt(f u) / u / distance with u turning code frequency into Hz."""
    u = MILLIS * 1000
    return 2 * _col(amp) * F.sqrt(_col(f) * u) / F.lit(u) / F.lit(distance)


def spectral_density(amp: Column | str, f: Column | str) -> Column:
    """2 A sqrt(f), the quantity whose peak is reported."""
    return 2 * _col(amp) * F.sqrt(_col(f))


def dimensionless_spin(j_rad: Column | str, energy: Column | str, j0: float = J_START, m0: float = M_START) -> Column:
    left = F.lit(m0) - _col(energy)
    return (_col(j_rad) + F.lit(j0)) / (left * left)


def radial_kinetic(kinetic: Column | str, rotation: Column | str, kinz: Column | str) -> Column:
    return _col(kinetic) - _col(rotation) - _col(kinz)


def retarded(t: Column | str, radius: float) -> Column:
    return _col(t) - F.lit(float(radius))


def both_halves(value: Column | str, factor: float = 2.0) -> Column:
    """A surface integral taken above a plane of symmetry, for the whole surface."""
    return _col(value) * F.lit(float(factor))


def since_merger(t: Column | str, t_merge: Column | str, unit: float = MILLIS) -> Column:
    return (_col(t) - _col(t_merge)) / F.lit(unit)


def cutoff_periods(omega: float = ORBITAL_OMEGA) -> list[float]:
    """Cutoff periods tried for the double integration, as multiples of the GW period."""
    period = 2 * math.pi / (2 * omega)
    return [k * period for k in CUTOFF_FACTORS]


def symlog(value: Column | str, linthresh: float, linscale: float = 1.0) -> Column:
    """Symmetric log scale: linear inside +-linthresh, logarithmic outside."""
    v = _col(value)
    out = F.lit(linthresh) * (linscale + F.log10(F.greatest(F.abs(v), F.lit(linthresh)) / linthresh))
    return F.when(F.abs(v) <= linthresh, v * linscale).otherwise(F.signum(v) * out)
