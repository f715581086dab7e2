"""Distance kernels and smooth switching functions (F6-F12) as expressions.

All of these stay inside whole-stage code generation: no Python per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distance(x1, y1, z1, x2, y2, z2) -> Column:
    """Euclidean distance between two points given as six columns."""
    dx, dy, dz = _c(x2) - _c(x1), _c(y2) - _c(y1), _c(z2) - _c(z1)
    return F.sqrt(dx * dx + dy * dy + dz * dz)


def norm3(x, y, z) -> Column:
    x, y, z = _c(x), _c(y), _c(z)
    return F.sqrt(x * x + y * y + z * z)


def _clamp(c: Column, lo, hi) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def cosine_cutoff(d, rc: float) -> Column:
    """0.5 * (cos(pi * clamp(d, 1e-6, rc) / rc) + 1)."""
    dc = _clamp(_c(d), 1e-6, rc)
    return F.lit(0.5) * (F.cos(F.lit(math.pi) * dc / F.lit(rc)) + F.lit(1.0))


def exp_cutoff(d, rc: float) -> Column:
    """F8: exp(-1 / (1 - clamp(d/rc, 0, 1-1e-6)^2)) / exp(-1)."""
    u = _clamp(_c(d) / F.lit(rc), 0.0, 1.0 - 1e-6)
    return F.exp(F.lit(-1.0) / (F.lit(1.0) - u * u)) / F.lit(math.exp(-1.0))


def gaussian_expand(d, shifts: list[float], eta: float) -> Column:
    """array of exp(-eta * (d - s)^2) over the shift list."""
    arr = F.array(*[F.lit(float(s)) for s in shifts])
    dd = _c(d)
    return F.transform(arr, lambda s: F.exp(F.lit(-eta) * (dd - s) * (dd - s)))


def softplus(x) -> Column:
    """log(1 + exp(x)), linear above 20 to avoid overflow."""
    x = _c(x)
    return F.when(x > 20, x).otherwise(F.log1p(F.exp(x)))


def softplus_gap(lo, hi) -> Column:
    """keep hi above lo: lo + softplus(hi - lo)."""
    return _c(lo) + softplus(_c(hi) - _c(lo))


def huber(x, delta: float = 1.0) -> Column:
    """quadratic below ``delta``, linear from ``delta`` on."""
    a = F.abs(_c(x))
    return F.when(a < delta, F.lit(0.5) * a * a).otherwise(F.lit(delta) * (a - F.lit(0.5 * delta)))


def _unit_step_arg(x, lo: float, hi: float, eps: float) -> Column:
    return _clamp((_c(x) - F.lit(lo)) / F.lit(hi - lo), eps, 1.0 - eps)


def bump(x, lo: float = 0.0, hi: float = 1.0) -> Column:
    """smooth 0 -> 1 switch a / (a + b), a = exp(-1/t), b = exp(-1/(1-t))."""
    t = _unit_step_arg(x, lo, hi, 1e-6)
    a = F.exp(F.lit(-1.0) / t)
    b = F.exp(F.lit(-1.0) / (F.lit(1.0) - t))
    return a / (a + b)


def smoothstep(x, lo: float = 0.0, hi: float = 1.0) -> Column:
    """quintic step t^3 (6t^2 - 15t + 10), t clamped to [0, 1]."""
    t = _unit_step_arg(x, lo, hi, 0.0)
    return t * t * t * (t * (t * F.lit(6.0) - F.lit(15.0)) + F.lit(10.0))


def expstep(x, lo: float = 0.0, hi: float = 1.0) -> Column:
    """exp(-1 / (1 - t^2)) / exp(-1), t clamped to [1e-6, 1 - 1e-6]."""
    t = _unit_step_arg(x, lo, hi, 1e-6)
    return F.exp(F.lit(-1.0) / (F.lit(1.0) - t * t)) / F.lit(math.exp(-1.0))


def erfc_approx(x) -> Column:
    """Complementary error function, Abramowitz-Stegun 7.1.26 (|error| < 1.5e-7).

    Spark has no ``erfc``; this keeps the DSF kernel on the JVM.
    """
    x = _c(x)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * ax)
    poly = t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (
        F.lit(1.421413741) + t * (F.lit(-1.453152027) + t * F.lit(1.061405429)))))
    y = poly * F.exp(-ax * ax)
    return F.when(x >= 0, y).otherwise(F.lit(2.0) - y)


def dsf_kernel(d, rc: float = 15.0, alpha: float = 0.2) -> Column:
    """damped shifted force 1/r kernel, zero beyond rc."""
    d = _c(d)
    erfc_rc = math.erfc(alpha * rc)
    shift = erfc_rc / rc
    slope = erfc_rc / rc ** 2 + 2 * alpha / math.sqrt(math.pi) * math.exp(-(alpha * rc) ** 2) / rc
    val = erfc_approx(F.lit(alpha) * d) / d - F.lit(shift) + (d - F.lit(rc)) * F.lit(slope)
    return F.when(d <= rc, val).otherwise(F.lit(0.0))


def sf_kernel(d, rc: float = 15.0) -> Column:
    """undamped shifted force 1/r - 2/rc + r/rc^2, zero beyond rc."""
    d = _c(d)
    val = F.lit(1.0) / d - F.lit(1.0 / rc) + (d - F.lit(rc)) * F.lit(1.0 / (rc * rc))
    return F.when(d <= rc, val).otherwise(F.lit(0.0))
