"""Bounded least-squares fit of the decline curves, for many series at a time.

For fixed shape parameters all three curves are linear in the initial rate, so the best rate is a
ratio of two sums and only the decline rate (and, for the hyperbolic curve, the exponent) is
searched: a coarse grid over the box, then repeated zooming around the best candidate. Every numpy
step works on a block of series at once; Spark partitions the series and hands over Arrow batches.
The search has fixed steps, so results do not depend on how series are spread over tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Task code is shipped with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAYS_PER_YEAR = 365.25


class Box(NamedTuple):
    """Limits of the search: decline rate, and initial rate as a multiple of its first estimate."""

    di: tuple[float, float]
    qi_scale: tuple[float, float]
    qi_floor: float = 0.0


# Boxes tried in order, R2 at which no wider box is tried, exponent range.
TWO_PARAMETER_BOXES = (
    Box((0.001, 3.0), (0.1, 5.0)),
    Box((0.0001, 5.0), (0.01, 20.0)),
    Box((0.00001, 10.0), (0.0, 100.0), 0.001),
)
BOXES = {
    "exponential": TWO_PARAMETER_BOXES,
    "hyperbolic": TWO_PARAMETER_BOXES[:2],
    "harmonic": TWO_PARAMETER_BOXES,
}
GOOD_ENOUGH = {"exponential": 0.8, "hyperbolic": 0.8, "harmonic": 0.7}
EXPONENT_RANGE = (0.001, 0.999)
PARAMETER_COUNT = {"exponential": 2, "hyperbolic": 3, "harmonic": 2}

# Search layout of our own: coarse points of log(di), then levels of a finer line search around the
# best of them; for the hyperbolic curve this is done at COARSE_B exponents, and levels of a search
# in both parameters follow. A level looks REACH points to each side at 1/SHRINK of the last spacing.
COARSE_DI = 20
LINE_LEVELS = {"exponential": 6, "hyperbolic": 2, "harmonic": 6}
LINE_REACH, LINE_SHRINK = 4, 4.0
COARSE_B = 7
PLANE_LEVELS = 14
PLANE_REACH, PLANE_SHRINK = 2, 2.0
# Half-width of the closing parabola step on log(di).
POLISH = 1e-4
# Relative distance from a limit at which an optimum counts as inside the box.
CLEARANCE = 1e-3
# A wider box replaces a narrower one only for a gain above numeric noise.
MIN_GAIN = 1e-9
# Least eigenvalue, relative to unit columns, of a normal matrix that can be inverted.
SINGULAR = 1e-13
# Floor of the mean squared error, relative to mean(q^2), so a perfect fit has a finite AIC.
MSE_FLOOR = 1e-12
BLOCK = 512
# Rows are padded to a multiple of this, so that a sum never depends on the longest row of its block.
PAD = 32

FIT_TYPE = (
    "exp_qi double, exp_di double, exp_r2 double, exp_aic double, exp_method string, "
    "hyp_qi double, hyp_di double, hyp_b double, hyp_r2 double, hyp_aic double, "
    "har_qi double, har_di double, har_r2 double, har_aic double, "
    "exp_qi_error double, exp_di_error double, hyp_qi_error double, hyp_di_error double, hyp_b_error double, "
    "har_qi_error double, har_di_error double"
)


def _shape(curve: str, years: np.ndarray, di: np.ndarray, b: np.ndarray | None) -> np.ndarray:
    x = di[:, None] * years
    if curve == "exponential":
        return np.exp(-x)
    if curve == "harmonic":
        return 1.0 / (1.0 + x)
    return np.exp(-np.log1p(b[:, None] * x) / b[:, None])


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise sum of products."""
    return np.einsum("ij,ij->i", a, b)


class _Series:
    """A block of zero-padded series with the sums every candidate needs."""

    def __init__(self, years, q, mask, estimate):
        self.years, self.q, self.mask, self.estimate = years, q, mask, estimate
        self.n = _dot(mask, mask)
        self.sum_q2 = _dot(q, q)
        spread = (q - (_dot(q, mask) / self.n)[:, None]) * mask
        self.ss_total = _dot(spread, spread)
        self.middle = years.max(axis=1) / 2.0

    def take(self, rows):
        return _Series(self.years[rows], self.q[rows], self.mask[rows], self.estimate[rows])

    def rate_limits(self, box):
        return np.maximum(box.qi_scale[0] * self.estimate, box.qi_floor), box.qi_scale[1] * self.estimate

    def inside(self, box, qi, di):
        """Whether the parameters keep clear of the limits that differ between boxes."""
        low, high = self.rate_limits(box)
        return ((qi > low * (1 + CLEARANCE)) & (qi < high * (1 - CLEARANCE))
                & (di > box.di[0] * (1 + CLEARANCE)) & (di < box.di[1] * (1 - CLEARANCE)))

    def profile(self, curve, box, di, b=None):
        """Best initial rate inside the box and its squared error, for one candidate per series."""
        f = _shape(curve, self.years, di, b) * self.mask
        qf, ff = _dot(self.q, f), _dot(f, f)
        qi = np.clip(qf / np.maximum(ff, 1e-300), *self.rate_limits(box))
        return qi, self.sum_q2 - 2.0 * qi * qf + qi * qi * ff

    def quality(self, curve, qi, di, b=None):
        residual = (self.q - qi[:, None] * _shape(curve, self.years, di, b)) * self.mask
        ss = _dot(residual, residual)
        total = np.where(self.ss_total > 0, self.ss_total, 1.0)
        r2 = np.where(self.ss_total > 0, 1.0 - ss / total, 0.0)
        mse = np.maximum(ss / self.n, MSE_FLOOR * self.sum_q2 / self.n)
        return r2, self.n * np.log(mse) + 2.0 * PARAMETER_COUNT[curve]


    def errors(self, curve, qi, di, b=None):
        """Standard errors of (qi, di) or (qi, di, b): square roots of the diagonal of the inverse normal
        matrix times the residual variance. NaN where it is singular or no degree of freedom is left."""
        f = _shape(curve, self.years, di, b) * self.mask
        x = di[:, None] * self.years
        scaled = -qi[:, None] * self.years * f
        if curve == "exponential":
            columns = [f, scaled]
        elif curve == "harmonic":
            columns = [f, scaled * f]
        else:
            b = b[:, None]
            columns = [f, scaled / (1.0 + b * x), qi[:, None] * f * (np.log1p(b * x) / b - x / (1.0 + b * x)) / b]
        normal = np.stack([np.stack([_dot(u, v) for v in columns], axis=-1) for u in columns], axis=-1)
        p = len(columns)
        length = np.sqrt(np.maximum(normal[:, range(p), range(p)], 0.0))
        unit = normal / np.maximum(length[:, :, None] * length[:, None, :], 1e-300)
        known = np.isfinite(unit).all(axis=(1, 2)) & (length > 0).all(axis=1) & (self.n > p)
        unit[~known] = np.eye(p)
        known &= np.linalg.eigvalsh(unit)[:, 0] > SINGULAR
        unit[~known] = np.eye(p)
        residual = (self.q - qi[:, None] * f) * self.mask
        variance = _dot(residual, residual) / np.maximum(self.n - p, 1)
        spread = np.linalg.inv(unit)[:, range(p), range(p)] * variance[:, None] / np.maximum(length**2, 1e-300)
        return np.where(known[:, None], np.sqrt(np.maximum(spread, 0.0)), np.nan)


def _search(curve: str, s: _Series, box: Box) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best (qi, di, b) of the box per series; di is searched on a log scale.

    In the search of both parameters, the step in b keeps the total decline up to mid-history,
    ln(1 + b di y) / b, and the other step scales it: along these axes the error is nearly round,
    where (di, b) form a long narrow valley.
    """
    rows = len(s.estimate)
    u_low, u_high = np.log(box.di[0]), np.log(box.di[1])
    b_low, b_high = EXPONENT_RANGE
    hyperbolic = curve == "hyperbolic"
    coarse = (u_high - u_low) / (COARSE_DI - 1)

    def error(cu, cb):
        return s.profile(curve, box, np.exp(cu), cb if hyperbolic else None)[1]

    class Best:
        def __init__(self):
            self.error, self.u, self.b = np.full(rows, np.inf), np.zeros(rows), np.full(rows, 0.5)

        def offer(self, cu, cb, value=None):
            value = error(cu, cb) if value is None else value
            better = value < self.error
            self.error[better], self.u[better], self.b[better] = value[better], cu[better], cb[better]

    best = Best()
    for j in range(COARSE_B if hyperbolic else 1):
        b = np.full(rows, b_low + j * ((b_high - b_low) / (COARSE_B - 1)) if hyperbolic else 0.5)
        line = Best()
        for i in range(COARSE_DI):
            line.offer(np.full(rows, u_low + i * coarse), b)
        step = coarse
        for _ in range(LINE_LEVELS[curve]):
            step, center = step / LINE_SHRINK, line.u.copy()
            for i in range(-LINE_REACH, LINE_REACH + 1):
                if i:
                    line.offer(np.clip(center + i * step, u_low, u_high), b)
        best.offer(line.u, line.b, line.error)

    if hyperbolic:
        step, b_step = coarse / LINE_SHRINK, (b_high - b_low) / (COARSE_B - 1)
        for _ in range(PLANE_LEVELS):
            step, b_step, center = step / PLANE_SHRINK, b_step / PLANE_SHRINK, best.b.copy()
            drop = np.log1p(center * np.exp(best.u) * s.middle) / center
            for j in range(-PLANE_REACH, PLANE_REACH + 1):
                cb = np.clip(center + j * b_step, b_low, b_high)
                for i in range(-PLANE_REACH, PLANE_REACH + 1):
                    cu = np.log(np.expm1(cb * drop * np.exp(i * step)) / (cb * s.middle))
                    best.offer(np.clip(cu, u_low, u_high), cb)

    u, b = best.u, best.b
    left, here, right = error(u - POLISH, b), error(u, b), error(u + POLISH, b)
    bend = left - 2.0 * here + right
    shift = 0.5 * POLISH * (left - right) / np.where(bend > 0, bend, np.inf)
    inner = (u - POLISH >= u_low) & (u + POLISH <= u_high) & (np.abs(shift) <= POLISH)
    di = np.exp(np.where(inner, u + shift, u))
    return s.profile(curve, box, di, b if hyperbolic else None)[0], di, b


def _fit_curve(curve: str, s: _Series, start: dict[str, np.ndarray] | None) -> dict[str, np.ndarray]:
    """Try the boxes from narrow to wide.

    A series stops once an improving fit is good enough, or once its optimum touches no limit of the
    box: a wider box would only find it again. A fit whose parameters have no finite standard errors
    (singular normal matrix) is not taken.
    """
    rows = len(s.estimate)
    fit = start or {"qi": np.full(rows, np.nan), "di": np.full(rows, np.nan), "b": np.zeros(rows),
                    "r2": np.full(rows, -np.inf), "aic": np.full(rows, np.inf),
                    "refined": np.zeros(rows, bool)}
    fit |= {f"{name}_error": np.full(rows, np.nan) for name in ("qi", "di", "b")}
    active = np.arange(rows)
    for box in BOXES[curve]:
        if not len(active):
            break
        part = s if len(active) == rows else s.take(active)
        qi, di, b = _search(curve, part, box)
        r2, aic = part.quality(curve, qi, di, b)
        errors = part.errors(curve, qi, di, b)
        gain = (r2 > fit["r2"][active] + MIN_GAIN) & np.isfinite(errors).all(axis=1)
        target = active[gain]
        named = zip(("qi_error", "di_error", "b_error"), errors.T)
        for name, values in (("qi", qi), ("di", di), ("b", b), ("r2", r2), ("aic", aic), *named):
            fit[name][target] = values[gain]
        fit["refined"][target] = True
        active = active[~((gain & (r2 > GOOD_ENOUGH[curve])) | part.inside(box, qi, di))]
    return fit


def _log_linear(s: _Series, slope: np.ndarray, intercept: np.ndarray) -> dict[str, np.ndarray]:
    """The straight-line fit of log q as first exponential candidate, where it declines."""
    rows = len(slope)
    qi, di = np.exp(intercept), -slope
    ok = np.isfinite(qi) & np.isfinite(di) & (di > 0)
    r2, aic = s.quality("exponential", np.where(ok, qi, 1.0), np.where(ok, di, 1.0))
    return {"qi": np.where(ok, qi, np.nan), "di": np.where(ok, di, np.nan), "b": np.zeros(rows),
            "r2": np.where(ok, r2, -np.inf), "aic": np.where(ok, aic, np.inf),
            "refined": np.zeros(rows, bool)}


def fit_block(t: Sequence, q: Sequence, estimate, slope, intercept, curves: Sequence[str] = tuple(BOXES)) -> pd.DataFrame:
    """Fit the curves to a block of series given as arrays of day offsets and rates; other curves are NaN."""
    lengths = np.array([len(x) for x in t])
    width = -(-int(lengths.max()) // PAD) * PAD
    mask = (np.arange(width)[None, :] < lengths[:, None]).astype(float)
    years, rates = np.zeros(mask.shape), np.zeros(mask.shape)
    inside = mask.astype(bool)
    years[inside] = np.concatenate([np.asarray(x, float) for x in t]) / DAYS_PER_YEAR
    rates[inside] = np.concatenate([np.asarray(x, float) for x in q])
    s = _Series(years, rates, mask, np.asarray(estimate, float))

    out = pd.DataFrame(np.nan, index=range(len(lengths)), columns=[part.split()[0] for part in FIT_TYPE.split(", ")])
    out["exp_method"] = None
    for curve in curves:
        line = curve == "exponential"
        start = _log_linear(s, np.asarray(slope, float), np.asarray(intercept, float)) if line else None
        fit = _fit_curve(curve, s, start)
        for name in ("qi", "di", "b", "r2", "aic", "qi_error", "di_error", "b_error"):
            if f"{curve[:3]}_{name}" in out:
                out[f"{curve[:3]}_{name}"] = fit[name]
        if line:
            out["exp_method"] = np.where(fit["refined"], "nonlinear", "log-linear")
    return out


def fit_curves(t: Column, q: Column, estimate: Column, slope: Column, intercept: Column,
               curves: Sequence[str] = tuple(BOXES)) -> Column:
    """Struct of fitted parameters per series; null arrays (rejected series) and curves not asked for give nulls.

    Marked non-deterministic only so that the optimizer never evaluates it twice.
    """

    @F.pandas_udf(FIT_TYPE)
    def fitted(ts: pd.Series, qs: pd.Series, e: pd.Series, sl: pd.Series, ic: pd.Series) -> pd.DataFrame:
        names = [part.split()[0] for part in FIT_TYPE.split(", ")]
        result = pd.DataFrame(np.nan, index=range(len(ts)), columns=names)
        result["exp_method"] = None
        usable = np.flatnonzero(ts.notna().to_numpy())
        ts, qs = ts.to_numpy(), qs.to_numpy()
        e, sl, ic = e.to_numpy(), sl.to_numpy(), ic.to_numpy()
        # Series of similar length share a block, so little is spent on padding.
        usable = usable[np.argsort([len(ts[i]) for i in usable], kind="stable")] if len(usable) else usable
        for at in range(0, len(usable), BLOCK):
            rows = usable[at:at + BLOCK]
            block = fit_block(ts[rows], qs[rows], e[rows], sl[rows], ic[rows], curves)
            for name in names:
                result.loc[rows, name] = block[name].to_numpy()
        return result

    return fitted.asNondeterministic()(t, q, estimate, slope, intercept)
