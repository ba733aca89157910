"""Decline curves as Column expressions; t in days, di per year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def exponential(t: Column, qi: Column, di: Column) -> Column:
    return qi * F.exp(-di * t / F.lit(DAYS_PER_YEAR))


def hyperbolic(t: Column, qi: Column, di: Column, b: Column) -> Column:
    return qi * F.pow(F.lit(1.0) + b * di * t / F.lit(DAYS_PER_YEAR), F.lit(-1.0) / b)


def harmonic(t: Column, qi: Column, di: Column) -> Column:
    return qi / (F.lit(1.0) + di * t / F.lit(DAYS_PER_YEAR))


def rate_at(curve: Column, t: Column, qi: Column, di: Column, b: Column) -> Column:
    """Rate of whichever curve the row names; null for an unknown name."""
    safe_b = F.when(curve == "hyperbolic", b).otherwise(F.lit(0.5))
    return (F.when(curve == "exponential", exponential(t, qi, di))
            .when(curve == "hyperbolic", hyperbolic(t, qi, di, safe_b))
            .when(curve == "harmonic", harmonic(t, qi, di)))


def r_squared(ss_residual: Column, ss_total: Column) -> Column:
    return F.when(ss_total != 0, F.lit(1.0) - ss_residual / ss_total).otherwise(F.lit(0.0))


def aic(n: Column, mse: Column, parameters: int | Column) -> Column:
    k = F.lit(parameters) if isinstance(parameters, int) else parameters
    return n * F.log(mse) + F.lit(2.0) * k
