"""Cleaning of untyped text. All casts are the null-on-failure kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is stripped before a numeric cast, and the short month form.
NOT_NUMERIC = r"[^\d.-]"
NOT_INTEGER = r"[^\d-]"
YEAR_MONTH = r"^\d{4}-\d{2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_text(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), NOT_NUMERIC, "").try_cast("double")


def integer_text(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), NOT_INTEGER, "").try_cast("int")


def timestamp_text(c: Column | str) -> Column:
    return F.try_to_timestamp(F.nullif(_col(c), F.lit("")))


def month_text(c: Column | str) -> Column:
    """First day of the month named by `yyyy-MM` or any timestamp text; null if unreadable."""
    c = _col(c)
    stamp = F.when(c.rlike(YEAR_MONTH), F.try_to_timestamp(c, F.lit("yyyy-MM"))).otherwise(
        F.try_to_timestamp(F.nullif(c, F.lit(""))))
    return month_start(stamp)


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def number_or_zero(c: Column | str) -> Column:
    """Plain numeric coercion: anything that is not a number counts as 0."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def clip_negative(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)
