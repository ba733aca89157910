"""Periods of equal running hours, interpolated on the cumulative curves.

A period boundary k*P lies in exactly one calendar row: the first with cumulative hours >= k*P. Each
row therefore knows from its own and the previous cumulative hours which boundaries it contains;
`sequence` + `explode` emits them. No join and no search, one shuffle by entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MAIN_VOLUMES, WELL_METADATA

# Running hours per period, and days added to the first period's offset.
PERIOD_HOURS = 730.0
FIRST_PERIOD_DAYS = 30


def normalize_periods(calendar: DataFrame, measures: Sequence[str] = tuple(MAIN_VOLUMES),
                      qualifying: Sequence[str] = tuple(MAIN_VOLUMES[:3]), hours: str = "Hours",
                      period: float = PERIOD_HOURS, metadata: Sequence[str] = tuple(WELL_METADATA),
                      entity: str = "WellID", month: str = "ProductionMonth") -> DataFrame:
    """One row per completed period with volumes, daily rates, totals and estimated dates.

    Entities qualify if some row has more than one period of hours and some qualifying total > 0.
    """
    metadata = [m for m in metadata if m in calendar.columns]
    cum_hours = F.col(f"{hours}Cumulative")
    rows = Window.partitionBy(entity).orderBy(month)
    whole = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    produces = F.lit(False)
    for m in qualifying:
        produces = produces | (F.col(f"{m}Cumulative") > 0)
    here = F.struct(F.col(month).alias("month"), cum_hours.alias("h"),
                    *[F.col(f"{m}Cumulative").alias(m) for m in measures])

    annotated = calendar.select(
        entity, here.alias("cur"), F.lag(here).over(rows).alias("prev"),
        F.first(F.struct(F.col(month).alias("month"), *metadata)).over(whole).alias("head"),
        F.max(F.when((cum_hours > period) & produces, 1)).over(whole).alias("_qualifies"),
    )
    first_k = F.coalesce(F.floor(F.col("prev.h") / period), F.lit(0)).cast("int") + 1
    last_k = F.floor(F.col("cur.h") / period).cast("int")
    boundaries = (
        annotated.filter((F.col("_qualifies") == 1) & (last_k >= first_k))
        .select("*", F.explode(F.sequence(first_k, last_k)).alias("NormalizedPeriod"))
    )

    target = F.col("NormalizedPeriod") * F.lit(period)
    # A boundary met exactly, or inside the very first row, takes the row as it is.
    as_is = (F.col("cur.h") == target) | F.col("prev").isNull()
    ratio = F.when(~as_is, (target - F.col("prev.h")) / (F.col("cur.h") - F.col("prev.h")))
    between = boundaries.withColumn("_ratio", ratio)
    r = F.col("_ratio")

    def at_boundary(m: str):
        now, before = F.col(f"cur.{m}"), F.col(f"prev.{m}")
        return F.when(r.isNull(), now).otherwise(before + r * (now - before))

    days_between = F.datediff(F.col("cur.month"), F.col("prev.month"))
    end = F.when(r.isNull(), F.col("cur.month").cast("date")).otherwise(
        F.date_add(F.col("prev.month"), (r * days_between).cast("int")))
    points = between.select(
        entity, "head", "NormalizedPeriod", end.alias("PeriodEndDate"), target.alias(f"{hours}Cumulative"),
        *[at_boundary(m).alias(f"{m}Cumulative") for m in measures],
    )

    days = period / 24.0
    order = Window.partitionBy(entity).orderBy("NormalizedPeriod")
    volumes = {m: F.col(f"{m}Cumulative") - F.coalesce(F.lag(f"{m}Cumulative").over(order), F.lit(0.0))
               for m in measures}
    start = F.when(F.col("NormalizedPeriod") == 1, F.col("head.month").cast("date")).otherwise(
        F.date_sub("PeriodEndDate", int(days)))
    offset = F.floor((F.col(f"{hours}Cumulative") - period) / 24.0).cast("int") + FIRST_PERIOD_DAYS
    return points.withColumns(volumes).select(
        entity, *[F.col(f"head.{m}").alias(m) for m in metadata], "NormalizedPeriod",
        start.alias("PeriodStartDate"), "PeriodEndDate", F.lit(period).alias("HoursInPeriod"), *measures,
        *[(F.col(m) / days).alias(f"{m}DailyRate") for m in measures],
        *[f"{m}Cumulative" for m in measures], f"{hours}Cumulative",
        offset.alias("DaysFromFirstProducing"),
    )
