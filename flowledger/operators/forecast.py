"""Forecasts from a fit table (one row per series, see decline.fit_series).

The fit table holds parameters and history figures, so points, summary and forecast rows are
projections of it: no second pass over the history except for the few metadata columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.curves import rate_at
from ..schemas import (
    COMBINED, FORECAST_ROWS, FORECAST_SUMMARY, PRODUCTION_COLUMNS, WELL_METADATA, conform,
)
from .decline import OK

# Forecast grid, first-year length, hours of a forecast month, labels.
FIRST_STEP_DAYS = 30
STEP_DAYS = 30.44
FIRST_YEAR_POINTS = 12
FORECAST_HOURS = 720.0
UNIT, PER_DAY, PER_MONTH = "DataUnit", "per day", "per month"
FORECAST, HISTORICAL = "Forecast", "Historical"
METHOD_PREFIX = "ARPS_"
# Share-of-good-fits threshold, histogram bins.
GOOD_R2 = 0.6
R2_BINS = 20


def _day(step: Column) -> Column:
    """Day offset of the 0-based forecast step."""
    return (F.col("last_day") + FIRST_STEP_DAYS + step * F.lit(STEP_DAYS)).cast("int")


def _rate(day: Column) -> Column:
    return rate_at(F.col("CurveType"), day - F.col("t_offset"), F.col("qi"), F.col("di"), F.col("b"))


def fitted_only(fits: DataFrame) -> DataFrame:
    return fits.filter(F.col("Status") == OK)


def forecast_points(fits: DataFrame, months: int = 24, keep: Sequence[str] = ()) -> DataFrame:
    """`months` points per fitted series; ProductionMonth is the month label of ForecastDate."""
    return (
        fitted_only(fits)
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("_i"))
        .withColumn("DaysFromFirst", _day(F.col("_i")))
        .withColumn("ForecastDate", F.date_add("first_month", F.col("DaysFromFirst")))
        .select("WellID", "ProductionType", (F.col("_i") + 1).alias("Step"), "DaysFromFirst", "ForecastDate",
                F.trunc("ForecastDate", "month").alias("ProductionMonth"),
                _rate(F.col("DaysFromFirst")).alias("Rate"), "CurveType", "RSquared", *keep)
    )


def forecast_summary(fits: DataFrame, as_of: str, months: int = 24) -> DataFrame:
    """One row per fitted series: parameters, history figures, first-year volume, and the unit of the rates.

    A fit per day gives a daily rate; its first-year figure is the rate times the days of a step.
    """
    steps = F.sequence(F.lit(0), F.lit(min(months, FIRST_YEAR_POINTS) - 1))
    first_year = F.aggregate(steps, F.lit(0.0), lambda total, i: total + _rate(_day(i)))
    if UNIT in fits.columns:
        first_year = first_year * F.when(F.col(UNIT) == PER_DAY, STEP_DAYS).otherwise(1.0)
    summary = fitted_only(fits).select(
        *([UNIT] if UNIT in fits.columns else []),
        "WellID", "ProductionType", F.lit(as_of).alias("ForecastDate"), "CurveType", "RSquared",
        F.lit(True).alias("FitSuccess"), F.col("qi").alias("InitialRate_qi"),
        F.col("di").alias("DeclineRate_di"), F.col("b").alias("DeclineExponent_b"),
        F.col("hist_min").alias("HistoricalDataMinDate"), F.col("hist_max").alias("HistoricalDataMaxDate"),
        F.col("n_points").alias("DataPointsUsed"), F.col("hist_avg").alias("HistoricalAvgProduction"),
        F.col("hist_peak").alias("HistoricalPeakProduction"),
        F.col("hist_last").alias("HistoricalLastProduction"),
        F.date_add("first_month", _day(F.lit(0))).alias("ForecastStartDate"),
        first_year.alias("ForecastCumulative12Month"), "AIC", F.lit("").alias("FitError"),
    )
    return conform(summary, _with_unit(FORECAST_SUMMARY) if UNIT in fits.columns else FORECAST_SUMMARY)


def _with_unit(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(UNIT, StringType())])


def first_metadata(history: DataFrame, entity: str = "WellID", month: str = "ProductionMonth") -> DataFrame:
    """Metadata of each entity's first row; combined map-side to one row per entity and task."""
    present = [c for c in WELL_METADATA if c in history.columns]
    return history.groupBy(F.col(entity).alias("WellID")).agg(
        F.min_by(F.struct(*present), F.struct(month, *present)).alias("meta"))


def forecast_rows(fits: DataFrame, history: DataFrame, months: int = 24) -> DataFrame:
    """Forecast points in the layout of the input rows; only the forecast measure is filled."""
    unit = [UNIT] if UNIT in fits.columns else []
    points = forecast_points(fitted_only(fits).join(first_metadata(history), "WellID"), months, keep=("meta", *unit))
    measures = {m: F.when(F.col("ProductionType") == m, F.col("Rate")).otherwise(F.lit(0.0))
                for m in PRODUCTION_COLUMNS}
    meta_fields = [c for c in WELL_METADATA if c in history.columns]
    zero = [f.name for f in FORECAST_ROWS.fields
            if f.dataType.typeName() == "double" and f.name not in (*measures, "Hours", "ForecastRSquared")]
    rows = points.select(
        "WellID", "ProductionType", "Step", "ForecastDate", "ProductionMonth", "DaysFromFirst", *unit,
        *[c.alias(m) for m, c in measures.items()], *[F.lit(0.0).alias(c) for c in zero],
        *[F.col(f"meta.{c}").alias(c) for c in meta_fields], F.lit(FORECAST_HOURS).alias("Hours"),
        F.lit(FORECAST).alias("DataType"), F.concat(F.lit(METHOD_PREFIX), "CurveType").alias("ForecastMethod"),
        F.col("RSquared").alias("ForecastRSquared"),
    )
    typed = conform(rows, FORECAST_ROWS).columns
    casts = {f.name: F.col(f.name) if f.name in rows.columns else F.lit(None) for f in FORECAST_ROWS.fields}
    return rows.select("ProductionType", "Step", "ForecastDate", "DaysFromFirst", *unit,
                       *[casts[c].cast(FORECAST_ROWS[c].dataType).alias(c) for c in typed])


def as_history(table: DataFrame) -> DataFrame:
    """Calendar rows as they are; normalized periods dated by their start, with their offset in days and hours."""
    out = table
    if "Hours" not in out.columns and "HoursInPeriod" in out.columns:
        out = out.withColumn("Hours", F.col("HoursInPeriod"))
    if "ProductionMonth" not in out.columns:
        out = out.withColumn("ProductionMonth", F.col("PeriodStartDate"))
    if "DaysFromFirst" not in out.columns:
        out = out.withColumn("DaysFromFirst", F.col("DaysFromFirstProducing"))
    return out


def combine(history: DataFrame, forecasts: DataFrame, measures: Sequence[str] | None = None,
            ordered: bool = False, fitted: Mapping[str, str] | None = None) -> DataFrame:
    """History and forecast rows of each measure in one layout, tagged by DataType.

    `fitted` names the column that was fitted for each measure (rate_columns): history then shows that
    column under the measure's name, in the unit of the forecast. Forecasts with a DataUnit give it to
    the history of the same measure.

    All history rows appear once per measure, fitted or not. Columns a side lacks become typed
    zeros (numbers) or nulls (text).
    """
    measures = list(measures or PRODUCTION_COLUMNS)
    if "DataType" not in history.columns:
        history = history.withColumn("DataType", F.lit(HISTORICAL))

    def layout(df: DataFrame) -> DataFrame:
        present = set(df.columns)
        out = []
        for f in COMBINED.fields:
            numeric = f.dataType.typeName() in ("double", "integer") and f.name != "ForecastRSquared"
            source = F.col(f.name) if f.name in present else F.lit(0 if numeric else None)
            out.append(source.cast(f.dataType).alias(f.name))
        return df.select("ProductionType", *out, *([UNIT] if unit else []))

    unit = UNIT in forecasts.columns
    if fitted:
        history = history.withColumns({m: F.col(c) for m, c in fitted.items() if c in history.columns})
    if unit:
        daily = [m for m, c in (fitted or {}).items() if m != c]
        history = history.withColumn("_daily", F.array(*[F.lit(m) for m in daily]).cast("array<string>"))
    kinds = F.explode(F.array(*[F.lit(m) for m in measures]))
    tagged = as_history(history).select("*", kinds.alias("ProductionType"))
    if unit:
        tagged = tagged.withColumn(UNIT, F.when(F.array_contains("_daily", F.col("ProductionType")), PER_DAY).otherwise(PER_MONTH))
    tagged = layout(tagged)
    ahead = layout(forecasts.filter(F.col("ProductionType").isin(measures)))
    both = tagged.unionByName(ahead)
    return both.orderBy("ProductionType", "WellID", "ProductionMonth") if ordered else both


def fit_quality(summary: DataFrame) -> DataFrame:
    """One row of fit figures over a summary table."""
    def wells(curve: str) -> Column:
        return F.count(F.when(F.col("CurveType") == curve, 1)).alias(f"{curve}_wells")

    return summary.agg(
        F.count("*").alias("wells"), F.avg("RSquared").alias("avg_r2"), F.avg("AIC").alias("avg_aic"),
        wells("exponential"), wells("hyperbolic"), wells("harmonic"),
        F.min("InitialRate_qi").alias("min_qi"), F.max("InitialRate_qi").alias("max_qi"),
        F.min("DeclineRate_di").alias("min_di"), F.max("DeclineRate_di").alias("max_di"),
        F.min("HistoricalDataMinDate").alias("data_from"), F.max("HistoricalDataMaxDate").alias("data_to"),
        F.avg("DataPointsUsed").alias("avg_points"),
        F.avg(F.when(F.col("RSquared") >= GOOD_R2, 1.0).otherwise(0.0)).alias("share_good"),
    )


def r2_histogram(summary: DataFrame, bins: int = R2_BINS) -> DataFrame:
    """Counts of equal-width R2 bins between the smallest and largest value; the last is closed."""
    r2 = F.col("RSquared")
    # Two scalar subqueries over one aggregate; a single row either way.
    low, high = summary.agg(F.min("RSquared")).scalar(), summary.agg(F.max("RSquared")).scalar()
    width = (high - low) / bins
    place = F.when(high > low, F.least(F.floor((r2 - low) / width), F.lit(bins - 1))).otherwise(F.lit(bins // 2))
    return (
        summary.select((place.cast("int") + 1).alias("bin"))
        .groupBy("bin").agg(F.count("*").alias("wells"))
    )
