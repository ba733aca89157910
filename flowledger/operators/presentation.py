"""Data operators behind the views: extension of forecasts, running totals, coverage per entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PRODUCTION_COLUMNS
from .forecast import HISTORICAL

# End of the extension, its yearly decline and its smallest rate.
EXTEND_TO = "2030-12-01"
EXTEND_ANNUAL_DECLINE = 0.1
EXTEND_FLOOR = 0.01


def extend_forecast(forecast: DataFrame, value: str = "Rate", keys: Sequence[str] = ("WellID", "ProductionType"),
                    month: str = "ProductionMonth", tie: Sequence[str] = (), until: str = EXTEND_TO,
                    annual_decline: float = EXTEND_ANNUAL_DECLINE, floor: float = EXTEND_FLOOR) -> DataFrame:
    """Continue each series month by month to `until` at a fixed yearly decline.

    The last row of a series emits its continuation; no separate aggregate, join or union. Series
    already reaching `until` are unchanged. Other columns are null in added rows, `Extended` marks them.
    """
    order = Window.partitionBy(*keys).orderBy(month, *tie)
    target = F.lit(until).cast("date")
    m = F.col(month).cast("date")
    months = F.when(F.col("_last") & (m < target), F.sequence(m, target, F.expr("interval 1 month"))).otherwise(
        F.array(m))
    added = F.col("_k") > 0
    rate = F.greatest(F.col(value) * F.pow(F.lit(1.0 - annual_decline / 12.0), F.col("_k")), F.lit(floor))

    def column(name: str):
        if name in keys:
            return F.col(name)
        if name == month:
            return F.col("_month").alias(name)
        if name == value:
            return F.when(added, rate).otherwise(F.col(name)).alias(name)
        return F.when(~added, F.col(name)).alias(name)

    return (
        forecast.withColumn("_last", F.lead(month).over(order).isNull())
        .select("*", F.posexplode(months).alias("_k", "_month"))
        .select(*[column(c) for c in forecast.columns], added.alias("Extended"))
    )


def running_total(combined: DataFrame, value: str, keys: Sequence[str] = ("WellID", "ProductionType"),
                  month: str = "ProductionMonth", tie: Sequence[str] = ()) -> DataFrame:
    """Running total through history and on through the forecast."""
    order = (Window.partitionBy(*keys)
             .orderBy(F.when(F.col("DataType") == HISTORICAL, 0).otherwise(1), month, *tie)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return combined.withColumn(f"{value}_Cumulative", F.sum(F.coalesce(F.col(value), F.lit(0.0))).over(order))


def entity_list(*sources: DataFrame, entity: str = "WellID") -> DataFrame:
    """Distinct entities of all sources, sorted. Each source is reduced before the union."""
    parts = [s.select(entity).distinct() for s in sources]
    return reduce(DataFrame.unionByName, parts).distinct().orderBy(entity)


def liquid_stream(summary: DataFrame) -> DataFrame:
    """The liquid to show per well: oil if it has an oil forecast, else condensate."""
    rank = F.min(F.when(F.col("ProductionType") == "OilProduction", 1)
                 .when(F.col("ProductionType") == "CondensateProduction", 2))
    return (
        summary.groupBy("WellID").agg(rank.alias("_rank"))
        .select("WellID", F.when(F.col("_rank") == 1, "oil").when(F.col("_rank") == 2, "condensate")
                .alias("LiquidStream"))
    )


def fluid_coverage(summary: DataFrame, measures: Sequence[str] = tuple(PRODUCTION_COLUMNS)) -> DataFrame:
    """Per well: the measures with a forecast, and their fit figures side by side."""
    def of(measure: str, column: str):
        name = f"{measure.removesuffix('Production').lower()}_{column}"
        return F.max(F.when(F.col("ProductionType") == measure, F.col(column))).alias(name)

    columns = ("RSquared", "CurveType", "InitialRate_qi", "DeclineRate_di", "DeclineExponent_b")
    return summary.groupBy("WellID").agg(
        F.array_join(F.sort_array(F.collect_set("ProductionType")), ",").alias("Fluids"),
        *[of(m, c) for m in measures for c in columns])


def one_entity(df: DataFrame, value: str, entity: str = "WellID") -> DataFrame:
    """Rows of one entity: a plain equality, so it reaches the scan."""
    return df.filter(F.col(entity) == F.lit(value))


def entities(df: DataFrame, values: Sequence[str], entity: str = "WellID") -> DataFrame:
    """Rows of a few entities: one IN list, so it reaches the scan and selects buckets of a clustered table."""
    return df.filter(F.col(entity).isin(*values))
