"""The forecast job: all entities and measures in one distributed fit."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import (
    rate_columns, rename_with_replace, select_entities, time_column, with_min_history,
)
from ..operators.decline import fit_series, stack_measures
from ..operators.forecast import PER_DAY, PER_MONTH, UNIT, as_history, combine, forecast_rows, forecast_summary
from ..schemas import PRODUCTION_COLUMNS
from ..sources.staging import stage
from ..sources.tables import measure_views, table_exists, write_table
from .medallion import bronze_to_silver, build_calendar_and_normalized


@dataclass
class ForecastSettings:
    horizon_months: int = 30
    min_months: int = 6
    curve_type: str = "auto"
    min_r_squared: float = 0.3
    measures: Sequence[str] = field(default_factory=lambda: list(PRODUCTION_COLUMNS))
    include: Sequence[str] = ()
    exclude: Sequence[str] = ()
    as_of: str | None = None


def forecast_input(table: DataFrame, s: ForecastSettings) -> tuple[DataFrame, dict[str, str]]:
    """Selected rows with one time column, and which column to fit for each measure."""
    columns = rate_columns(table, s.measures)
    history = rename_with_replace(as_history(table), time_column(table), "DaysFromFirst")
    return with_min_history(select_entities(history, s.include, s.exclude), s.min_months), columns


def fit_table(history: DataFrame, columns: dict[str, str], s: ForecastSettings) -> DataFrame:
    """Fits of every (entity, measure); DataUnit tells whether values are daily rates."""
    fits = fit_series(stack_measures(history, columns), s.curve_type, s.min_r_squared)
    rates = [m for m, c in columns.items() if c != m]
    unit = F.when(F.col("ProductionType").isin(rates), PER_DAY).otherwise(PER_MONTH) if rates else F.lit(PER_MONTH)
    return fits.withColumn(UNIT, unit)


def forecast_tables(spark: SparkSession, namespace: str, settings: ForecastSettings | None = None,
                    input_table: str | None = None, use_normalized: bool = True,
                    dataset: str = "ngl") -> dict[str, DataFrame]:
    """Write `forecast_fits`, `forecast_summary`, `forecasted_production`,
    `historical_forecast_combined`, each holding all measures and partitioned by ProductionType.

    The fit runs once; the three results read the stored fit table. Per-measure views carry the
    names `<measure>_<table>`.
    """
    s = settings or ForecastSettings()
    if input_table is None:
        if use_normalized:
            needed = [f"{namespace}.{dataset}_normalized", f"{namespace}.{dataset}_calendar"]
            if not all(table_exists(spark, n) for n in needed):
                build_calendar_and_normalized(spark, namespace, dataset)
            input_table = needed[0]
        else:
            # Reported months only: inserted ones would count for the minimum history.
            input_table = f"{namespace}.{dataset}_silver"
            if not table_exists(spark, input_table):
                bronze_to_silver(spark, dataset, namespace)
    selected, columns = forecast_input(spark.table(input_table), s)
    # Fits, rows and the combined table all read the selection.
    history = stage(selected)

    def store(df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{namespace}.{name}", partition_by="ProductionType")

    fits = store(fit_table(history, columns, s), "forecast_fits")
    as_of = s.as_of or datetime.date.today().isoformat()
    summary = store(forecast_summary(fits, as_of, s.horizon_months), "forecast_summary")
    rows = store(forecast_rows(fits, history, s.horizon_months), "forecasted_production")
    combined = store(combine(history, rows, s.measures, fitted=columns), "historical_forecast_combined")
    tables = {"forecast_summary": summary, "forecasted_production": rows,
              "historical_forecast_combined": combined}
    for kind, table in tables.items():
        measure_views(spark, kind, table, list(s.measures))
    return {"forecast_fits": fits, **tables}
