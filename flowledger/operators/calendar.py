"""Continuous monthly calendar per entity: day offsets, gap filling, running totals, checks.

Inputs are unique per (entity, month) (merge_duplicates), so an entity has at most twelve rows per
year of history whatever the size of the raw data; that bounds every per-entity window below.
All windows share `partitionBy(entity)`: one shuffle serves the chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import month_start
from ..schemas import MAIN_VOLUMES, columns_of_type
from .clean import zero_nulls
from .quality import Rule, Validated, any_true, issue_log, without_fatal
from .spread import spread_join

BACKFILLED = "Backfilled"


def add_days_from_first(df: DataFrame, entity: str = "WellID", month: str = "ProductionMonth") -> DataFrame:
    """Days since the entity's first month, for rows of any multiplicity.

    The minimum is a map-side combined aggregate joined back in parts: no entity's raw rows are gathered.
    """
    first = df.groupBy(F.col(entity)).agg(F.min(month).alias("_first"))
    return (spread_join(df, first, entity)
            .withColumn("DaysFromFirst", F.datediff(month, "_first").cast("int")).drop("_first"))


def backfill_months(df: DataFrame, entity: str = "WellID", month: str = "ProductionMonth") -> DataFrame:
    """Insert the months missing between an entity's own first and last month.

    Each row emits itself and the months up to the entity's next row, so no month grid is built and
    joined. Doubles are 0 in inserted rows, other columns null; null doubles of reported rows become
    0 as well. `Backfilled` marks the inserted rows.
    """
    doubles = set(columns_of_type(df, DoubleType))
    series = Window.partitionBy(entity).orderBy(month)
    following = F.col("_next")
    months = F.when(
        following > F.col(month),
        F.sequence(F.col(month), F.add_months(following, -1), F.expr("interval 1 month")),
    ).otherwise(F.array(F.col(month)))
    reported = F.col("_step") == 0

    def fill(name: str):
        if name == entity:
            return F.col(name)
        if name == month:
            return F.col("_month").alias(name)
        if name in doubles:
            return F.when(reported, F.coalesce(F.col(name), F.lit(0.0))).otherwise(F.lit(0.0)).alias(name)
        return F.when(reported, F.col(name)).alias(name)

    return (
        df.withColumn(month, month_start(month))
        .withColumn("_next", F.lead(month).over(series))
        .select("*", F.posexplode(months).alias("_step", "_month"))
        .select(*[fill(c) for c in df.columns], (~reported).alias(BACKFILLED))
    )


def backfill_issues(filled: DataFrame, entity: str = "WellID", month: str = "ProductionMonth") -> DataFrame:
    return issue_log(filled, [_backfill_rule()], entity, month)


def _backfill_rule() -> Rule:
    return Rule("backfilled_month", "Info", F.col(BACKFILLED))


def add_cumulatives(df: DataFrame, measures: Sequence[str] = tuple(MAIN_VOLUMES), hours: str = "Hours",
                    entity: str = "WellID", month: str = "ProductionMonth") -> DataFrame:
    """Running totals `<measure>Cumulative` in month order; null counts as 0."""
    columns = [*measures, hours]
    running = (Window.partitionBy(entity).orderBy(month)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return zero_nulls(df, columns).withColumns({f"{c}Cumulative": F.sum(c).over(running) for c in columns})


def decrease_rules(measures: Sequence[str], hours: str) -> list[Rule]:
    now, before = F.col(f"{hours}Cumulative"), F.col(f"_prev_{hours}")
    return [
        Rule("hours_cumulative_decreased", "Fatal", now < before, f"{hours}Cumulative", before, now),
        Rule("production_cumulative_decreased", "Warn",
             any_true([F.coalesce(F.col(f"{m}Cumulative") < F.col(f"_prev_{m}"), F.lit(False))
                       for m in measures])),
    ]


def check_cumulatives(df: DataFrame, measures: Sequence[str] = tuple(MAIN_VOLUMES[:3]), hours: str = "Hours",
                      entity: str = "WellID", month: str = "ProductionMonth") -> Validated:
    """Running totals must not fall: hours falling is Fatal, production falling a warning.

    If the rows carry `Backfilled`, inserted months are logged in the same pass.
    """
    series = Window.partitionBy(entity).orderBy(month)
    previous = {f"_prev_{c}": F.lag(f"{c}Cumulative").over(series) for c in [*measures, hours]}
    flagged = df.withColumns(previous)
    rules = decrease_rules(measures, hours)
    if BACKFILLED in df.columns:
        rules = [_backfill_rule(), *rules]
    return Validated(without_fatal(flagged, rules).drop(*previous), issue_log(flagged, rules, entity, month))


def build_calendar(silver: DataFrame, measures: Sequence[str] = tuple(MAIN_VOLUMES), hours: str = "Hours",
                   entity: str = "WellID", month: str = "ProductionMonth") -> DataFrame:
    """Gap-filled months with running totals and day offsets (`Backfilled` kept for the checks)."""
    filled = backfill_months(silver, entity, month)
    totals = add_cumulatives(filled, measures, hours, entity, month)
    series = Window.partitionBy(entity).orderBy(month).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return totals.withColumn(
        "DaysFromFirst", F.datediff(month, F.first(month).over(series)).cast("int"))


def validate_calendar(silver: DataFrame, measures: Sequence[str] = tuple(MAIN_VOLUMES), hours: str = "Hours",
                      entity: str = "WellID", month: str = "ProductionMonth") -> Validated:
    """Calendar and its issue log: gaps are filled first, then accumulated, then checked."""
    calendar = build_calendar(silver, measures, hours, entity, month)
    clean, issues = check_cumulatives(calendar, measures[:3], hours, entity, month)
    return Validated(clean.drop(BACKFILLED), issues)
