"""Severity-graded validation with a long-form issue log.

Fatal rows leave the data; Warn and Info are logged only. Every rule is a flag on the same row, so
one pass serves all rules: no scan per rule, no job to see whether a rule fires, no anti join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..functions.measures import hours_in_month
from ..functions.text import clip_negative
from ..schemas import ISSUES

# Tolerances of the hour rules.
HOURS_OVER_MONTH = 24.0
HOURS_MISMATCH_SHARE = 0.15

# Notes of the issue log; rules without one have an empty note.
NOTES = {
    "aggregated_duplicate": "Aggregated rows for WellID+ProductionMonth",
    "negative_clipped": "Negative production clipped to 0",
    "hours_significantly_mismatch_month": "Check downtime/reporting",
    "backfilled_month": "Inserted missing month with zero volumes/hours",
    "production_cumulative_decreased": "Check source data or downtime corrections",
}

LINES = "LineCount"


class Validated(NamedTuple):
    clean: DataFrame
    issues: DataFrame


class Rule(NamedTuple):
    name: str
    severity: str
    fires: Column
    field: str = ""
    original: Column | None = None
    corrected: Column | None = None

    def entry(self) -> Column:
        blank = F.lit("")
        return F.struct(
            F.coalesce(self.fires, F.lit(False)).alias("fired"),
            F.lit(self.name).alias("Rule"), F.lit(self.severity).alias("Severity"),
            F.lit(self.field).alias("Field"),
            (blank if self.original is None else self.original.cast("string")).alias("OriginalValue"),
            (blank if self.corrected is None else self.corrected.cast("string")).alias("CorrectedValue"),
            F.lit(NOTES.get(self.name, "")).alias("Note"),
        )


def any_true(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions) if conditions else F.lit(False)


def issue_log(df: DataFrame, rules: Sequence[Rule], entity: str, month: str) -> DataFrame:
    """One row per fired rule. Rows without any issue are filtered before the expansion."""
    entries = F.array(*[r.entry() for r in rules])
    return (
        df.filter(any_true([F.coalesce(r.fires, F.lit(False)) for r in rules]))
        .select(F.col(entity).alias("WellID"), F.col(month).alias("ProductionMonth"),
                F.explode(entries).alias("e"))
        .filter("e.fired")
        .select("WellID", "ProductionMonth", "e.Rule", "e.Severity", "e.Field", "e.OriginalValue",
                "e.CorrectedValue", "e.Note")
    )


def without_fatal(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    fatal = [F.coalesce(r.fires, F.lit(False)) for r in rules if r.severity == "Fatal"]
    return df.filter(~any_true(fatal))


def no_issues(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], ISSUES)


def exact_sum(name: str, scale: int | None) -> Column:
    """Sum of a double column; with a scale, on whole units of 10^-scale.

    Whole-unit sums do not depend on the order of rows, so a re-run task gives the same bits. NaN, infinite
    values and those beyond whole units decide the sum as they do in a plain one.
    """
    if scale is None:
        return F.sum(name)
    unit = 10.0 ** scale
    whole = F.col(name) * F.lit(unit) + F.lit(0.5)
    countable = F.abs(whole) < F.lit(2.0 ** 62)
    exact = F.sum(F.when(countable, F.floor(whole)).cast("decimal(38,0)")).cast("double") / F.lit(unit)
    rest = F.sum(F.when(~countable, F.col(name)))
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def merge_duplicates(df: DataFrame, keys: Sequence[str], exact_scale: int | None = None) -> DataFrame:
    """One row per key: doubles are summed, every other column takes its smallest non-null value.

    A map-side combined aggregate: whatever share of the rows one key holds, a task ships at most
    one row per key. Adds `LineCount`, the number of merged rows.

    Smallest-text aggregates are sorted, not hashed, by Spark; a leading hash of the keys lets that
    sort decide on eight bytes instead of comparing ids that share a long prefix.
    """
    others = [f for f in df.schema.fields if f.name not in keys]
    merged = [
        (exact_sum(f.name, exact_scale) if isinstance(f.dataType, DoubleType) else F.min(f.name)).alias(f.name)
        for f in others
    ]
    hashed = [F.xxhash64(*keys).alias("_key")] if any(isinstance(f.dataType, StringType) for f in others) else []
    return df.groupBy(*hashed, *keys).agg(*merged, F.count("*").alias(LINES)).drop("_key")


def silver_rules(measures: Sequence[str], hours: str, month: str) -> list[Rule]:
    in_month = hours_in_month(month)
    h = F.col(hours)
    produced = any_true([F.col(m) > 0 for m in measures])
    return [
        Rule("aggregated_duplicate", "Warn", F.col(LINES) > 1, original=F.col(LINES)),
        *[Rule("negative_clipped", "Warn", F.col(m) < 0, m, F.col(m), F.lit("0")) for m in measures],
        Rule("hours_negative", "Fatal", h < 0, hours, h),
        Rule("hours_zero_with_production", "Fatal", (h == 0) & produced, hours, h),
        Rule("hours_exceed_month_by_over_24", "Fatal", h > in_month + HOURS_OVER_MONTH, hours, h),
        Rule("hours_significantly_mismatch_month", "Warn",
             (F.abs(h - in_month) / in_month > HOURS_MISMATCH_SHARE) & produced, hours, h, in_month),
    ]


def validate_merged(merged: DataFrame, measures: Sequence[str], entity: str = "WellID",
                    month: str = "ProductionMonth", hours: str = "Hours") -> Validated:
    """Validation of rows that are already unique per (entity, month) and carry `LineCount`.

    Jobs store the merged rows once and take both outputs from that table.
    """
    measures = [m for m in measures if m in merged.columns]
    rules = silver_rules(measures, hours, month)
    clean = without_fatal(merged, rules).withColumns({m: clip_negative(m) for m in measures})
    return Validated(clean.drop(LINES), issue_log(merged, rules, entity, month))


def validate_silver(df: DataFrame, measures: Sequence[str], entity: str = "WellID",
                    month: str = "ProductionMonth", hours: str = "Hours",
                    exact_scale: int | None = None) -> Validated:
    """Merge duplicates, apply the rules, return (clean rows, issue log).

    Without the key columns there is nothing to validate: the input comes back with an empty log.
    """
    if not {entity, month} <= set(df.columns):
        return Validated(df, no_issues(df))
    return validate_merged(merge_duplicates(df, [entity, month], exact_scale), measures, entity, month, hours)
