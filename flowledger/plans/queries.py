"""Registered queries: one per operator group, each over whole tables.

`QUERIES[name]` takes (spark, directory) and returns a DataFrame; `ORACLES[name]` is SQL with the
same result. Doubles are rounded on both sides because the engines add in different order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from .. import fixtures as X
from ..functions import curves, text
from ..functions.measures import add_derived_measures, hours_in_month, to_imperial
from ..operators import calendar as C
from ..operators import changes as H
from ..operators import clean as P
from ..operators import decline as D
from ..operators import forecast as FC
from ..operators import presentation as V
from ..operators import profile as R
from ..operators import quality as Q
from ..operators import ranges as G
from ..operators.periods import normalize_periods
from ..schemas import MAIN_VOLUMES, PRODUCTION_COLUMNS
from ..session import shared_folder
from ..sources.clustered import write_clustered
from ..sources.staging import stage
from ..sources.tables import loaded_months, measure_views, missing_months, month_range, register_views
from .forecasting import ForecastSettings, fit_table, forecast_input
from .oracles import CTES, HALF, MAIN, MEASURES, PRODUCTION, rounded, sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MONTHS = 24
AS_OF = "2024-01-01"


def register(oracle: str | None, **override: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = sql(oracle, **override)
        return query
    return add


def near(c: Column | str, digits: int = 4) -> Column:
    """Round half up, where anything a hair below a tie counts as the tie (as rnd in the SQL)."""
    unit = 10.0 ** digits
    return F.floor((F.col(c) if isinstance(c, str) else c) * unit + HALF) / unit


def r(columns: Sequence[str], digits: int = 4) -> list[Column]:
    return [near(c, digits).alias(c) for c in columns]


def long(c: str) -> Column:
    return F.col(c).cast("long").alias(c)


# ---- cleaning -------------------------------------------------------------------------------

TEXT_SCHEMA = StructType([
    StructField("GasProduction", DoubleType()), StructField("Sequence", IntegerType()),
    StructField("Pool", StringType()), StructField("ProductionMonth", StringType(), False)])


@register("""SELECT l_orderkey, l_linenumber, l_partkey,
  try_cast(nullif(regexp_replace(GasProduction, '[^\\d.-]', '', 'g'), '') AS DOUBLE) AS GasProduction,
  try_cast(nullif(regexp_replace(Sequence, '[^\\d-]', '', 'g'), '') AS INTEGER) AS Sequence, trim(Pool) AS Pool FROM dirty""")
def numeric_text_clean(spark, sf):
    return P.apply_schema(X.well_text(spark, sf), TEXT_SCHEMA).drop("ProductionMonth")


@register("""SELECT * FROM (SELECT l_orderkey, l_linenumber, CAST(date_trunc('month', CASE
  WHEN regexp_matches(ProductionMonth, '^\\d{4}-\\d{2}$') THEN try_cast(concat(ProductionMonth, '-01') AS DATE)
  ELSE try_cast(ProductionMonth AS DATE) END) AS DATE) AS ProductionMonth FROM dirty)
  WHERE ProductionMonth IS NOT NULL""")
def parse_month_required(spark, sf):
    parsed = P.drop_incomplete(P.parse_months(X.well_text(spark, sf)), TEXT_SCHEMA)
    return parsed.select("l_orderkey", "l_linenumber", "ProductionMonth")


@register("SELECT WellID, ProductionMonth, Hours, " + ", ".join(
    f"rnd(CASE WHEN {c} < 0 THEN 0 ELSE {c} END, 4) AS {c}" for c in PRODUCTION_COLUMNS)
    + ", rnd(coalesce(PropaneMixVolume, 0), 4) AS PropaneMixVolume FROM line")
def negative_clip(spark, sf):
    clipped = P.clip_negatives(X.well_line(spark, sf), PRODUCTION_COLUMNS)
    return P.zero_nulls(clipped, ["PropaneMixVolume"]).select(
        "WellID", "ProductionMonth", "Hours", *r([*PRODUCTION_COLUMNS, "PropaneMixVolume"]))


@register("SELECT l_orderkey, l_linenumber, coalesce(try_cast(GasProduction AS DOUBLE), 0) AS GasProduction FROM dirty")
def number_or_zero(spark, sf):
    return X.well_text(spark, sf).select(
        "l_orderkey", "l_linenumber", text.number_or_zero("GasProduction").alias("GasProduction"))


# ---- derived measures -----------------------------------------------------------------------

_EQUIVALENTS = ["ethane_gas_equiv", "propane_gas_equiv", "butane_gas_equiv", "pentane_gas_equiv",
                "lite_gas_equiv", "total_gas_equiv"]
_LIQUIDS = ["c5_liquids", "oil_liquids", "condensate_liquids", "lite_liquids", "total_liquids"]


@register(f"SELECT WellID, ProductionMonth, {rounded(_EQUIVALENTS)} FROM measured")
def gas_equivalent(spark, sf):
    return add_derived_measures(X.well_month(spark, sf)).select("WellID", "ProductionMonth", *r(_EQUIVALENTS))


@register(f"""SELECT WellID, ProductionMonth, {rounded(_LIQUIDS)},
  CASE WHEN total_liquids > 0 THEN rnd(coalesce(GasProduction, 0) / total_liquids, 4) END AS gas_liquids_ratio,
  total_gas_equiv BETWEEN 0 AND 1000000 AND total_liquids BETWEEN 0 AND 10000 AS aer_compliant FROM measured""")
def liquids_ratio(spark, sf):
    return add_derived_measures(X.well_month(spark, sf)).select(
        "WellID", "ProductionMonth", *r([*_LIQUIDS, "gas_liquids_ratio"]), "aer_compliant")


@register("""SELECT count(*) AS total_rows, count(DISTINCT WellID) AS total_wells,
  rnd(sum(total_gas_equiv), 2) AS total_gas_equivalent, rnd(sum(total_liquids), 2) AS total_real_liquids,
  rnd(sum(GasProduction), 2) AS total_gas_production FROM measured""")
def measure_summary(spark, sf):
    totals = R.measure_summary(add_derived_measures(X.well_month(spark, sf)))
    return totals.select("total_rows", "total_wells", *r(
        ["total_gas_equivalent", "total_real_liquids", "total_gas_production"], 2))


@register("""SELECT WellID, ProductionMonth, LineCount, day(last_day(ProductionMonth)) * 24.0e0 AS HoursInMonth
  FROM merged""")
def hours_per_month(spark, sf):
    merged = Q.merge_duplicates(X.well_line(spark, sf), ["WellID", "ProductionMonth"], X.EXACT_SCALE)
    return merged.select("WellID", "ProductionMonth", "LineCount",
                         hours_in_month("ProductionMonth").alias("HoursInMonth"))


@register("""SELECT WellID, ProductionMonth, CAST(date_diff('day', min(ProductionMonth) OVER (PARTITION BY WellID),
  ProductionMonth) AS INTEGER) AS DaysFromFirst, n AS lines
  FROM (SELECT WellID, ProductionMonth, count(*) AS n FROM line GROUP BY ALL)""")
def days_from_first(spark, sf):
    offsets = C.add_days_from_first(X.well_line(spark, sf).select("WellID", "ProductionMonth"))
    return offsets.groupBy("WellID", "ProductionMonth", "DaysFromFirst").agg(F.count("*").alias("lines"))


_TO_IMPERIAL = {"GasProduction": "0.035315e0", "OilProduction": "6.28981e0", "CondensateProduction": "6.28981e0"}


@register("SELECT WellID, ProductionMonth, " + ", ".join(
    f"rnd({c}{x} * {k}, 4) AS {c}{x}" for x in ("", "Cumulative") for c, k in _TO_IMPERIAL.items()) + " FROM calendar")
def imperial_units(spark, sf):
    """Volumes and running totals of the calendar."""
    columns = [c + x for x in ("", "Cumulative") for c in _TO_IMPERIAL]
    return to_imperial(_calendar(spark, sf)).select("WellID", "ProductionMonth", *r(columns))


@register("""SELECT WellID, ProductionMonth, rnd(qi * exp(-di * t / 365.25e0), 4) AS exponential,
  rnd(qi * power(1 + 0.5e0 * di * t / 365.25e0, -1 / 0.5e0), 4) AS hyperbolic,
  rnd(qi / (1 + di * t / 365.25e0), 4) AS harmonic
  FROM (SELECT WellID, ProductionMonth, t, di, OilProduction AS qi FROM trended)""")
def decline_curves(spark, sf):
    k = X.well_number()
    rows = X.decline(spark, sf).withColumn("di", F.pmod(k, F.lit(6)) * F.lit(0.1))
    t, qi, di = F.col("DaysFromFirst"), F.col("OilProduction"), F.col("di")
    return rows.select(
        "WellID", "ProductionMonth", near(curves.exponential(t, qi, di), 4).alias("exponential"),
        near(curves.hyperbolic(t, qi, di, F.lit(0.5)), 4).alias("hyperbolic"),
        near(curves.harmonic(t, qi, di), 4).alias("harmonic"))


# ---- selection and sources ------------------------------------------------------------------

MIN_ROWS = 600


@register(f"SELECT WellID, count(*) AS lines FROM line GROUP BY WellID HAVING count(*) >= {MIN_ROWS}")
def min_history(spark, sf):
    kept = P.with_min_history(X.well_line(spark, sf).select("WellID"), MIN_ROWS)
    return kept.groupBy("WellID").agg(F.count("*").alias("lines"))


@register("""SELECT WellID, count(*) AS lines, rnd(sum(CAST(GasProduction AS DECIMAL(18,4))), 2)::DOUBLE AS GasProduction
  FROM line WHERE WellID IN (SELECT WellID FROM attributes WHERE Field <> 'ASIA')
  AND WellID NOT IN (SELECT WellID FROM attributes WHERE OperatorName LIKE '%1') AND WellID <> 'W000000000002'
  GROUP BY WellID""")
def include_exclude(spark, sf):
    wells = X.well_attributes(spark, sf)
    chosen = P.select_entities(X.well_line(spark, sf), wells.filter("Field <> 'ASIA'"),
                               wells.filter("OperatorName LIKE '%1'"))
    chosen = P.select_entities(chosen, exclude=["W000000000002"])
    return chosen.groupBy("WellID").agg(
        F.count("*").alias("lines"), near(Q.exact_sum("GasProduction", 4), 2).alias("GasProduction"))


@register("""SELECT Month, strftime(Month, '%Y-%m') AS Label FROM (SELECT CAST(unnest(generate_series(
  DATE '1993-06-01', DATE '2003-06-01', INTERVAL 1 MONTH)) AS DATE) AS Month)
  WHERE Month NOT IN (SELECT ProductionMonth FROM line)""")
def missing_month_plan(spark, sf):
    loaded = loaded_months(X.well_line(spark, sf))
    return missing_months(month_range(spark, "1993-06", "2003-06"), loaded)


# ---- quality --------------------------------------------------------------------------------

_MERGED = ["WellID", "ProductionMonth", "Pool", "Area", *MEASURES]


@register(f"SELECT WellID, ProductionMonth, Pool, Area, {', '.join(MEASURES)}, LineCount FROM merged")
def merge_duplicates(spark, sf):
    return Q.merge_duplicates(X.well_line(spark, sf), ["WellID", "ProductionMonth"], X.EXACT_SCALE).select(
        *_MERGED, "LineCount")


def _validated(spark, sf) -> Q.Validated:
    return Q.validate_silver(X.well_line_injected(spark, sf), PRODUCTION_COLUMNS, exact_scale=X.EXACT_SCALE)


def _issue(rule: str, severity: str, field: str, original: str, corrected: str, note: str, where: str,
           source: str = "flagged") -> str:
    return (f"SELECT WellID, ProductionMonth, '{rule}' AS Rule, '{severity}' AS Severity, '{field}' AS Field, "
            f"rnd({original}, 4) AS OriginalValue, rnd({corrected}, 4) AS CorrectedValue, '{note}' AS Note "
            f"FROM {source} WHERE {where}")


_NUL = "CAST(NULL AS DOUBLE)"
_SILVER_ISSUES = [
    _issue("aggregated_duplicate", "Warn", "", "CAST(LineCount AS DOUBLE)", _NUL,
           "Aggregated rows for WellID+ProductionMonth", "LineCount > 1"),
    *[_issue("negative_clipped", "Warn", m, m, "0e0", "Negative production clipped to 0", f"{m} < 0")
      for m in PRODUCTION],
    _issue("hours_negative", "Fatal", "Hours", "Hours", _NUL, "", "Hours < 0"),
    _issue("hours_zero_with_production", "Fatal", "Hours", "Hours", _NUL, "", "Hours = 0 AND produced"),
    _issue("hours_exceed_month_by_over_24", "Fatal", "Hours", "Hours", _NUL, "", "Hours > HIM + 24"),
    _issue("hours_significantly_mismatch_month", "Warn", "Hours", "Hours", "HIM", "Check downtime/reporting",
           "abs(Hours - HIM) / HIM > 0.15 AND produced"),
]


def _numeric_values(issues: DataFrame) -> DataFrame:
    """Value texts as numbers: the engines print doubles differently."""
    return issues.withColumns({c: near(F.col(c).try_cast("double"), 4)
                               for c in ("OriginalValue", "CorrectedValue")})


@register(" UNION ALL ".join(_SILVER_ISSUES))
def silver_issues(spark, sf):
    return _numeric_values(_validated(spark, sf).issues)


@register(f"SELECT WellID, ProductionMonth, Pool, Area, {', '.join(MEASURES)} FROM silver")
def silver_clean(spark, sf):
    return _validated(spark, sf).clean.select(*_MERGED)


def _calendar(spark, sf) -> DataFrame:
    return C.build_calendar(_validated(spark, sf).clean)


@register(f"SELECT WellID, ProductionMonth, Pool, Area, {', '.join(MEASURES)}, Backfilled FROM filled")
def month_backfill(spark, sf):
    return C.backfill_months(_validated(spark, sf).clean).select(*_MERGED, C.BACKFILLED)


_BACKFILL_ISSUE = _issue("backfilled_month", "Info", "", _NUL, _NUL,
                         "Inserted missing month with zero volumes/hours", "Backfilled", "{source}")


@register(_BACKFILL_ISSUE.format(source="filled"))
def backfill_issues(spark, sf):
    return _numeric_values(C.backfill_issues(C.backfill_months(_validated(spark, sf).clean)))


_CUMULATIVE = [f"{c}Cumulative" for c in [*MAIN, "Hours"]]


@register(f"""SELECT WellID, ProductionMonth, {', '.join(MAIN)}, Hours, {rounded(_CUMULATIVE)}, DaysFromFirst
  FROM calendar""")
def calendar_cumulative(spark, sf):
    return C.validate_calendar(_validated(spark, sf).clean).clean.select(
        "WellID", "ProductionMonth", *MAIN, "Hours", *r(_CUMULATIVE), "DaysFromFirst")


def _reported(spark, sf) -> DataFrame:
    """Calendar whose reported totals fall in one month for some wells."""
    sevens, month = F.pmod(X.well_number(), F.lit(7)), F.col("ProductionMonth")
    hours = F.when((sevens == 2) & (month == F.lit("1997-03-01").cast("date")), 5000.0).otherwise(0.0)
    gas = F.when((sevens == 3) & (month == F.lit("1998-05-01").cast("date")), 9000000.0).otherwise(0.0)
    return _calendar(spark, sf).withColumns({
        "HoursCumulative": F.col("HoursCumulative") - hours,
        "GasProductionCumulative": F.col("GasProductionCumulative") - gas})


@register(" UNION ALL ".join([
    _BACKFILL_ISSUE.format(source="lagged"),
    _issue("hours_cumulative_decreased", "Fatal", "HoursCumulative", "prevHours", "HoursCumulative", "",
           "HoursCumulative < prevHours", "lagged"),
    _issue("production_cumulative_decreased", "Warn", "", _NUL, _NUL, "Check source data or downtime corrections",
           " OR ".join(f"{m}Cumulative < prev{m}" for m in MAIN[:3]), "lagged")]))
def calendar_checks(spark, sf):
    return _numeric_values(C.check_cumulatives(_reported(spark, sf)).issues)


@register(f"""SELECT WellID, ProductionMonth, {', '.join(MAIN)}, Hours, {rounded(_CUMULATIVE)}, DaysFromFirst FROM lagged
  WHERE NOT coalesce(HoursCumulative < prevHours, false)""")
def calendar_clean(spark, sf):
    return C.check_cumulatives(_reported(spark, sf)).clean.select(
        "WellID", "ProductionMonth", *MAIN, "Hours", *r(_CUMULATIVE), "DaysFromFirst")


# ---- equal-hour periods ---------------------------------------------------------------------

def _normalized(spark, sf) -> DataFrame:
    return normalize_periods(C.validate_calendar(_validated(spark, sf).clean).clean)


@register("SELECT WellID, Pool, Area, CAST(k AS INTEGER) AS NormalizedPeriod, PeriodStartDate, PeriodEndDate, 730e0 AS HoursInPeriod, "
          + rounded(MAIN) + ", " + ", ".join(f"rnd({m} / (730 / 24.0e0), 4) AS {m}DailyRate" for m in MAIN) + ", "
          + rounded(_CUMULATIVE[:4]) + ", target AS HoursCumulative, DaysFromFirstProducing FROM normalized")
def normalized_periods(spark, sf):
    return _normalized(spark, sf).select(
        "WellID", "Pool", "Area", "NormalizedPeriod", "PeriodStartDate", "PeriodEndDate", "HoursInPeriod",
        *r(MAIN), *r([f"{m}DailyRate" for m in MAIN]), *r(_CUMULATIVE[:4]), "HoursCumulative",
        "DaysFromFirstProducing")


@register("""SELECT n.WellID, CAST(n.k AS INTEGER) AS NormalizedPeriod, n.target AS HoursCumulative, c.h AS RowHours, c.ProductionMonth
  FROM normalized n ASOF LEFT JOIN (SELECT WellID, HoursCumulative AS h, min(ProductionMonth) AS ProductionMonth FROM calendar GROUP BY ALL) c
  ON n.WellID = c.WellID AND n.target <= c.h""")
def period_rows(spark, sf):
    """The calendar row in which each period ends: the first with as many hours."""
    calendar = stage(C.validate_calendar(_validated(spark, sf).clean).clean)
    rows = calendar.groupBy("WellID", F.col("HoursCumulative").alias("RowHours")).agg(F.min("ProductionMonth").alias("ProductionMonth"))
    periods = normalize_periods(calendar).select("WellID", "NormalizedPeriod", "HoursCumulative")
    return G.as_of(periods, rows, ["WellID"], "HoursCumulative", ["RowHours", "ProductionMonth"], "RowHours", forward=True)


def _readings(spark, sf) -> DataFrame:
    """Raw rows by day; three pools, two areas, whatever the number of rows."""
    return X.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("Pool"), F.col("l_linestatus").alias("Area"),
        F.col("l_shipdate").cast("date").alias("Day"), F.col("l_quantity").alias("OilProduction"),
        F.col("l_extendedprice").alias("GasProduction"))


_READINGS = """(SELECT l_orderkey, l_linenumber, l_returnflag AS Pool, l_linestatus AS Area, CAST(l_shipdate AS DATE) AS Day,
  l_quantity AS OilProduction, l_extendedprice AS GasProduction FROM lineitem)"""


@register(f"""SELECT l_orderkey, l_linenumber, Pool, Day, rnd(sum(OilProduction) OVER w, 2) AS OilProductionCumulative,
  rnd(sum(GasProduction) OVER w, 2) AS GasProductionCumulative FROM {_READINGS}
  WINDOW w AS (PARTITION BY Pool ORDER BY Day, l_orderkey, l_linenumber, OilProduction, GasProduction ROWS UNBOUNDED PRECEDING)""")
def raw_running_totals(spark, sf):
    """Running totals over raw rows of keys that hold a quarter to half of them each; order and line may repeat."""
    measures = ["OilProduction", "GasProduction"]
    totals = G.running_sums(_readings(spark, sf), measures, ["Pool"], ["Day", "l_orderkey", "l_linenumber", *measures])
    return totals.select("l_orderkey", "l_linenumber", "Pool", "Day", *r([f"{m}Cumulative" for m in measures], 2))


@register(f"""SELECT t.l_orderkey, t.l_linenumber, t.Area, t.Day, f.Day AS LastDay, f.GasProduction AS LastGas
  FROM {_READINGS} t ASOF LEFT JOIN (SELECT Area, Day, max(GasProduction) AS GasProduction FROM {_READINGS} WHERE Pool <> 'R' GROUP BY ALL) f
  ON t.Area = f.Area AND t.Day >= f.Day WHERE t.Pool = 'R'""")
def reading_as_of(spark, sf):
    """For rows of one pool the last reading of the others in their area, its largest on that day."""
    readings = _readings(spark, sf)
    others = readings.where("Pool <> 'R'").select("Area", F.col("Day").alias("LastDay"), F.col("GasProduction").alias("LastGas"))
    targets = readings.where("Pool = 'R'").select("l_orderkey", "l_linenumber", "Area", "Day")
    return G.as_of(targets, others, ["Area"], "Day", ["LastDay", "LastGas"], "LastDay")


# ---- decline fit ----------------------------------------------------------------------------

_KEYS = ["WellID", "ProductionType"]


def _points(spark, sf) -> DataFrame:
    return D.stack_measures(X.decline(spark, sf), PRODUCTION_COLUMNS)


def _solved(spark, sf) -> DataFrame:
    return D.solve_series(D.series_table(_points(spark, sf)))


def _fits(spark, sf) -> DataFrame:
    return D.fit_series(_points(spark, sf))


@register("""SELECT WellID, ProductionType, ProductionMonth, CAST(idx AS INTEGER) AS idx, CAST(n AS INTEGER) AS n,
  CAST(peak_idx AS INTEGER) AS peak_idx, CAST(start_idx AS INTEGER) AS start_idx, in_segment FROM segment""")
def peak_segment(spark, sf):
    return D.decline_segment(_points(spark, sf)).filter("positive").select(
        *_KEYS, "ProductionMonth", *[F.col(c).cast("int").alias(c) for c in ("idx", "n", "peak_idx", "start_idx")],
        "in_segment")


@register("""SELECT WellID, ProductionType, CAST(coalesce(n_points, 0) AS INTEGER) AS n_points, CAST(seg_len AS INTEGER) AS seg_len,
  rnd(overall_ratio, 6) AS overall_ratio, rnd(trend_ratio, 6) AS trend_ratio, coalesce(rejected, 'ok') AS Outcome
  FROM series""")
def decline_test(spark, sf):
    return D.series_table(_points(spark, sf)).select(
        *_KEYS, F.col("n_points").cast("int").alias("n_points"), F.col("seg_len").cast("int").alias("seg_len"),
        *r(["overall_ratio", "trend_ratio"], 6), F.coalesce("rejected", F.lit("ok")).alias("Outcome"))


@register("""SELECT WellID, ProductionType, ProductionMonth, rnd(low_bound, 6) AS low_bound,
  rnd(high_bound, 6) AS high_bound, inside, keep FROM masked""")
def iqr_mask(spark, sf):
    return D.mark_outliers(D.decline_segment(_points(spark, sf))).filter("in_segment").select(
        *_KEYS, "ProductionMonth", *r(["low_bound", "high_bound"], 6), "inside", "keep")


@register("""SELECT WellID, ProductionType, CAST(n_used AS INTEGER) AS n_used, rnd(t_offset, 4) AS t_offset,
  rnd(slope, 6) AS slope, rnd(intercept, 6) AS intercept, rnd(qi_estimate, 4) AS qi_estimate
  FROM series WHERE rejected IS NULL""")
def loglinear_fit(spark, sf):
    return D.series_table(_points(spark, sf)).filter("rejected IS NULL").select(
        *_KEYS, F.col("n_used").cast("int").alias("n_used"), near("t_offset", 4).alias("t_offset"),
        *r(["slope", "intercept"], 6), *r(["qi_estimate"]))


_FIT_COLUMNS = {"exp": "exponential", "hyp": "hyperbolic", "har": "harmonic"}


@register("SELECT WellID, ProductionType, " + ", ".join(
    f"max(CASE WHEN curve = '{name}' AND r2 > -1e299 THEN rnd({c}, {d}) END) AS {p}_{c}"
    for p, name in _FIT_COLUMNS.items() for c, d in (("qi", 2), ("di", 3), ("r2", 5), ("aic", 2)))
    + ", max(CASE WHEN curve = 'hyperbolic' THEN rnd(b, 2) END) AS hyp_b FROM curves GROUP BY ALL")
def curve_fits(spark, sf):
    fit = F.col("fit")
    return _solved(spark, sf).filter("rejected IS NULL").select(
        *_KEYS, *[near(fit[f"{p}_{c}"], d).alias(f"{p}_{c}") for p in _FIT_COLUMNS
                  for c, d in (("qi", 2), ("di", 3), ("r2", 5), ("aic", 2))],
        near(fit["hyp_b"], 2).alias("hyp_b"))


_ERROR_DIGITS = {"exp_qi": 2, "exp_di": 3, "hyp_qi": 2, "hyp_di": 3, "har_qi": 2, "har_di": 3}


@register("""SELECT WellID, ProductionType, """ + ", ".join(
    f"rnd(max(CASE WHEN curve = '{_FIT_COLUMNS[c[:3]]}' THEN {c[4:]}_error END), {d}) AS {c}_error" for c, d in _ERROR_DIGITS.items())
    + ", rnd(max(CASE WHEN b_error < 1 THEN b_error END), 3) AS hyp_b_error FROM fit_errors GROUP BY ALL")
def parameter_errors(spark, sf):
    """The exponent's error only where the points determine it: beyond 1 it is longer than its range."""
    fit = F.col("fit")
    return _solved(spark, sf).filter("rejected IS NULL").select(
        *_KEYS, *[near(fit[f"{c}_error"], d).alias(f"{c}_error") for c, d in _ERROR_DIGITS.items()],
        near(F.when(fit["hyp_b_error"] < 1, fit["hyp_b_error"]), 3).alias("hyp_b_error"))


@register("""SELECT WellID, ProductionType, CurveType, rnd(qi, 2) AS qi, rnd(di, 3) AS di, rnd(b, 2) AS b,
  rnd(RSquared, 5) AS RSquared, rnd(AIC, 2) AS AIC FROM fits WHERE CurveType IS NOT NULL""")
def model_choice(spark, sf):
    return _fits(spark, sf).filter("CurveType IS NOT NULL").select(
        *_KEYS, "CurveType", *r(["qi"], 2), *r(["di"], 3), *r(["b"], 2), *r(["RSquared"], 5), *r(["AIC"], 2))


@register("SELECT WellID, ProductionType, Status FROM fits")
def fit_outcome(spark, sf):
    return _fits(spark, sf).select(*_KEYS, "Status")


@register("""SELECT WellID, ProductionType, CurveType, rnd(RSquared, 5) AS RSquared, Status FROM fits""",
          auto_choice="SELECT * FROM curves WHERE r2 > 0 AND curve = 'harmonic'")
def named_curve_outcome(spark, sf):
    return D.fit_series(_points(spark, sf), "harmonic").select(
        *_KEYS, "CurveType", *r(["RSquared"], 5), "Status")


# ---- forecasts ------------------------------------------------------------------------------

@register("""SELECT WellID, ProductionType, CAST(i + 1 AS INTEGER) AS Step, day AS DaysFromFirst, ForecastDate, ProductionMonth,
  rnd(Rate, 2) AS Rate, CurveType FROM ahead""")
def forecast_points(spark, sf):
    return FC.forecast_points(_fits(spark, sf), MONTHS).select(
        *_KEYS, "Step", "DaysFromFirst", "ForecastDate", "ProductionMonth", *r(["Rate"], 2), "CurveType")


_SUMMARY_NUMBERS = {"RSquared": 5, "InitialRate_qi": 2, "DeclineRate_di": 3, "DeclineExponent_b": 2,
                    "HistoricalAvgProduction": 4, "HistoricalPeakProduction": 4, "HistoricalLastProduction": 4,
                    "ForecastCumulative12Month": 1, "AIC": 2}
_SUMMARY_DATES = ["HistoricalDataMinDate", "HistoricalDataMaxDate", "ForecastStartDate"]


def _summary_rounded(summary: DataFrame) -> DataFrame:
    return summary.select(
        *_KEYS, "CurveType", "DataPointsUsed", *[F.col(c).cast("date").alias(c) for c in _SUMMARY_DATES],
        *[near(c, d).alias(c) for c, d in _SUMMARY_NUMBERS.items()])


_SUMMARY_SQL = ("SELECT WellID, ProductionType, CurveType, DataPointsUsed, " + ", ".join(_SUMMARY_DATES) + ", "
                + ", ".join(f"rnd({c}, {d}) AS {c}" for c, d in _SUMMARY_NUMBERS.items()) + " FROM summary")


def _summary(spark, sf) -> DataFrame:
    return FC.forecast_summary(_fits(spark, sf), AS_OF, MONTHS)


@register(_SUMMARY_SQL)
def forecast_summary(spark, sf):
    return _summary_rounded(_summary(spark, sf))


@register(_SUMMARY_SQL.replace("rnd(ForecastCumulative12Month,", "rnd(30.44e0 * ForecastCumulative12Month,"), points=CTES["normalized_points"])
def normalized_forecast_summary(spark, sf):
    settings = ForecastSettings(horizon_months=MONTHS)
    history, columns = forecast_input(stage(_normalized(spark, sf)), settings)
    return _summary_rounded(FC.forecast_summary(fit_table(history, columns, settings), AS_OF, MONTHS))


_ROW_TEXT = ["ReportingFacilityID", "ReportingFacilityName", "OperatorBAID", "OperatorName", "WellLicenseNumber",
             "Field", "Pool", "Area"]


def _forecast_rows(history: DataFrame) -> DataFrame:
    return FC.forecast_rows(D.fit_series(D.stack_measures(history, PRODUCTION_COLUMNS)), history, MONTHS)


@register(f"""SELECT ProductionType, CAST(Step AS INTEGER) AS Step, WellID, ProductionMonth, {rounded(PRODUCTION, 2)},
  {', '.join(_ROW_TEXT)}, Hours, 'Forecast' AS DataType, ForecastMethod, rnd(ForecastRSquared, 5) AS ForecastRSquared
  FROM forecasts""")
def forecast_rows(spark, sf):
    return _forecast_rows(stage(X.decline(spark, sf))).select(
        "ProductionType", "Step", "WellID", F.col("ProductionMonth").cast("date").alias("ProductionMonth"),
        *r(PRODUCTION, 2), *_ROW_TEXT, "Hours", "DataType", "ForecastMethod", *r(["ForecastRSquared"], 5))


_HISTORY_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS ProductionType, t.*, t.t AS DaysFromFirst FROM trended t" for m in PRODUCTION)


@register(f"""SELECT ProductionType, WellID, ProductionMonth, {rounded(PRODUCTION, 2)}, OperatorName, Field, Hours,
  rnd(WaterProduction, 4) AS WaterProduction, DaysFromFirst, 'Historical' AS DataType, CAST(NULL AS VARCHAR) AS ForecastMethod
  FROM history
  UNION ALL SELECT ProductionType, WellID, ProductionMonth, {rounded(PRODUCTION, 2)}, OperatorName, Field, Hours,
  0e0, DaysFromFirst, 'Forecast', ForecastMethod FROM forecasts""", history=_HISTORY_SQL)
def combined(spark, sf):
    history = stage(X.decline(spark, sf))
    return FC.combine(history, _forecast_rows(history)).select(
        "ProductionType", "WellID", F.col("ProductionMonth").cast("date").alias("ProductionMonth"),
        *r(PRODUCTION, 2), "OperatorName", "Field", "Hours", *r(["WaterProduction"]), "DaysFromFirst",
        "DataType", "ForecastMethod")


_NORMAL_HISTORY = " UNION ALL ".join(
    f"SELECT '{m}' AS ProductionType, * FROM normalized" for m in PRODUCTION)


@register(f"""SELECT ProductionType, WellID, ProductionMonth, {rounded(PRODUCTION, 2)}, Hours, DaysFromFirst, DataType, DataUnit FROM (
  SELECT ProductionType, WellID, PeriodStartDate AS ProductionMonth, {', '.join(f'{m} / (730 / 24.0e0) AS {m}' for m in PRODUCTION)},
  730e0 AS Hours, CAST(DaysFromFirstProducing AS INTEGER) AS DaysFromFirst, 'Historical' AS DataType, 'per day' AS DataUnit
  FROM history WHERE WellID IN (SELECT WellID FROM normalized GROUP BY WellID HAVING count(*) >= 6)
  UNION ALL SELECT ProductionType, WellID, ProductionMonth, {', '.join(
      f"CASE WHEN ProductionType = '{m}' THEN Rate ELSE 0 END" for m in PRODUCTION)}, 720e0, day, 'Forecast', 'per day' FROM ahead)""",
          points=CTES["normalized_points"], history=_NORMAL_HISTORY)
def normalized_combined(spark, sf):
    settings = ForecastSettings(horizon_months=MONTHS)
    history, columns = forecast_input(stage(_normalized(spark, sf)), settings)
    history = stage(history)
    rows = FC.forecast_rows(fit_table(history, columns, settings), history, MONTHS)
    return FC.combine(history, rows, fitted=columns).select(
        "ProductionType", "WellID", F.col("ProductionMonth").cast("date").alias("ProductionMonth"), *r(PRODUCTION, 2),
        "Hours", "DaysFromFirst", "DataType", "DataUnit")


@register("""SELECT count(*) AS wells, rnd(avg(RSquared), 5) AS avg_r2, rnd(avg(AIC), 2) AS avg_aic,
  count(CASE WHEN CurveType = 'exponential' THEN 1 END) AS exponential_wells,
  count(CASE WHEN CurveType = 'hyperbolic' THEN 1 END) AS hyperbolic_wells,
  count(CASE WHEN CurveType = 'harmonic' THEN 1 END) AS harmonic_wells,
  rnd(min(InitialRate_qi), 2) AS min_qi, rnd(max(InitialRate_qi), 2) AS max_qi,
  rnd(min(DeclineRate_di), 3) AS min_di, rnd(max(DeclineRate_di), 3) AS max_di,
  min(HistoricalDataMinDate) AS data_from, max(HistoricalDataMaxDate) AS data_to,
  rnd(avg(DataPointsUsed), 4) AS avg_points, rnd(avg(CASE WHEN RSquared >= 0.6 THEN 1e0 ELSE 0 END), 6) AS share_good
  FROM summary""")
def fit_quality(spark, sf):
    q = FC.fit_quality(_summary(spark, sf))
    digits = {"avg_r2": 5, "avg_aic": 2, "min_qi": 2, "max_qi": 2, "min_di": 3, "max_di": 3, "avg_points": 4,
              "share_good": 6}
    dates = {"data_from", "data_to"}
    return q.select([near(c, digits[c]).alias(c) if c in digits
                     else F.col(c).cast("date").alias(c) if c in dates else F.col(c) for c in q.columns])


@register("""SELECT CAST(CASE WHEN hi > lo THEN least(floor((RSquared - lo) / ((hi - lo) / 20)), 19) ELSE 10 END AS INTEGER) + 1 AS bin,
  count(*) AS wells FROM summary, (SELECT min(RSquared) AS lo, max(RSquared) AS hi FROM summary) GROUP BY ALL""")
def r2_histogram(spark, sf):
    return FC.r2_histogram(stage(_summary(spark, sf)))


# ---- views ----------------------------------------------------------------------------------

@register("""SELECT WellID, ProductionType, ProductionMonth, rnd(Rate, 2) AS Rate, false AS Extended FROM ahead
  UNION ALL SELECT WellID, ProductionType, CAST(last_month + to_months(CAST(k AS INTEGER)) AS DATE),
  rnd(greatest(last_rate * power(1 - 0.1e0 / 12, k), 0.01), 2), true FROM (
  SELECT WellID, ProductionType, max(ProductionMonth) AS last_month, arg_max(Rate, i) AS last_rate FROM ahead GROUP BY ALL),
  generate_series(1, 600) g(k) WHERE last_month + to_months(CAST(k AS INTEGER)) <= DATE '2030-12-01'""")
def extend_forecast(spark, sf):
    extended = V.extend_forecast(FC.forecast_points(_fits(spark, sf), MONTHS), tie=["Step"])
    return extended.select(*_KEYS, "ProductionMonth", *r(["Rate"], 2), "Extended")


@register("""SELECT WellID, ProductionType, DataType, ProductionMonth, Step, rnd(sum(coalesce(q, 0)) OVER (PARTITION BY WellID, ProductionType
  ORDER BY DataType DESC, ProductionMonth, Step ROWS UNBOUNDED PRECEDING), 1) AS Volume_Cumulative FROM (
  SELECT WellID, ProductionType, 'Historical' AS DataType, ProductionMonth, 0 AS Step, q FROM points
  UNION ALL SELECT WellID, ProductionType, 'Forecast', ProductionMonth, CAST(i + 1 AS INTEGER), Rate FROM ahead)""")
def running_total(spark, sf):
    """All measures, through history and on through the forecast."""
    points = stage(_points(spark, sf))
    ahead = FC.forecast_points(D.fit_series(points), MONTHS).select(
        *_KEYS, F.lit("Forecast").alias("DataType"), "ProductionMonth", "Step", F.col("Rate").alias("Volume"))
    past = points.select(*_KEYS, F.lit("Historical").alias("DataType"), F.col("ProductionMonth").cast("date").alias("ProductionMonth"),
                         F.lit(0).alias("Step"), F.col("q").alias("Volume"))
    return V.running_total(past.unionByName(ahead), "Volume", _KEYS, tie=["Step"]).select(
        *_KEYS, "DataType", "ProductionMonth", "Step", *r(["Volume_Cumulative"], 1))


@register("SELECT DISTINCT WellID FROM (SELECT WellID FROM merged UNION ALL SELECT WellID FROM attributes) ORDER BY 1")
def entity_list(spark, sf):
    return V.entity_list(X.well_line(spark, sf), X.well_attributes(spark, sf))


@register("SELECT WellID, string_agg(ProductionType, ',' ORDER BY ProductionType) AS Fluids, " + ", ".join(
    f"max(CASE WHEN ProductionType = '{m}' THEN {f'rnd({c}, {d})' if d else c} END) AS {m.removesuffix('Production').lower()}_{c}"
    for m in PRODUCTION for c, d in (("RSquared", 5), ("CurveType", 0), ("InitialRate_qi", 2), ("DeclineRate_di", 3),
                                     ("DeclineExponent_b", 2)))
    + " FROM summary GROUP BY WellID")
def fluid_coverage(spark, sf):
    covered = V.fluid_coverage(_summary(spark, sf))
    digits = {"RSquared": 5, "InitialRate_qi": 2, "DeclineRate_di": 3, "DeclineExponent_b": 2}

    def column(c: str) -> Column:
        d = digits.get(c.split("_", 1)[-1])
        return near(c, d).alias(c) if d else F.col(c)

    return covered.select([column(c) for c in covered.columns])


@register("""SELECT WellID, CASE min(CASE ProductionType WHEN 'OilProduction' THEN 1 WHEN 'CondensateProduction' THEN 2 END)
  WHEN 1 THEN 'oil' WHEN 2 THEN 'condensate' END AS LiquidStream FROM summary GROUP BY WellID""")
def liquid_stream(spark, sf):
    return V.liquid_stream(_summary(spark, sf))


# ---- profiles, changes, audit ---------------------------------------------------------------

@register("SELECT count(*) AS rows, 15 AS columns, count(DISTINCT WellID) AS entities FROM line")
def table_size(spark, sf):
    return R.table_size(X.well_line(spark, sf))


_CLEAN_GAS = "try_cast(nullif(regexp_replace(GasProduction, '[^\\d.-]', '', 'g'), '') AS DOUBLE)"
_CLEAN_SEQ = "try_cast(nullif(regexp_replace(Sequence, '[^\\d-]', '', 'g'), '') AS INTEGER)"


def _profile(name: str, type_: str, required: str, value: str, typed: bool) -> str:
    bad = f"count(CASE WHEN {name} IS NOT NULL AND trim({name}) <> '' AND {value} IS NULL THEN 1 END)" if typed else "0"
    lo, hi = (f"CAST(min({value}) AS DOUBLE)", f"CAST(max({value}) AS DOUBLE)") if typed else (_NUL, _NUL)
    return (f"SELECT count(*) AS Rows, '{name}' AS \"Column\", '{type_}' AS DeclaredType, {required} AS Required, true AS Present, "
            f"count(CASE WHEN {name} IS NULL THEN 1 END) AS Nulls, count(CASE WHEN trim({name}) = '' THEN 1 END) AS Blanks, "
            f"{bad} AS FailedCasts, {lo} AS Low, {hi} AS High FROM dirty")


@register(" UNION ALL ".join([
    _profile("GasProduction", "double", "false", _CLEAN_GAS, True),
    _profile("Sequence", "int", "false", _CLEAN_SEQ, True),
    _profile("Pool", "string", "false", "Pool", False),
    _profile("ProductionMonth", "string", "true", "ProductionMonth", False)]))
def schema_profile(spark, sf):
    return R.schema_profile(X.well_text(spark, sf), TEXT_SCHEMA)


_PROFILED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(" UNION ALL ".join(
    f"SELECT '{c}' AS \"Column\", count({c}) AS \"count\", rnd(avg({c}), 6) AS mean, rnd(stddev({c}), 6) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, rnd(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, rnd(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, "
    f"rnd(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in _PROFILED))
def numeric_profile(spark, sf):
    profile = R.numeric_profile(X.table(spark, sf, "lineitem"))
    return profile.select("Column", "count", *r(["mean", "std"], 6), "min", *r(["q25", "q50", "q75"], 6), "max")


def _loads(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Two loads of overlapping months: late months are new in the second, the earliest are gone
    from it, and gas was corrected where Pool is R."""
    rows = Q.merge_duplicates(X.well_line(spark, sf), ["WellID", "ProductionMonth"], X.EXACT_SCALE).select(
        "WellID", "ProductionMonth", "GasProduction", "Hours", "Pool")
    gas = F.col("GasProduction") + F.when(F.col("Pool") == "R", 1.0).otherwise(0.0)
    return (rows.filter("ProductionMonth < DATE'2001-07-01'"),
            rows.filter("ProductionMonth >= DATE'1995-03-01'").withColumn("GasProduction", gas))


_CHANGES = """SELECT WellID, ProductionMonth, CASE WHEN ProductionMonth >= DATE '2001-07-01' THEN 'inserted'
  WHEN ProductionMonth < DATE '1995-03-01' THEN 'deleted' WHEN Pool = 'R' THEN 'updated' ELSE 'unchanged' END AS Change
  FROM merged"""


@register(_CHANGES)
def row_hash_changes(spark, sf):
    previous, current = _loads(spark, sf)
    return H.track_changes(previous, current, ["WellID", "ProductionMonth"]).drop("PreviousHash", "CurrentHash")


_FROM_TO = """SELECT WellID, ProductionMonth, {start} AS ValidFrom, {end} AS ValidTo FROM merged WHERE {where}"""
_JAN, _FEB, _OPEN = "DATE '2024-01-01'", "DATE '2024-02-01'", "CAST(NULL AS DATE)"
_LATE, _EARLY = "ProductionMonth >= DATE '2001-07-01'", "ProductionMonth < DATE '1995-03-01'"
_BOTH = f"NOT {_LATE} AND NOT {_EARLY}"


@register(" UNION ALL ".join([
    _FROM_TO.format(start=_FEB, end=_OPEN, where=_LATE), _FROM_TO.format(start=_JAN, end=_FEB, where=_EARLY),
    _FROM_TO.format(start=_JAN, end=_OPEN, where=f"{_BOTH} AND Pool IS DISTINCT FROM 'R'"),
    _FROM_TO.format(start=_JAN, end=_FEB, where=f"{_BOTH} AND Pool = 'R'"),
    _FROM_TO.format(start=_FEB, end=_OPEN, where=f"{_BOTH} AND Pool = 'R'")]))
def load_history(spark, sf):
    """Intervals of three loads, the last like the one before."""
    keys, (first, second) = ["WellID", "ProductionMonth"], _loads(spark, sf)
    history = None
    for day, load in (("2024-01-01", first), ("2024-02-01", second), ("2024-03-01", second)):
        history = H.advance_history(history, load, keys, day)
    return history.select(*keys, *[F.col(c).cast("date").alias(c) for c in ("ValidFrom", "ValidTo")])


_HASHED = sorted([*MEASURES, "Area", "LineCount", "Pool"])
_AS_TEXT = {c: f"CAST(CAST({c} AS DECIMAL(28, 6)) AS VARCHAR)" if c in MEASURES else f"CAST({c} AS VARCHAR)" for c in _HASHED}


@register("SELECT WellID, ProductionMonth, sha256(concat(" + ", ".join(
    f"coalesce(length({t}) || ':' || {t}, 'n')" for t in _AS_TEXT.values()) + ")) AS RowHash FROM merged")
def row_hash(spark, sf):
    rows = Q.merge_duplicates(X.well_line(spark, sf), ["WellID", "ProductionMonth"], X.EXACT_SCALE)
    exact = rows.withColumns({c: F.col(c).cast("decimal(28,6)") for c in MEASURES})
    return H.add_row_hash(exact, ["WellID", "ProductionMonth"], AS_OF).select("WellID", "ProductionMonth", H.HASH)


@register("""SELECT 'quality' AS Section, Rule AS Name, CAST(to_json({'Rule': Rule, 'Severity': Severity, 'issues': count(*),
  'wells': count(DISTINCT WellID)}) AS VARCHAR) AS Document FROM issues GROUP BY Rule, Severity
  UNION ALL SELECT 'changes', Change, CAST(to_json({'Change': Change, 'rows': count(*)}) AS VARCHAR) FROM changed GROUP BY Change""",
          issues=" UNION ALL ".join(_SILVER_ISSUES), changed=_CHANGES)
def audit_report(spark, sf):
    changes = H.track_changes(*_loads(spark, sf), ["WellID", "ProductionMonth"])
    return H.audit_report(_validated(spark, sf).issues, changes)


@register("""SELECT l_orderkey, l_linenumber, try_cast(nullif(CASE l_linenumber WHEN 5 THEN concat(ProductionMonth, '-01 10:30:00')
  ELSE concat(ProductionMonth, '-01') END, '') AS TIMESTAMP) AS Stamp FROM dirty""")
def timestamp_clean(spark, sf):
    """Texts of dates and times, some unreadable."""
    month = F.col("ProductionMonth")
    given = X.well_text(spark, sf).select("l_orderkey", "l_linenumber", F.when(
        F.col("l_linenumber") == 5, F.concat(month, F.lit("-01 10:30:00"))).otherwise(F.concat(month, F.lit("-01"))).alias("Stamp"))
    return P.apply_schema(given, StructType([StructField("Stamp", TimestampType())]))


@register(f"SELECT WellID, ProductionMonth, {', '.join(MAIN)}, Hours FROM merged WHERE WellID = 'W000000000007'")
def one_well(spark, sf):
    """One entity's months; the equality is applied below the merge."""
    months = Q.merge_duplicates(X.well_line(spark, sf), ["WellID", "ProductionMonth"], X.EXACT_SCALE)
    return V.one_entity(months, "W000000000007").select("WellID", "ProductionMonth", *MAIN, "Hours")


@register(f"SELECT WellID, ProductionMonth, {', '.join(MAIN)}, Hours FROM merged WHERE WellID IN ('W000000000003', 'W000000000007', 'W000000000011')")
def wells_of_clustered(spark, sf):
    """Some entities' months from a table that is laid out by entity; files of other buckets stay closed."""
    months = Q.merge_duplicates(X.well_line(spark, sf), ["WellID", "ProductionMonth"], X.EXACT_SCALE)
    name = f"clustered_{uuid.uuid4().hex}"
    table = write_clustered(months, name, path=f"{shared_folder(spark)}/{name}")
    return V.entities(table, ["W000000000003", "W000000000007", "W000000000011"]).select("WellID", "ProductionMonth", *MAIN, "Hours")


@register("""SELECT ProductionType, count(*) AS rows, count(DISTINCT WellID) AS wells, rnd(sum(q), 2) AS volume FROM points
  WHERE q > 0 GROUP BY ProductionType""")
def view_totals(spark, sf):
    """SQL over a result that was registered as a view, one view per measure."""
    points = _points(spark, sf)
    names = measure_views(spark, "history", points, PRODUCTION_COLUMNS)
    register_views({"production_history": points})
    parts = " UNION ALL ".join(f"SELECT '{m}' AS ProductionType, count(*) AS n FROM {v} WHERE q > 0" for m, v in zip(PRODUCTION_COLUMNS, names))
    return spark.sql(f"""SELECT h.ProductionType, max(v.n) AS rows, count(DISTINCT WellID) AS wells, sum(q) AS volume
      FROM production_history h JOIN ({parts}) v ON h.ProductionType = v.ProductionType WHERE q > 0
      GROUP BY h.ProductionType""").withColumn("volume", near("volume", 2))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows to the validated calendar with running totals."""
    return calendar_cumulative(spark, sf)
