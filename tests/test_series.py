import datetime
import math
import random

import pytest
from pyspark.sql import functions as F
from samples import month, three_months

from flowledger.operators import calendar, periods

MAIN = ["GasProduction", "OilProduction", "CondensateProduction", "WaterProduction"]


def frame(spark, rows):
    return spark.createDataFrame(rows).select(*rows[0]).withColumn("ProductionMonth", F.col("ProductionMonth").cast("date"))


def test_running_totals(spark):
    rows = calendar.add_cumulatives(frame(spark, three_months())).orderBy("ProductionMonth").collect()
    assert [r.GasProductionCumulative for r in rows] == [100.0, 180.0, 240.0]
    assert [r.HoursCumulative for r in rows] == [730.0, 1460.0, 2190.0]


def test_gap_is_filled_then_accumulated(spark):
    months = [month(0), month(2), month(3)]
    df = spark.createDataFrame([("W", m, None if i else "P", 700.0, 1.0, 1.0, 1.0, 1.0) for i, m in enumerate(months)],
                               "WellID string, ProductionMonth date, Pool string, Hours double, " + " double, ".join(MAIN) + " double")
    out = calendar.validate_calendar(df)
    rows = out.clean.orderBy("ProductionMonth").collect()
    assert [r.Hours for r in rows] == [700.0, 0.0, 700.0, 700.0]
    assert [r.HoursCumulative for r in rows] == [700.0, 700.0, 1400.0, 2100.0]
    assert [r.DaysFromFirst for r in rows] == [0, 31, 60, 91]
    issues = out.issues.collect()
    assert [(i.Rule, i.Severity, i.ProductionMonth) for i in issues] == [("backfilled_month", "Info", month(1))]


def test_repeated_months_are_kept(spark):
    df = spark.createDataFrame([("W", month(0), 1.0), ("W", month(0), 2.0), ("W", month(2), 3.0)],
                               "WellID string, ProductionMonth date, Hours double")
    rows = calendar.backfill_months(df).orderBy("ProductionMonth", "Hours").collect()
    assert [(r.Hours, r.Backfilled) for r in rows] == [(1.0, False), (2.0, False), (0.0, True), (3.0, False)]


def test_decreases(spark):
    df = spark.createDataFrame(
        [("W", month(0), 5.0, 9.0, 1.0, 1.0), ("W", month(1), 4.0, 9.0, 1.0, 1.0), ("W", month(2), 6.0, 8.0, 1.0, 1.0)],
        "WellID string, ProductionMonth date, HoursCumulative double, GasProductionCumulative double, "
        "OilProductionCumulative double, CondensateProductionCumulative double")
    out = calendar.check_cumulatives(df)
    assert sorted((i.Rule, i.ProductionMonth) for i in out.issues.collect()) == [
        ("hours_cumulative_decreased", month(1)), ("production_cumulative_decreased", month(2))]
    assert sorted(r.ProductionMonth for r in out.clean.collect()) == [month(0), month(2)]


def test_days_from_first_on_unmerged_rows(spark):
    df = spark.createDataFrame([("a", month(0)), ("a", month(2)), ("a", month(2)), ("b", month(5))],
                               "WellID string, ProductionMonth date")
    assert sorted(r.DaysFromFirst for r in calendar.add_days_from_first(df).collect()) == [0, 0, 60, 60]


def normalized(spark, rows):
    return periods.normalize_periods(calendar.build_calendar(frame(spark, rows)))


def test_three_full_periods(spark):
    rows = normalized(spark, three_months()).orderBy("NormalizedPeriod").collect()
    assert [r.GasProduction for r in rows] == [100.0, 80.0, 60.0]
    assert [r.NormalizedPeriod for r in rows] == [1, 2, 3]
    assert rows[0].PeriodStartDate == datetime.date(2024, 1, 1)
    assert rows[1].PeriodStartDate == datetime.date(2024, 2, 1) - datetime.timedelta(days=30)
    assert rows[0].GasProductionDailyRate == pytest.approx(100 / (730 / 24))
    assert [r.DaysFromFirstProducing for r in rows] == [30, 60, 90]
    assert rows[0].OperatorName == "Operator"


def test_too_few_hours_gives_no_rows_but_the_columns(spark):
    out = normalized(spark, three_months(hours=200.0))
    assert out.count() == 0 and "DaysFromFirstProducing" in out.columns


def expected_periods(rows, period=730.0):
    """Per-well walk over the period boundaries, straight from the definition."""
    out, hours, total = [], 0.0, 0.0
    points = []
    for m, h, g in rows:
        hours, total = hours + h, total + g
        points.append((m, hours, total))
    k, before = 1, 0.0
    while k * period <= points[-1][1]:
        target = k * period
        i = next(i for i, p in enumerate(points) if p[1] >= target)
        m, h, c = points[i]
        if h == target or i == 0:
            end, value = m, c
        else:
            pm, ph, pc = points[i - 1]
            share = (target - ph) / (h - ph)
            value, end = pc + share * (c - pc), pm + datetime.timedelta(days=int(share * (m - pm).days))
        out.append((k, end, value - before))
        before, k = value, k + 1
    return out


def test_against_per_well_walk(spark):
    rng = random.Random(5)
    wells = {}
    for w in range(12):
        wells[f"W{w}"] = [(month(i), rng.choice([0.0, 365.0, 730.0, 744.0, float(rng.randint(1, 760))]),
                           float(rng.randint(1, 900))) for i in range(30)]
    rows = [(w, m, h, g, 0.0, 0.0, 0.0) for w, series in wells.items() for m, h, g in series]
    df = spark.createDataFrame(rows, "WellID string, ProductionMonth date, Hours double, " + " double, ".join(MAIN) + " double")
    out = periods.normalize_periods(calendar.build_calendar(df)).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.WellID, r.NormalizedPeriod)):
        got.setdefault(r.WellID, []).append((r.NormalizedPeriod, r.PeriodEndDate, r.GasProduction))
    for w, series in wells.items():
        want = expected_periods(series)
        assert [x[:2] for x in got[w]] == [x[:2] for x in want]
        assert all(math.isclose(a[2], b[2], rel_tol=1e-9, abs_tol=1e-6) for a, b in zip(got[w], want))


def test_calendar_and_periods_share_one_shuffle(spark):
    plan = normalized(spark, three_months())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
