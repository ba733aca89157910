import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import declining, month

from flowledger.operators import decline, forecast, presentation
from flowledger.schemas import COMBINED, FORECAST_ROWS, FORECAST_SUMMARY, PRODUCTION_COLUMNS


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(declining()).withColumn("ProductionMonth", F.col("ProductionMonth").cast("date"))


@pytest.fixture(scope="module")
def fits(spark, history):
    rows = decline.fit_series(decline.stack_measures(history, PRODUCTION_COLUMNS))
    return spark.createDataFrame(rows.toPandas(), rows.schema)


def rate(f, day):
    years = (day - f.t_offset) / 365.25
    if f.CurveType == "exponential":
        return f.qi * math.exp(-f.di * years)
    if f.CurveType == "harmonic":
        return f.qi / (1 + f.di * years)
    return f.qi * (1 + f.b * f.di * years) ** (-1 / f.b)


@pytest.mark.parametrize("months", [1, 3, 6, 12, 30])
def test_points_follow_grid_and_curve(fits, months):
    points = forecast.forecast_points(fits, months).filter("WellID = 'W1' AND ProductionType = 'OilProduction'")
    rows = points.orderBy("Step").collect()
    fit = fits.filter("WellID = 'W1' AND ProductionType = 'OilProduction'").first()
    last = 30 * 23
    days = np.arange(last + 30, last + months * 30.44, 30.44).astype(int)
    assert [r.DaysFromFirst for r in rows] == list(days) and len(rows) == months
    for r in rows:
        assert r.Rate == pytest.approx(rate(fit, r.DaysFromFirst))
        date = month(0) + datetime.timedelta(days=r.DaysFromFirst)
        assert (r.ForecastDate, r.ProductionMonth) == (date, date.replace(day=1))


def test_summary(fits):
    out = forecast.forecast_summary(fits, "2024-05-01", 24)
    assert out.schema == FORECAST_SUMMARY or [f.name for f in out.schema] == [f.name for f in FORECAST_SUMMARY]
    row = out.filter("WellID = 'W2' AND ProductionType = 'GasProduction'").first()
    gas = [r["GasProduction"] for r in declining(("W2",))]
    assert row.DataPointsUsed == 24 and row.FitSuccess and row.ForecastDate == "2024-05-01"
    assert row.HistoricalAvgProduction == pytest.approx(sum(gas) / 24)
    assert row.HistoricalPeakProduction == max(gas) and row.HistoricalLastProduction == gas[-1]
    points = forecast.forecast_points(fits, 24).filter("WellID = 'W2' AND ProductionType = 'GasProduction' AND Step <= 12")
    assert row.ForecastCumulative12Month == pytest.approx(points.agg(F.sum("Rate")).first()[0])
    short = forecast.forecast_summary(fits, "2024-05-01", 3).filter("WellID = 'W2' AND ProductionType = 'GasProduction'").first()
    assert short.ForecastCumulative12Month == pytest.approx(points.filter("Step <= 3").agg(F.sum("Rate")).first()[0])


def test_rows_in_input_layout(fits, history):
    rows = forecast.forecast_rows(fits, history, 6)
    assert rows.columns == ["ProductionType", "Step", "ForecastDate", "DaysFromFirst", *[f.name for f in FORECAST_ROWS]]
    gas = rows.filter("ProductionType = 'GasProduction'").collect()
    assert len(gas) == 12
    for r in gas:
        assert r.GasProduction > 0 and r.OilProduction == r.WaterProduction == 0.0 and r.Hours == 720.0
        assert r.DataType == "Forecast" and r.ForecastMethod.startswith("ARPS_") and r.Field == f"Field_{r.WellID}"


def test_combined(fits, history):
    both = forecast.combine(history, forecast.forecast_rows(fits, history, 3), ["GasProduction"], ordered=True)
    assert both.columns == ["ProductionType", *[f.name for f in COMBINED]]
    rows = both.collect()
    assert {r.DataType for r in rows} == {"Historical", "Forecast"} and len(rows) == 2 * (24 + 3)
    assert rows == sorted(rows, key=lambda r: (r.WellID, r.ProductionMonth))
    old = next(r for r in rows if r.DataType == "Historical")
    assert old.ForecastMethod is None and old.ForecastRSquared is None


def test_unfitted_history_is_kept(fits, history):
    none = fits.filter("false")
    assert forecast.forecast_summary(none, "x").count() == 0
    rows = forecast.forecast_rows(none, history)
    own = ["ProductionType", "Step", "ForecastDate", "DaysFromFirst"]
    assert rows.count() == 0 and rows.columns == [*own, *[f.name for f in FORECAST_ROWS]]
    assert forecast.combine(history, rows).count() == 3 * 48


def summary(spark, *rows):
    out = [(w, t, c, r2, 10.0 * i, 0.1, 0.0, 1.0, 8) for i, (w, t, c, r2) in enumerate(rows)]
    return spark.createDataFrame(out, "WellID string, ProductionType string, CurveType string, RSquared double, "
                                 "InitialRate_qi double, DeclineRate_di double, DeclineExponent_b double, AIC double, DataPointsUsed int"
                                 ).withColumns({c: F.lit(month(0)) for c in ("HistoricalDataMinDate", "HistoricalDataMaxDate")})


def test_quality_figures(spark):
    s = summary(spark, ("a", "OilProduction", "exponential", 0.5), ("b", "OilProduction", "harmonic", 0.7),
                ("c", "GasProduction", "exponential", 0.9))
    q = forecast.fit_quality(s).first()
    assert (q.wells, q.exponential_wells, q.harmonic_wells, q.hyperbolic_wells) == (3, 2, 1, 0)
    assert q.avg_r2 == pytest.approx(0.7) and q.share_good == pytest.approx(2 / 3)


def test_histogram_matches_equal_width_bins(spark):
    rng = np.random.default_rng(4)
    r2 = rng.uniform(0.3, 1.0, 200)
    s = summary(spark, *[(f"w{i}", "OilProduction", "harmonic", float(v)) for i, v in enumerate(r2)])
    counts, _ = np.histogram(r2, bins=20)
    got = {r.bin: r.wells for r in forecast.r2_histogram(s).collect()}
    assert [got.get(i + 1, 0) for i in range(20)] == list(counts)
    one = summary(spark, ("a", "OilProduction", "harmonic", 0.5))
    assert [(r.bin, r.wells) for r in forecast.r2_histogram(one).collect()] == [(11, 1)]


def test_extension(spark):
    rows = [("a", "GasProduction", month(i, 2030), 10.0 - i) for i in range(9)] + [
        ("b", "GasProduction", month(11, 2030), 5.0), ("c", "GasProduction", month(0, 2030), 0.0)]
    df = spark.createDataFrame(rows, "WellID string, ProductionType string, ProductionMonth date, Rate double")
    out = presentation.extend_forecast(df)
    a = out.filter("WellID = 'a' AND Extended").orderBy("ProductionMonth").collect()
    assert [r.ProductionMonth for r in a] == [month(9, 2030), month(10, 2030), month(11, 2030)]
    assert [r.Rate for r in a] == pytest.approx([2.0 * (1 - 0.1 / 12) ** k for k in (1, 2, 3)])
    assert out.filter("WellID = 'b'").count() == 1
    assert {r.Rate for r in out.filter("WellID = 'c' AND Extended").collect()} == {0.01}


def test_running_total_continues(spark):
    rows = [("a", "GasProduction", "Historical", month(0), 1.0), ("a", "GasProduction", "Historical", month(1), 2.0),
            ("a", "GasProduction", "Forecast", month(1), 4.0), ("a", "GasProduction", "Forecast", month(2), None)]
    df = spark.createDataFrame(rows, "WellID string, ProductionType string, DataType string, ProductionMonth date, q double")
    out = presentation.running_total(df, "q").orderBy("q_Cumulative").collect()
    assert [r.q_Cumulative for r in out] == [1.0, 3.0, 7.0, 7.0]


def test_coverage_and_liquid(spark):
    s = summary(spark, ("a", "OilProduction", "exponential", 0.5), ("a", "GasProduction", "harmonic", 0.7),
                ("b", "CondensateProduction", "harmonic", 0.6), ("a", "CondensateProduction", "harmonic", 0.4),
                ("c", "GasProduction", "harmonic", 0.6))
    cover = {r.WellID: r for r in presentation.fluid_coverage(s).collect()}
    assert cover["a"].Fluids == "CondensateProduction,GasProduction,OilProduction"
    assert cover["a"].gas_RSquared == 0.7 and cover["b"].oil_RSquared is None and cover["b"].condensate_CurveType == "harmonic"
    assert {r.WellID: r.LiquidStream for r in presentation.liquid_stream(s).collect()} == {
        "a": "oil", "b": "condensate", "c": None}
    assert [r.WellID for r in presentation.entity_list(s, s.filter("WellID = 'b'")).collect()] == ["a", "b", "c"]
    assert presentation.one_entity(s, "a").count() == 3
