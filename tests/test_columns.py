import datetime

import pytest
from pyspark.sql import functions as F

from flowledger import schemas
from flowledger.functions import curves, measures, text


def values(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


@pytest.mark.parametrize("code, layer, width", [
    ("vol", "bronze", 30), ("ngl", "bronze", 26), ("vol", "silver", 30), ("ngl", "silver", 32),
    ("ngl_calendar", "silver", 32), ("ngl_normalized", "silver", 27)])
def test_schema_lookup(code, layer, width):
    assert len(schemas.get_schema(code, layer).fields) == width


def test_schema_lookup_rejects_unknown():
    with pytest.raises(ValueError, match="Unknown table type"):
        schemas.get_schema("other")
    with pytest.raises(ValueError, match="Unknown layer"):
        schemas.get_schema("ngl_normalized", "bronze")


def test_output_schemas():
    assert len(schemas.FORECAST_SUMMARY.fields) == 19
    assert len(schemas.FORECAST_ROWS.fields) == 29
    assert len(schemas.COMBINED.fields) == 30
    assert schemas.required_columns(schemas.WELL_RAW) == [
        "ReportingFacilityID", "OperatorBAID", "ProductionMonth", "WellID"]
    assert schemas.required_columns(schemas.FACILITY_RAW) == ["ProductionMonth", "OperatorBAID", "ReportingFacilityID"]


def test_conform_casts_and_adds(spark):
    df = spark.createDataFrame([("W", 3)], "WellID string, DaysFromFirst long").withColumn("extra", F.lit(1))
    out = schemas.conform(df, schemas.WELL_CALENDAR)
    assert out.columns == [f.name for f in schemas.WELL_CALENDAR.fields]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schemas.WELL_CALENDAR.fields]


def test_text_cleaning(spark):
    df = spark.createDataFrame(
        [("1,234.5",), ("***",), ("(5)",), ("1e3",), ("1-2",), ("-",), ("",), (None,), (" $7 ",)], "s string")
    assert values(df, text.numeric_text("s")) == [(v,) for v in (1234.5, None, 5.0, 13.0, None, None, None, None, 7.0)]
    assert values(df, text.integer_text("s"))[:3] == [(12345,), (None,), (5,)]
    assert values(df, text.number_or_zero("s"))[3:5] == [(1000.0,), (0.0,)]


def test_month_text(spark):
    df = spark.createDataFrame([("2024-03",), ("2024-03-17",), ("",), ("n/a",), (None,), ("2024-13",)], "s string")
    first = datetime.date(2024, 3, 1)
    assert values(df, text.month_text("s")) == [(first,), (first,), (None,), (None,), (None,), (None,)]


def test_gas_equivalent_known_total(spark):
    row = {"EthaneMixVolume": 10.0, "PropaneMixVolume": 5.0, "ButaneMixVolume": 2.0, "PentaneMixVolume": 1.0,
           "LiteMixVolume": 0.5, "PentaneSpecVolume": None, "OilProduction": 4.0, "CondensateProduction": None,
           "GasProduction": 11.0}
    schema = ", ".join(f"{k} double" for k in row)
    out = measures.add_derived_measures(spark.createDataFrame([tuple(row.values())], schema)).first()
    assert (out.ethane_gas_equiv, out.propane_gas_equiv, out.total_gas_equiv) == (3840.0, 1175.0, 5557.0)
    assert out.total_liquids == 5.5 and out.gas_liquids_ratio == 2.0 and out.aer_compliant


def test_null_volumes_count_as_zero(spark):
    schema = ("EthaneMixVolume double, PropaneMixVolume double, ButaneMixVolume double, PentaneMixVolume double, "
              "LiteMixVolume double, PentaneSpecVolume double, OilProduction double, CondensateProduction double, GasProduction double")
    rows = [(None, 5.0, None, 1.0, None, None, None, None, 3.0), (10.0, None, None, 2.0, 1.0, 0.0, 0.0, 0.0, None)]
    out = measures.add_derived_measures(spark.createDataFrame(rows, schema)).collect()
    assert out[0].total_gas_equiv == 5 * 235.0 + 130.0
    assert out[1].total_gas_equiv == 10 * 384.0 + 2 * 130.0 + 200.0
    none = measures.add_derived_measures(spark.createDataFrame([(None,) * 9], schema)).first()
    assert none.gas_liquids_ratio is None and none.total_liquids == 0.0


@pytest.mark.parametrize("gas, liquids, ok", [
    (50_000, 100, True), (2_000_000, 100, False), (50_000, 15_000, False), (-100, 50, False), (0, 0, True)])
def test_compliance(spark, gas, liquids, ok):
    df = spark.createDataFrame([(float(gas), float(liquids))], "g double, l double")
    assert values(df, measures.compliant(F.col("g"), F.col("l"))) == [(ok,)]


def test_units(spark):
    df = spark.createDataFrame([(1000.0, 1.0, "x")], "GasProduction double, OilProduction double, other string")
    out = measures.to_imperial(df).first()
    assert out.GasProduction == pytest.approx(35.315, abs=1e-3) and out.OilProduction == pytest.approx(6.28981)
    assert out.other == "x"


def test_hours_in_month(spark):
    df = spark.createDataFrame([(datetime.date(2024, 2, 1),), (datetime.date(2023, 2, 1),)], "m date")
    assert values(df, measures.hours_in_month("m")) == [(696.0,), (672.0,)]


def test_curves_start_at_qi_and_fall(spark):
    df = spark.createDataFrame([(0,), (365,), (730,)], "t int")
    t, qi, di, b = F.col("t"), F.lit(100.0), F.lit(0.1), F.lit(0.5)
    for curve in (curves.exponential(t, qi, di), curves.hyperbolic(t, qi, di, b), curves.harmonic(t, qi, di)):
        a, m, z = (v[0] for v in values(df, curve))
        assert a == 100.0 and a > m > z


def test_fit_measures(spark):
    df = spark.createDataFrame([(40.0, 0.0), (40.0, 40.0), (0.0, 0.0)], "total double, residual double")
    assert values(df, curves.r_squared(F.col("residual"), F.col("total"))) == [(1.0,), (0.0,), (0.0,)]
    good, bad = values(spark.createDataFrame([(0.01,), (8.0,)], "mse double"), curves.aic(F.lit(5), F.col("mse"), 2))
    assert good[0] < bad[0]
