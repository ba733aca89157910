"""Declared table schemas, schema lookup and conformance.

Column names and required flags are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DoubleType, IntegerType, StringType, StructField, StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(), "double": DoubleType(), "int": IntegerType(),
    "timestamp": TimestampType(), "boolean": BooleanType(),
}


def _struct(*groups: tuple[str, str]) -> StructType:
    """Build a StructType from (type, "names...") groups; a trailing ! means required."""
    fields = []
    for type_name, names in groups:
        for name in names.split():
            fields.append(StructField(name.rstrip("!"), _TYPES[type_name], not name.endswith("!")))
    return StructType(fields)


# Measure columns of a well-month row, in table order.
VOLUMES = (
    "GasProduction OilProduction CondensateProduction WaterProduction ResidueGasVolume Energy "
    "EthaneMixVolume EthaneSpecVolume PropaneMixVolume PropaneSpecVolume ButaneMixVolume "
    "ButaneSpecVolume PentaneMixVolume PentaneSpecVolume LiteMixVolume"
)
MAIN_VOLUMES = ["GasProduction", "OilProduction", "CondensateProduction", "WaterProduction"]
PRODUCTION_COLUMNS = ["OilProduction", "GasProduction", "CondensateProduction"]
WELL_METADATA = [
    "ReportingFacilityID", "ReportingFacilityName", "OperatorBAID", "OperatorName",
    "WellLicenseNumber", "Field", "Pool", "Area",
]

_FACILITY_MIDDLE = (
    "OperatorName ReportingFacilityID! ReportingFacilityProvinceState ReportingFacilityType "
    "ReportingFacilityIdentifier ReportingFacilityName ReportingFacilitySubType "
    "ReportingFacilitySubTypeDesc ReportingFacilityLocation FacilityLegalSubdivision "
    "FacilitySection FacilityTownship FacilityRange FacilityMeridian"
)
_FACILITY_MOVEMENT = (
    "ActivityID ProductID FromToID FromToIDProvinceState FromToIDType FromToIDIdentifier"
)


def _facility(month_type: str) -> StructType:
    return _struct(
        (month_type, "ProductionMonth!"), ("string", "OperatorBAID! " + _FACILITY_MIDDLE),
        (month_type, "SubmissionDate"), ("string", _FACILITY_MOVEMENT),
        ("double", "Volume Energy Hours"), ("string", "CCICode ProrationProduct"),
        ("double", "ProrationFactor Heat"),
    )


def _well_month(month_type: str) -> tuple[tuple[str, str], ...]:
    return (
        ("string", "ReportingFacilityID! ReportingFacilityName OperatorBAID! OperatorName"),
        (month_type, "ProductionMonth!"),
        ("string", "WellID! WellLicenseNumber Field Pool Area"),
        ("double", "Hours " + VOLUMES),
    )


FACILITY_RAW = _facility("string")
FACILITY_TYPED = _facility("timestamp")
WELL_RAW = _struct(*_well_month("string"))
WELL_CALENDAR = _struct(
    *_well_month("timestamp"),
    ("double", " ".join(m + "Cumulative" for m in MAIN_VOLUMES) + " HoursCumulative"),
    ("int", "DaysFromFirst"),
)
WELL_NORMALIZED = _struct(
    ("string", "ReportingFacilityID! ReportingFacilityName OperatorBAID! OperatorName WellID! "
               "WellLicenseNumber Field Pool Area"),
    ("int", "NormalizedPeriod!"), ("timestamp", "PeriodStartDate PeriodEndDate"),
    ("double", "HoursInPeriod!"), ("double", " ".join(MAIN_VOLUMES)),
    ("double", " ".join(m + "DailyRate" for m in MAIN_VOLUMES)),
    ("double", " ".join(m + "Cumulative" for m in MAIN_VOLUMES) + " HoursCumulative"),
    ("int", "DaysFromFirstProducing"),
)
ISSUES = _struct(
    ("string", "WellID"), ("timestamp", "ProductionMonth"),
    ("string", "Rule Severity Field OriginalValue CorrectedValue Note"),
)
FORECAST_SUMMARY = _struct(
    ("string", "WellID ProductionType ForecastDate CurveType"), ("double", "RSquared"),
    ("boolean", "FitSuccess"), ("double", "InitialRate_qi DeclineRate_di DeclineExponent_b"),
    ("timestamp", "HistoricalDataMinDate HistoricalDataMaxDate"), ("int", "DataPointsUsed"),
    ("double", "HistoricalAvgProduction HistoricalPeakProduction HistoricalLastProduction"),
    ("timestamp", "ForecastStartDate"), ("double", "ForecastCumulative12Month AIC"),
    ("string", "FitError"),
)
_FORECAST_HEAD = (
    ("string", "WellID"), ("timestamp", "ProductionMonth"),
    ("double", "OilProduction GasProduction CondensateProduction " + VOLUMES.split(" ", 3)[3]),
    ("string", " ".join(WELL_METADATA)), ("double", "Hours"),
)
_FORECAST_TAIL = (("string", "DataType ForecastMethod"), ("double", "ForecastRSquared"))
FORECAST_ROWS = _struct(*_FORECAST_HEAD, *_FORECAST_TAIL)
COMBINED = _struct(*_FORECAST_HEAD, ("int", "DaysFromFirst"), *_FORECAST_TAIL)

_REGISTRY = {
    ("vol", "bronze"): FACILITY_RAW,
    ("vol", "silver"): FACILITY_TYPED,
    ("ngl", "bronze"): WELL_RAW,
    ("ngl", "silver"): WELL_CALENDAR,
    ("ngl_calendar", "silver"): WELL_CALENDAR,
    ("ngl_normalized", "silver"): WELL_NORMALIZED,
}


def get_schema(table_code: str, layer: str = "bronze") -> StructType:
    if table_code not in {code for code, _ in _REGISTRY}:
        raise ValueError(f"Unknown table type: {table_code}")
    try:
        return _REGISTRY[table_code, layer]
    except KeyError:
        raise ValueError(f"Unknown layer: {layer}") from None


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def columns_of_type(df: DataFrame, data_type: type[DataType], exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, data_type) and f.name not in exclude]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly the declared columns, cast to the declared types; absent ones become null."""
    present = set(df.columns)

    def one(field: StructField) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select([one(f) for f in schema.fields])
