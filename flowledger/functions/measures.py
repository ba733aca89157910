"""Derived measures of a well-month row."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Gas-equivalent factor per m3 of each component, and unit factors.
GAS_EQUIVALENT = {
    "ethane": ("EthaneMixVolume", 384.0),
    "propane": ("PropaneMixVolume", 235.0),
    "butane": ("ButaneMixVolume", 156.0),
    "pentane": ("PentaneMixVolume", 130.0),
    "lite": ("LiteMixVolume", 200.0),
}
M3_TO_BBL = 6.28981
M3_TO_MCF = 0.035315
MAX_GAS_EQUIVALENT = 1_000_000.0
MAX_LIQUIDS = 10_000.0

IMPERIAL = {
    "GasProduction": M3_TO_MCF, "OilProduction": M3_TO_BBL, "CondensateProduction": M3_TO_BBL,
    "GasProduction_Cumulative": M3_TO_MCF, "OilProduction_Cumulative": M3_TO_BBL,
    "CondensateProduction_Cumulative": M3_TO_BBL,
    "GasProductionCumulative": M3_TO_MCF, "OilProductionCumulative": M3_TO_BBL, "CondensateProductionCumulative": M3_TO_BBL,
}


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def gas_equivalents() -> dict[str, Column]:
    parts = {f"{name}_gas_equiv": zero_if_null(column) * F.lit(factor)
             for name, (column, factor) in GAS_EQUIVALENT.items()}
    return {**parts, "total_gas_equiv": reduce(add, parts.values())}


def liquids() -> dict[str, Column]:
    parts = {
        "c5_liquids": zero_if_null("PentaneMixVolume") + zero_if_null("PentaneSpecVolume"),
        "oil_liquids": zero_if_null("OilProduction"),
        "condensate_liquids": zero_if_null("CondensateProduction"),
        "lite_liquids": zero_if_null("LiteMixVolume"),
    }
    return {**parts, "total_liquids": reduce(add, parts.values())}


def gas_liquids_ratio(total_liquids: Column) -> Column:
    return F.when(total_liquids > 0, zero_if_null("GasProduction") / total_liquids)


def compliant(gas_equivalent: Column, total_liquids: Column) -> Column:
    return gas_equivalent.between(0.0, MAX_GAS_EQUIVALENT) & total_liquids.between(0.0, MAX_LIQUIDS)


def add_derived_measures(df: DataFrame) -> DataFrame:
    """Gas equivalents, liquids, their ratio and the range check, in one projection each level."""
    return df.withColumns({**gas_equivalents(), **liquids()}).withColumns({
        "gas_liquids_ratio": gas_liquids_ratio(F.col("total_liquids")),
        "aer_compliant": compliant(F.col("total_gas_equiv"), F.col("total_liquids")),
    })


def hours_in_month(month: Column | str) -> Column:
    return F.dayofmonth(F.last_day(month)) * F.lit(24.0)


def to_imperial(df: DataFrame) -> DataFrame:
    """Gas to Mcf, oil and condensate to bbl; only for the columns that are present."""
    return df.withColumns({c: F.col(c) * F.lit(k) for c, k in IMPERIAL.items() if c in df.columns})
