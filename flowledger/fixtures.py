"""Maps the star-schema test tables onto the production model.

Supplier = well, nation = operator, region = field, ship month = production month. Every table
grows with lineitem; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.quality import merge_duplicates

EXACT_SCALE = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def well_id(number: str) -> Column:
    digits = F.col(number).cast("string")
    return F.concat(F.lit("W"), F.lpad(digits, F.greatest(F.length(digits), F.lit(12)), F.lit("0"))).alias("WellID")


def well_number() -> Column:
    return F.substr(F.col("WellID"), F.lit(2)).cast("long")


def _numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("number"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("ProductionMonth"),
        F.col("l_returnflag").alias("Pool"), F.col("l_linestatus").alias("Area"),
        (q * 4).alias("Hours"), F.col("l_extendedprice").alias("GasProduction"), q.alias("OilProduction"),
        (q * (F.col("l_discount") - 0.02)).alias("CondensateProduction"),
        (q * F.col("l_tax")).alias("WaterProduction"), (q * F.col("l_discount")).alias("EthaneMixVolume"),
        F.when(F.col("l_linenumber") != 5, q * 0.1).alias("PropaneMixVolume"),
        (q * 0.05).alias("ButaneMixVolume"), (q * 0.02).alias("PentaneMixVolume"),
        (q * 0.01).alias("PentaneSpecVolume"), (q * 0.03).alias("LiteMixVolume"),
    )


def well_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows, many per well-month, without the well's own attributes."""
    lines = _numbered_lines(spark, sf_dir)
    return lines.select(well_id("number"), *[c for c in lines.columns if c != "number"])


def well_line_injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with negative and zero hours set for some wells in one month each."""
    tens = F.pmod(well_number(), F.lit(10))
    month = F.col("ProductionMonth")
    hours = (F.when((tens == 3) & (month == F.lit("1996-01-01").cast("date")), -1.0)
             .when((tens == 4) & (month == F.lit("1996-02-01").cast("date")), 0.0)
             .otherwise(F.col("Hours")))
    return well_line(spark, sf_dir).withColumn("Hours", hours)


def well_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            well_id("s_suppkey"),
            F.concat(F.lit("F"), F.col("s_nationkey").cast("string")).alias("ReportingFacilityID"),
            F.col("s_name").alias("ReportingFacilityName"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("OperatorBAID"),
            F.col("n_name").alias("OperatorName"),
            F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("WellLicenseNumber"),
            F.col("r_name").alias("Field"))
    )


def well_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged well-months with attributes; merging first keeps the join small and free of hot keys."""
    merged = merge_duplicates(_numbered_lines(spark, sf_dir), ["number", "ProductionMonth"], EXACT_SCALE)
    months = merged.select(well_id("number"), *[c for c in merged.columns if c != "number"])
    return months.join(well_attributes(spark, sf_dir), "WellID")


def well_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as dirty text, for the cleaning operators."""
    v = F.col("l_extendedprice").cast("string")
    d = F.substring(F.col("l_shipdate").cast("string"), 1, 7)
    line = F.col("l_linenumber")
    gas = (F.when(line == 1, F.concat(F.substring(v, 1, 2), F.lit(","), F.substr(v, F.lit(3))))
           .when(line == 2, "***").when(line == 3, F.concat(F.lit("("), v, F.lit(")")))
           .when(line == 4, F.concat(F.lit(" $"), v, F.lit(" "))).when(line == 5, F.concat(v, F.lit("-1")))
           .when(line == 6, "").otherwise(v))
    month = (F.when(line == 1, F.concat(d, F.lit("-01"))).when(line == 2, "").when(line == 3, "n/a")
             .when(line == 4, F.lit(None)).otherwise(d))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", gas.alias("GasProduction"),
        F.concat(F.lit(" "), "l_returnflag", F.lit("  ")).alias("Pool"),
        F.concat(F.lit("#"), F.col("l_partkey").cast("string"), F.lit(".")).alias("Sequence"),
        month.alias("ProductionMonth"))


def decline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-months whose gas and oil follow a known decline; condensate stays as reported.

    One well in ten stops producing after half a year (its rows stay, with zero volumes), so that
    every outcome of the fit occurs.
    """
    k, t = well_number(), F.datediff("ProductionMonth", F.lit("1995-01-01").cast("date"))
    di = F.pmod(k, F.lit(6)) * F.lit(0.1)
    years = t / F.lit(365.25)
    stopped = (F.pmod(k, F.lit(10)) == 9) & (t > 180)

    def trend(shift: int) -> Column:
        kind = F.pmod(k + shift, F.lit(3))
        return (F.when(kind == 0, F.exp(-di * years)).when(kind == 1, 1.0 / (1.0 + di * years))
                .otherwise(F.pow(1.0 + 0.5 * di * years, F.lit(-2.0))))

    def volume(c: Column) -> Column:
        return F.when(stopped, 0.0).otherwise(c)

    return well_month(spark, sf_dir).withColumns({
        "DaysFromFirst": t,
        "GasProduction": volume(F.col("GasProduction") / 1000.0 * trend(0)),
        "OilProduction": volume(F.col("OilProduction") * trend(1)),
        "CondensateProduction": volume(F.col("CondensateProduction")),
    }).drop("LineCount")
