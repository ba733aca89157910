"""Catalog tables: existence, loaded months, month plan, writers."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import month_text
from ..schemas import conform
from .staging import stage


def table_exists(spark: SparkSession, name: str) -> bool:
    """True for tables and temporary views; a missing database counts as no table."""
    return spark.catalog.tableExists(name)


def existing_months(spark: SparkSession, table: str, month: str = "ProductionMonth") -> DataFrame:
    """Distinct months (dates) of a table; empty if the table is missing."""
    if not table_exists(spark, table):
        return spark.createDataFrame([], "Month date")
    return loaded_months(spark.table(table), month)


def loaded_months(df: DataFrame, month: str = "ProductionMonth") -> DataFrame:
    return df.select(month_text(F.col(month).cast("string")).alias("Month")).filter("Month is not null").distinct()


def month_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Months from start to end inclusive, given and labelled as yyyy-MM."""
    first, last = (F.lit(f"{m}-01").cast("date") for m in (start, end))
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return (spark.range(1).select(F.explode(months).alias("Month"))
            .select("Month", F.date_format("Month", "yyyy-MM").alias("Label")))


def missing_months(wanted: DataFrame, loaded: DataFrame) -> DataFrame:
    return wanted.join(loaded, "Month", "left_anti")


def write_table(df: DataFrame, name: str, schema: StructType | None = None,
                partition_by: str | None = None) -> DataFrame:
    """Overwrite a table, in the declared schema if one is given, and read it back.

    What follows works on the stored rows: nothing is recomputed, and a lost executor costs a
    re-read. Empty and non-empty results have the same columns.
    """
    out = conform(df, schema) if schema is not None else df
    writer = out.write.mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


LOAD_MONTH, UNKNOWN = "LoadMonth", "unknown"


def _digests(df: DataFrame) -> DataFrame:
    """Per load month: number of rows and two sums of row hashes, whatever the order of rows."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns) if c != LOAD_MONTH]
    sums = {f"Digest{lane}": F.xxhash64(F.lit(lane), *columns).cast("decimal(38,0)") for lane in (1, 2)}
    return df.groupBy(LOAD_MONTH).agg(F.count("*").alias("Rows"), *[F.sum(c).alias(n) for n, c in sums.items()])


def _write_partitions(df: DataFrame, name: str) -> None:
    """Write over the partitions that df has rows for; a table insert takes the mode from the session only."""
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(name)
    finally:
        conf.set(key, before)


def load_changed_months(df: DataFrame, name: str, start: str | None = None, end: str | None = None,
                        month: str = "ProductionMonth", refresh: bool = True) -> DataFrame:
    """Bring the months of df that a table lacks, or that differ from it, into the table; returns them.

    The table is partitioned by LoadMonth (yyyy-MM; "unknown" for rows without a readable month) and only the
    partitions of those months are written over; all others keep their files. `start` and `end` limit the load to
    a plan of months. With refresh=False months that the table has are left as they are. What the table holds is
    known from `<name>_months`, one row per month, so the table is not read; that table is written last, and
    a load that broke off is simply repeated. A month that df lacks stays.
    """
    spark = df.sparkSession
    label = F.date_format(month_text(F.col(month).cast("string")), "yyyy-MM")
    rows = df.withColumn(LOAD_MONTH, F.coalesce(label, F.lit(UNKNOWN)))
    if start and end:
        wanted = month_range(spark, start, end).select(F.col("Label").alias(LOAD_MONTH))
        rows = rows.join(F.broadcast(wanted), LOAD_MONTH, "left_semi")  # one row per month of the plan
    rows = rows.select(*df.columns, LOAD_MONTH)
    state = f"{name}_months"
    digests = _digests(rows)
    if not table_exists(spark, name) or not table_exists(spark, state):
        write_table(rows, name, partition_by=LOAD_MONTH)
        return write_table(digests, state).select(LOAD_MONTH)
    if spark.table(name).columns != rows.columns:
        raise ValueError(f"{name} has other columns than the load")
    known = spark.table(state)
    changed = stage(digests.join(known, LOAD_MONTH if not refresh else [LOAD_MONTH, "Rows", "Digest1", "Digest2"], "left_anti"))
    # One row per month.
    part = rows.join(F.broadcast(changed.select(LOAD_MONTH)), LOAD_MONTH, "left_semi").select(rows.columns)
    if not changed.isEmpty():
        _write_partitions(part, name)
        write_table(stage(known.join(changed, LOAD_MONTH, "left_anti").unionByName(changed)), state)
    return changed.select(LOAD_MONTH)


def build_if_missing(spark: SparkSession, name: str, build: Callable[[], object]) -> DataFrame:
    if not table_exists(spark, name):
        build()
    return spark.table(name)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make results reachable from spark.sql under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def measure_views(spark: SparkSession, kind: str, table: DataFrame, measures: list[str]) -> list[str]:
    """Per-measure views `<measure>_<kind>` over one table with a ProductionType column."""
    names = []
    for m in measures:
        name = f"{m.lower()}_{kind}"
        table.filter(F.col("ProductionType") == m).createOrReplaceTempView(name)
        names.append(name)
    return names
