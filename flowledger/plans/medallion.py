"""Batch jobs from CSV to the calendar and normalized tables.

Each step writes a table and the next one reads it, so no step recomputes an earlier one.
Table names are `<namespace>.<dataset>_<layer>`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.calendar import BACKFILLED, build_calendar, check_cumulatives
from ..operators.changes import advance_history, audit_report, changes_since
from ..operators.clean import apply_schema, clean_dataset, drop_incomplete, parse_months
from ..operators.periods import normalize_periods
from ..operators.quality import merge_duplicates, no_issues, validate_merged
from ..schemas import (
    ISSUES, PRODUCTION_COLUMNS, WELL_CALENDAR, WELL_NORMALIZED, get_schema,
)
from ..sources.clustered import BUCKETS, write_clustered
from ..sources.files import read_csv
from ..sources.staging import stage
from ..sources.tables import LOAD_MONTH, load_changed_months, table_exists, write_table

# Dataset names and their table codes.
DATASETS = {"conventional": "vol", "ngl": "ngl"}


def _code(dataset: str) -> str:
    if dataset not in DATASETS:
        raise ValueError(f"Invalid dataset: {dataset}")
    return DATASETS[dataset]


def csv_to_bronze(spark: SparkSession, folder: str, dataset: str, namespace: str,
                  clip: Sequence[str] = tuple(PRODUCTION_COLUMNS)) -> DataFrame:
    """CSV folder -> `<dataset>_bronze`: typed measures, required fields present."""
    return raw_to_bronze(read_csv(spark, folder), dataset, namespace, clip)


def raw_to_bronze(raw: DataFrame, dataset: str, namespace: str,
                  clip: Sequence[str] = tuple(PRODUCTION_COLUMNS)) -> DataFrame:
    """Untyped rows from any reader (CSV folder, archives) -> `<dataset>_bronze`."""
    code = _code(dataset)
    schema = get_schema(code, "bronze")
    bronze = drop_incomplete(clean_dataset(raw, code, schema, clip), schema)
    return write_table(bronze, f"{namespace}.{dataset}_bronze")


def load_bronze_months(raw: DataFrame, dataset: str, namespace: str, start: str | None = None, end: str | None = None,
                       refresh: bool = True, clip: Sequence[str] = tuple(PRODUCTION_COLUMNS)) -> DataFrame:
    """Untyped rows -> the months of `<dataset>_bronze` that are missing or changed; returns these months."""
    code = _code(dataset)
    schema = get_schema(code, "bronze")
    bronze = drop_incomplete(clean_dataset(raw, code, schema, clip), schema)
    return load_changed_months(bronze, f"{namespace}.{dataset}_bronze", start, end, refresh=refresh)


def bronze_to_silver(spark: SparkSession, dataset: str, namespace: str, measures: Sequence[str] | None = None,
                     entity: str = "WellID", exact_scale: int | None = None) -> DataFrame:
    """`<dataset>_bronze` -> `<dataset>_silver` and `<dataset>_silver_quality_issues`.

    Rows carry DaysFromFirst, the days since the entity's first reported month. Measures are by default the
    production columns, or Volume for conventional data.

    The merged rows are stored once and both outputs are taken from that table. A table without
    the entity column is not validated; its issue table is empty. With `exact_scale`, the number of
    decimals reported, duplicate sums are the same bits on every run, so that row hashes of repeated
    loads differ only where the data does.
    """
    schema = get_schema(_code(dataset), "silver")
    if measures is None:
        measures = PRODUCTION_COLUMNS if dataset == "ngl" else ["Volume"]
    bronze = spark.table(f"{namespace}.{dataset}_bronze").drop(LOAD_MONTH)
    silver = drop_incomplete(apply_schema(parse_months(bronze), schema), schema)
    issues_name, silver_name = f"{namespace}.{dataset}_silver_quality_issues", f"{namespace}.{dataset}_silver"
    if entity not in silver.columns:
        write_table(no_issues(silver), issues_name)
        return write_table(_typed_month(silver), silver_name)
    # One row per entity and month, so a window over an entity is bounded by its years of history.
    first = F.min("ProductionMonth").over(Window.partitionBy(entity))
    months = merge_duplicates(silver, [entity, "ProductionMonth"], exact_scale)
    merged = write_table(months.withColumn("DaysFromFirst", F.datediff("ProductionMonth", first).cast("int")),
                         f"{namespace}.{dataset}_merged")
    clean, issues = validate_merged(merged, measures, entity)
    write_table(issues, issues_name, ISSUES)
    return write_table(_typed_month(clean), silver_name)


def record_load(spark: SparkSession, dataset: str, namespace: str, loaded_at: str,
                keys: Sequence[str] = ("WellID", "ProductionMonth")) -> DataFrame:
    """After bronze_to_silver: compare `<dataset>_silver` with the loads before it, and remember it.

    `<dataset>_silver_history` holds a hash and an interval of loads per version of a row, so the load
    before need not be kept; `<dataset>_audit` gets one JSON document per rule and per kind of change
    of this load (again if a load is recorded again). Returns the documents of this load.
    """
    keys, silver = list(keys), spark.table(f"{namespace}.{dataset}_silver")
    history_name, audit_name = f"{namespace}.{dataset}_silver_history", f"{namespace}.{dataset}_audit"
    at = F.lit(loaded_at).cast("timestamp")
    before = advance_history(None, silver.limit(0), keys, loaded_at)
    if table_exists(spark, history_name):
        # A load recorded twice is compared with the loads before it both times.
        kept = spark.table(history_name).where(F.col("ValidFrom") < at)
        before = kept.withColumn("ValidTo", F.when(F.col("ValidTo") < at, F.col("ValidTo")))
    changes = changes_since(before, silver, keys)
    issues = spark.table(f"{namespace}.{dataset}_silver_quality_issues")
    report = stage(audit_report(issues, changes).withColumn("LoadedAt", at))
    if table_exists(spark, audit_name):
        earlier = spark.table(audit_name).where(F.col("LoadedAt") != at)
        write_table(stage(earlier.unionByName(report)), audit_name)
    else:
        write_table(report, audit_name)
    write_table(stage(advance_history(before, silver, keys, loaded_at)), history_name)
    return report


def _typed_month(df: DataFrame) -> DataFrame:
    """Stored months are timestamps, as declared; the operators work on dates."""
    return df.withColumn("ProductionMonth", F.col("ProductionMonth").cast("timestamp"))


def silver_to_calendar(spark: SparkSession, namespace: str, dataset: str = "ngl", buckets: int = BUCKETS) -> DataFrame:
    """`<dataset>_silver` -> `<dataset>_calendar`, clustered by entity, and `<dataset>_calendar_quality_issues`."""
    staged = write_table(build_calendar(spark.table(f"{namespace}.{dataset}_silver")),
                         f"{namespace}.{dataset}_calendar_staged")
    clean, issues = check_cumulatives(staged)
    write_table(issues, f"{namespace}.{dataset}_calendar_quality_issues", ISSUES)
    return write_clustered(clean.drop(BACKFILLED), f"{namespace}.{dataset}_calendar", WELL_CALENDAR, buckets=buckets)


def calendar_to_normalized(spark: SparkSession, namespace: str, dataset: str = "ngl", buckets: int = BUCKETS) -> DataFrame:
    """`<dataset>_calendar` -> `<dataset>_normalized`; periods follow the calendar's buckets without a shuffle."""
    return write_clustered(normalize_periods(spark.table(f"{namespace}.{dataset}_calendar")),
                           f"{namespace}.{dataset}_normalized", WELL_NORMALIZED,
                           order=("NormalizedPeriod",), buckets=buckets)


def build_calendar_and_normalized(spark: SparkSession, namespace: str, dataset: str = "ngl") -> tuple[str, str]:
    """Build both tables, and the silver table first if it does not exist."""
    if not table_exists(spark, f"{namespace}.{dataset}_silver"):
        bronze_to_silver(spark, dataset, namespace)
    silver_to_calendar(spark, namespace, dataset)
    calendar_to_normalized(spark, namespace, dataset)
    return f"{namespace}.{dataset}_calendar", f"{namespace}.{dataset}_normalized"

