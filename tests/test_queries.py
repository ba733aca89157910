"""Every registered query against its SQL, on the smallest tables and on a heavily skewed copy."""

import glob
import os

import pytest
from parity import connect, difference
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from flowledger.plans.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables with a third of all lineitem rows moved to one supplier."""
    folder = tmp_path_factory.mktemp("skewed")
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path)
        df = spark.read.parquet(path)
        if name == "lineitem.parquet":
            df = df.withColumn("l_suppkey", F.when(F.pmod(F.col("l_orderkey"), F.lit(3)) == 0, 7).otherwise(F.col("l_suppkey")))
            df = df.withColumn("l_suppkey", F.col("l_suppkey").cast("long"))
        df.toPandas().to_parquet(folder / name) if name != "lineitem.parquet" else df.toPandas().astype(
            {"l_shipdate": "datetime64[us]"}).to_parquet(folder / name)
    return str(folder)


def check(spark, name, folder):
    got = QUERIES[name](spark, folder).toPandas()
    want = connect(folder).execute(ORACLES[name]).df()
    assert difference(got, want) is None


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    check(spark, name, SMALL)


@pytest.mark.parametrize("name", [
    "numeric_text_clean", "merge_duplicates", "days_from_first", "min_history", "include_exclude", "silver_issues", "silver_clean",
    "calendar_cumulative", "normalized_periods", "loglinear_fit", "combined", "row_hash_changes", "audit_report",
    "numeric_profile", "measure_summary"])
def test_query_on_skewed_rows(spark, skewed, name):
    check(spark, name, skewed)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "HoursCumulative" in df.columns
