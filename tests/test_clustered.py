"""Tables laid out by entity: few files for one entity, none too large for a hot one."""

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowledger.operators.presentation import entities, one_entity
from flowledger.sources.clustered import write_clustered


def rows(spark, n=60_000, hot=0.5):
    return spark.range(n, numPartitions=8).select(
        F.when(F.col("id") < n * hot, "W1").otherwise(F.concat(F.lit("V"), F.col("id") % 900)).alias("WellID"),
        F.when(F.col("id") < n * hot, F.lit(datetime.date(2020, 1, 1))).otherwise(
            F.add_months(F.lit(datetime.date(2000, 1, 1)), (F.col("id") / 900).cast("int"))).alias("ProductionMonth"))


def files_read(spark, df):
    """One task per file that the scan opens."""
    confs = {"spark.sql.files.openCostInBytes": str(128 << 20), "spark.sql.files.minPartitionNum": "1"}
    for key, value in confs.items():
        spark.conf.set(key, value)
    try:
        return df.rdd.getNumPartitions()
    finally:
        for key in confs:
            spark.conf.unset(key)


def test_one_entity_opens_few_files(spark, namespace):
    table = write_clustered(rows(spark, hot=0), f"{namespace}.t")
    found = one_entity(table, "V7")
    assert files_read(spark, table) == len(table.inputFiles()) >= 64
    assert files_read(spark, found) / len(table.inputFiles()) < 0.05
    assert found.count() == rows(spark, hot=0).where("WellID = 'V7'").count() > 0
    three = entities(table, ["V1", "V2", "V3"])
    assert files_read(spark, three) <= 6 and three.count() > 2 * found.count()


def test_hot_entity_is_cut(spark, namespace):
    # Small parts are put together again by size, which would hide the cut here.
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        table = write_clustered(rows(spark), f"{namespace}.t")
    finally:
        spark.conf.unset(key)
    sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 0.2 * 60_000


def test_windows_need_no_shuffle(spark, namespace):
    table = write_clustered(rows(spark, hot=0), f"{namespace}.t", buckets=8)
    plan = table.select(F.count("*").over(Window.partitionBy("WellID")))._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]


def test_odd_tables(spark, namespace):
    empty = write_clustered(rows(spark, n=0), f"{namespace}.empty")
    assert empty.count() == 0 and empty.columns == ["WellID", "ProductionMonth"]
    nulls = spark.createDataFrame([(None, None), ("A", None), ("A", None)], "WellID string, ProductionMonth date")
    table = write_clustered(nulls, f"{namespace}.nulls")
    assert sorted(r.WellID or "" for r in table.collect()) == ["", "A", "A"] and one_entity(table, "A").count() == 2
