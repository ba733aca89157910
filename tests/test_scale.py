"""Rules that matter at scale: exact quartiles without sorting, split hot keys, hashes and readers that keep rows apart."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowledger.operators import calendar as C
from flowledger.operators import changes as H
from flowledger.operators import clean as P
from flowledger.operators import profile as R
from flowledger.operators.quality import merge_duplicates
from flowledger.operators.spread import PARTS, hot_keys, spread_join
from flowledger.sources.files import read_csv


@pytest.mark.parametrize("settled", [R.SETTLED, 10])
def test_quartiles_of_any_distribution(spark, monkeypatch, settled):
    monkeypatch.setattr(R, "SETTLED", settled)
    random.seed(4)
    data = {
        "heavy": [math.exp(random.gauss(0, 10)) for _ in range(3000)],
        "equal": [7.5] * 3000,
        "signed": [random.choice([-0.0, 0.0, -1e300, 1e-300, 5.0, -3.25]) for _ in range(3000)],
        "normal": [random.gauss(1e9, 1e-3) for _ in range(3000)],
        "halves": [1.0] * 1500 + [2.0] * 1500,
        "ends": [random.choice([-math.inf, math.inf, 1.0]) for _ in range(3000)],
        "tiny": [random.uniform(-5e-324, 1e-307) for _ in range(3000)],
    }
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data))
    got = {r["Column"]: r for r in R.numeric_profile(df).collect()}
    for c, v in data.items():
        order = np.sort(np.array(v) + 0.0)
        for k, p in ((25, 0.25), (50, 0.5), (75, 0.75)):
            a, b = order[math.floor(p * 2999)], order[math.ceil(p * 2999)]
            want = a if a == b else a + (b - a) * (p * 2999 - math.floor(p * 2999))
            assert got[c][f"q{k}"] == want or math.isclose(got[c][f"q{k}"], want, rel_tol=1e-12), (c, k)
        assert got[c]["count"] == 3000


def test_quartiles_beside_nan_and_null(spark):
    rows = [(float(i), None, float("nan")) for i in range(10)] + [(float("nan"), None, None)] * 10 + [(None, None, 1.0)]
    got = {r["Column"]: r for r in R.numeric_profile(spark.createDataFrame(rows, "x double, y double, z double")).collect()}
    assert set(got) == {"x", "z"} and got["x"]["count"] == 20
    assert (got["x"]["q25"], got["x"]["min"]) == (4.75, 0.0) and math.isnan(got["x"]["q75"]) and math.isnan(got["x"]["max"])
    assert got["z"]["min"] == 1.0 and math.isnan(got["z"]["q25"])
    assert R.numeric_profile(spark.range(0)).count() == 0


def test_quartiles_where_the_sketch_misses(spark, monkeypatch):
    monkeypatch.setattr(R, "SKETCH", 8)
    monkeypatch.setattr(R, "MARGIN", 0.0)
    values = [float((i * 7919) % 100_003) for i in range(100_003)]
    got = R.numeric_profile(spark.createDataFrame([(v,) for v in values], "x double").repartition(8)).first()
    assert (got["q25"], got["q50"], got["q75"]) == (25000.5, 50001.0, 75001.5)


def hot(spark):
    rows = spark.range(60_000, numPartitions=16)
    well = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("w"), (F.col("id") % 500).cast("string")))
    return rows.select(well.alias("WellID"), F.expr("date_add(DATE'2020-01-01', int(id % 700))").alias("ProductionMonth"), "id")


@pytest.mark.parametrize("name", ["min_history", "include", "exclude", "days", "bare_min_history", "bare_include", "null"])
def test_hot_key_is_split(spark, name):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("-1", "64", "false")):
        spark.conf.set(k, v)
    try:
        df = hot(spark)
        if name.startswith("bare"):
            df, name = df.select("WellID"), name.removeprefix("bare_")
        if name == "null":
            df = df.withColumn("WellID", F.when(F.col("WellID") != "hot", F.col("WellID")))
        some = df.where("WellID != 'w3'").select("WellID")
        out = {
            "min_history": lambda: P.with_min_history(df, 10),
            "include": lambda: P.select_entities(df, include=some),
            "exclude": lambda: P.select_entities(df, exclude=df.where("WellID = 'w3'").select("WellID")),
            "days": lambda: C.add_days_from_first(df),
            "null": lambda: spread_join(df, some.distinct().withColumn("x", F.lit(1)), "WellID", "left"),
        }[name]()
        parts = Counter()
        for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect():
            parts[r["p"]] += r["count"]
        assert max(parts.values()) <= 0.15 * sum(parts.values())
        assert sum(parts.values()) == 60_000 - (name in ("include", "exclude")) * df.where("WellID = 'w3'").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_spread_join_equals_join(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    keys = spark.createDataFrame([("a", 10), ("c", 30)], "k string, w int")
    for how in ("inner", "left_semi", "left_anti", "left"):
        got = sorted(map(str, spread_join(rows, keys, "k", how).select(*rows.columns).collect()))
        assert got == sorted(map(str, rows.join(keys, "k", how).select(*rows.columns).collect())), how
    assert PARTS > 1


def test_hot_keys_are_found_by_share(spark):
    rows = spark.range(100_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "third").when(F.col("id") % 25 == 1, "more").when(F.col("id") % 100 == 2, "hundredth")
        .otherwise(F.col("id").cast("string")).alias("k"))
    assert {r.k for r in hot_keys(rows, "k").collect()} == {"third", "more"}
    assert hot_keys(rows.limit(0), "k").count() == 0 and hot_keys(rows.select(F.lit(None).cast("int").alias("k")), "k").count() == 0
    assert hot_keys(spark.range(1000), "id").count() == 0


def test_only_hot_keys_are_copied(spark):
    rows = hot(spark).select("WellID")
    per_key = rows.distinct()
    plan = spread_join(rows, per_key, "WellID")._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k" in plan.lower() or "ApproxTopK" in plan
    joined = spread_join(rows, per_key.withColumn("x", F.lit(1)), "WellID", "full_outer")
    # Of 32 copies of the hot key all but those its rows meet stay alone; other keys have none.
    alone = joined.join(rows.groupBy("WellID").count(), "WellID").groupBy("WellID").agg(F.count("*").alias("n"), F.max("count").alias("c"))
    assert all(r.n == r.c for r in alone.collect())


def test_sums_keep_what_is_not_a_number(spark):
    rows = [("a", 0.1), ("a", 0.2), ("b", float("nan")), ("b", 1.0), ("c", float("inf")), ("c", 2.0), ("d", float("inf")),
            ("d", float("-inf")), ("e", None), ("f", 1e300), ("f", 1e300), ("g", -0.3), ("g", None), ("h", 4e14), ("h", 4e14)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.v for r in merge_duplicates(df, ["k"], 4).collect()}
    assert (got["a"], got["c"], got["e"], got["f"], got["g"], got["h"]) == (0.3, math.inf, None, 2e300, -0.3, 8e14)
    assert math.isnan(got["b"]) and math.isnan(got["d"])


def kinds(previous, current, keys):
    return Counter(r["Change"] for r in H.track_changes(previous, current, keys).collect())


def test_changes_tell_rows_apart(spark):
    def one(row, schema):
        return spark.createDataFrame([row], schema)
    s = "k int, x string, y string"
    assert kinds(one((1, "a|b", "c"), s), one((1, "a", "b|c"), s), ["k"]) == {"updated": 1}
    assert kinds(one((1, None, "c"), s), one((1, "\\N", "c"), s), ["k"]) == {"updated": 1}
    assert kinds(one((1, None, "n"), s), one((1, "n", None), s), ["k"]) == {"updated": 1}
    assert kinds(one((1, "a", "b"), s), one((1, "a", "b", "new"), s + ", z string"), ["k"]) == {"updated": 1}
    assert kinds(one((1, "a", "b", "old"), s + ", z string"), one((1, "a", "b"), s), ["k"]) == {"updated": 1}
    assert kinds(one((None, "a", "b"), s), one((None, "a", "b"), s), ["k"]) == {"unchanged": 1}


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text('WellID,Hours\nW1,1\n"say ""hi""",2\n')
    (tmp_path / "two.CSV").write_text('Hours,WellID\n3,"W2\nsecond line"\n')
    (tmp_path / "three.csv").write_text("WellID\nW3\n")
    got = {(r["WellID"], r["Hours"]) for r in read_csv(spark, str(tmp_path)).collect()}
    assert got == {("W1", "1"), ('say "hi"', "2"), ("W2\nsecond line", "3"), ("W3", None)}
