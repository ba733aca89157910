"""Repeated loads: only missing or changed months are written, rows keep a history, audits compare loads."""

from __future__ import annotations

import datetime
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from test_tables import raw_rows

from flowledger.operators import changes
from flowledger.plans import forecasting, medallion
from flowledger.sources import tables

KEYS = ["k", "m"]


def files_of(df):
    out = {}
    for f in df.inputFiles():
        path = f.removeprefix("file://").removeprefix("file:")
        out[path] = os.stat(path).st_mtime_ns
    return out


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "WellID string, ProductionMonth string, v double")


def test_second_load_rewrites_only_changed_months(spark, namespace):
    name = f"{namespace}.loads"
    rows = [(f"W{w}", f"2023-{m:02d}", float(w * m)) for w in range(20) for m in range(1, 13)] + [("W1", "n/a", 1.0), ("W1", None, 2.0)]
    first = tables.load_changed_months(rows_of(spark, rows).repartition(4), name)
    assert {r.LoadMonth for r in first.collect()} == {*(f"2023-{m:02d}" for m in range(1, 13)), "unknown"}
    before = files_of(spark.table(name))
    changed = [(w, m, v + (m == "2023-05" and w == "W3")) for w, m, v in rows if m != "2023-09"]
    changed += [("W1", "2024-01", 5.0), ("W2", "2024-02", 5.0)]
    got = tables.load_changed_months(rows_of(spark, changed).repartition(3), name)
    assert {r.LoadMonth for r in got.collect()} == {"2023-05", "2024-01", "2024-02"}
    after = files_of(spark.table(name))
    kept = {f for f in before if "LoadMonth=2023-05" not in f}
    assert all(after.get(f) == before[f] for f in kept) and all(any(f"LoadMonth={m}" in f for m in ("2023-05", "2024-")) for f in set(after) - kept)
    want = sorted(map(str, [*changed, *(r for r in rows if r[1] == "2023-09")]))
    assert sorted(str(tuple(r)) for r in spark.table(name).drop("LoadMonth").collect()) == want
    assert tables.load_changed_months(rows_of(spark, changed), name).count() == 0
    assert files_of(spark.table(name)) == after


def test_load_follows_the_month_plan(spark, namespace):
    name = f"{namespace}.planned"
    rows = [("W1", f"2023-{m:02d}", float(m)) for m in range(1, 13)]
    tables.load_changed_months(rows_of(spark, rows), name, "2023-02", "2023-04")
    assert sorted(r.ProductionMonth for r in spark.table(name).collect()) == ["2023-02", "2023-03", "2023-04"]
    other = [(w, m, v * 2) for w, m, v in rows]
    got = tables.load_changed_months(rows_of(spark, other), name, "2023-04", "2023-06", refresh=False)
    assert sorted(r.LoadMonth for r in got.collect()) == ["2023-05", "2023-06"]
    assert {r.ProductionMonth: r.v for r in spark.table(name).collect()} == {"2023-02": 2, "2023-03": 3, "2023-04": 4, "2023-05": 10, "2023-06": 12}
    with pytest.raises(ValueError):
        tables.load_changed_months(rows_of(spark, rows).withColumn("more", F.lit(1)), name)


def test_interrupted_load_is_repeated(spark, namespace):
    name = f"{namespace}.broken"
    rows = [("W1", "2023-01", 1.0), ("W1", "2023-02", 1.0)]
    tables.load_changed_months(rows_of(spark, rows), name)
    state = spark.table(f"{name}_months").collect()
    rows[0] = ("W1", "2023-01", 3.0)
    tables.load_changed_months(rows_of(spark, rows), name)
    # As if the second load had ended before it noted its months.
    tables.write_table(spark.createDataFrame(state), f"{name}_months")
    assert [r.LoadMonth for r in tables.load_changed_months(rows_of(spark, rows), name).collect()] == ["2023-01"]
    assert sorted(r.v for r in spark.table(name).collect()) == [1.0, 3.0]


def loads_of(seed, n=6):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append({(k, None if k == 3 else k % 2): rng.choice(["x", "y", None]) for k in range(40) if rng.random() < 0.8})
    return [*out[:3], out[2], *out[3:]]


def brute_history(loads, days):
    out = set()
    for key in {k for load in loads for k in load}:
        since, value = None, None
        for day, load in zip(days, loads):
            here = (load[key],) if key in load else None
            if here != value:
                if value is not None:
                    out.add((*key, value[0], since, day))
                since, value = day, here
        if value is not None:
            out.add((*key, value[0], since, None))
    return out


def test_history_of_loads_both_ways(spark):
    loads = loads_of(4)
    days = [datetime.datetime(2024, 1 + i, 1) for i in range(len(loads))]
    frames = [spark.createDataFrame([(*k, v) for k, v in load.items()], "k int, m int, v string") for load in loads]
    hashes = {v: spark.createDataFrame([(v,)], "v string").select(changes.row_hash(["v"])).first()[0] for v in ("x", "y", None)}
    want = {(k, m, hashes[v], a, b) for k, m, v, a, b in brute_history(loads, days)}
    history = None
    for day, load in zip(days, frames):
        history = changes.advance_history(history, load, KEYS, str(day))
    columns = [*KEYS, changes.HASH, changes.FROM, changes.TO]
    assert {tuple(r) for r in history.select(columns).collect()} == want
    stored = [changes.add_row_hash(f, KEYS, str(d)).drop("v") for d, f in zip(days, frames)]
    at_once = stored[0]
    for more in stored[1:]:
        at_once = at_once.unionByName(more)
    assert {tuple(r) for r in changes.history_of_loads(at_once.repartition(5), KEYS).select(columns).collect()} == want
    assert changes.history_of_loads(at_once.limit(0), KEYS).count() == 0


def test_job_records_two_loads(spark, namespace):
    header = list(raw_rows()[0])

    def load(rows, at):
        raw = spark.createDataFrame([tuple(None if r[c] is None else str(r[c]) for c in header) for r in rows], ", ".join(f"{c} string" for c in header))
        months = {r.LoadMonth for r in medallion.load_bronze_months(raw, "ngl", namespace).collect()}
        medallion.bronze_to_silver(spark, "ngl", namespace, exact_scale=6)
        report = medallion.record_load(spark, "ngl", namespace, at)
        counts = {r.Name: json.loads(r.Document) for r in report.collect()}
        return months, {n: d["rows"] for n, d in counts.items() if "rows" in d}, counts

    rows = raw_rows(months=12)
    months, kinds, _ = load(rows, "2024-01-01")
    assert len(months) == 12 and kinds == {"inserted": 24}
    silver = spark.table(f"{namespace}.ngl_silver")
    first = {r.WellID: r.m for r in silver.groupBy("WellID").agg(F.min("ProductionMonth").alias("m")).collect()}
    assert all(r.DaysFromFirst == (r.ProductionMonth - first[r.WellID]).days for r in silver.collect())

    rows = [dict(r) for r in raw_rows(months=13)]
    last = max(r["ProductionMonth"] for r in rows)
    next(r for r in rows if r["WellID"] == "W2" and r["ProductionMonth"] != last)["Hours"] = "100.0"
    months, kinds, docs = load(rows, "2024-02-01")
    assert len(months) == 2 and last in months and kinds == {"inserted": 2, "updated": 1, "unchanged": 23}
    assert docs["hours_significantly_mismatch_month"]["issues"] == 1
    again = load(rows, "2024-02-01")
    assert again[0] == set() and again[1] == kinds
    history = spark.table(f"{namespace}.ngl_silver_history")
    assert history.count() == 27 and history.where("ValidTo IS NOT NULL").count() == 1
    audits = spark.table(f"{namespace}.ngl_audit").where("Section = 'changes'").groupBy("LoadedAt").count().collect()
    assert sorted(r["count"] for r in audits) == [1, 3]
    fits = forecasting.forecast_tables(spark, namespace, forecasting.ForecastSettings(min_months=13), use_normalized=False)["forecast_fits"]
    assert fits.count() == 6 and fits.where("DataUnit = 'per month'").count() == 6


def test_conventional_volume_is_the_measure(spark, namespace):
    raw = spark.createDataFrame([("W1", "2024-01", "OP", "F1", "-5", "2024-02-03", "744"), ("W1", "2024-02", "OP", "F1", "5", "2024-02-03", "0")],
                                "WellID string, ProductionMonth string, OperatorBAID string, ReportingFacilityID string, Volume string, SubmissionDate string, Hours string")
    medallion.raw_to_bronze(raw, "conventional", namespace)
    silver = medallion.bronze_to_silver(spark, "conventional", namespace).collect()
    issues = {r.Rule for r in spark.table(f"{namespace}.conventional_silver_quality_issues").collect()}
    assert {"negative_clipped", "hours_zero_with_production"} <= issues and [r.Volume for r in silver] == [0.0]
