import datetime
import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import declining

from flowledger.operators import changes, profile
from flowledger.plans import forecasting, medallion
from flowledger.schemas import FORECAST_SUMMARY, WELL_NORMALIZED, WELL_RAW
from flowledger.sources import files, staging, tables

HEADER = [f.name for f in WELL_RAW.fields]


def csv_text(rows, columns=HEADER):
    lines = [",".join(columns)]
    for r in rows:
        lines.append(",".join('"{}"'.format("" if r.get(c) is None else r.get(c)) for c in columns))
    return "\n".join(lines) + "\n"


def raw_rows(wells=("W1", "W2"), months=24):
    rows = []
    for r in declining(wells, months):
        m = r["ProductionMonth"]
        days = ((m.replace(day=28) + datetime.timedelta(days=4)).replace(day=1) - m).days
        row = {**r, "ProductionMonth": m.strftime("%Y-%m"), "Hours": f"{days * 24}.0"}
        row["GasProduction"] = f"{r['GasProduction']:,.6f}"
        rows.append(row)
    return rows


def test_table_exists(spark, namespace):
    spark.range(1).createOrReplaceTempView("some_view")
    assert tables.table_exists(spark, "some_view")
    assert not tables.table_exists(spark, "missing_db.nothing")
    tables.write_table(spark.range(3), f"{namespace}.t")
    assert tables.table_exists(spark, f"{namespace}.t") and spark.table(f"{namespace}.t").count() == 3


def test_write_with_schema_even_if_empty(spark, namespace):
    df = spark.createDataFrame([], "WellID string, extra int")
    out = tables.write_table(df, f"{namespace}.s", FORECAST_SUMMARY)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in FORECAST_SUMMARY]
    again = tables.write_table(spark.range(2), f"{namespace}.s")
    assert again.columns == ["id"]


def test_build_if_missing_builds_once(spark, namespace):
    calls = []

    def build():
        calls.append(1)
        tables.write_table(spark.range(1), f"{namespace}.b")

    for _ in range(2):
        assert tables.build_if_missing(spark, f"{namespace}.b", build).count() == 1
    assert calls == [1]


def test_months(spark, namespace):
    labels = [r.Label for r in tables.month_range(spark, "2023-11", "2024-02").orderBy("Month").collect()]
    assert labels == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert tables.month_range(spark, "2024-02", "2024-01").count() == 0
    assert tables.existing_months(spark, f"{namespace}.none").count() == 0
    tables.write_table(spark.createDataFrame([("2023-12",), ("2024-01",), ("2024-01",)], "ProductionMonth string"),
                       f"{namespace}.m")
    have = tables.existing_months(spark, f"{namespace}.m")
    assert have.count() == 2
    missing = tables.missing_months(tables.month_range(spark, "2023-11", "2024-02"), have)
    assert sorted(r.Label for r in missing.collect()) == ["2023-11", "2024-02"]


def test_views_answer_sql(spark):
    tables.register_views({"numbers": spark.range(5)})
    assert spark.sql("SELECT count(*) FROM numbers WHERE id > 2").first()[0] == 2
    assert spark.sql("SELECT * FROM numbers ORDER BY id LIMIT 2").count() == 2


def test_csv_folder_any_case(spark, tmp_path):
    rows = raw_rows(months=2)
    (tmp_path / "a.CSV").write_text(csv_text(rows[:2]))
    (tmp_path / "b.csv").write_text(csv_text(rows[2:]))
    (tmp_path / "c.txt").write_text("ignored")
    df = files.read_csv(spark, str(tmp_path))
    assert df.count() == 4 and {t for _, t in df.dtypes} == {"string"}


def test_parquet_and_staging(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "p"))
    df = files.read_parquet(spark, str(tmp_path / "p"))
    staged = staging.stage(df.withColumn("x", F.col("id") * 2))
    assert staged.agg(F.sum("x")).first()[0] == 12
    assert "Range" not in staged._jdf.queryExecution().executedPlan().toString()


def zipped(entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in entries.items():
            z.writestr(name, content)
    return out.getvalue()


def test_nested_archives(spark, tmp_path):
    rows = raw_rows(months=3)
    shuffled = list(reversed(HEADER))[:-1]
    nested = zipped({"inner.csv": csv_text(rows[:3]), "readme.txt": "no"})
    (tmp_path / "2020-01.zip").write_bytes(zipped({
        "vol.csv.zip": nested, "direct.CSV": "﻿" + csv_text(rows[3:5], shuffled), "skip.pdf": "x", "other.zip": nested}))
    (tmp_path / "2020-02.zip").write_bytes(zipped({"x/quoted.csv": csv_text([{**rows[5], "Field": "a, b\nc"}])}))
    df = files.read_archives(spark, str(tmp_path), WELL_RAW)
    got = df.collect()
    assert len(got) == 6
    entries = {r.Entry for r in got}
    assert entries == {"vol.csv.zip/inner.csv", "direct.CSV", "x/quoted.csv"}
    direct = [r for r in got if r.Entry == "direct.CSV"]
    assert direct[0].WellID == "W2" and direct[0].ReportingFacilityID is None
    assert next(r for r in got if r.Entry == "x/quoted.csv").Field == "a, b\nc"
    assert [r.LineNo for r in sorted((r for r in got if "inner" in r.Entry), key=lambda r: r.LineNo)] == [2, 3, 4]


def test_large_entry_streams_in_batches(spark, tmp_path):
    n = files.BATCH_ROWS * 2 + 5
    body = "WellID,Hours\n" + "".join(f"W{i},{i}\n" for i in range(n))
    (tmp_path / "big.zip").write_bytes(zipped({"big.csv": body}))
    df = files.read_archives(spark, str(tmp_path), WELL_RAW)
    row = df.agg(F.count("*"), F.countDistinct("WellID"), F.sum(F.col("Hours").cast("long"))).first()
    assert tuple(row) == (n, n, n * (n - 1) // 2)


def test_members_are_tasks(spark, tmp_path):
    inner = zipped({f"{i}.csv": f"WellID,Hours\nN{i},{i}\n" for i in range(3)})
    members = {f"dir/m {i:02d}.csv": f"WellID,Hours\nW{i},{i}\n" for i in range(49)}
    (tmp_path / "a b%20c.zip").write_bytes(zipped({**members, "nested.csv.zip": inner, "empty.csv": "", "no.txt": "x"}))
    df = files.read_archives(spark, str(tmp_path), WELL_RAW)
    got = df.select("WellID", "Entry", F.spark_partition_id().alias("task")).collect()
    assert {r.WellID for r in got} == {f"W{i}" for i in range(49)} | {"N0", "N1", "N2"} and len(got) == 52
    assert len({r.task for r in got}) == 50
    whole = files.read_archives(spark, str(tmp_path), WELL_RAW, ranged_schemes=())
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, df.collect()))


def test_no_archives(spark, tmp_path):
    (tmp_path / "none.zip").write_bytes(zipped({"readme.txt": "no"}))
    assert files.read_archives(spark, str(tmp_path), WELL_RAW).count() == 0


def test_csv_to_forecast_tables(spark, namespace, tmp_path):
    rows = raw_rows(months=30)
    broken = [{**rows[0], "WellID": None}, {**rows[1], "ProductionMonth": "n/a"}, {**rows[2]}]
    broken[2].update(OilProduction="-5", Hours="0")
    (tmp_path / "all.csv").write_text(csv_text(rows + broken))
    bronze = medallion.csv_to_bronze(spark, str(tmp_path), "ngl", namespace)
    assert bronze.count() == 62 and dict(bronze.dtypes)["GasProduction"] == "double"
    assert bronze.agg(F.min("OilProduction")).first()[0] == 0.0

    out = forecasting.forecast_tables(spark, namespace, forecasting.ForecastSettings(horizon_months=12, as_of="2024-01-01"))
    silver = spark.table(f"{namespace}.ngl_silver")
    assert silver.count() == 60
    issues = {(r.Rule, r["count"]) for r in spark.table(f"{namespace}.ngl_silver_quality_issues").groupBy("Rule").count().collect()}
    assert ("aggregated_duplicate", 1) in issues
    normalized = spark.table(f"{namespace}.ngl_normalized")
    for name in ("ngl_calendar", "ngl_normalized"):
        assert spark.sql(f"DESCRIBE EXTENDED {namespace}.{name}").where("col_name = 'Bucket Columns' AND data_type = '[`WellID`]'").count() == 1
    assert [f.name for f in normalized.schema] == [f.name for f in WELL_NORMALIZED]
    assert normalized.count() > 50
    fits = out["forecast_fits"]
    assert fits.count() == 6 and fits.filter("DataUnit = 'per day'").count() == 6
    good = fits.filter("Status = 'ok'").count()
    assert good == 6
    assert out["forecast_summary"].count() == good and out["forecasted_production"].count() == 12 * good
    assert out["historical_forecast_combined"].count() == 12 * good + 3 * normalized.count()
    assert spark.sql("SELECT count(*) FROM gasproduction_forecast_summary").first()[0] == 2
    for name in ("forecast_summary", "forecasted_production", "historical_forecast_combined"):
        assert {r.DataUnit for r in out[name].select("DataUnit").distinct().collect()} == {"per day"}
    gas = out["historical_forecast_combined"].filter("ProductionType = 'GasProduction' AND WellID = 'W1'")
    last = gas.filter("DataType = 'Historical'").orderBy(F.desc("ProductionMonth")).first()
    ahead = gas.filter("DataType = 'Forecast'").orderBy("ProductionMonth").first()
    assert 0.5 < ahead.GasProduction / last.GasProduction < 2 and last.Hours == 730.0
    assert ahead.DaysFromFirst > last.DaysFromFirst > 0
    year = out["forecast_summary"].filter("ProductionType = 'GasProduction' AND WellID = 'W1'").first()
    assert 5 * 30 < year.ForecastCumulative12Month / ahead.GasProduction < 12.1 * 30.5
    rate = out["forecasted_production"].filter("ProductionType = 'GasProduction'").agg(F.min("GasProduction")).first()[0]
    assert rate > 0

    plain = forecasting.forecast_tables(
        spark, namespace, forecasting.ForecastSettings(include=["W1"], min_months=12), use_normalized=False)
    assert {r.WellID for r in plain["forecast_fits"].collect()} == {"W1"}
    assert plain["forecast_fits"].first().DataUnit == "per month"


def test_conventional_dataset_is_not_validated(spark, namespace):
    raw = spark.createDataFrame([("2024-01", "OP", "F1", "1,000", "2024-02-03"), ("2024-01", None, "F1", "2", "")],
                                "ProductionMonth string, OperatorBAID string, ReportingFacilityID string, Volume string, SubmissionDate string")
    assert medallion.raw_to_bronze(raw, "conventional", namespace).count() == 1
    silver = medallion.bronze_to_silver(spark, "conventional", namespace).first()
    assert silver.Volume == 1000.0 and silver.SubmissionDate == datetime.datetime(2024, 2, 3)
    assert spark.table(f"{namespace}.conventional_silver_quality_issues").count() == 0
    with pytest.raises(ValueError):
        medallion.raw_to_bronze(raw, "other", namespace)


def test_changes(spark):
    schema = "k int, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (2, "x", "y"), (3, "q", None)], schema)
    new = spark.createDataFrame([(1, None, "x"), (2, "x", "y"), (4, "n", "n")], schema)
    got = {r.k: r.Change for r in changes.track_changes(old, new, ["k"]).collect()}
    assert got == {1: "updated", 2: "unchanged", 3: "deleted", 4: "inserted"}
    stamped = changes.add_row_hash(old, ["k"], "2024-01-01").first()
    assert len(stamped.RowHash) == 64 and stamped.LoadedAt == datetime.datetime(2024, 1, 1)


def test_audit_documents(spark):
    issues = spark.createDataFrame([("a", "r1", "Warn"), ("a", "r1", "Warn"), ("b", "r1", "Warn"), ("b", "r2", "Fatal")],
                                   "WellID string, Rule string, Severity string")
    docs = {r.Name: json.loads(r.Document) for r in changes.audit_report(issues).collect()}
    assert docs["r1"] == {"Rule": "r1", "Severity": "Warn", "issues": 3, "wells": 2} and docs["r2"]["issues"] == 1


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0] * 50, list(range(101)), [0.0] * 40 + [1e12], [-1.5, 2.25, 7.0, 7.0, 1e-9, 1e9]])
def test_exact_quartiles(spark, values):
    df = spark.createDataFrame([(float(v), "x") for v in values] + [(None, "y")], "v double, s string")
    row = profile.numeric_profile(df).first()
    q = np.percentile(values, [25, 50, 75])
    assert (row.q25, row.q50, row.q75) == pytest.approx(tuple(q)) and row["count"] == len(values)
    assert (row.min, row.max) == (min(values), max(values)) and row["mean"] == pytest.approx(np.mean(values))


def test_schema_profile_counts(spark):
    df = spark.createDataFrame([("W1", "1", " "), (None, "1-2", "x"), ("W2", "7", None)],
                               "WellID string, Hours string, Pool string")
    rows = {r.Column: r for r in profile.schema_profile(df, WELL_RAW).collect()}
    assert len(rows) == 26 and rows["WellID"].Nulls == 1 and rows["WellID"].Required
    assert (rows["Hours"].FailedCasts, rows["Hours"].Low, rows["Hours"].High) == (1, 1.0, 7.0)
    assert rows["Pool"].Blanks == 1 and not rows["Energy"].Present


