import datetime

from pyspark.sql import functions as F

from flowledger.operators import clean, quality
from flowledger.schemas import ISSUES, PRODUCTION_COLUMNS, WELL_RAW

JAN = datetime.date(2024, 1, 1)
SCHEMA = ("WellID string, ProductionMonth date, Pool string, Hours double, OilProduction double, "
          "GasProduction double, CondensateProduction double, DaysFromFirst int")


def run(spark, *rows):
    return quality.validate_silver(spark.createDataFrame(list(rows), SCHEMA), PRODUCTION_COLUMNS)


def rules(result):
    return sorted((i.WellID, i.Rule, i.Field) for i in result.issues.collect())


def test_duplicates_are_summed(spark):
    out = run(spark, ("a", JAN, None, 300.0, 1.0, None, 0.0, 5), ("a", JAN, "P2", 440.0, 2.0, None, 0.5, 3),
              ("a", JAN, "P1", 0.0, 0.0, None, 0.0, 4))
    row = out.clean.first()
    assert (row.Hours, row.OilProduction, row.GasProduction, row.Pool, row.DaysFromFirst) == (740.0, 3.0, None, "P1", 3)
    issue = out.issues.first()
    assert (issue.Rule, issue.Severity, issue.OriginalValue) == ("aggregated_duplicate", "Warn", "3")


def test_each_rule(spark):
    out = run(
        spark, ("negative", JAN, "p", -1.0, 0.0, 0.0, 0.0, 0), ("idle", JAN, "p", 0.0, 0.0, 2.0, 0.0, 0),
        ("over", JAN, "p", 769.0, 1.0, 1.0, 1.0, 0), ("edge", JAN, "p", 768.0, 1.0, 1.0, 1.0, 0),
        ("short", JAN, "p", 600.0, 1.0, 1.0, 1.0, 0), ("still", JAN, "p", 600.0, 0.0, 0.0, 0.0, 0),
        ("clip", JAN, "p", 744.0, -3.0, 1.0, -2.0, 0), ("nohours", JAN, "p", None, 1.0, 1.0, 1.0, 0))
    assert rules(out) == sorted([
        ("negative", "hours_negative", "Hours"), ("idle", "hours_zero_with_production", "Hours"),
        ("idle", "hours_significantly_mismatch_month", "Hours"), ("over", "hours_exceed_month_by_over_24", "Hours"),
        ("short", "hours_significantly_mismatch_month", "Hours"), ("clip", "negative_clipped", "OilProduction"),
        ("clip", "negative_clipped", "CondensateProduction")])
    kept = {r.WellID: r for r in out.clean.collect()}
    assert set(kept) == {"edge", "short", "still", "clip", "nohours"}
    assert kept["clip"].OilProduction == 0.0 and kept["clip"].CondensateProduction == 0.0
    mismatch = out.issues.filter("WellID = 'short'").first()
    assert (mismatch.OriginalValue, mismatch.CorrectedValue) == ("600.0", "744.0")


def test_without_keys_nothing_is_validated(spark):
    df = spark.createDataFrame([("f", 1.0)], "ReportingFacilityID string, Volume double")
    out = quality.validate_silver(df, ["Volume"])
    assert out.clean.count() == 1 and out.issues.count() == 0
    assert [f.name for f in out.issues.schema.fields] == [f.name for f in ISSUES.fields]


def test_facility_rows_validate_with_their_own_entity(spark):
    df = spark.createDataFrame([("f", JAN, 744.0, -1.0), ("f", JAN, 0.0, 2.0)],
                               "ReportingFacilityID string, ProductionMonth date, Hours double, Volume double")
    out = quality.validate_silver(df, ["Volume"], entity="ReportingFacilityID")
    assert out.clean.first().Volume == 1.0
    assert [i.WellID for i in out.issues.collect()] == ["f"]


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), (F.col("id") % 500).cast("string"))).alias("WellID"),
        F.lit(JAN).alias("ProductionMonth"), F.lit(0.01).alias("Hours"), F.lit("p").alias("Pool"))
    merged = quality.merge_duplicates(df, ["WellID", "ProductionMonth"], exact_scale=4)
    hot = merged.filter("WellID = 'hot'").first()
    assert (hot.LineCount, hot.Hours) == (30_000, 300.0)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    before, _, after = plan.partition("Exchange")
    assert "Aggregate" in before and "Aggregate" in after


def test_schema_cleaning_only_touches_text(spark):
    df = spark.createDataFrame([(" W1 ", "1,5", 12345678.9, "2024-01", "z")],
                               "WellID string, Hours string, GasProduction double, ProductionMonth string, other string")
    row = clean.apply_schema(df, WELL_RAW).first()
    assert (row.WellID, row.Hours, row.GasProduction, row.other) == ("W1", 15.0, 12345678.9, "z")


def test_dataset_dispatch(spark):
    df = spark.createDataFrame([("-4", "-4")], "OilProduction string, Hours string")
    assert clean.clean_dataset(df, "ngl", WELL_RAW).first() == (0.0, -4.0)
    assert clean.clean_dataset(df, "vol", WELL_RAW).first() == (-4.0, -4.0)
    assert clean.clean_dataset(df, "other", WELL_RAW).first() == ("-4", "-4")


def test_required_columns_drop_rows(spark):
    df = spark.createDataFrame([("W", None), (None, 1.0), ("W", 2.0)], "WellID string, Hours double")
    assert clean.drop_incomplete(df, WELL_RAW).count() == 2


def test_selection(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "WellID string")

    def wells(d):
        return sorted(r.WellID for r in d.collect())

    assert wells(clean.select_entities(df)) == ["a", "a", "b", "c"]
    assert wells(clean.select_entities(df, ["a", "b"], ["b"])) == ["a", "a"]
    frame = spark.createDataFrame([("a",), ("a",)], "WellID string")
    assert wells(clean.select_entities(df, frame)) == ["a", "a"]
    assert wells(clean.select_entities(df, exclude=frame)) == ["b", "c"]
    assert wells(clean.with_min_history(df, 2)) == ["a", "a"]


def test_rename_and_mapping(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "DaysFromFirst int, DaysFromFirstProducing int, OilProductionDailyRate double")
    assert clean.time_column(df) == "DaysFromFirstProducing"
    renamed = clean.rename_with_replace(df, "DaysFromFirstProducing", "DaysFromFirst")
    assert renamed.first().DaysFromFirst == 2 and "DaysFromFirstProducing" not in renamed.columns
    assert clean.rate_columns(df, ["OilProduction", "GasProduction"]) == {
        "OilProduction": "OilProductionDailyRate", "GasProduction": "GasProduction"}
