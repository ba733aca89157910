"""Decline-curve fit of every (entity, measure) series in one plan.

Rows are unique per (entity, month), so a series is bounded by its months of history. The plan is
one shuffle by entity; measures are stacked afterwards, the windows reuse that partitioning, and the
final aggregate turns a series into one row with its arrays and history figures. Only these arrays
cross to Python, in Arrow batches of many series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.curves import DAYS_PER_YEAR
from .solver import fit_curves

# Sizes and thresholds of the fit rules.
MIN_POINTS = 8
MAX_ROLLING = 6
MIN_ROLLING = 3
MIN_DECLINE_POINTS = 6
MAX_DECLINE_RATIO = 0.7
OUTLIER_IQRS = 2.5
MIN_KEPT_SHARE = 0.8
LOG_LINEAR_GOOD = 0.4
DEFAULT_MIN_R2 = 0.3
CURVES = ("exponential", "hyperbolic", "harmonic")
# Outcome texts.
OK = "ok"
TOO_FEW = "Insufficient data points"
NO_DECLINE = "No significant decline pattern observed"
ALL_FAILED = "All curve fits failed"

SERIES = ["WellID", "ProductionType"]


def stack_measures(df: DataFrame, measures: Mapping[str, str] | Sequence[str], time: str = "DaysFromFirst",
                   month: str = "ProductionMonth", entity: str = "WellID") -> DataFrame:
    """Long form (WellID, ProductionType, ProductionMonth, t, q).

    Shuffles the narrow rows once by entity before stacking, so the measures do not multiply what
    is shuffled; `explode` keeps the partitioning for everything that follows.
    """
    pairs = measures if isinstance(measures, Mapping) else {m: m for m in measures}
    values = F.array(*[F.struct(F.lit(name).alias("ProductionType"), F.col(c).cast("double").alias("q"))
                       for name, c in pairs.items()])
    return (
        df.select(F.col(entity).alias("WellID"), F.col(month).cast("date").alias("ProductionMonth"),
                  F.col(time).alias("t"), *[F.col(c) for c in dict.fromkeys(pairs.values())])
        .repartition("WellID")
        .select("WellID", "ProductionMonth", "t", F.explode(values).alias("m"))
        .select("WellID", "m.ProductionType", "ProductionMonth", "t", "m.q")
    )


def _rolling_mean(series, width: Column, position: Column, n: Column) -> Column:
    """Centered mean over `width` rows, null unless the frame is complete.

    Frame bounds must be literals, so each possible width is its own frame of one window operator.
    """
    choice = None
    for w in range(MIN_ROLLING, MAX_ROLLING + 1):
        before, after = w // 2, (w - 1) // 2
        mean = F.avg("q").over(series.rowsBetween(-before, after))
        complete = (position >= before) & (position + after < n)
        choice = (F.when if choice is None else choice.when)((width == w) & complete, mean)
    return choice


def decline_segment(points: DataFrame) -> DataFrame:
    """Mark each positive point with its place in the series and whether it is in the decline.

    Adds n, idx, peak_idx, start_idx and in_segment. Non-positive rows stay, apart, with nulls: they
    count for the last day and first month of the series.
    """
    group = Window.partitionBy(*SERIES, "positive")
    series = group.orderBy("t", "ProductionMonth")
    whole = series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    idx, n, width = F.col("idx"), F.col("n"), F.col("width")

    placed = (
        points.withColumn("positive", F.coalesce(F.col("q") > 0, F.lit(False)))
        .withColumns({"idx": F.row_number().over(series) - 1, "n": F.count("*").over(whole).cast("int")})
        .withColumn("width", F.least(F.lit(MAX_ROLLING), F.floor(n / 4).cast("int")))
    )
    height = F.when(width >= MIN_ROLLING, _rolling_mean(series, width, idx, n)).otherwise(F.col("q"))
    peak = F.max(F.when(F.col("height").isNotNull(), F.struct("height", (-idx).alias("back")))).over(whole)
    tail = n - F.greatest(F.lit(MIN_DECLINE_POINTS), F.floor(n / 3).cast("int"))
    return (
        placed.withColumn("height", height)
        .withColumn("peak_idx", -peak["back"])
        .withColumn("start_idx", F.when(F.col("peak_idx") < tail, F.col("peak_idx")).otherwise(
            F.least(F.floor(F.col("peak_idx") / 2).cast("int"), tail)))
        .withColumn("in_segment", F.col("positive") & (n >= MIN_POINTS) & (idx >= F.col("start_idx")))
        .drop("height", "width")
    )


def mark_outliers(segmented: DataFrame) -> DataFrame:
    """Decline ratios and the outlier mask of the segment: adds seg_len, ratios, bounds, keep."""
    whole = (Window.partitionBy(*SERIES, "positive").orderBy("t", "ProductionMonth")
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    place = F.col("idx") - F.col("start_idx")
    seg_len = F.col("n") - F.col("start_idx")
    third = F.floor(F.col("seg_len") / 3)
    seg_q = F.when(F.col("in_segment"), F.col("q"))
    last, first = F.max(F.when(F.col("idx") == F.col("n") - 1, seg_q)), F.max(F.when(place == 0, seg_q))
    late, early = F.avg(F.when(place >= F.col("seg_len") - third, seg_q)), F.avg(F.when(place < third, seg_q))

    quartiles = F.percentile(seg_q, F.array(F.lit(0.25), F.lit(0.75)))
    low, high = F.col("quartiles")[0], F.col("quartiles")[1]
    reach = (high - low) * OUTLIER_IQRS
    inside = F.col("in_segment") & F.col("q").between(F.col("low_bound"), F.col("high_bound"))
    return (
        segmented.withColumn("seg_len", seg_len)
        .withColumns({
            "overall_ratio": last.over(whole) / first.over(whole),
            "trend_ratio": late.over(whole) / early.over(whole),
            "quartiles": quartiles.over(whole),
        })
        .withColumns({"low_bound": low - reach, "high_bound": high + reach})
        .withColumn("inside", inside)
        .withColumn("kept", F.sum(inside.cast("int")).over(whole))
        .withColumn("keep", F.col("in_segment") & (
            F.col("inside") | (F.col("kept") < F.col("seg_len") * F.lit(MIN_KEPT_SHARE))))
        .drop("quartiles")
    )


def series_table(points: DataFrame) -> DataFrame:
    """One row per series: fit input, log-linear estimates, decline test and history figures."""
    keep, pos = F.col("keep"), F.col("positive")
    t, q, month = F.col("t").cast("double"), F.col("q"), F.col("ProductionMonth")
    kept_t, kept_q = F.when(keep, t), F.when(keep, q)
    log_q, years = F.log(kept_q), kept_t / DAYS_PER_YEAR

    def seg(c: str) -> Column:
        return F.max(F.when(F.col("in_segment"), F.col(c))).alias(c)

    table = (
        mark_outliers(decline_segment(points)).groupBy(*SERIES).agg(
            F.count("*").cast("int").alias("rows"),
            F.coalesce(F.max(F.when(pos, F.col("n"))), F.lit(0)).alias("n_points"),
            F.max("t").alias("last_day"), F.min("ProductionMonth").alias("first_month"),
            F.min(F.when(pos, month)).alias("hist_min"), F.max(F.when(pos, month)).alias("hist_max"),
            F.avg(F.when(pos, q)).alias("hist_avg"), F.max(F.when(pos, q)).alias("hist_peak"),
            F.max_by(F.when(pos, q), F.when(pos, month)).alias("hist_last"),
            seg("peak_idx"), seg("start_idx"), seg("seg_len"), seg("overall_ratio"), seg("trend_ratio"),
            seg("low_bound"), seg("high_bound"),
            F.count(kept_q).cast("int").alias("n_used"),
            F.min(kept_t).alias("t_offset"), F.min_by(kept_q, kept_t).alias("q_first"),
            F.regr_slope(log_q, years).alias("_slope"), F.regr_intercept(log_q, years).alias("_intercept"),
            F.sort_array(F.collect_list(F.when(keep, F.struct(t.alias("t"), q.alias("q"))))).alias("series"),
        )
    )
    # The line is fitted on absolute days; shift it to the first kept day.
    shift = F.col("t_offset") / DAYS_PER_YEAR
    reason = (
        F.when(F.col("n_points") < MIN_POINTS, TOO_FEW)
        .when(F.least("overall_ratio", "trend_ratio") > MAX_DECLINE_RATIO, NO_DECLINE)
    )
    return (
        table.withColumns({
            "slope": F.col("_slope"),
            "intercept": F.col("_intercept") + F.col("_slope") * shift,
            "rejected": reason,
        })
        .withColumn("qi_estimate", F.greatest(F.exp("intercept"), F.col("q_first")))
        .drop("_slope", "_intercept")
    )


def fit_series(points: DataFrame, curve: str = "auto", min_r2: float = DEFAULT_MIN_R2) -> DataFrame:
    """Fit, choose and gate; rejected series stay in the table with their reason in `Status`."""
    return choose_model(solve_series(series_table(points), curve), curve, min_r2)


def solve_series(table: DataFrame, curve: str = "auto") -> DataFrame:
    """Run the solver on every series that passed the decline test; adds the struct `fit`.

    Only the named curve is searched; `auto` searches all.
    """
    if curve not in (*CURVES, "auto"):
        raise ValueError(f"Unknown curve type: {curve}")
    usable = F.col("rejected").isNull()
    offsets = F.transform("series", lambda p: p["t"] - F.col("t_offset"))
    fit = fit_curves(
        F.when(usable, offsets), F.when(usable, F.col("series.q")),
        F.col("qi_estimate"), F.col("slope"), F.col("intercept"), CURVES if curve == "auto" else (curve,))
    return table.withColumn("fit", fit).drop("series")


def choose_model(solved: DataFrame, curve: str = "auto", min_r2: float = DEFAULT_MIN_R2) -> DataFrame:
    """Choose the curve and set CurveType, parameters with standard errors, RSquared, AIC and Status.

    A log-linear fit that no search improved has no standard errors.

    A fit is valid if its R2 > 0. `auto` takes an unimproved log-linear exponential of R2 >= 0.4,
    else the lowest AIC; a named curve is that curve or a failure. Then the R2 gate.
    """
    if curve not in (*CURVES, "auto"):
        raise ValueError(f"Unknown curve type: {curve}")
    f = F.col("fit")

    def option(prefix: str, name: str, order: int) -> Column:
        valid = f[f"{prefix}_r2"] > 0
        b = f["hyp_b"] if prefix == "hyp" else F.lit(0.0)
        b_error = f["hyp_b_error"] if prefix == "hyp" else F.lit(None).cast("double")
        return F.when(valid, F.struct(
            f[f"{prefix}_aic"].alias("aic"), F.lit(order).alias("order"), F.lit(name).alias("curve"),
            f[f"{prefix}_qi"].alias("qi"), f[f"{prefix}_di"].alias("di"), b.alias("b"),
            f[f"{prefix}_r2"].alias("r2"), f[f"{prefix}_qi_error"].alias("qi_error"),
            f[f"{prefix}_di_error"].alias("di_error"), b_error.alias("b_error")))

    options = {name: option(prefix, name, i)
               for i, (prefix, name) in enumerate(zip(("exp", "hyp", "har"), CURVES))}
    if curve == "auto":
        log_linear = (f["exp_method"] == "log-linear") & (f["exp_r2"] >= LOG_LINEAR_GOOD)
        best = F.when(log_linear, options["exponential"]).otherwise(F.least(*options.values()))
        failure = F.lit(ALL_FAILED)
    else:
        # Only the requested curve counts, so its failure leaves no valid fit at all.
        best, failure = options[curve], F.lit(ALL_FAILED)
    fitted = solved.withColumn("best", F.when(F.col("rejected").isNull(), best))
    gate = F.format_string("Best fit R² (%.3f) below threshold (" + str(min_r2) + ")", F.col("best.r2"))
    status = (
        F.coalesce(F.col("rejected"), F.when(F.col("best").isNull(), failure),
                   F.when(F.col("best.r2") < min_r2, gate), F.lit(OK))
    )
    return fitted.select(
        *[c for c in solved.columns if c not in ("fit", "rejected")],
        F.col("best.curve").alias("CurveType"), F.col("best.qi").alias("qi"), F.col("best.di").alias("di"),
        F.col("best.b").alias("b"), F.col("best.r2").alias("RSquared"), F.col("best.aic").alias("AIC"),
        status.alias("Status"), *[F.col(f"best.{c}").alias(c) for c in ("qi_error", "di_error", "b_error")],
    )
