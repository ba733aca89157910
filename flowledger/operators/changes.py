"""Row hashes, change detection between loads, audit report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HASH = "RowHash"


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the values as text, each with its length before it and null as "n": no two rows of
    different values give the same text, whatever characters they hold."""
    parts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.sha2(F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("n")) for p in parts]), 256)


def add_row_hash(df: DataFrame, keys: Sequence[str], loaded_at: str | None = None) -> DataFrame:
    """Hash of all non-key columns, in name order, and the load time."""
    columns = sorted(c for c in df.columns if c not in keys)
    at = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return df.withColumns({HASH: row_hash(columns), "LoadedAt": at})


def track_changes(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: inserted, updated, deleted or unchanged. Only keys and hashes are shuffled.

    A column that only one load has is null in the other. Null keys are equal to each other.
    """
    columns = sorted({*previous.columns, *current.columns} - {*keys})

    def side(df: DataFrame, name: str) -> DataFrame:
        whole = df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns})
        return whole.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], row_hash(columns).alias(name))

    old, new = F.col("PreviousHash"), F.col("CurrentHash")
    change = (F.when(old.isNull(), "inserted").when(new.isNull(), "deleted")
              .when(old != new, "updated").otherwise("unchanged"))
    same = reduce(and_, [F.col(f"PreviousHash_{k}").eqNullSafe(F.col(f"CurrentHash_{k}")) for k in keys])
    return (side(previous, "PreviousHash").join(side(current, "CurrentHash"), same, "full_outer")
            .select(*[F.coalesce(f"CurrentHash_{k}", f"PreviousHash_{k}").alias(k) for k in keys], change.alias("Change"),
                    "PreviousHash", "CurrentHash"))


FROM, TO = "ValidFrom", "ValidTo"


def _hashed(current: DataFrame, keys: Sequence[str]) -> DataFrame:
    columns = sorted(c for c in current.columns if c not in keys)
    return current.select(*keys, row_hash(columns).alias(HASH))


def _against_open(history: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The open interval (`old`) and the new hash (`new`) of every key that has one of them."""
    old = history.where(F.col(TO).isNull()).select(*[F.col(k).alias(f"old_{k}") for k in keys], F.struct(HASH, FROM).alias("old"))
    new = _hashed(current, keys).select(*[F.col(k).alias(f"new_{k}") for k in keys], F.col(HASH).alias("new"))
    same = reduce(and_, [F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}")) for k in keys])
    found = [F.when(F.col("new").isNull(), F.col(f"old_{k}")).otherwise(F.col(f"new_{k}")).alias(k) for k in keys]
    return old.join(new, same, "full_outer").select(*found, "old", "new")


def advance_history(history: DataFrame | None, current: DataFrame, keys: Sequence[str], loaded_at: str) -> DataFrame:
    """History of loads: keys, RowHash, ValidFrom, ValidTo (null while valid), after one more load.

    A row that is the same in consecutive loads stays one interval; one that changed or went away ends at
    the load that no longer has it, and begins anew when it comes back. Keys are unique in a load, null keys
    equal each other. Closed intervals are passed on, only open ones and the load's hashes are shuffled.
    A load with other columns differs in every row.
    """
    at = F.lit(loaded_at).cast("timestamp")
    never = F.lit(None).cast("timestamp")
    if history is None:
        return _hashed(current, keys).select(*keys, HASH, at.alias(FROM), never.alias(TO))
    old, new = F.col("old"), F.col("new")
    stays = F.coalesce(old[HASH] == new, F.lit(False))
    before = F.when(old.isNotNull(), F.struct(
        old[HASH].alias(HASH), old[FROM].alias(FROM), F.when(stays, never).otherwise(at).alias(TO)))
    after = F.when(new.isNotNull() & ~stays, F.struct(new.alias(HASH), at.alias(FROM), never.alias(TO)))
    moved = _against_open(history, current, keys).select(*keys, F.explode(F.filter(F.array(before, after), lambda x: x.isNotNull())).alias("i"))
    return history.where(F.col(TO).isNotNull()).unionByName(moved.select(*keys, "i.*"))


def changes_since(history: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: what a load changes against the open intervals (inserted, updated, deleted or unchanged)."""
    old, new = F.col("old")[HASH], F.col("new")
    change = (F.when(old.isNull(), "inserted").when(new.isNull(), "deleted").when(old != new, "updated").otherwise("unchanged"))
    return _against_open(history, current, keys).select(*keys, change.alias("Change"))


def history_of_loads(loads: DataFrame, keys: Sequence[str], loaded: str = "LoadedAt") -> DataFrame:
    """The same history from stored loads at once: keys, RowHash and load time, one row per key and load.

    Consecutive loads are numbered by their distinct times; a key has one row per load in its window.
    """
    times = loads.select(F.col(loaded).alias(FROM)).distinct()
    number = F.row_number().over(Window.orderBy(FROM))
    # One row per load.
    numbered = times.withColumns({"load": number, TO: F.lead(FROM).over(Window.orderBy(FROM))})
    placed = loads.withColumnRenamed(loaded, FROM).join(numbered, FROM)
    series = Window.partitionBy(*keys).orderBy("load")
    begins = ~((F.lag(HASH).over(series) == F.col(HASH)) & (F.lag("load").over(series) == F.col("load") - 1))
    runs = placed.withColumn("begins", F.coalesce(begins, F.lit(True)).cast("int")).withColumn("run", F.sum("begins").over(series))
    return runs.groupBy(*keys, "run").agg(
        F.first(HASH).alias(HASH), F.min(FROM).alias(FROM), F.max_by(TO, "load").alias(TO)).drop("run")


def issue_metrics(issues: DataFrame) -> DataFrame:
    """Issue count and number of affected wells per rule.

    Counted per well first, so one well with most of the issues is combined map-side.
    """
    per_well = issues.groupBy("Rule", "Severity", "WellID").agg(F.count("*").alias("n"))
    return per_well.groupBy("Rule", "Severity").agg(
        F.sum("n").alias("issues"), F.count("WellID").alias("wells"))


def audit_report(issues: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """One JSON document per rule and, if given, per kind of change."""
    quality = issue_metrics(issues).select(
        F.lit("quality").alias("Section"), F.col("Rule").alias("Name"),
        F.to_json(F.struct("Rule", "Severity", "issues", "wells")).alias("Document"))
    if changes is None:
        return quality
    counted = changes.groupBy("Change").agg(F.count("*").alias("rows"))
    return quality.unionByName(counted.select(
        F.lit("changes").alias("Section"), F.col("Change").alias("Name"),
        F.to_json(F.struct("Change", "rows")).alias("Document")))
