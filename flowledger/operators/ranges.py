"""Running sums and as-of lookups over raw rows, where one key may hold most of them.

A window partitioned by the key gathers a key's rows in one task. Here rows are dealt to ranges of
(key, order) by Spark's range partitioner, so a large key is cut into as many ranges as its rows
need. A window works inside each key's share of one range; what earlier ranges of the key add, a sum or
the last row seen, is one row per key and range, put in order by itself and joined back. Rows that are
equal in key and order are cut as well: their place in the input is the last part of the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

RANGE, PLACE = "_range", "_place"


def _in_ranges(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], ranges: int | None) -> DataFrame:
    """Rows stored with the number of their range; ranges follow (keys, order)."""
    count = ranges or 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn(PLACE, F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(count, *[F.col(k).asc() for k in keys], *order, F.col(PLACE).asc())
    return stage(dealt.withColumn(RANGE, F.spark_partition_id()))


def _join_back(rows: DataFrame, per_range: DataFrame, keys: Sequence[str]) -> DataFrame:
    """per_range has one row per key and range; null keys are a key like others."""
    names = {c: f"_at_{c}" for c in (RANGE, *keys)}
    side = per_range.withColumnsRenamed(names)
    match = [rows[RANGE] == side[names[RANGE]], *[rows[k].eqNullSafe(side[names[k]]) for k in keys]]
    return rows.join(side, match, "left").drop(*names.values())


def running_sums(rows: DataFrame, values: Sequence[str], keys: Sequence[str], order: Sequence[str],
                 suffix: str = "Cumulative", ranges: int | None = None) -> DataFrame:
    """Running sum `<value><suffix>` of each value per key in the order given; null counts as 0.

    Ties of the order are broken by the place in the input. Null keys are one key; nulls of the order come
    first. Doubles are added per range first, so the last bits may differ from those of one long addition.
    """
    columns = rows.columns
    dealt = _in_ranges(rows, keys, [F.col(c).asc() for c in order], ranges)
    # Names no input has, so that values may be called anything.
    added = {v: f"_sum_{i}" for i, v in enumerate(values)}
    zero = {v: F.coalesce(F.col(v), F.lit(0).cast(dealt.schema[v].dataType)) for v in values}
    totals = dealt.groupBy(RANGE, *keys).agg(*[F.sum(zero[v]).alias(added[v]) for v in values])
    before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(RANGE, *keys, *[F.sum(c).over(before).alias(c) for c in added.values()])
    inside = (Window.partitionBy(RANGE, *keys).orderBy(*order, PLACE)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = dealt.withColumns({f"{v}{suffix}": F.sum(zero[v]).over(inside) for v in values})
    joined = _join_back(summed, carried, keys)
    sums = [(F.col(f"{v}{suffix}") + F.coalesce(F.col(c), F.lit(0).cast(totals.schema[c].dataType))).alias(f"{v}{suffix}")
            for v, c in added.items()]
    return joined.select(*columns, *sums)


def as_of(targets: DataFrame, facts: DataFrame, keys: Sequence[str], time: str, take: Sequence[str],
          fact_time: str | None = None, forward: bool = False, prefix: str = "", ranges: int | None = None) -> DataFrame:
    """Every target with columns `take` of the last fact of its key at or before its time.

    With `forward`, of the first fact at or after it. `<prefix><column>` is null where there is none, and for
    targets without key or time. Facts without key or time are ignored. Of several facts at one time the
    greatest by `take` counts (the smallest nulls), so a fact is one row per key and time before rows move.
    Targets keep their multiplicity; `take` may hold the time of the fact.
    """
    fact_time = fact_time or time
    known = [F.col(k).isNotNull() for k in keys]
    valid = F.col(fact_time).isNotNull()
    for k in known:
        valid = valid & k
    payload = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(take)])
    single = facts.where(valid).select(*keys, F.col(fact_time).alias("_time"), payload.alias("_fact")).groupBy(
        *keys, "_time").agg(F.max("_fact").alias("_fact"))
    target = F.struct(*[F.col(f"`{c}`") for c in targets.columns])
    asked = targets.select(*keys, F.col(time).alias("_time"), target.alias("_target"))
    both = single.withColumn("_side", F.lit(0)).unionByName(asked.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    when = F.col("_time").desc() if forward else F.col("_time").asc()
    dealt = _in_ranges(both, keys, [when, F.col("_side").asc()], ranges)
    # The greatest position of a range's facts is that of the last one in its order.
    newest = F.min_by if forward else F.max_by
    seen = dealt.groupBy(RANGE, *keys).agg(newest("_fact", F.when(F.col("_side") == 0, F.col("_time"))).alias("_last"))
    before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.select(RANGE, *keys, F.last("_last", ignorenulls=True).over(before).alias("_before"))
    inside = (Window.partitionBy(RANGE, *keys).orderBy(when, "_side", PLACE)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = _join_back(dealt.withColumn("_met", F.last("_fact", ignorenulls=True).over(inside)), carried, keys)
    usable = F.col("_time").isNotNull()
    fact = F.when(usable, F.coalesce("_met", "_before"))
    return found.where("_side = 1").select("_target.*", *[fact[f"c{i}"].alias(f"{prefix}{c}") for i, c in enumerate(take)])
