"""Joins of rows of any multiplicity to a table with one row per key, hot keys dealt out by measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 32
# A key with more than one row in HOT_ONE_IN is hot, so there are at most HOT_ONE_IN of them.
HOT_ONE_IN = 64
# Counters of the summary: no key above the share is missed, since a count is off by at most 4 / TRACKED of all rows.
TRACKED = 4096


def hot_keys(rows: DataFrame, key: str, one_in: int = HOT_ONE_IN) -> DataFrame:
    """(key): the keys that hold more than one row in `one_in`; keys just below may be among them.

    A summary of frequent keys of fixed size is kept by every task and the summaries are merged: no key
    is shuffled, and the result has at most 2 * one_in rows whatever the table.
    """
    top = F.expr(f"approx_top_k(`{key}`, {2 * one_in}, {TRACKED})")
    found = rows.agg(top.alias("top"), F.count("*").alias("total")).select(F.explode("top").alias("t"), "total")
    return found.where((F.col("t.count") * one_in > F.col("total")) & F.col("t.item").isNotNull()).select(F.col("t.item").alias(key))


def spread_join(rows: DataFrame, per_key: DataFrame, key: str, how: str = "inner", parts: int = PARTS) -> DataFrame:
    """Join on `key`, dealing the rows of hot keys to `parts` groups.

    per_key has one row per key; the rows of hot keys are repeated `parts` times, all others stay single.
    Rows are dealt by their position in their task, so rows that are all alike are dealt too; rows should
    come from storage, where a repeated task reads them in the same order. Null keys, which match nothing,
    are dealt as hot ones. Where per_key is small enough for Spark to broadcast, nothing is shuffled.
    """
    # At most 2 * HOT_ONE_IN rows.
    hot = F.broadcast(hot_keys(rows, key).withColumn("_hot", F.lit(True)))
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    dealt = rows.withColumn("_place", place).join(hot, key, "left")
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))

    def part(chosen: Column) -> Column:
        return F.when(chosen, F.col("_place")).otherwise(F.lit(0))

    left = dealt.withColumn("_part", part(is_hot | F.col(f"`{key}`").isNull())).drop("_place", "_hot")
    copies = F.sequence(F.lit(0), F.when(is_hot, F.lit(parts - 1)).otherwise(F.lit(0)))
    right = per_key.join(hot, key, "left").withColumn("_part", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_part"], how).drop("_part")
