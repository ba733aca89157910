"""Running sums and as-of lookups against brute force, and with half of all rows on one key."""

from __future__ import annotations

import bisect
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowledger.operators import ranges as G

ROWS = "k string, t int, id int, v double, n long"


def series(seed: int = 3, count: int = 600) -> list[tuple]:
    rng = random.Random(seed)
    pick = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", None])
    return [(pick(), rng.choice([None, *range(40)]) if i % 9 == 0 else rng.randrange(40), i,
             rng.choice([None, 0.5, 1.25, -2.0]), rng.randrange(5)) for i in range(count)]


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_running_sums(spark, ranges):
    rows = series()
    got = G.running_sums(spark.createDataFrame(rows, ROWS).repartition(3), ["v", "n"], ["k"], ["t", "id"], ranges=ranges)
    assert got.columns == ["k", "t", "id", "v", "n", "vCumulative", "nCumulative"]
    want, sums = {}, Counter()
    for k, t, i, v, n in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        sums[k, "v"] += v or 0.0
        sums[k, "n"] += n
        want[i] = (k, t, v, n, sums[k, "v"], sums[k, "n"])
    found = {r.id: (r.k, r.t, r.v, r.n, r.vCumulative, r.nCumulative) for r in got.collect()}
    assert found == want


def test_running_sums_of_equal_rows(spark):
    rows = spark.range(500).select(F.lit("x").alias("k"), F.lit(1).alias("t"), F.lit(2.0).alias("v"))
    got = G.running_sums(rows, ["v"], ["k"], ["t"], ranges=8)
    assert sorted(r.vCumulative for r in got.collect()) == [2.0 * (i + 1) for i in range(500)]
    assert G.running_sums(rows.limit(0), ["v"], ["k"], ["t"]).count() == 0


def looked_up(targets, facts, forward):
    best = {}
    for k, t, i, v, _ in facts:
        if k is not None and t is not None:
            value = (i, v is not None, v or 0.0, v)
            best[k, t] = max(best.get((k, t), value), value)
    times = {k: sorted(t for q, t in best if q == k) for k in {q for q, _ in best}}
    out = []
    for k, t, i, _, _ in targets:
        own = times.get(k, [])
        at = None if t is None else bisect.bisect_left(own, t) if forward else bisect.bisect_right(own, t) - 1
        fact = best[k, own[at]] if at is not None and 0 <= at < len(own) else None
        out.append((k, t, i, fact and fact[0], fact and fact[3]))
    return Counter(out)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("ranges", [1, 9, 50])
def test_as_of(spark, forward, ranges):
    targets, facts = series(5, 300) * 2, [r for r in series(6, 300) if r[1] is None or 5 < r[1] < 34 and r[1] % 3]
    frame = lambda rows: spark.createDataFrame(rows, ROWS).repartition(4)
    got = G.as_of(frame(targets).select("k", "t", "id"), frame(facts), ["k"], "t", ["id", "v"], forward=forward, prefix="fact_", ranges=ranges)
    assert got.columns == ["k", "t", "id", "fact_id", "fact_v"]
    assert Counter(tuple(r) for r in got.collect()) == looked_up(targets, facts, forward)


def test_as_of_without_facts(spark):
    targets = spark.createDataFrame(series(5, 20), ROWS).select("k", "t")
    got = G.as_of(targets, targets.limit(0).withColumn("x", F.lit(1)), ["k"], "t", ["x"]).collect()
    assert len(got) == 20 and all(r.x is None for r in got)
    assert G.as_of(targets.limit(0), targets.withColumn("x", F.lit(1)), ["k"], "t", ["x"]).count() == 0


def _largest_share(df) -> float:
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_no_task_holds_a_hot_key(spark):
    rows = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 3).alias("t"), F.lit(1.0).alias("v"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        summed = G.running_sums(rows, ["v"], ["k"], ["t"])
        assert _largest_share(summed) < 0.15
        assert summed.where("k = 'hot'").agg(F.max("vCumulative"), F.countDistinct("vCumulative")).first()[:] == (20_000.0, 20_000)
        facts = rows.select("k", (F.col("t") + 0).alias("t"), "v").distinct()
        assert _largest_share(G.as_of(rows, facts, ["k"], "t", ["v"], prefix="f_")) < 0.15
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
