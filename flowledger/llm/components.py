"""Connected components of an edge table by hooking and pointer jumping; nothing goes to the driver.

Every node points to its smallest neighbour (or itself), pointers are doubled until they reach roots,
edges are renamed to roots, and what still joins different roots goes into the next round. Minima are
pre-aggregated, so a node with a third of all edges ships one row per task; joins are between stored
tables on unique right keys, so Spark can split a hot left key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stage


def _roots(edges: DataFrame) -> DataFrame:
    """(u, p): each node of the edges and the root its chain of smallest neighbours ends at."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    pointers = stage(both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")))
    while True:
        jump = pointers.select(F.col("u").alias("p"), F.col("p").alias("q"))
        jumped = stage(pointers.join(jump, "p").select("u", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")))
        release(pointers)
        pointers = jumped.select("u", "p")
        if jumped.where("moved").isEmpty():
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in the edge table (a, b): the smallest id that edges reach.

    Loops and repeated edges change nothing; edges with a null end are ignored; no edges, no rows.
    """
    wide = edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    rest = stage(wide.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    found = None
    while found is None or not rest.isEmpty():
        roots = _roots(rest)
        if found is None:
            merged = roots.select(F.col("u").alias("id"), F.col("p").alias("component"))
        else:
            merged = found.join(roots, found["component"] == roots["u"], "left").select(
                "id", F.coalesce("p", "component").alias("component")
            )
        merged = stage(merged)
        high = roots.select(F.col("u").alias("hi"), F.col("p").alias("high"))
        low = roots.select(F.col("u").alias("lo"), F.col("p").alias("low"))
        renamed = rest.join(high, "hi").join(low, "lo").where("high != low")
        smaller = stage(renamed.select(F.greatest("high", "low").alias("hi"), F.least("high", "low").alias("lo")).distinct())
        for old in (rest, roots, *([found] if found is not None else [])):
            release(old)
        rest, found = smaller, merged
    release(rest)
    return found
