"""Words of texts in bounded slices, and dense positions in a global order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, stage

# Bytes of words: digits, a-z and everything beyond ASCII; A-Z in lower case, the rest is a gap.
WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in LOWER)
SLICE_BYTES = 1 << 20


def slices(raw: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """raw in parts of about `size` bytes, cut at spaces only, so that no list of a whole long text is made."""
    at = 0
    while len(raw) - at > size:
        cut = raw.rfind(b" ", at, at + size)
        if cut <= at:
            cut = raw.find(b" ", at + size)
            if cut < 0:
                break
        yield raw[at:cut]
        at = cut
    yield raw[at:] if at else raw


def word_slices(text: str | None) -> Iterator[list[bytes]]:
    """Lower-cased words of a text, slice by slice; none for null."""
    for part in slices((text or "").encode("utf-8", "replace").translate(WORD_BYTES)):
        yield part.split()


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """The rows of df, stored, with their position (from 0) in the order, however many there are.

    Rows are dealt out by range; only the number of rows of each partition is brought together.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = stage(dealt.withColumn("position", F.monotonically_increasing_id()))
    part = F.shiftright("position", 33)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = F.broadcast(sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")))
    place = F.col("start") + F.col("position").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.withColumn("part", part).join(starts, "part").withColumn("position", place).drop("part", "start")
