"""Table summaries: measure totals, counts, schema compliance, numeric profile with exact quartiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, NumericType, StringType, StructType, TimestampType,
)

from ..functions import text
from ..functions.text import YEAR_MONTH

QUARTILES = (0.25, 0.5, 0.75)
BINS = 4096
# Size of the quantile sketch, and the share of rows around a quartile that its bracket takes in: several times its error.
SKETCH, MARGIN = 4096, 0.004
# Values of a bracket that are sorted.
SETTLED = 1_000_000


def measure_summary(df: DataFrame, entity: str = "WellID") -> DataFrame:
    """Row and entity counts and the totals of derived measures; missing totals are 0."""
    def total(c: str):
        return F.coalesce(F.sum(c), F.lit(0.0))

    return df.agg(
        F.count("*").alias("total_rows"), F.countDistinct(entity).alias("total_wells"),
        total("total_gas_equiv").alias("total_gas_equivalent"),
        total("total_liquids").alias("total_real_liquids"),
        total("GasProduction").alias("total_gas_production"),
    )


def table_size(df: DataFrame, entity: str = "WellID") -> DataFrame:
    """Rows, columns and, where the entity column exists, distinct entities."""
    entities = F.countDistinct(entity) if entity in df.columns else F.lit(None).cast("long")
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"), entities.alias("entities"))


def _reader(data_type):
    if isinstance(data_type, DoubleType):
        return text.numeric_text
    if isinstance(data_type, IntegerType):
        return text.integer_text
    if isinstance(data_type, TimestampType):
        return lambda c: F.when(c.rlike(YEAR_MONTH), F.try_to_timestamp(c, F.lit("yyyy-MM"))).otherwise(
            text.timestamp_text(c))
    return None


def schema_profile(df: DataFrame, schema: StructType) -> DataFrame:
    """Per declared column: presence, nulls, blanks, values that do not convert, numeric range.

    One aggregate over one scan, whatever the number of columns; its single row is then unfolded.
    """
    metrics, entries = [], []
    for i, f in enumerate(schema.fields):
        present = f.name in df.columns
        c = F.col(f.name) if present else F.lit(None).cast("string")
        is_text = not present or isinstance(df.schema[f.name].dataType, StringType)
        reader = _reader(f.dataType) if is_text else None
        value = reader(c) if reader else c
        number = value.cast("double") if isinstance(f.dataType, NumericType) else F.lit(None).cast("double")
        blank = F.trim(c) == "" if is_text else F.lit(False)
        failed = c.isNotNull() & ~blank & value.isNull() if reader else F.lit(False)
        metrics += [
            F.count(F.when(c.isNull(), 1)).alias(f"n{i}"), F.count(F.when(blank, 1)).alias(f"b{i}"),
            F.count(F.when(failed, 1)).alias(f"f{i}"), F.min(number).alias(f"lo{i}"), F.max(number).alias(f"hi{i}"),
        ]
        entries.append(F.struct(
            F.lit(f.name).alias("Column"), F.lit(f.dataType.simpleString()).alias("DeclaredType"),
            F.lit(not f.nullable).alias("Required"), F.lit(present).alias("Present"),
            F.col(f"n{i}").alias("Nulls"), F.col(f"b{i}").alias("Blanks"), F.col(f"f{i}").alias("FailedCasts"),
            F.col(f"lo{i}").alias("Low"), F.col(f"hi{i}").alias("High")))
    one_row = df.agg(F.count("*").alias("Rows"), *metrics)
    return one_row.select("Rows", F.explode(F.array(*entries)).alias("e")).select("Rows", "e.*")


class _Bracket:
    """What is known of the two order statistics of one quartile of one column: they lie in [low, high], `inside`
    values do, `below` are smaller. Settled once both values are known."""

    def __init__(self, column: str, p: float, n: int, nans: int):
        self.column, self.place = column, p * (n - 1)
        self.ranks = math.floor(self.place), math.ceil(self.place)
        self.low, self.high, self.below, self.inside = -math.inf, math.inf, 0, n - nans
        # NaN stands above all numbers.
        self.values = [math.nan if r >= n - nans else None for r in self.ranks]

    def settled(self) -> bool:
        return None not in self.values

    def take(self, low: float, high: float, below: int, inside: int) -> None:
        self.low, self.high, self.below, self.inside = low, high, below, inside
        if low == high:
            self.values = [low if v is None else v for v in self.values]

    def sums(self, v: Column, low: float, high: float) -> Column:
        return F.struct(F.count(F.when(v < low, 1)).alias("below"), F.count(F.when(v.between(low, high), 1)).alias("inside"))

    def choose(self, low: float, high: float, below: int, inside: int) -> None:
        """Take the sketch's bracket if its exact counts hold the ranks, else what it left out."""
        wanted = [r for r, v in zip(self.ranks, self.values) if v is None]
        if wanted[0] < below:
            self.take(self.low, high, 0, below + inside)
        elif wanted[-1] >= below + inside:
            self.take(low, self.high, below, self.inside - below)
        else:
            self.take(low, high, below, inside)

    def bin(self, v: Column) -> Column:
        """Bins of the bracket: equal parts where its ends are within a factor of two, else half octaves."""
        span = self.high - self.low
        sizes = sorted((abs(self.low), abs(self.high)))
        near = (self.low > 0) == (self.high > 0) and 0 < sizes[1] <= 2 * sizes[0]
        if near and 0 < span < math.inf:
            return F.least(F.floor((v - self.low) / span * BINS), F.lit(BINS - 1)).cast("int")
        return _half_octave(v)

    def narrow(self, bins: list[tuple[int, int, float, float]]) -> None:
        """bins: (bin, values in it, smallest, largest), in order."""
        upto, chosen = self.below, []
        for _, n, low, high in bins:
            chosen += [(k, upto, n, low, high) for k, r in enumerate(self.ranks) if self.values[k] is None and upto <= r < upto + n]
            upto += n
        if len(chosen) == 2 and chosen[0][1] != chosen[1][1]:
            # Neighbouring ranks in two bins are the largest value of one and the smallest of the next.
            self.values = [chosen[0][4], chosen[1][3]]
        else:
            _, below, inside, low, high = chosen[0]
            self.take(low, high, below, inside)

    def quartile(self) -> float:
        a, b = self.values
        return a if a == b or math.isnan(a) else a + (b - a) * (self.place - self.ranks[0])


def _inside(df: DataFrame, brackets: Sequence[_Bracket], *more) -> DataFrame:
    """(i, v, more): the values in each bracket, i its place in the list; one scan, no other values."""
    entries = []
    for i, b in enumerate(brackets):
        v = F.col(b.column).cast("double")
        fields = [F.lit(i).alias("i"), v.alias("v"), *[make(b, v).alias(name) for name, make in more]]
        entries.append(F.when(v.between(b.low, b.high), F.struct(*fields)))
    return df.select(F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("x")).select("x.*")


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max of every numeric column; columns without values are left out.

    A quartile lies between two order statistics. One scan takes the moments and a quantile sketch per column;
    the sketch gives a bracket for each quartile, and a second scan counts exactly what is below and inside. A
    bracket that misses is widened. A third scan counts the different values inside, which settles them.
    Brackets with more than SETTLED values are first narrowed by bin counts; in half octaves, then in BINS equal
    parts of what is left, which ends at one value for any distribution. Only figures per column and bin
    come to the driver; at most SETTLED values per quartile are sorted.
    """
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    values = {c: F.col(c).cast("double") for c in columns}
    moments = [F.struct(
        F.count(v).alias("n"), F.count(F.when(F.isnan(v), 1)).alias("nans"), F.avg(v).alias("mean"), F.stddev(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.kll_sketch_agg_double(F.when(~F.isnan(v), v), F.lit(SKETCH)).alias("sketch")).alias(f"c{i}") for i, v in enumerate(values.values())]
    shares = F.array(*[F.lit(max(0.0, min(1.0, p + d))) for p in QUARTILES for d in (-MARGIN, MARGIN)])
    told = df.agg(*moments).select(*[F.struct(*[f"c{i}.{x}" for x in ("n", "nans", "mean", "std", "min", "max")], F.when(
        F.col(f"c{i}.n") > F.col(f"c{i}.nans"), F.kll_sketch_get_quantile_double(f"c{i}.sketch", shares)).alias("at")).alias(f"c{i}")
        for i in range(len(columns))]).first() if columns else []
    stats = {c: row for c, row in zip(columns, told) if row["n"]}
    brackets = {(c, p): _Bracket(c, p, row["n"], row["nans"]) for c, row in stats.items() for p in QUARTILES}
    guesses = {(c, p): tuple(row["at"][2 * k : 2 * k + 2]) for c, row in stats.items() if row["at"] for k, p in enumerate(QUARTILES)}

    open_now = [key for key, b in brackets.items() if not b.settled()]
    if open_now:
        for key in open_now:
            b, row = brackets[key], stats[key[0]]
            b.low, b.high = row["min"], row["max"] if not row["nans"] else math.inf
        counts = df.agg(*[brackets[key].sums(values[key[0]], *guesses[key]).alias(f"x{i}") for i, key in enumerate(open_now)]).first()
        for key, got in zip(open_now, counts):
            brackets[key].choose(*guesses[key], got["below"], got["inside"])
    while wide := [b for b in brackets.values() if not b.settled() and b.inside > SETTLED]:
        bins = _inside(df, wide, ("bin", _Bracket.bin)).groupBy("i", "bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        found: dict[int, list] = {}
        for i, at, n, low, high in bins.collect():  # at most BINS or some 8800 half octaves per bracket
            found.setdefault(i, []).append((at, n, low, high))
        for i, rows in found.items():
            wide[i].narrow(sorted(rows))
    if left := [b for b in brackets.values() if not b.settled()]:
        each = _inside(df, left).groupBy("i", "v").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("i").orderBy("v"))
        below = F.element_at(F.array(*[F.lit(b.below) for b in left]), F.col("i") + 1)
        ranks = F.element_at(F.array(*[F.array(*map(F.lit, b.ranks)) for b in left]), F.col("i") + 1)
        placed = each.withColumn("upto", below + upto).withColumn("rank", F.explode(ranks))
        hits = placed.where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))).select("i", "rank", "v").distinct()
        for i, rank, v in hits.collect():  # two rows per bracket
            left[i].values = [v if r == rank and old is None else old for r, old in zip(left[i].ranks, left[i].values)]
    rows = [(c, s["n"], s["mean"], s["std"], s["min"], *[brackets[c, p].quartile() for p in QUARTILES], s["max"]) for c, s in stats.items()]
    names = ["mean", "std", "min", *[f"q{int(p * 100)}" for p in QUARTILES], "max"]
    return df.sparkSession.createDataFrame(rows, "Column string, count bigint, " + ", ".join(f"{n} double" for n in names))


def _half_octave(v: Column) -> Column:
    """Ascending with v: twice the binary logarithm of its size, by sign; 0 and infinities have bins of their own."""
    size = (F.floor(F.log2(F.abs(v)) * 2) + 2200).cast("int")
    return (F.when(v == float("inf"), 5000).when(v == -float("inf"), -5000)
            .when(v == 0, 0).when(v > 0, size).otherwise(-size))
