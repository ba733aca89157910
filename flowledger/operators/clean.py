"""Schema-driven cleaning, required-field filters and entity selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DoubleType, IntegerType, StringType, StructType, TimestampType,
)

from ..functions import text
from ..schemas import PRODUCTION_COLUMNS, required_columns
from .spread import spread_join

# Columns with their own rule elsewhere (month parsing, day offset).
HANDLED_ELSEWHERE = ("DaysFromFirst", "ProductionMonth")


def _cleaned(name: str, source: DataType, target: DataType) -> Column:
    """Text is cleaned; values that already have a type are only cast."""
    c = F.col(name)
    if not isinstance(source, StringType):
        return c.cast(target)
    if isinstance(target, DoubleType):
        return text.numeric_text(c)
    if isinstance(target, IntegerType):
        return text.integer_text(c)
    if isinstance(target, TimestampType):
        return text.timestamp_text(c)
    return F.trim(c)


def apply_schema(df: DataFrame, schema: StructType, skip: Iterable[str] = HANDLED_ELSEWHERE) -> DataFrame:
    """Clean every declared column that is present, in a single projection; extra columns stay."""
    targets = {f.name: f.dataType for f in schema.fields if f.name not in set(skip)}
    return df.select([
        _cleaned(f.name, f.dataType, targets[f.name]).alias(f.name) if f.name in targets else F.col(f.name)
        for f in df.schema.fields
    ])


def drop_incomplete(df: DataFrame, schema: StructType) -> DataFrame:
    """Remove rows with a null in a required column."""
    needed = [c for c in required_columns(schema) if c in df.columns]
    return df.na.drop(subset=needed) if needed else df


def clip_negatives(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.clip_negative(c) for c in columns if c in df.columns})


def clean_dataset(df: DataFrame, table_code: str, schema: StructType,
                  clip: Sequence[str] = tuple(PRODUCTION_COLUMNS)) -> DataFrame:
    """`vol`: typed columns; `ngl`: typed columns and no negative production; others unchanged."""
    if table_code == "vol":
        return apply_schema(df, schema)
    if table_code == "ngl":
        return clip_negatives(apply_schema(df, schema), clip)
    return df


def parse_months(df: DataFrame, month: str = "ProductionMonth") -> DataFrame:
    """Month text to the first day of that month; rows without a readable month are dropped."""
    given = df.filter(F.col(month).isNotNull() & (F.col(month) != ""))
    return given.withColumn(month, text.month_text(month)).filter(F.col(month).isNotNull())


def zero_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0.0, subset=[c for c in columns if c in df.columns])


def select_entities(df: DataFrame, include: Sequence[str] | DataFrame = (),
                    exclude: Sequence[str] | DataFrame = (), entity: str = "WellID") -> DataFrame:
    """Keep the included entities (all when none is given) that are not excluded.

    Short Python lists become pushed-down IN filters; frames become semi / anti joins.
    """
    if isinstance(include, DataFrame):
        df = spread_join(df, include.select(entity).distinct(), entity, "left_semi").select(df.columns)
    elif include:
        df = df.filter(F.col(entity).isin(list(include)))
    if isinstance(exclude, DataFrame):
        df = spread_join(df, exclude.select(entity).distinct(), entity, "left_anti").select(df.columns)
    elif exclude:
        df = df.filter(~F.col(entity).isin(list(exclude)))
    return df


def with_min_history(df: DataFrame, min_rows: int, entity: str = "WellID") -> DataFrame:
    """Rows of entities that have at least `min_rows` rows.

    Counted by a map-side combined aggregate and joined back in parts (spread_join), so that an entity
    with a large share of all rows is never gathered in one task.
    """
    enough = df.groupBy(entity).agg(F.count("*").alias("_rows")).filter(F.col("_rows") >= min_rows)
    return spread_join(df, enough.select(entity), entity, "left_semi").select(df.columns)


def rename_with_replace(df: DataFrame, source: str, target: str) -> DataFrame:
    """Rename a column; an existing column of the new name gives way."""
    if source == target or source not in df.columns:
        return df
    return df.drop(target).withColumnRenamed(source, target)


def rate_columns(df: DataFrame, measures: Sequence[str]) -> dict[str, str]:
    """Measure -> column to fit: the daily rate where the table has one, else the measure."""
    return {m: f"{m}DailyRate" if f"{m}DailyRate" in df.columns else m for m in measures}


def time_column(df: DataFrame) -> str:
    return "DaysFromFirstProducing" if "DaysFromFirstProducing" in df.columns else "DaysFromFirst"
