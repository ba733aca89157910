"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.staging import stage

__all__ = ["LOWER", "batches_of", "free_names", "hash_lanes", "plain_text", "read_table", "release", "shared_folder", "shuffles_dropped", "stage", "words_of"]

# A-Z to a-z and nothing else.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, null text as empty, under the names doc_id and text."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def hash_lanes(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes, 128 bits together, of a value that is only compared for equality."""
    return [F.xxhash64(F.lit(lane), *columns) for lane in (1, 2)]


def free_names(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be none of the taken ones."""
    used = {c.lower() for c in taken}
    return [next(c for n in range(1, len(used) + 2) if (c := "_" * n + name) not in used) for name in names]


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space (20, 09-0D); empty for no words."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def release(df: DataFrame) -> None:
    """Delete the files of a staged intermediate that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/stage-" in path:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While a result is stored: so many rows per Arrow batch, for rows that hold whole blocks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """While results are stored: each run's shuffle files go when it ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
