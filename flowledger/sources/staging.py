"""Intermediate results that several branches read, stored once in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import shared_folder


def stage(df: DataFrame) -> DataFrame:
    """Write to the folder named by spark.checkpoint.dir and read back.

    Cuts the lineage on shared storage, so a lost executor costs a re-read; unlike checkpoint() the
    copy is columnar and keeps column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
